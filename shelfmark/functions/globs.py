"""Shell globs as regular expressions that Spark evaluates on whole paths."""

import re


def _bracket(glob: str, start: int) -> tuple[str, int] | None:
    """Regex class for the bracket expression opening at ``start``, if it closes."""
    first = start + 1
    negated = glob[first:first + 1] == "!"
    if negated:
        first += 1
    # A "]" straight after the opening is a member, not the end.
    end = glob.find("]", first + 1)
    if end < 0:
        return None
    members = glob[first:end]
    spans, i = [], 0
    while i < len(members):
        low = high = members[i]
        if members[i + 1:i + 2] == "-" and i + 2 < len(members):
            high = members[i + 2]
            i += 2
        i += 1
        if low <= high:
            spans.append((low, high))
    body = "".join(f"\\x{{{ord(a):x}}}-\\x{{{ord(b):x}}}" for a, b in spans)
    if negated:
        return f"[^/{body}]", end + 1
    return (f"(?!/)[{body}]" if spans else "(?!)"), end + 1


def glob_to_regex(glob: str) -> str:
    """Regex for one path component; wildcards never cross a slash."""
    out, i = [], 0
    while i < len(glob):
        char = glob[i]
        if char == "[" and (found := _bracket(glob, i)):
            out.append(found[0])
            i = found[1]
            continue
        out.append({"*": "[^/]*", "?": "[^/]"}.get(char) or re.escape(char))
        i += 1
    return "".join(out)


def any_component_regex(globs) -> str:
    """Regex found in a relative path when any whole component matches a glob."""
    options = "|".join(glob_to_regex(g) for g in globs)
    return rf"(?s)(?:\A|/)(?:{options})(?:/|\z)"
