"""Expressions that read everything a path tells: parts, format, corpus hint.

All of them are built-in SQL expressions over a named column, so they run inside
whole-stage codegen and need no dimension table, join or broadcast.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark import schema as S
from shelfmark.functions.globs import any_component_regex


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def rel_path(path: str, root: str) -> str:
    return f"substring({path}, length({root}) + if(endswith({root}, '/'), 1, 2))"


def filename(path: str) -> str:
    return f"substring_index({path}, '/', -1)"


def top_folder(rel: str) -> str:
    return f"if(contains({rel}, '/'), substring_index({rel}, '/', 1), '')"


def extension(name: str) -> str:
    """What follows the last dot, in lower case; a dot that starts the name does not count."""
    return f"if(contains(substring({name}, 2), '.'), lower(substring_index({name}, '.', -1)), '')"


def category(ext: str) -> str:
    cases = " ".join(
        f"WHEN {ext} IN ({_quoted(exts)}) THEN '{name}'" for name, exts in S.EXTENSIONS.items()
    )
    return f"CASE {cases} ELSE '{S.OTHER_CATEGORY}' END"


def format_name(ext: str) -> str:
    known = [e for exts in S.EXTENSIONS.values() for e in exts]
    cases = " ".join(f"WHEN '{e}' THEN '{fmt}'" for e, fmt in S.SAME_FORMAT.items())
    return (
        f"CASE WHEN {ext} NOT IN ({_quoted(known)}) THEN '{S.UNKNOWN_FORMAT}'"
        f" ELSE CASE {ext} {cases} ELSE {ext} END END"
    )


def eligible(cat: str) -> str:
    return f"int({cat} IN ({_quoted(S.ELIGIBLE_CATEGORIES)}))"


def corpus_hint(text: str) -> str:
    cases = " ".join(
        "WHEN " + " OR ".join(f"contains(lower({text}), '{n}')" for n in needles)
        + f" THEN '{corpus}'"
        for corpus, needles in S.CORPUS_KEYWORDS
    )
    return f"CASE {cases} ELSE '{S.UNASSIGNED}' END"


def excluded(rel: Column, globs) -> Column:
    """True where the file or any folder above it (below the root) matches a glob."""
    if not globs:
        return F.lit(False)
    return rel.rlike(any_component_regex(globs))


def walk_key(rel: str) -> str:
    """Sort key of a top-down walk: a folder's files by name, then its subfolders."""
    return (
        f"transform(split({rel}, '/'), (part, i) ->"
        f" struct(i < size(split({rel}, '/')) - 1 AS d, part AS n))"
    )


# Columns that follow from ``path`` and ``root`` alone.
FROM_PATH = (
    "rel_path", "filename", "top_folder", "ext", "fmt", "category", "rag_eligible", "corpus_hint",
)


def described(df: DataFrame, hint_scope: str = "path") -> DataFrame:
    """Add the ``FROM_PATH`` columns.

    ``hint_scope``: ``path`` reads corpus keywords in the whole absolute path,
    ``top_folder`` only in the first folder below the root.
    """
    if hint_scope not in ("path", "top_folder"):
        raise ValueError(f"hint_scope: {hint_scope!r}")
    return df.selectExpr(
        "*",
        f"{rel_path('path', 'root')} AS rel_path",
        f"{filename('path')} AS filename",
        f"{top_folder('rel_path')} AS top_folder",
        f"{extension('filename')} AS ext",
        f"{format_name('ext')} AS fmt",
        f"{category('ext')} AS category",
        f"{eligible('category')} AS rag_eligible",
        f"{corpus_hint(hint_scope)} AS corpus_hint",
    )
