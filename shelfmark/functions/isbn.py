"""Book numbers in text, as SQL expressions: found, checked and brought to 13 digits."""

#: Ten or thirteen digits with single hyphens or spaces between; the tenth may be an X.
FOUND = "(?<![0-9])((?:97[89][- ]?)?(?:[0-9][- ]?){9}[0-9Xx])(?![0-9A-Za-z])"


def _sum(number: str, weights) -> str:
    terms = (
        f"coalesce(try_cast(substr({number}, {at}, 1) AS int), 10) * {weight}"
        for at, weight in enumerate(weights, 1)
    )
    return "(" + " + ".join(terms) + ")"


def _valid(number: str) -> str:
    ten, thirteen = _sum(number, range(10, 0, -1)), _sum(number, [1, 3] * 6 + [1])
    return f"""CASE length({number}) WHEN 10 THEN {ten} % 11 = 0
        WHEN 13 THEN NOT endswith({number}, 'X') AND {thirteen} % 10 = 0 ELSE false END"""


def _long(number: str) -> str:
    check = f"(10 - {_sum('body', [1, 3] * 6)} % 10) % 10"
    return f"""if(length({number}) = 13, {number},
        element_at(transform(array(concat('978', left({number}, 9))), body -> concat(body, {check})), 1))"""


def isbn13(text: str) -> str:
    """The first number in ``text`` whose check digit is right, as 13 digits; else NULL."""
    plain = f"transform(regexp_extract_all({text}, '{FOUND}', 1), n -> upper(regexp_replace(n, '[- ]', '')))"
    return f"get(transform(filter({plain}, n -> {_valid('n')}), n -> {_long('n')}), 0)"
