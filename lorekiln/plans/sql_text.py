"""SQL of text functions that several queries share."""

from __future__ import annotations

from lorekiln.functions import text as T

#: Label keys once more: the brackets go in a fold over nine levels.
_QUOTES = "[" + T.OUTER_QUOTES.replace("'", "''") + r" ]+"
_BARE = rf"regexp_replace({{0}}, '^{_QUOTES}|{_QUOTES}$', '', 'g')".replace("{_QUOTES}", _QUOTES)
_UNPAIRED = (
    "list_reduce(list_prepend({0}, list_transform(range(0, 9), lambda i: '')), lambda a, b: CASE WHEN (left(a, 1) || right(a, 1)) IN ('()', '[]', '{{}}')"
    " AND trim(a[2:length(a) - 1]) <> '' THEN trim(a[2:length(a) - 1]) ELSE a END)"
)


def sql_basic(text: str) -> str:
    """SQL of :func:`lorekiln.functions.text.normalize_basic`."""
    x = f"coalesce({text}, '')"
    for letter, name in T.GREEK_LETTERS.items():
        x = f"replace({x}, '{letter}', '{name}')"
    x = rf"trim(regexp_replace(translate({x}, '{T.DASHES}', '-------'), '[ \t\n\r\f\x0B]+', ' ', 'g'))"
    x = _UNPAIRED.format(_BARE.format(x))
    x = f"regexp_replace(regexp_replace(translate(lower({x}), 'ё', 'е'), ' *- *', '-', 'g'), ' */ *', '/', 'g')"
    return _UNPAIRED.format(_BARE.format(f"trim(regexp_replace({x}, '[ .,:;]+$', ''))"))


SQL_QUOTE_KEY = r"trim(regexp_replace(lower(translate(coalesce({0}, ''), chr(160) || 'ёЁ', ' еЕ')), '[ \t\n\r\f\x0B]+', ' ', 'g'))"
