"""List-valued column functions (Column -> Column; no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: An item of a list literal with its quotes.
QUOTED = "(?s)" + r'"(?:[^"\\]|\\.)*"' + "|" + r"'(?:[^'\\]|\\.)*'"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---------------------------------------------------------------- FN-1
def to_list(col: Column | str, max_items: int | None = None, sep: str | None = None) -> Column:
    """Normalise a list-like string to ``array<string>``.

    Accepted encodings: a Python list literal (``['a', 'b']``), ``a|b|c``,
    ``a,b,c``, a single value, or null (-> empty array). Items are trimmed and
    empty items dropped; ``max_items`` keeps the first n. Never evaluates text.
    In a literal each item ends at the quote that opened it, so ``"Children's"`` is one
    item; a backslash keeps the character behind it.
    """
    s = F.trim(_c(col).cast("string"))
    quoted = F.regexp_extract_all(s, F.lit(QUOTED), 0)
    literal = F.transform(quoted, lambda x: F.regexp_replace(F.substring(x, F.lit(2), F.length(x) - 2), r"\\(.)", "$1"))
    if sep is not None:
        plain = F.split(s, _re_escape(sep))
    else:
        plain = F.when(s.contains("|"), F.split(s, r"\|")).otherwise(F.split(s, ","))
    arr = F.when(s.isNull() | (s == "") | (s == "nan") | (s == "[]"), F.array().cast("array<string>")) \
        .when(s.startswith("["), literal).otherwise(plain)
    arr = F.filter(F.transform(arr, lambda x: F.trim(x)), lambda x: x != "")
    if max_items:
        arr = F.slice(arr, 1, int(max_items))
    return arr


def _re_escape(sep: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?{}[]\|()" else ch for ch in sep)


# ---------------------------------------------------------------- FN-2
def compound_tokens(arr: Column | str) -> Column:
    """Spaces inside each value become '_', values joined by one space."""
    return F.array_join(F.transform(_c(arr), lambda x: F.regexp_replace(x, " ", "_")), " ")


# ---------------------------------------------------------------- FN-16 (genre label)
def first_n_joined(arr: Column | str, n: int = 2, sep: str = ", ") -> Column:
    return F.array_join(F.slice(_c(arr), 1, n), sep)
