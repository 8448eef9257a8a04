"""Tokenizers and n-grams as column expressions (FN-3, FN-4, FN-5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.functions.vectors import once

# Accent folding pairs (accented -> plain), used by the TF-IDF tokenizer.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"
WORD_RUN = r"[\p{L}\p{N}_]{2,}"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---------------------------------------------------------------- FN-3
def tokenize_keyword(col: Column | str) -> Column:
    """Keyword-index tokens: lower-case, anything but [a-z0-9 whitespace] -> space,
    split on whitespace, keep tokens longer than one character: the runs of two or more of
    [a-z0-9], found in one pass."""
    return F.regexp_extract_all(F.lower(_c(col)), F.lit("[a-z0-9]{2,}"), 0)


def one_a_row(tokens: Column, out: str, df: DataFrame, *kept: str) -> DataFrame:
    """``kept`` and every token, a row each. Before an inner ``explode`` Spark puts a filter on the array's size, and
    makes the tokens again for it; the outer one has none, and rows without a token are dropped after it."""
    return df.select(*kept, F.explode_outer(tokens).alias(out)).where(F.col(out).isNotNull())


# ---------------------------------------------------------------- FN-4
def tokenize_tfidf(col: Column | str, stop_words: list[str] | None = None, strip_accents: bool = False) -> Column:
    """Vectoriser tokens: lower-case, maximal runs of two or more Unicode word characters
    (letters, numbers, underscore: what ``\\b\\w\\w+\\b`` matches with Unicode ``\\w``),
    optional accent folding and stop-word removal (a list the caller supplies)."""
    s = F.lower(_c(col))
    if strip_accents:
        s = F.translate(s, ACCENTED, PLAIN)
    toks = F.regexp_extract_all(s, F.lit(WORD_RUN), 0)
    if stop_words:
        stops = F.array(*[F.lit(w) for w in stop_words])
        toks = F.filter(toks, lambda x: ~F.array_contains(stops, x))
    return toks


# ---------------------------------------------------------------- FN-5
def char_ngrams(col: Column | str, n_min: int = 2, n_max: int = 3) -> Column:
    """All character n-grams of lengths n_min..n_max of the lower-cased text, in order
    (n_min-grams first), as produced by a character analyser without padding; runs of
    two or more whitespace characters are first collapsed to one space."""
    def grams(chars: Column) -> Column:
        size = F.size(chars)
        parts = [F.when(size >= n, F.transform(F.sequence(F.lit(0), size - n), lambda i: F.concat(*[F.get(chars, i + F.lit(j)) for j in range(n)])))
                 .otherwise(F.array().cast("array<string>")) for n in range(n_min, n_max + 1)]
        return F.concat(*parts)

    # The text is made ready and cut into its characters once: a substring of a long text is looked for from its start.
    return once(F.regexp_extract_all(F.regexp_replace(F.lower(_c(col)), r"\s\s+", " "), F.lit("(?s)."), 0), grams)
