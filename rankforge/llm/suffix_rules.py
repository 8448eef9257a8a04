"""Quality rules on repetition inside a text, by suffix arrays.

A suffix array over the words of a run of texts is built by prefix doubling (texts never share a suffix rank, so
nothing is compared across them). Longest common prefixes of neighbouring suffixes come from the ranks kept at each
doubling. The interval of suffixes that share a longest prefix of at least ``LEAST`` words is a repeat; a suffix
whose left neighbour starts a longer repeat that holds it adds nothing, so that maximal repeats are left. The union
of their spans is the covered part. A text is rejected when its covered fraction or its longest repeat is too large.

Defined results: a null text has no words and fails the base rules; ties need no order; every row is judged for
itself, repeated ones alike; other columns stay as they are; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.llm.common import byte_texts, prepare, runs_of, words_of

#: Words that a repeat must have to count as covering; most of a text that repeats may cover; most words of a repeat
#: as a share of the text. Base rules: least words, most percent of words in 3-word windows found twice.
LEAST, MOST_COVERED, MOST_LONGEST = 8, 0.30, 0.25
LEAST_WORDS, MOST_REPEATED = 50, 50
SYMBOLS = b"#*$%&|<>"  # fixed values of the rule
FIELDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, covered_words long, longest_repeat long, kept boolean"


def repeat_lengths(codes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For each position, the words of the longest prefix of its suffix that occurs elsewhere in the same text."""
    n = len(codes)
    longest = np.zeros(n, np.int64)
    if n < 2:
        return longest
    # rank 0 stands for the end of a text; equal ranks: equal prefixes of h words (in the same text)
    _, rank = np.unique(owner * (int(codes.max()) + 1) + codes, return_inverse=True)
    rank = rank.astype(np.int64) + 1
    last = np.searchsorted(owner, owner, side="right")  # where each position's text ends
    ranks, h = [rank], 1
    live = np.arange(n)
    while True:
        counts = np.bincount(rank[live], minlength=1)
        live = live[counts[rank[live]] > 1]  # the others are told apart already
        if not len(live):
            break
        after = live + h
        follow = np.where(after < last[live], rank[np.minimum(after, n - 1)], 0)
        order = np.lexsort((follow, rank[live]))
        a, b = rank[live][order], follow[order]
        new = np.empty(len(live), bool)
        new[0] = True
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        first = np.empty(len(live), bool)
        first[0] = True
        first[1:] = a[1:] != a[:-1]
        # a group keeps the ranks from its old one on, so ranks stay ordered: groups were numbered with gaps
        place = np.arange(len(live))
        group = np.maximum.accumulate(np.where(first, place, 0))
        inside = np.maximum.accumulate(np.where(new, place, 0)) - group
        if h == 1:
            rank = _spread(rank)
            ranks[0] = rank
            a = rank[live][order]
        rank = rank.copy()
        rank[live[order]] = a + inside
        ranks.append(rank)
        h *= 2
    if len(ranks) == 1:
        return longest
    if h == 1:
        return longest
    order = np.argsort(rank, kind="stable")
    i, j, lcp = order[:-1].copy(), order[1:].copy(), np.zeros(n - 1, np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        step = 1 << level
        there = (i < n) & (j < n)
        same = np.zeros(n - 1, bool)
        same[there] = ranks[level][i[there]] == ranks[level][j[there]]
        lcp[same] += step
        i[same] += step
        j[same] += step
    longest[order[:-1]] = lcp
    longest[order[1:]] = np.maximum(longest[order[1:]], lcp)
    return longest


def _spread(rank: np.ndarray) -> np.ndarray:
    """Dense ranks to ranks with room for each group's members: the number of positions of a smaller rank, plus 1."""
    counts = np.bincount(rank)
    return (np.cumsum(counts) - counts)[rank] + 1


def spans_cover(start: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in a span."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, np.minimum(start + length, n), -1)
    return np.cumsum(edge[:-1]) > 0


def maximal_repeats(longest: np.ndarray, owner: np.ndarray, least: int) -> np.ndarray:
    """Positions where a maximal repeat of at least ``least`` words begins: not just the rest of the one before."""
    inner = np.zeros(len(longest), bool)
    inner[1:] = (longest[:-1] == longest[1:] + 1) & (owner[:-1] == owner[1:])
    return np.flatnonzero((longest >= least) & ~inner)


def judge_run(column: pa.Array, least: int, most_covered: float, most_longest: float) -> pa.StructArray:
    """The verdicts of a run of texts."""
    column = pc.fill_null(column, "")
    words = words_of(column, lower=False)
    counts, n = words.counts, len(column)
    owner = np.repeat(np.arange(n), counts)
    total = len(owner)
    longest = repeat_lengths(words.codes, owner)
    ends = words.ends
    windows = np.flatnonzero(longest >= 3)
    repeated = spans_cover(windows, np.full(len(windows), 3), total)
    begin = maximal_repeats(longest, owner, least)
    covered = spans_cover(begin, longest[begin], total)
    of = lambda x: np.bincount(owner, weights=x, minlength=n).astype(np.int64)
    most = np.zeros(n, np.int64)
    np.maximum.at(most, owner, longest)
    chars = pc.utf8_length(words.distinct).to_numpy(zero_copy_only=False)[words.codes] if total else np.empty(0)
    raw = byte_texts(column)
    symbols = np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in raw], np.int64)
    lines = np.array([_dup_lines(t) for t in raw], np.int64)
    repeat_words, covered_words = of(repeated), of(covered)
    most[most < least] = 0
    failed = (counts < LEAST_WORDS) | (100 * repeat_words > MOST_REPEATED * counts)
    share = np.maximum(counts, 1)
    kept = ~failed & (covered_words <= most_covered * share) & (most <= most_longest * share)
    values = (counts, of(chars), symbols, lines, repeat_words, failed, covered_words, most, kept)
    return pa.StructArray.from_arrays([pa.array(v) for v in values], [f.split()[0] for f in FIELDS.split(", ")])


def _dup_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    if b"\n" not in text:
        return 0
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))



def repetition(least: int = LEAST, most_covered: float = MOST_COVERED, most_longest: float = MOST_LONGEST):
    """A function of a text column that gives the struct ``FIELDS``."""

    @F.arrow_udf(FIELDS)
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            found = [judge_run(x, least, most_covered, most_longest) for x in runs_of(column)]
            yield pa.concat_arrays(found) if found else judge_run(column, least, most_covered, most_longest)

    return judge


def judge_repetition(docs: DataFrame, text_col: str = "text", as_col: str = "repetition", **limits) -> DataFrame:
    """Every row with its verdict in the struct column ``as_col``; no shuffle."""
    prepare(docs.sparkSession)
    return docs.withColumn(as_col, repetition(**limits)(F.col(text_col)))
