"""Benchmark decontamination by winnowing.

Benchmark windows are ``WINDOW`` consecutive words of an item (all of them where an item has fewer). Of every run of
w consecutive k-gram hashes the least is kept as a fingerprint, on both sides by the same rule; with k + w - 1 words
in a window, texts that share a window share a fingerprint, so no shared window is missed. Document fingerprints
are joined with the benchmark's; around each hit the windows that hold it are compared word by word, which extends
the hit over whatever the texts share.

The benchmark's index is broadcast in blocks of at most ``BLOCK_WORDS`` words, each held against all documents in
a pass of its own; a benchmark of one block needs one pass and no shuffle.

Defined results: null and wordless texts have no words, no hits; an item without words has no window; an item id that
is null counts as the empty text, one that repeats counts once; document rows are judged each for itself; other columns
stay as they are; empty tables give no rows, or rows without hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.llm.common import alnum_words, prepare, ragged

WINDOW, BLOCK_WORDS = 10, 1_000_000
FIELDS = "n_words long, spans array<struct<start: long, end: long>>, items array<string>"
NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)


def gram_hashes(codes: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """A hash of the k codes from each position on (k - 1 fewer positions than codes)."""
    n = max(0, len(codes) - k + 1)
    h = np.full(n, np.uint64(0x9E3779B97F4A7C15 + salt), np.uint64)
    for j in range(k):
        h = (h ^ codes[j:j + n].astype(np.uint64)) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
    return np.minimum(h, NEVER - np.uint64(1))


def winnow(hashes: np.ndarray, w: int) -> np.ndarray:
    """Positions kept: the least (the last of equals) of each run of w hashes; ``NEVER`` is never kept."""
    n = len(hashes) - w + 1
    if n < 1:
        return np.empty(0, np.int64)
    least, at = hashes[:n].copy(), np.arange(n)
    for j in range(1, w):
        lower = hashes[j:j + n] <= least
        least = np.where(lower, hashes[j:j + n], least)
        at = np.where(lower, np.arange(j, j + n), at)
    return np.unique(at[least != NEVER])


@dataclass
class WindowIndex:
    """Windows of one length: sorted fingerprints, and the distinct windows by their hashes."""

    length: int
    salt: int
    prints: np.ndarray
    hashes: np.ndarray
    windows: np.ndarray
    items: list[list[str]]

    @property
    def k(self) -> int:
        return (self.length + 1) // 2

    @property
    def w(self) -> int:
        return self.length - self.k + 1


@dataclass
class BenchmarkIndex:
    """Codes of the benchmark's words from 1 on (0: any other word), and its windows by length."""

    codes: dict[bytes, int]
    by_length: list[WindowIndex]


def build_index(items: list[tuple[str, list[bytes]]], window: int = WINDOW) -> BenchmarkIndex:
    codes: dict[bytes, int] = {}
    grouped: dict[int, dict[bytes, set[str]]] = {}
    prints: dict[int, list[np.ndarray]] = {}
    for item, words in items:
        if not words:
            continue
        own = np.array([codes.setdefault(x, len(codes) + 1) for x in words], np.int32)
        m = min(window, len(own))
        for i in range(len(own) - m + 1):
            grouped.setdefault(m, {}).setdefault(own[i:i + m].tobytes(), set()).add(item)
        k = (m + 1) // 2
        hashes = gram_hashes(own, k)
        prints.setdefault(m, []).append(hashes[winnow(hashes, m - k + 1)])
    by_length = []
    for m, windows in sorted(grouped.items()):
        matrix = np.frombuffer(b"".join(windows), np.int32).reshape(-1, m)
        owners = [sorted(x) for x in windows.values()]
        for salt in range(100):  # two different windows must not share a hash
            hashes = _row_hashes(matrix, salt)
            if len(np.unique(hashes)) == len(hashes):
                break
        order = np.argsort(hashes)
        by_length.append(WindowIndex(m, salt, np.unique(np.concatenate(prints[m])), hashes[order], matrix[order], [owners[i] for i in order.tolist()]))
    return BenchmarkIndex(codes, by_length)


def _row_hashes(matrix: np.ndarray, salt: int) -> np.ndarray:
    h = np.full(len(matrix), np.uint64(0x9E3779B97F4A7C15 + salt), np.uint64)
    for j in range(matrix.shape[1]):
        h = (h ^ matrix[:, j].astype(np.uint64)) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
    return h


def occurrences(codes: np.ndarray, owner: np.ndarray, index: WindowIndex) -> tuple[np.ndarray, np.ndarray]:
    """(position, window) of every place where a window of the index stands in a text."""
    nothing = np.empty(0, np.int64), np.empty(0, np.int64)
    k, m, n = index.k, index.length, len(codes)
    if n < m:
        return nothing
    unknown = np.concatenate([[0], np.cumsum(codes == 0)])
    whole = (unknown[k:] == unknown[:n - k + 1]) & (owner[:n - k + 1] == owner[k - 1:])
    if not whole.any():
        return nothing
    hashes = np.where(whole, gram_hashes(codes, k), NEVER)
    kept = winnow(hashes, index.w)
    kept = kept[_find(index.prints, hashes[kept]) >= 0]
    if not len(kept):
        return nothing
    # Extend: all windows that hold the k-gram, compared word by word.
    start = np.unique(ragged(kept - (m - k), np.full(len(kept), m - k + 1)))
    start = start[(start >= 0) & (start <= n - m)]
    start = start[(owner[start] == owner[start + m - 1]) & (unknown[start + m] == unknown[start])]
    rows = codes[start[:, None] + np.arange(m)]
    at = _find(index.hashes, _row_hashes(rows, index.salt))
    same = at >= 0
    same[same] = (index.windows[at[same]] == rows[same]).all(1)
    return start[same], at[same]


def _find(sorted_: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)
    return np.where(sorted_[at] == values, at, -1)


def find_hits(column: pa.Array, index: BenchmarkIndex, before: list | None = None) -> pa.StructArray:
    """``FIELDS`` of each text; ``before``: what earlier blocks of the benchmark have found."""
    words = alnum_words(column)
    n = len(column)
    known = np.array([index.codes.get(x, 0) for x in words.distinct.cast(pa.binary()).to_pylist()] or [0], np.int32)
    codes, owner, begin = known[words.codes], np.repeat(np.arange(n), words.counts), words.ends - words.counts
    spans: dict[int, list[tuple[int, int]]] = {}
    items: dict[int, set[str]] = {}
    for own in index.by_length:
        at, window = occurrences(codes, owner, own)
        docs = owner[at]
        for d, a in zip(docs.tolist(), (at - begin[docs]).tolist()):
            spans.setdefault(d, []).append((a, a + own.length))
        for d, x in set(zip(docs.tolist(), window.tolist())):
            items.setdefault(d, set()).update(own.items[x])
    for d, old in enumerate(before or []):
        if old and old["spans"]:
            spans.setdefault(d, []).extend((x["start"], x["end"]) for x in old["spans"])
            items.setdefault(d, set()).update(old["items"])
    merged = [_merge(spans[d]) if d in spans else [] for d in range(n)]
    kinds = [pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.list_(pa.string())]
    values = (words.counts, [[{"start": a, "end": b} for a, b in x] for x in merged], [sorted(items.get(d, ())) for d in range(n)])
    return pa.StructArray.from_arrays([pa.array(v, t) for v, t in zip(values, kinds)], ["n_words", "spans", "items"])


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def benchmark_blocks(benchmark: DataFrame, id_col: str, text_col: str, most: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items with their words, in blocks of about ``most`` words; a part of the table is fetched at a time."""
    block, size = [], 0
    for row in benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col).cast("string")).toLocalIterator():
        words = alnum_words(pa.array([row[1]], pa.string()))
        distinct = words.distinct.cast(pa.binary()).to_pylist()
        block.append((row[0], [distinct[c] for c in words.codes.tolist()]))
        size += len(words.codes)
        if size >= most:
            yield block
            block, size = [], 0
    if block:
        yield block


def mark_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, id_col: str = "doc_id",
                       text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", as_col: str = "contamination") -> DataFrame:
    """Every row with the struct ``FIELDS`` in ``as_col``: its words, the word spans that benchmark windows cover,
    and the items that those windows are of (sorted as strings)."""
    spark = prepare(docs.sparkSession)
    for k, block in enumerate([*benchmark_blocks(benchmark, item_col, item_text_col, block_words)] or [[]]):
        shared = spark.sparkContext.broadcast(build_index(block, window))
        docs = docs.withColumn(as_col, _marker(shared)(F.col(text_col), F.col(as_col)) if k else _first_marker(shared)(F.col(text_col)))
    return docs


def _first_marker(shared):
    @F.arrow_udf(FIELDS)
    def mark(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield find_hits(column, shared.value)

    return mark


def _marker(shared):
    @F.arrow_udf(FIELDS)
    def mark(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for column, before in batches:
            yield find_hits(column, shared.value, before.to_pylist())

    return mark


def n_hit(found: Column) -> Column:
    """Words inside an occurrence of a window."""
    return F.aggregate(found["spans"], F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
