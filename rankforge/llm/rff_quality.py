"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration.

Statistics of a whole text (shares of character classes, words, lines, repetition) are standardised; cosines of random
projections approximate a Gaussian kernel over them. Each task sums its rows' normal equations; the sums are added up
in two steps, so that their size, fixed by the number of features, is all that moves. The ridge scores are calibrated by
isotonic regression over counts of finely binned scores.

Defined results: null and wordless texts have statistics (zeros) and so a score; labels that are null are not learned
from; an id with several labels is learned from once for each; without labelled rows the score is 0.5 for all; rows
that repeat are scored alike; other columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.llm.common import prepare, stored, words_of

FEATURES, RIDGE, BINS, SEED = 256, 1e-3, 512, 11
#: Character classes, by UTF-8 byte: upper, lower, digit, blank, line end, sentence marks, brackets and quotes, symbols, others of ASCII, beyond it.
_CLASSES = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", " \t", "\n\r", ".,;:", "!?", "()[]{}\"'`", "#*$%&|<>@~^=+_/\\-")
_CLASS_OF = np.full(256, len(_CLASSES), np.uint8)
for _k, _chars in enumerate(_CLASSES):
    _CLASS_OF[[ord(c) for c in _chars]] = _k
_CLASS_OF[128:] = len(_CLASSES) + 1
N_CLASSES = len(_CLASSES) + 2
STATISTICS = (
    *(f"share_{k}" for k in range(N_CLASSES)), "log_words", "word_length", "distinct_words", "top_word", "repeated_next", "caps_words", "marked_words",
    "bar_words", "title_words", "words_per_line", "log_lines", "long_words", "sentence_words",
)


def statistics(column: pa.Array) -> np.ndarray:
    """A row of ``STATISTICS`` for each text."""
    column = pc.fill_null(column, "").cast(pa.string())
    n = len(column)
    out = np.zeros((n, len(STATISTICS)))
    if not n:
        return out
    sizes = pc.binary_length(column).to_numpy().astype(np.int64)
    raw = np.frombuffer(pc.binary_join(pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), column.cast(pa.binary())), b"")[0].as_py(), np.uint8)
    there = np.flatnonzero(sizes)
    begin = (np.cumsum(sizes) - sizes)[there]
    chars = np.zeros((n, N_CLASSES))
    classes = _CLASS_OF[raw]
    for k in range(N_CLASSES):
        if len(there):
            chars[there, k] = np.add.reduceat(classes == k, begin, dtype=np.int64)
    lines = np.zeros(n)
    if len(there):
        lines[there] = np.add.reduceat(raw == 10, begin, dtype=np.int64) + 1
    out[:, :N_CLASSES] = chars / np.maximum(sizes, 1)[:, None]
    words = words_of(column, lower=False)
    count = np.maximum(words.counts, 1)
    owner = np.repeat(np.arange(n), words.counts)
    if len(owner):
        d = words.distinct
        match = lambda pattern: pc.match_substring_regex(d, pattern).to_numpy(zero_copy_only=False)
        share = lambda own: np.bincount(owner, weights=own[words.codes], minlength=n) / count
        length = pc.utf8_length(d).to_numpy().astype(float)
        pairs, times = np.unique(owner * len(d) + words.codes, return_counts=True)
        top = np.zeros(n)
        np.maximum.at(top, pairs // len(d), times)
        same = np.zeros(len(owner))
        same[1:] = (owner[1:] == owner[:-1]) & (words.codes[1:] == words.codes[:-1])
        upper = match("[A-Z]")
        values = (
            np.log1p(words.counts), share(length), np.bincount(pairs // len(d), minlength=n) / count, top / count, np.bincount(owner, weights=same, minlength=n) / count,
            share(upper & ~match("[a-z]") & (length > 2)), share(match("[#*$%&]$")), share(match(r"^[|]+$")), share(match("^[A-Z][^A-Z]*$")), np.log1p(words.counts / np.maximum(lines, 1)),
            np.log1p(lines), share(length > 12), np.log1p(words.counts / (1 + chars[:, 5])),
        )
        out[:, N_CLASSES:] = np.stack(values, 1)
    return out


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    projection: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    edges: np.ndarray  # calibration: upper ends of the score bins, and the value in each
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.concatenate([np.sqrt(2 / len(self.phase)) * np.cos(z @ self.projection + self.phase), np.ones((len(z), 1))], 1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.values[np.searchsorted(self.edges, self.raw(x), side="left")] if len(self.values) else np.full(len(x), 0.5)


def pool_adjacent(sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Isotonic regression: the non-decreasing values nearest to sums / counts, weighted by counts."""
    blocks: list[list[float]] = []
    for s, c in zip(sums.tolist(), counts.tolist()):
        blocks.append([s, c, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, c, k = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + c, blocks[-1][2] + k]
    return np.concatenate([np.full(int(k), s / c) for s, c, k in blocks]) if blocks else np.empty(0)


def _partial_sums(df: DataFrame, function, size: int) -> np.ndarray:
    """The sum over all rows of ``function(statistics, label)``, a vector of ``size``: one vector a task, then one for
    each of a few groups of tasks, then theirs."""
    def own(batches):
        total = np.zeros(size)
        for batch in batches:
            x = batch.column("x")
            if len(x):
                total += function(np.stack(x.to_numpy(zero_copy_only=False)), batch.column("label").to_numpy().astype(float))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["total"])

    def add(table: pa.Table) -> pa.Table:
        return pa.table({"total": [sum(np.frombuffer(x) for x in table.column("total").to_pylist()).tobytes()]})

    parts = df.select("x", "label").mapInArrow(own, "total binary").withColumn("group", F.spark_partition_id() % 16)
    rows = parts.groupBy("group").applyInArrow(lambda t: add(t), "total binary").collect()
    return sum((np.frombuffer(bytes(r[0])) for r in rows), np.zeros(size))


def train(rows: DataFrame, n_statistics: int = len(STATISTICS), features: int = FEATURES, ridge: float = RIDGE, gamma: float | None = None, seed: int = SEED) -> QualityModel:
    """Fit on ``rows(x: statistics, label)``, all of them."""
    d = n_statistics
    sums = _partial_sums(rows, lambda x, y: np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)]), 2 * d + 1)
    n = sums[0]
    rng = np.random.default_rng(seed)
    mean = sums[1:d + 1] / max(n, 1)
    scale = np.sqrt(np.maximum(sums[d + 1:] / max(n, 1) - mean ** 2, 1e-12))
    gamma = 0.5 / d if gamma is None else gamma
    model = QualityModel(mean, scale, rng.normal(0, np.sqrt(2 * gamma), (d, features)), rng.uniform(0, 2 * np.pi, features), np.zeros(features + 1), np.empty(0), np.empty(0))
    if not n:
        return model
    k = features + 1

    def normal(x, y):
        z = model.features(x)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    found = _partial_sums(rows, normal, k * k + k)
    model.weights = np.linalg.solve(found[:k * k].reshape(k, k) + ridge * n * np.diag(np.r_[np.ones(features), 1e-9]) / features, found[k * k:])

    def binned(x, y):
        at = np.clip(((model.raw(x) + 0.5) * BINS / 2).astype(int), 0, BINS - 1)
        return np.concatenate([np.bincount(at, weights=y, minlength=BINS), np.bincount(at, minlength=BINS)])

    found = _partial_sums(rows, binned, 2 * BINS)
    there = np.flatnonzero(found[BINS:])
    model.values = np.clip(pool_adjacent(found[:BINS][there], found[BINS:][there]), 0, 1)
    # A score between two bins belongs to the nearer one.
    upper = (there + 1) * 2 / BINS - 0.5
    model.edges = (upper[:-1] + upper[1:] - 2 / BINS) / 2
    return model


def score_quality(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", **options) -> DataFrame:
    """id and score of every row; learns from the labelled rows that ``learn`` (of the id column ``id``) admits.

    The texts are read once: their statistics are stored, and both the fit and the scores are taken from there.
    """
    spark = prepare(docs.sparkSession)

    @F.arrow_udf("array<double>")
    def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            x = statistics(column)
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))

    found = stored(docs.select(F.col(id_col).alias("id"), measure(F.col(text_col)).alias("x")), "quality")
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label")).filter(F.col("label").isNotNull() & F.col("id").isNotNull()).filter(learn)
    shared = spark.sparkContext.broadcast(train(found.join(known, "id").select("x", "label"), **options))

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for x in batches:
            yield pa.array(shared.value.score(np.stack(x.to_numpy(zero_copy_only=False))) if len(x) else np.empty(0))

    return found.select("id", score("x").alias("score"))
