"""Toxicity by a factorization machine over hashed terms.

score = w0 + sum w_i + sum over pairs <v_i, v_j> for the hashed terms i, j that a text holds (each once), through the
logistic function: pairs such as an insult with a mention of a group have a weight of their own, which additive weights
miss. The fit uses a bounded sample of labelled rows (``MOST_ROWS``, by a hash of the id); all hashed terms that
``LEAST_TEXTS`` texts of it hold are features, also those that say nothing of the label alone. Scores cover whole
texts of all rows.

Defined results: null and wordless texts have the score of the bias alone; labels that are null are not learned from;
an id with several labels is learned from once for each; without labelled rows the score is 0.5 for all; rows that
repeat are scored alike; other columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.llm.common import alnum_words, prepare, runs_of, stored

#: Buckets of the term hash; labelled rows in the sample; factors of a feature; texts that must hold a feature.
BUCKETS, MOST_ROWS, FACTORS, LEAST_TEXTS = 1 << 20, 20_000, 8, 5
PREFIXES, TIMES = (5, 6, 7), (2, 4)


def term_pairs(column: pa.Array, buckets: int = BUCKETS, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of each hashed term that each text holds, once, in order of the texts.

    Terms: words, proper prefixes of ``PREFIXES`` letters (compounds of a stem), and that a term occurs at least
    ``TIMES`` times. ``wanted``: buckets that matter, to leave the others out early.
    """
    words = alnum_words(column)
    if not len(words.codes):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    kinds = [_buckets(words.distinct, 0, buckets)]
    length = pc.utf8_length(words.distinct).to_numpy()
    for n in PREFIXES:
        found = pc.utf8_slice_codeunits(words.distinct, 0, n).dictionary_encode()
        kinds.append(np.where(length > n, _buckets(found.dictionary, n, buckets)[found.indices.to_numpy()], -1))
    if wanted is not None:
        useful = wanted.copy()
        for t in TIMES:
            useful |= wanted[_often(np.arange(buckets), t, buckets)]
        kinds = [np.where((x >= 0) & useful[x], x, -1) for x in kinds]
    owner = np.repeat(np.arange(len(column)), words.counts)
    parts = []
    for x in kinds:
        own = x[words.codes]
        there = own >= 0
        parts.append(owner[there] * buckets + own[there])
    pairs, count = np.unique(np.concatenate(parts), return_counts=True)
    doc, bucket = pairs // buckets, pairs % buckets
    more = [doc[count >= t] * buckets + _often(bucket[count >= t], t, buckets) for t in TIMES]
    pairs = np.unique(np.concatenate([pairs, *more]))
    return pairs // buckets, pairs % buckets


def _buckets(terms: pa.Array, kind: int, buckets: int) -> np.ndarray:
    return np.fromiter((xxhash.xxh32_intdigest(x, kind) for x in terms.cast(pa.binary()).to_pylist()), np.int64, len(terms)) % buckets


def _often(bucket: np.ndarray, times: int, buckets: int) -> np.ndarray:
    return (bucket * 2654435761 + times) % buckets


@dataclass
class FactorizationMachine:
    feature: np.ndarray  # bucket -> feature or -1
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def margin(self, doc: np.ndarray, own: np.ndarray, n: int) -> np.ndarray:
        """w0 + sum w + pairs, of n texts; ``own``: features, ``doc`` ascending."""
        out = np.full(n, self.bias) + np.bincount(doc, weights=self.linear[own], minlength=n)
        if len(doc):
            at = np.flatnonzero(np.diff(doc, prepend=-1))
            v = self.factors[own]
            out[doc[at]] += 0.5 * ((np.add.reduceat(v, at) ** 2).sum(1) - np.add.reduceat((v * v).sum(1), at))
        return out

    def score(self, column: pa.Array) -> np.ndarray:
        wanted, margins = self.feature >= 0, [np.empty(0)]
        for run in runs_of(column):
            doc, bucket = term_pairs(run, len(self.feature), wanted)
            own = self.feature[bucket]
            margins.append(self.margin(doc[own >= 0], own[own >= 0], len(run)))
        return 1 / (1 + np.exp(-np.clip(np.concatenate(margins), -35, 35)))


def fit(doc: np.ndarray, bucket: np.ndarray, label: np.ndarray, buckets: int = BUCKETS, factors: int = FACTORS,
        epochs: int = 20, rate: float = 0.1, l2: float = 5e-4, weight: float = 4.0, batch: int = 128, seed: int = 7) -> FactorizationMachine:
    """Logistic loss (a positive row counts ``weight`` times), AdaGrad over mini-batches; ``doc`` (ascending) numbers the
    rows of ``label``; every bucket that occurs is a feature."""
    n, positive = len(label), float(label.sum())
    feature = np.full(buckets, -1, np.int32)
    bias = float(np.log((positive + 1) / (n - positive + 1)))
    kept = np.unique(bucket)
    feature[kept] = np.arange(len(kept))
    rng = np.random.default_rng(seed)
    model = FactorizationMachine(feature, bias, np.zeros(len(kept)), rng.normal(0, 0.01, (len(kept), factors)))
    own = feature[bucket]
    ends = np.searchsorted(doc, np.arange(n + 1, dtype=doc.dtype))
    gb, gw, gv = 1.0, np.ones(len(kept)), np.ones((len(kept), factors))
    for _ in range(epochs if len(kept) else 0):
        for rows in np.array_split(rng.permutation(n), max(1, n // batch)):
            size = ends[rows + 1] - ends[rows]
            i = own[np.repeat(ends[rows] - np.cumsum(size) + size, size) + np.arange(size.sum())]
            d = np.repeat(np.arange(len(rows)), size)
            error = 1 / (1 + np.exp(-np.clip(model.margin(d, i, len(rows)), -35, 35))) - label[rows]
            error = np.where(label[rows] > 0, weight, 1.0) * error
            g = error.sum()
            gb += g * g
            model.bias -= rate * g / np.sqrt(gb)
            if not len(i):
                continue
            v = model.factors[i]
            sums = np.zeros((len(rows), factors))
            at = np.flatnonzero(np.diff(d, prepend=-1))
            sums[d[at]] = np.add.reduceat(v, at)
            used, place = np.unique(i, return_inverse=True)
            dw = np.bincount(place, weights=error[d], minlength=len(used)) + l2 * model.linear[used] * len(rows)
            pull = error[d][:, None] * (sums[d] - v)
            dv = np.stack([np.bincount(place, weights=pull[:, k], minlength=len(used)) for k in range(factors)], 1) + l2 * model.factors[used] * len(rows)
            gw[used] += dw * dw
            gv[used] += dv * dv
            model.linear[used] -= rate * dw / np.sqrt(gw[used])
            model.factors[used] -= rate * dv / np.sqrt(gv[used])
    return model


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          most_rows: int = MOST_ROWS, buckets: int = BUCKETS, least: int = LEAST_TEXTS, **options) -> FactorizationMachine:
    """Fit on at most ``most_rows`` labelled rows among those that ``learn`` (of the id column ``id``) admits.

    The sample is chosen from ids and labels alone; only then are its texts read. Its terms are counted on the
    cluster; what comes to the driver is which of those in ``least`` texts each of the sampled texts holds.
    """
    prepare(docs.sparkSession)
    rows = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter(F.col("label").isNotNull() & F.col("id").isNotNull()).filter(learn)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    present = rows.join(texts.select("id").distinct(), "id", "left_semi")
    sample = present.orderBy(F.xxhash64("id"), "id", "label").limit(most_rows)

    def terms(batches):
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            doc, bucket = term_pairs(batch.column(2), buckets)
            cut = np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row + np.arange(batch.num_rows)), batch.column(0).cast(pa.string()), batch.column(1), pa.ListArray.from_arrays(pa.array(cut), pa.array(bucket.astype(np.int32)))],
                ["row", "id", "label", "terms"])
            row += batch.num_rows

    found = stored(texts.join(F.broadcast(sample), "id").select("id", "label", "text").mapInArrow(terms, "row long, id string, label int, terms array<int>"), "toxicity-terms")
    rows = found.select("row", "id", "label").toArrow().sort_by([("id", "ascending"), ("label", "ascending"), ("row", "ascending")])
    label = rows.column("label").to_numpy().astype(np.float64)
    common = found.select(F.explode("terms").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("held")).filter(F.col("held") >= least)
    kept = np.zeros(buckets, bool)
    kept[common.select("bucket").toArrow().column("bucket").to_numpy()] = True

    def chosen(batches):
        for batch in batches:
            lists = batch.column(1)
            bucket = lists.flatten().to_numpy(zero_copy_only=False)
            there = kept[bucket]
            size = np.diff(np.concatenate([[0], np.cumsum(there)])[np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)])
            cut = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(cut), pa.array(bucket[there].astype(np.int32)))], ["row", "terms"])

    held = found.select("row", "terms").mapInArrow(chosen, "row long, terms array<int>").toArrow()
    # Rows in the order of their ids, each with the common terms it holds; 32-bit numbers and no more copies than
    # needed, as this is the driver's memory.
    by_row = np.argsort(held.column("row").to_numpy())
    place = by_row[np.searchsorted(held.column("row").to_numpy()[by_row], rows.column("row").to_numpy())] if held.num_rows else by_row
    lists = held.column("terms").take(pa.array(place)).combine_chunks() if held.num_rows else pa.array([], pa.list_(pa.int32()))
    del held, rows
    bucket, size = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(len(label), dtype=np.int32), size)
    pa.default_memory_pool().release_unused()
    return fit(doc, bucket, label, buckets, **options)


def toxicity(spark, model: FactorizationMachine):
    """A function of a text column: the score from 0 to 1."""
    shared = prepare(spark).sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.array(shared.value.score(column))

    return score
