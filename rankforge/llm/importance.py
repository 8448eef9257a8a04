"""Target-distribution importance resampling on hashed n-grams, counted by overlapped regex scanning.

Words are runs of letters, digits and bytes from 128 on, A-Z lower-cased. Whatever stands between them is collapsed to
one space, and one pattern, run by ``regex.finditer`` with ``overlapped=True``, matches at each word between boundary
lookarounds and gives the spans of all n-grams that begin there; their CRCs are chained from one span to the next.
A document becomes a sparse count of its features by bucket, written once (its size is bounded by the number of
buckets, whatever the text's length); bucket totals are sums of those over the cluster. Gains, a number a
bucket, are the only thing that reaches the driver.

Documents are drawn by Gumbel keys: weight plus noise from a hash of seed and id, highest first, which is sampling
without replacement in proportion to exp(weight / 1000). Ranks come from a range partition by score.

Defined results: null and wordless texts have no features and weight 0; a null id counts as the empty text in the hash
and comes last among equal scores; rows of one id are rows of their own, ranked by score, then by their number of
features, and equal rows take neighbouring ranks in any order; an empty target table counts as one without features;
an empty document table gives no rows. Other columns are neither read nor returned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.llm.common import byte_texts, prepare, stored
from rankforge.operators.running import running_totals

BUCKETS, LONGEST, SEED, LEAST_WORDS = 10_000, 3, 42, 20
#: Features are counted in runs of so many matches, whatever the text's length.
RUN = 1 << 17
#: Texts whose counts are handed on together.
ROWS = 250
_SEPARATED = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower())
COUNTS = "id string, n_words long, n_features long, buckets binary, counts binary"


def collapsed(text: bytes) -> bytes:
    """The words of a text with one space before, between and behind them (a single space: no words)."""
    a = np.frombuffer(b" " + text.translate(_SEPARATED) + b" ", np.uint8)
    space = a == 32
    keep = np.ones(len(a), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    return a[keep].tobytes()


def scanner(longest: int) -> regex.Pattern:
    """Matches at each word the spans by which a run of 1 word grows to one of ``longest``."""
    return regex.compile(rb"(?<= )([^ ]+)" + rb"( [^ ]+)" * (longest - 1) + rb"(?= )")


def feature_counts(text: bytes, pattern: regex.Pattern, longest: int = LONGEST, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """(number of words, how many features fall into each bucket) of a text."""
    counts = np.zeros(buckets, np.int64)
    words = collapsed(text)
    n = words.count(b" ") - 1
    if n < 1:
        return 0, counts
    # Filler words close the text, so that its last words match as well; what holds a filler is taken off below.
    matches = pattern.finditer(words + b"\x01 " * (longest - 1), overlapped=True, concurrent=False)
    for first in range(0, n, RUN):
        crcs: list[int] = []
        add = crcs.append
        for match in islice(matches, RUN):
            crc = 0
            for span in match.groups():
                crc = crc32(span, crc)
                add(crc)
        grid = np.array(crcs, np.uint32).reshape(-1, longest)
        inside = np.arange(first, first + len(grid))[:, None] + np.arange(longest) < n
        counts += np.bincount((grid[inside] if first + len(grid) > n - longest + 1 else grid.ravel()) % np.uint32(buckets), minlength=buckets)
    return n, counts


def _counter(longest: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = scanner(longest)
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            words, features, which, many = [], [], [], []
            for text in byte_texts(batch.column(1)):
                n, counts = feature_counts(text, pattern, longest, buckets)
                own = np.flatnonzero(counts)
                words.append(n)
                features.append(int(counts.sum()))
                # As differences, and mostly ones: both shrink well in the file.
                which.append(np.diff(own, prepend=0).astype("<u4").tobytes())
                many.append(counts[own].astype("<u8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(features, pa.int64()), pa.array(which, pa.binary()), pa.array(many, pa.binary())],
                ["id", "n_words", "n_features", "buckets", "counts"])

    return run


def _sparse(buckets: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(np.frombuffer(buckets, "<u4"), dtype=np.int64), np.frombuffer(counts, "<u8").astype(np.int64)


def count_features(docs: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_features, buckets, counts) of every row, the last two for ``bucket_totals`` and ``weights``; stored."""
    prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return stored(rows.mapInArrow(_counter(longest, buckets), COUNTS.replace("id string", f"id {kind}")), "features")


def bucket_totals(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all rows by bucket: summed by task, then by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for which, many in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own, counts = _sparse(which, many)
                total[own] += counts
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(total[own], pa.int64())], ["bucket", "n"])

    sums = features.select("buckets", "counts").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket: 1000 times the log of how much likelier it is in the target than in the source, rounded down."""
    size = len(source)
    s, t, all_s, all_t = source.astype(float), target.astype(float), float(source.sum()) + size, float(target.sum()) + size
    return np.array([math.floor(1000 * math.log(a)) for a in ((t + 1) * all_s / ((s + 1) * all_t)).tolist()], np.int64)


def _weigher(gains: np.ndarray):
    @F.arrow_udf("long")
    def weight(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for which, many in batches:
            out = []
            for a, b in zip(which.to_pylist(), many.to_pylist()):
                own, counts = _sparse(a, b)
                out.append(int((gains[own] * counts).sum()))
            yield pa.array(out, pa.int64())

    return weight


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, rounded down, from the first 32 bits of sha256 of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = LEAST_WORDS, longest: int = LONGEST, buckets: int = BUCKETS,
             seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """(id, n_features, weight, score, rank) of every row. Of those with ``least_words`` words or more, ``percent`` in
    a hundred are drawn, the highest scores; ``rank`` is null for the others."""
    features = count_features(docs, longest, buckets, id_col, text_col)
    wanted = count_features(target.select(F.lit(0).alias("id"), F.col(target_col).alias("text")), longest, buckets, "id", "text")
    gains = bucket_gains(bucket_totals(features, buckets), bucket_totals(wanted, buckets))
    weighed = features.select("id", "n_words", "n_features", _weigher(gains)("buckets", "counts").alias("weight"))
    scored = stored(weighed.withColumn("score", F.col("weight") + noise(F.col("id"), seed))
                    .withColumn("salt", F.xxhash64(F.monotonically_increasing_id())), "scores")
    able = scored.where(F.col("n_words") >= least_words)
    most = percent * able.count() // 100
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("n_features"), F.col("salt")]
    ranked = running_totals(able.withColumn("one", F.lit(1).cast("long")), order, ["one"], keep=lambda d: stored(d, "ranked"))
    columns = ["id", "n_features", "weight", "score"]
    return (ranked.select(*columns, F.when(F.col("one_to") <= most, F.col("one_to")).alias("rank"))
            .unionByName(scored.where(F.col("n_words") < least_words).select(*columns, F.lit(None).cast("long").alias("rank"))))
