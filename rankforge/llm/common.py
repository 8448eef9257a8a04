"""What the operators share: the cluster's folder, stored intermediates, folds, and words of whole texts.

Inside tasks a text is handled as its UTF-8 bytes: ``bytes.split()`` cuts at exactly the six ASCII
white-space characters, and ``bytes.lower()`` lowers exactly A-Z.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.session import ensure_checkpoint_dir

#: Texts are handed to Python in batches of at most so many rows and bytes (a single longer text is a batch of its own).
BATCH_ROWS, BATCH_BYTES = 4000, 12 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Bound the batches that go to Python, by rows and by bytes, so that long texts don't pile up there."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, what: str) -> str:
    """A fresh folder below the one that the cluster shares (``spark.checkpoint.dir``)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str, *partition_by: str) -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and read it back: later uses neither recompute it
    nor depend on the executors that made it."""
    folder = new_folder(df.sparkSession, what)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def own_name(docs: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as tell it from every column of ``docs``, whatever their case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts`` (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(parts)


def byte_texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null is the empty text."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def runs_of(column: pa.Array, most: int = 2 << 20) -> Iterator[pa.Array]:
    """Whole texts in runs of about ``most`` bytes."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)) if len(column) else np.empty(0)
    at = 0
    while at < len(column):
        base = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, base + most, side="right")))
        yield column.slice(at, end - at)
        at = end


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of each run, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)

@dataclass
class Words:
    """The words of a run of texts: ``codes`` points into ``distinct``; text k owns the next ``counts[k]`` codes."""

    codes: np.ndarray
    distinct: pa.Array
    counts: np.ndarray

    @property
    def ends(self) -> np.ndarray:
        return np.cumsum(self.counts)


def words_of(column: pa.Array, lower: bool = True) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text, A-Z lower-cased unless told otherwise; null has none."""
    column = pc.fill_null(column, "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(column) if lower else column)
    flat = lists.flatten()
    full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    ends = np.concatenate([[0], np.cumsum(full)])[np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), dtype=np.int64)] if len(lists) else np.empty(0, np.int64)
    found = flat.filter(pa.array(full)).dictionary_encode()
    return Words(found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary, np.diff(ends, prepend=0).astype(np.int64))


_SPACED = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower())


def alnum_words(column: pa.Array) -> Words:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of each text, A-Z lower-cased; null has none."""
    column = pc.fill_null(column, "").cast(pa.string())
    if column.offset or not len(column):
        column = pa.concat_arrays([column, pa.array([], pa.string())]) if len(column) else pa.array([], pa.string())
    valid, offsets, data = column.buffers()
    data = pa.py_buffer(data.to_pybytes().translate(_SPACED)) if data is not None else pa.py_buffer(b"")
    return words_of(pa.StringArray.from_buffers(len(column), offsets, data, None, 0, column.offset), lower=False)
