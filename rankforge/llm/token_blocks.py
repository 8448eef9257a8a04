"""Token files of patched frame-of-reference blocks (PFOR).

Ids are cut into blocks of ``BLOCK``. A block subtracts its minimum and packs the low bits of what is left at
the width that covers ``PERCENTILE`` of its ids; the others (exceptions) are listed whole with their places.
File: magic | blocks | documents (id, has an id, number of ids) | block starts | footer (JSON, its length, magic).
The starts let a reader begin at any block.

Defined results: a null text is empty and has the end id alone; documents with a null id come first; rows that
repeat an id are kept, in order of their texts; other columns of the input are not looked at; an empty table
gives no file and no rows.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankforge.llm.common import new_folder, prepare, ragged, stored
from rankforge.llm.storage import opened, own_name
from rankforge.llm.subwords import encoder

MAGIC = b"RFPFOR01"
BLOCK, PERCENTILE = 512, 0.95
#: A block's head: minimum, ids, exceptions, width.
HEAD = np.dtype([("least", "<u4"), ("n", "<u2"), ("exceptions", "<u2"), ("width", "<u2")])
#: Blocks handled at once; ids in a file before the next one begins (at a document's end).
RUN, FILE_IDS = 1024, 8 << 20


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """(m, 64 k) uint64 of at most ``width`` bits -> (m, width k) uint64 words."""
    if width == 0:
        return np.empty((len(values), 0), np.uint64)
    lanes = values.reshape(-1, 64).T.copy()
    words = np.zeros((width, lanes.shape[1]), np.uint64)
    for j in range(64):
        k, shift = divmod(j * width, 64)
        words[k] |= lanes[j] << np.uint64(shift)
        if shift + width > 64:
            words[k + 1] |= lanes[j] >> np.uint64(64 - shift)
    return words.T.reshape(len(values), -1)


def unpack(words: np.ndarray, width: int, block: int) -> np.ndarray:
    if width == 0:
        return np.zeros((len(words), block), np.uint64)
    words = words.reshape(-1, width).T
    lanes = np.empty((64, words.shape[1]), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for j in range(64):
        k, shift = divmod(j * width, 64)
        lane = words[k] >> np.uint64(shift)
        if shift + width > 64:
            lane = lane | (words[k + 1] << np.uint64(64 - shift))
        lanes[j] = lane & mask
    return lanes.T.reshape(-1, block)


def encode_blocks(ids: np.ndarray, percentile: float = PERCENTILE) -> list[bytes]:
    """Blocks of ``BLOCK`` ids (the last may be shorter), each as its bytes."""
    n = -(-len(ids) // BLOCK)
    if not n:
        return []
    rows = np.full(n * BLOCK, ids[-1], np.uint64)
    rows[:len(ids)] = ids
    rows = rows.reshape(n, BLOCK)
    least = rows.min(1)
    rows -= least[:, None]
    kth = max(0, int(np.ceil(percentile * BLOCK)) - 1)
    covered = np.partition(rows, kth, axis=1)[:, kth]
    width = np.ceil(np.log2(covered.astype(np.float64) + 1)).astype(np.int64)
    over = rows >= (np.uint64(1) << width.astype(np.uint64))[:, None]
    over.ravel()[len(ids):] = False
    count = over.sum(1)
    heads = np.zeros(n, HEAD)
    heads["least"], heads["n"], heads["exceptions"], heads["width"] = least, BLOCK, count, width
    heads["n"][-1] = len(ids) - (n - 1) * BLOCK
    packed: list[bytes] = [b""] * n
    for w in np.unique(width):
        own = np.flatnonzero(width == w)
        words = pack(rows[own] & np.uint64((1 << int(w)) - 1), int(w))
        for k, row in zip(own.tolist(), words):
            packed[k] = row.tobytes()
    where, ends = np.nonzero(over), np.concatenate([[0], np.cumsum(count)])
    places, values = where[1].astype("<u2"), rows[where].astype("<u4")
    return [
        heads[k].tobytes() + packed[k] + (places[a:b].tobytes() + values[a:b].tobytes() if b > a else b"")
        for k, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist()))
    ]


def decode_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """Ids of the blocks that begin at ``starts`` in ``data``."""
    raw = np.frombuffer(data, np.uint8)
    gather = lambda at, size: raw[at[:, None] + np.arange(size)]
    heads = gather(starts, HEAD.itemsize).copy().view(HEAD)[:, 0]
    width = heads["width"].astype(np.int64)
    rows = np.empty((len(starts), BLOCK), np.uint64)
    for w in np.unique(width):
        own = np.flatnonzero(width == w)
        words = gather(starts[own] + HEAD.itemsize, int(w) * BLOCK // 8).copy().view("<u8") if w else np.empty((len(own), 0), np.uint64)
        rows[own] = unpack(words, int(w), BLOCK)
    count = heads["exceptions"].astype(np.int64)
    if count.any():
        at = starts + HEAD.itemsize + width * BLOCK // 8
        block = np.repeat(np.arange(len(starts)), count)
        k = ragged(np.zeros(len(starts), np.int64), count)
        place = gather(at[block] + 2 * k, 2).copy().view("<u2")[:, 0]
        rows[block, place] = gather((at + 2 * count)[block] + 4 * k, 4).copy().view("<u4")[:, 0]
    rows += heads["least"].astype(np.uint64)[:, None]
    n = heads["n"]
    return (rows.ravel() if (n == BLOCK).all() else rows[np.arange(BLOCK) < n[:, None]]).astype(np.uint32)


class BlockWriter:
    """One token file; blocks go out as soon as a run of them is full."""

    def __init__(self, out, percentile: float = PERCENTILE):
        self.out, self.percentile = out, percentile
        self.at, self.n_ids, self.waiting, self.held = out.write(MAGIC), 0, 0, []
        self.starts: list[int] = []
        self.docs: list[tuple[int | None, int]] = []

    def add(self, ids: np.ndarray) -> None:
        """Ids that follow those before, of whatever documents."""
        self.held.append(ids)
        self.waiting += len(ids)
        self.n_ids += len(ids)
        if self.waiting >= RUN * BLOCK:
            self._flush(self.waiting // BLOCK * BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.empty(0, np.uint32)
        for at in range(0, n, RUN * BLOCK):
            for x in encode_blocks(ids[at:min(n, at + RUN * BLOCK)], self.percentile):
                self.starts.append(self.at)
                self.at += self.out.write(x)
        self.held, self.waiting = [ids[n:]], len(ids) - n

    def close(self) -> None:
        self._flush(self.waiting)
        docs_at = self.at
        for x in (
            np.array([d or 0 for d, _ in self.docs], "<i8"), np.array([d is not None for d, _ in self.docs], "u1"), np.array([n for _, n in self.docs], "<i8"),
        ):
            self.at += self.out.write(x.tobytes())
        foot = {"docs_at": docs_at, "n_docs": len(self.docs), "starts_at": self.at, "n_blocks": len(self.starts), "n_ids": self.n_ids, "block": BLOCK}
        self.at += self.out.write(np.array([*self.starts, docs_at], "<u8").tobytes())
        foot = json.dumps(foot).encode()
        self.out.write(foot + struct.pack("<I", len(foot)) + MAGIC)
        self.out.close()


class BlockReader:
    """Random access to a token file: the documents, and the ids of any range of blocks."""

    def __init__(self, source):
        self.source, size = source, source.size()
        tail = self._read(size - 12, 12)
        if tail[4:] != MAGIC or self._read(0, 8) != MAGIC:
            raise ValueError("not a token file")
        n = struct.unpack("<I", tail[:4])[0]
        self.foot = json.loads(self._read(size - 12 - n, n))
        n, at = self.foot["n_docs"], self.foot["docs_at"]
        raw = self._read(at, 17 * n)
        has = np.frombuffer(raw, "u1", n, 8 * n)
        self.doc_ids = [int(d) if h else None for d, h in zip(np.frombuffer(raw, "<i8", n), has)]
        self.n_tokens = np.frombuffer(raw, "<i8", n, 9 * n)
        self.starts = np.frombuffer(self._read(self.foot["starts_at"], 8 * self.foot["n_blocks"] + 8), "<u8").astype(np.int64)

    def _read(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def blocks(self, first: int, last: int) -> np.ndarray:
        """Ids of the blocks first..last-1."""
        at, end = int(self.starts[first]), int(self.starts[last])
        return decode_blocks(self._read(at, end - at), self.starts[first:last] - at)

    def runs(self) -> Iterator[np.ndarray]:
        for k in range(0, self.foot["n_blocks"], RUN):
            yield self.blocks(k, min(k + RUN, self.foot["n_blocks"]))


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                      percentile: float = PERCENTILE, file_ids: int = FILE_IDS) -> DataFrame:
    """Encode every text, end it with ``end_id``, and write token files in ascending order of the ids.

    One shuffle: a range partitioning by id. Returns the manifest, a row for each file:
    part, file, path, n_docs, n_ids, first (ids in all files before it).
    """
    prepare(docs.sparkSession)

    def write(batches):
        part, number, out = TaskContext.get().partitionId(), 0, None
        store, path = opened(folder)
        store.create_dir(path, recursive=True)
        rows = {"part": [], "file": [], "path": [], "n_docs": [], "n_ids": []}

        def closed():
            out.close()
            for k, v in zip(rows, (part, number, name, len(out.docs), out.n_ids)):
                rows[k].append(v)

        for batch in batches:
            ids, ends = encoder(vocabulary).encode(batch.column(1))
            begin = 0
            for doc, end in zip(batch.column(0).to_pylist(), ends.tolist()):
                if out is None:
                    name = own_name(part, "pfor")
                    out = BlockWriter(store.open_output_stream(f"{path}/{name}"), percentile)
                own = np.append(ids[begin:end], end_id).astype(np.uint32)
                out.docs.append((doc, len(own)))
                out.add(own)
                begin = end
                if out.n_ids >= file_ids:
                    closed()
                    out, number = None, number + 1
        if out is not None:
            closed()
        yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.string() if k == "path" else pa.int64()) for k, v in rows.items()})

    ordered = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    )
    files = stored(ordered.mapInArrow(write, "part long, file long, path string, n_docs long, n_ids long"), "tokens-manifest")
    # Sums over files within a task, then over tasks: one row a task meets in the last window.
    tasks = files.groupBy("part").agg(F.sum("n_ids").alias("all")).withColumn(
        "before", F.coalesce(F.sum("all").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    inside = F.coalesce(F.sum("n_ids").over(W.partitionBy("part").orderBy("file").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return files.withColumn("inside", inside).join(tasks.select("part", "before"), "part").select(
        "part", "file", "path", "n_docs", "n_ids", (F.col("before") + F.col("inside")).alias("first"))


def read_token_files(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """Decode the files of a manifest: doc_id, start, n_tokens, ids_crc32 of each document, from the files alone."""
    prepare(spark)

    def read(batches):
        store, path = opened(folder)
        for batch in batches:
            for name, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with store.open_input_file(f"{path}/{name}") as source:
                    reader = BlockReader(source)
                    lengths = reader.n_tokens
                    ends, crcs = np.cumsum(lengths), []
                    k, seen, crc = 0, 0, 0
                    for ids in reader.runs():
                        at = 0
                        while at < len(ids):
                            stop = min(int(ends[k]) - seen, len(ids))
                            crc = zlib.crc32(ids[at:stop].astype("<u4").tobytes(), crc)
                            at = stop
                            if seen + at == ends[k]:
                                crcs.append(crc)
                                k, crc = k + 1, 0
                        seen += len(ids)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(reader.doc_ids, pa.int64()), pa.array(first + ends - lengths, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])

    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return manifest.select("path", "first").repartition(tasks).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_and_read(docs: DataFrame, vocabulary: str, end_id: int, folder: str | None = None, **options) -> DataFrame:
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "tokens")
    return read_token_files(spark, write_token_files(docs, folder, vocabulary, end_id, **options), folder)
