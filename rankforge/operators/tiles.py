"""Dense symmetric matrices as square tiles, for models whose matrix is dense by nature.

A matrix of n rows is cut into tiles of ``TILE`` rows and columns; only tiles on and above the
diagonal are kept, each a file in the cluster's shared folder. One Spark task handles one tile and
holds four of them at most, whatever n. ``invert`` is the symmetric block sweep: step k takes the
tiles of block column k (the panel), and every other tile subtracts a product of two panel tiles,
so a step is two Spark jobs without a shuffle; the pivot tile is inverted once, by the task that
makes it, and read by the others. Several matrices of one size go through the same jobs together.
Files are written under a temporary name and then renamed, and a step reads only what the step
before has finished, so lost or repeated tasks do no harm. A first tile of few entries is kept as
its entries alone (``SparseTile``), so a sparse matrix takes the disk of its entries.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.session import ensure_checkpoint_dir

TILE = 2048
#: A first tile is kept sparse if that takes at most this share of the dense tile.
SPARSE = 0.25


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)


def pack(*arrays: np.ndarray) -> np.ndarray:
    """Arrays as bytes, each from a multiple of 8 on."""
    head = json.dumps([[a.dtype.str, a.size] for a in arrays]).encode()
    parts = [np.int64([len(head)]).tobytes(), head] + [np.ascontiguousarray(a).tobytes() for a in arrays]
    return np.frombuffer(b"".join(p + bytes(-len(p) % 8) for p in parts), np.uint8)


def unpack(kept: np.ndarray) -> list[np.ndarray]:
    """The arrays of ``pack``."""
    n, out = int(kept[:8].view(np.int64)[0]), []
    at = 8 + n + -n % 8
    for kind, size in json.loads(kept[8:8 + n].tobytes()):
        width = size * np.dtype(kind).itemsize
        out.append(kept[at:at + width].view(kind))
        at += width + -width % 8
    return out


@dataclass(frozen=True)
class SparseTile:
    """The entries of a tile by row: those of row r are ``column`` and ``value`` from ``start[r]`` to ``start[r + 1]``."""

    start: np.ndarray
    column: np.ndarray
    value: np.ndarray
    columns: int

    @staticmethod
    def of(row: np.ndarray, column: np.ndarray, value: np.ndarray, rows: int, columns: int) -> SparseTile:
        """Of entries in any order; the last of equal places counts."""
        place = row * columns + column
        order = np.argsort(place, kind="stable")
        last = np.append(place[order][1:] != place[order][:-1], True)[:len(order)]
        order = order[last]
        return SparseTile(np.searchsorted(row[order], np.arange(rows + 1)).astype(np.int64), column[order].astype(np.int32), value[order], columns)

    @property
    def rows(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(len(self.start) - 1), np.diff(self.start))

    @property
    def T(self) -> SparseTile:
        order = np.argsort(self.column.astype(np.uint16) if self.columns <= 1 << 16 else self.column, kind="stable")
        start = np.concatenate([[0], np.cumsum(np.bincount(self.column, minlength=self.columns))]).astype(np.int64)
        return SparseTile(start, self.rows[order].astype(np.int32), self.value[order], len(self.start) - 1)

    def dense(self) -> np.ndarray:
        out = np.zeros((len(self.start) - 1, self.columns))
        out[self.rows, self.column] = self.value
        return out


@dataclass(frozen=True)
class Tiles:
    """A symmetric n x n matrix; ``name`` tells the files of its steps apart, ``label`` those of matrices in one folder.

    ``shift`` is added to the diagonal whenever the first tiles (``name`` ``raw``) are read."""

    folder: str
    n: int
    size: int
    name: str = "raw"
    label: str = ""
    shift: float = 0.0

    @property
    def blocks(self) -> int:
        return -(-self.n // self.size)

    def rows(self, i: int) -> int:
        return min(self.size, self.n - i * self.size)

    def read(self, i: int, j: int, name: str | None = None) -> np.ndarray:
        """Block (i, j); below the diagonal it is the transpose of its mirror image."""
        tile = self.read_kept(i, j, name)
        if isinstance(tile, SparseTile):
            tile = tile.dense()
        if self.shift and i == j and (name or self.name) == "raw":
            tile = tile + self.shift * np.eye(len(tile))
        return tile

    def read_kept(self, i: int, j: int, name: str | None = None) -> np.ndarray | SparseTile:
        """Block (i, j) as it is kept, without ``shift``."""
        a, b = min(i, j), max(i, j)
        rows, columns = self.rows(a), self.rows(b)
        kept = self.read_raw(name or self.name, a, b, np.uint8)
        if len(kept) == 8 * rows * columns:
            tile = kept.view(np.float64).reshape(rows, columns)
        else:
            start = kept[:8 * (rows + 1)].view(np.int64)
            value, column = np.split(kept[8 * (rows + 1):], [8 * int(start[-1])])
            tile = SparseTile(start, column.view(np.int32), value.view(np.float64), columns)
        return tile if i <= j else tile.T

    def read_raw(self, name: str, i: int, j: int, dtype=np.float64) -> np.ndarray:
        """The numbers of a file, flat."""
        store, path = _opened(self.folder)
        with store.open_input_file(f"{path}/{self.label}{name}-{i}-{j}" if name != "raw" else f"{path}/raw-{i}-{j}") as f:
            return np.frombuffer(f.read(), dtype)

    def read_vector(self, name: str, i: int, dtype=np.float64) -> np.ndarray:
        """The part of a stored vector that goes with block i."""
        return self.read_raw(name, i, i, dtype)

    def write_vectors(self, name: str, values: DataFrame, dtype=np.float64) -> None:
        """``values(pos, value)``, all of a vector, one file a block."""
        def fill(rows: pa.Table) -> pa.Table:
            pos, i = rows.column("pos").to_numpy(), rows.column("block")[0].as_py()
            vector = np.zeros((1, self.rows(i)), dtype)
            vector[0, pos - i * self.size] = rows.column("value").to_numpy()
            self.write(name, i, i, vector, dtype)
            return pa.table({"done": [1]})

        values.select("pos", "value", F.floor(F.col("pos") / self.size).cast("int").alias("block")).groupBy("block").applyInArrow(fill, "done long").count()

    def write_rows(self, name: str, values: DataFrame, width: int) -> None:
        """``values(pos, vector)``, a row of ``width`` numbers each (0 where absent), one file a block; read flat by ``read_vector``."""
        def fill(rows: pa.Table) -> pa.Table:
            pos, i = rows.column("pos").to_numpy(), rows.column("block")[0].as_py()
            out = np.zeros((self.rows(i), width))
            given = [v is not None for v in rows.column("vector").to_pylist()]
            if any(given):
                out[pos[given] - i * self.size] = np.array([v for v in rows.column("vector").to_pylist() if v is not None], float)
            self.write(name, i, i, out)
            return pa.table({"done": [1]})

        # A row of nothing for every block, so that blocks without rows are written too.
        empty = values.sparkSession.createDataFrame([(i * self.size, None) for i in range(self.blocks)], "pos long, vector array<double>")
        rows = values.select("pos", "vector").unionByName(empty)
        rows.withColumn("block", F.floor(F.col("pos") / self.size).cast("int")).groupBy("block").applyInArrow(fill, "done long").count()

    def write_first(self, i: int, j: int, row: np.ndarray, column: np.ndarray, value: np.ndarray, diagonal: float = 0.0) -> None:
        """The first tile (i, j) from its entries; of a tile on the diagonal those on and above it count, and are mirrored."""
        rows, columns = self.rows(i), self.rows(j)
        if i == j:
            at, off = np.flatnonzero(row <= column), np.flatnonzero(row < column)
            row, column, value = (np.concatenate([x[at], y[off]]) for x, y in ((row, column), (column, row), (value, value)))
        own = SparseTile.of(row, column, value, rows, columns)
        if not (i == j and diagonal) and 8 * len(own.start) + 12 * len(own.value) <= SPARSE * 8 * rows * columns:
            self.write("raw", i, j, np.concatenate([x.view(np.uint8) for x in (own.start, own.value, own.column)]), np.uint8)
            return
        tile = own.dense()
        if i == j:
            tile += diagonal * np.eye(rows)
        self.write("raw", i, j, tile)

    def write(self, name: str, i: int, j: int, tile: np.ndarray, dtype=np.float64) -> None:
        store, path = _opened(self.folder)
        part = f"{path}/.{uuid.uuid4().hex}"
        with store.open_output_stream(part) as f:
            f.write(np.ascontiguousarray(tile, dtype).tobytes())
        store.move(part, f"{path}/{self.label}{name}-{i}-{j}" if name != "raw" else f"{path}/raw-{i}-{j}")


def each_tile(spark: SparkSession, places: list[tuple[int, ...]], work) -> None:
    """Run ``work(*place)`` for every place, a task each."""
    def run(batches):
        for batch in batches:
            for k in batch.column(0).to_pylist():
                work(*places[k])
                yield pa.RecordBatch.from_arrays([pa.array([1])], ["done"])

    # A partition for every place: dealt by hash, some would get several.
    df = spark.range(0, len(places), 1, len(places))
    done = df.mapInArrow(run, "done long").count()
    if done != len(places):
        raise RuntimeError(f"{done} of {len(places)} tiles were made")


def _upper(blocks: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(blocks) for j in range(i, blocks)]


def new_tiles(spark: SparkSession, n: int, size: int = TILE) -> Tiles:
    """An empty folder for blocks of n rows."""
    tiles = Tiles(f"{ensure_checkpoint_dir(spark).rstrip('/')}/tiles-{uuid.uuid4().hex}", n, size)
    store, path = _opened(tiles.folder)
    store.create_dir(path, recursive=True)
    return tiles


def store_tiles(entries: DataFrame, n: int, diagonal: float = 0.0, size: int = TILE) -> Tiles:
    """Tiles of the symmetric matrix with ``entries(i, j, v)``, i <= j (absent ones 0), plus ``diagonal`` on the diagonal."""
    return store_all_tiles(entries, n, ["v"], diagonal, size)[0]


def store_all_tiles(entries: DataFrame, n: int, values: list[str], diagonal: float = 0.0, size: int = TILE) -> list[Tiles]:
    """Of each column of ``values`` in ``entries(i, j, ...)`` a matrix, all from one shuffle."""
    spark = entries.sparkSession
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tiles-{uuid.uuid4().hex}"
    tiles = [Tiles(f"{base}/{v}", n, size) for v in values]
    for t in tiles:
        store, path = _opened(t.folder)
        store.create_dir(path, recursive=True)

    def fill(rows: pa.Table) -> pa.Table:
        a, b = rows.column("a")[0].as_py(), rows.column("b")[0].as_py()
        i, j = (rows.column(c).to_numpy() for c in ("i", "j"))
        for name, t in zip(values, tiles):
            v = rows.column(name).to_numpy()
            there = v != 0
            t.write_first(a, b, i[there] - a * size, j[there] - b * size, v[there], diagonal)
        return pa.table({"done": [1]})

    # An entry of 0 for every tile, so that tiles without entries are written too.
    empty = spark.createDataFrame([(a * size, b * size, *([0.0] * len(values))) for a, b in _upper(tiles[0].blocks)], ", ".join(["i long", "j long", *(f"{v} double" for v in values)]))
    rows = entries.select(F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), *[F.col(v).cast("double").alias(v) for v in values]).unionByName(empty)
    rows = rows.withColumn("a", F.floor(F.col("i") / size).cast("int")).withColumn("b", F.floor(F.col("j") / size).cast("int"))
    if n:
        rows.groupBy("a", "b").applyInArrow(fill, "done long").count()
    return tiles


def invert(spark: SparkSession, tiles: Tiles) -> Tiles:
    """The inverse of a positive definite matrix, by a symmetric sweep over its block columns."""
    return invert_all(spark, [tiles])[0]


def invert_all(spark: SparkSession, matrices: list[Tiles]) -> list[Tiles]:
    """The inverses of matrices of one size: each step of the sweep is one pair of jobs for all of them."""
    blocks, many = matrices[0].blocks, range(len(matrices))
    if not blocks:
        return matrices
    now = list(matrices)

    def pivot(m: int, t=tuple(now)) -> None:
        t[m].write("v0", 0, 0, np.linalg.inv(t[m].read(0, 0)))

    each_tile(spark, [(m,) for m in many], pivot)
    for k in range(blocks):
        def panel(m: int, i: int, t=tuple(now), k=k) -> None:
            column = t[m].read(i, k)
            t[m].write(f"c{k}", i, i, column)
            t[m].write(f"d{k}", i, i, column @ t[m].read_raw(f"v{k}", k, k).reshape(t[m].rows(k), -1))

        def sweep(m: int, i: int, j: int, t=tuple(now), k=k) -> None:
            own = t[m]
            kept = lambda kind, at: own.read_raw(f"{kind}{k}", at, at).reshape(own.rows(at), own.rows(k))
            if i == j == k:
                tile = -kept("v", k)
            elif j == k:
                tile = kept("d", i)
            elif i == k:
                tile = kept("d", j).T
            else:
                tile = own.read(i, j) - kept("d", i) @ kept("c", j).T
            own.write(f"s{k}", i, j, tile)
            if i == j == k + 1:  # the next step's pivot
                own.write(f"v{k + 1}", i, i, np.linalg.inv(tile))

        if blocks > 1:
            each_tile(spark, [(m, i) for m in many for i in range(blocks) if i != k], panel)
        each_tile(spark, [(m, i, j) for m in many for i, j in _upper(blocks)], sweep)
        for m in many:
            drop(now[m], [f"c{k}", f"d{k}", f"v{k}", *([now[m].name] if now[m].name != "raw" or not now[m].label else [])])
            now[m] = replace(now[m], name=f"s{k}")

    def turn(m: int, i: int, j: int, t=tuple(now)) -> None:
        t[m].write("inverse", i, j, -t[m].read(i, j))

    each_tile(spark, [(m, i, j) for m in many for i, j in _upper(blocks)], turn)
    return [replace(t, name="inverse") for t in now]


def drop(tiles: Tiles, names: list[str]) -> None:
    """Delete a step's own inputs, which nothing reads any more; raw tiles that labelled matrices share stay."""
    store, path = _opened(tiles.folder)
    ends = tuple(f"{tiles.label}{name}-" if name != "raw" else "raw-" for name in names)
    for info in store.get_file_info(fs.FileSelector(path)):
        if info.base_name.startswith(ends):
            store.delete_file(info.path)


def drop_folder(tiles: Tiles, name: str) -> None:
    """Delete a folder of one's own beside the tiles."""
    store, path = _opened(tiles.folder)
    store.delete_dir(f"{path}/{name}")
