"""Near-duplicates by SimHash fingerprints and BK-trees.

A fingerprint has 64 bits; two texts link where theirs differ in at most ``radius`` bits. Equal fingerprints are one
node from the start. To find the links of a fingerprint, only shards that can hold one are searched: its bits are cut
into ``radius + 1`` bands, and fingerprints within the radius agree on a band at least, so each shard takes the
fingerprints of some values of one band. A shard is a BK-tree of bounded size (children keyed by their Hamming distance
to the parent), and a search follows only edges within the radius of the distance to the node. A shard that a hot band
value makes too large is cut into several trees, each searched with all fingerprints of the shard.

A shard gives back a spanning forest of its links, never all pairs; components are then found by alternating star
contraction over the forests' edges, each round written to the shared folder.

Defined results: null and wordless texts have fingerprint zero and link like any other; fewer words than a shingle are
one shingle; rows with a null id are in a component too, whose id is the smallest that is not null (null if all are);
rows that repeat an id each get a row; other columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.llm.common import own_name, prepare, stored, words_of

#: Fingerprints in a tree; queries that search it at once.
TREE, BLOCK = 4096, 2048
SEED = 42


def fingerprints(column: pa.Array, shingle: int) -> np.ndarray:
    """The fingerprint of each text, as int64."""
    words = words_of(column)
    n = len(column)
    out = np.zeros(n, np.uint64)
    if not len(words.codes):
        return out.view(np.int64)
    # All words of the run, each followed by a space; a shingle is a slice of that.
    distinct = words.distinct.cast(pa.binary())
    text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words.codes)], pa.int32()), distinct.take(pa.array(words.codes))), b" ")[0].as_py()
    ends = np.cumsum(pc.binary_length(distinct).to_numpy()[words.codes].astype(np.int64) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    many = np.maximum(words.counts - shingle + 1, np.minimum(words.counts, 1))  # shingles of each text
    last = np.cumsum(many)
    doc = np.repeat(np.arange(n), many)
    first_word = (words.ends - words.counts)[doc] + np.arange(len(doc)) - (last - many)[doc]
    last_word = np.minimum(first_word + shingle, words.ends[doc]) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(text[a:b], SEED) for a, b in zip(starts[first_word].tolist(), ends[last_word].tolist())), np.uint64, len(doc))
    there = np.flatnonzero(many)
    begins = (last - many)[there]
    step = 1 << 17  # bits of so many hashes at once
    ones = np.zeros((n, 64), np.int64)
    for at in range(0, len(hashes), step):
        end = min(at + step, len(hashes))
        bits = np.unpackbits(hashes[at:end].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        own = there[(begins < end) & (begins + many[there] > at)]
        cut = np.maximum((last - many)[own], at) - at
        ones[own] += np.add.reduceat(bits, cut, axis=0, dtype=np.int32)
    bits = 2 * ones > many[:, None]
    return np.packbits(bits, axis=1).view(">u8")[:, 0].astype(np.uint64).view(np.int64)


class BKTree:
    """A BK-tree over distinct 64-bit points; ``child[node, distance]`` is a node or -1."""

    def __init__(self, points: np.ndarray):
        points = points.view(np.uint64)
        n = len(points)
        self.points = points
        self.child = np.full((n, 65), -1, np.int32)
        # Level by level: the first point of each group is the node that the group hangs on, the rest go by distance.
        rest, group = np.arange(1, n), np.zeros(max(0, n - 1), np.int64)
        while len(rest):
            distance = np.bitwise_count(points[rest] ^ points[group]).astype(np.int64)
            key = group * 65 + distance
            order = np.argsort(key, kind="stable")
            key, rest = key[order], rest[order]
            first = np.concatenate([[True], key[1:] != key[:-1]])
            heads = rest[first]
            self.child[key[first] // 65, key[first] % 65] = heads
            group = heads[np.cumsum(first) - 1][~first]
            rest = rest[~first]

    def within(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, point) indices at a distance of at most ``radius``."""
        queries = queries.view(np.uint64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        q, node = np.arange(len(queries)), np.zeros(len(queries) if len(self.points) else 0, np.int64)
        q = q[:len(node)]
        while len(q):
            distance = np.bitwise_count(queries[q] ^ self.points[node]).astype(np.int64)
            hit = distance <= radius
            found.append((q[hit], node[hit]))
            below: list[tuple[np.ndarray, np.ndarray]] = []
            for by in range(-radius, radius + 1):
                edge = distance + by
                ok = (edge >= 0) & (edge <= 64)
                child = np.where(ok, self.child[node, np.clip(edge, 0, 64)], -1)
                there = child >= 0
                below.append((q[there], child[there].astype(np.int64)))
            q, node = (np.concatenate(x) for x in zip(*below))
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64), np.empty(0, np.int64))


def forest(points: np.ndarray, members: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of all ``points`` to those marked ``members``, as (point, smallest of its links' set) without loops."""
    parent = np.arange(len(points))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    own = np.flatnonzero(members)
    tree = BKTree(points[own])
    for at in range(0, len(points), BLOCK):
        q, p = tree.within(points[at:at + BLOCK], radius)
        q, p = q + at, own[p]
        apart = q != p
        for a, b in zip(q[apart].tolist(), p[apart].tolist()):
            a, b = root(a), root(b)
            if a != b:
                a, b = (a, b) if points[a] < points[b] else (b, a)
                parent[b] = a
    roots = np.array([root(x) for x in range(len(points))], np.int64)
    linked = np.flatnonzero(roots != np.arange(len(points)))
    return points[linked], points[roots[linked]]


def link_forests(nodes: DataFrame, radius: int, tree: int = TREE) -> DataFrame:
    """Edges (a, b) that connect whatever distinct fingerprints ``nodes(fp)`` are linked within the radius."""
    shards = max(1, -(-nodes.count() // tree))
    bands = 1 if shards == 1 else radius + 1
    cuts = [round(64 * k / bands) for k in range(bands + 1)]
    keys = F.array(*[
        F.pmod(F.xxhash64(F.lit(k), F.shiftrightunsigned(F.shiftleft("fp", 64 - b), 64 - b + a)), F.lit(shards)) + F.lit(k * shards)
        for k, (a, b) in enumerate(zip(cuts, cuts[1:]))
    ])
    rows = stored(nodes.select("fp", F.explode(keys).alias("shard")), "simhash-shards")
    sizes = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    trees = F.ceil(F.col("n") / F.lit(2 * tree)).cast("int")  # an ordinary shard stays one tree
    dealt = (
        rows.join(sizes, "shard")
        .select("fp", "shard", F.pmod(F.xxhash64("fp", F.lit("tree")), trees).alias("home"), F.explode(F.sequence(F.lit(0), trees - 1)).alias("tree"))
        .select("fp", "shard", "tree", (F.col("home") == F.col("tree")).alias("member"))
    )

    def links(rows: pa.Table) -> pa.Table:
        points, first = np.unique(rows.column("fp").to_numpy(), return_index=True)
        a, b = forest(points, rows.column("member").to_numpy(zero_copy_only=False)[first], radius)
        return pa.table({"a": a, "b": b})

    return dealt.groupBy("shard", "tree").applyInArrow(links, "a long, b long")


def star_components(edges: DataFrame, what: str = "stars") -> DataFrame:
    """(node, root) of every node that has an edge, roots included; root is the smallest node reachable.

    Large star and small star by turns until nothing changes; neighbours are only ever aggregated to a minimum.
    """
    def state(df: DataFrame) -> tuple:
        r = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), what)
    before = state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.select("a", F.col("m").alias("b")).union(joined.select(F.col("b").alias("a"), F.col("m").alias("b")))
        edges = stored(small.filter("a > b").distinct(), what)
        now = state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, tree: int = TREE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (the fingerprint as a long), group (the smallest fingerprint of its component), component_id, and
    text_key (a hash of the text, to find the row again) of every row."""
    prepare(docs.sparkSession)

    @F.arrow_udf("long")
    def fp(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.array(fingerprints(column, shingle))

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    marked = stored(texts.select("doc_id", fp("text").alias("fp"), F.xxhash64("text").alias("text_key")), "simhash")
    nodes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-nodes")
    members = star_components(link_forests(nodes.select("fp"), radius, tree))
    linked = nodes.join(members, nodes.fp == members.node).select("fp", "first_id", "root")
    firsts = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = linked.join(firsts, "root").select(F.col("fp"), F.col("root"), F.col("component_id"))
    groups = nodes.join(linked, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("group"), F.when(F.col("root").isNull(), F.col("first_id")).otherwise(F.col("component_id")).alias("component_id"))
    return marked.join(groups, "fp").select("doc_id", "fp", "group", "component_id", "text_key")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row with the smallest id stays (among rows
    that repeat it, one)."""
    found = near_duplicates(docs, shingle, radius, id_col=id_col, text_col=text_col)
    key, kept_id, kept_key = (own_name(docs, x) for x in ("key", "kept_id", "kept_key"))
    keepers = found.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("k")).select(F.col("k.doc_id").alias(kept_id), F.col("k.text_key").alias(kept_key))
    rows = docs.withColumn(key, F.xxhash64(text_col))
    same = F.col(key).eqNullSafe(F.col(kept_key)) & F.col(id_col).eqNullSafe(F.col(kept_id))
    return rows.join(keepers, same, "left_semi").dropDuplicates([id_col, key]).select(*docs.columns)


def hex_of(fp: Column) -> Column:
    """16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
