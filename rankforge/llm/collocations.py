"""Phrase collocation mining by vertical partitioning of the suffixes, in the manner of ERA.

A first scan counts words by language and, for prefixes of 1 to 5 words, how many suffixes begin with them; prefixes
are counted by hash slot, so the counts have a fixed size and never fall short. A prefix whose slot holds no more
suffixes than the memory budget is a unit; one that holds more is extended by a word, up to whole
truncated suffixes. Slots are packed into groups of at most the budget. A second scan cuts every suffix
off after 5 words, and before a word that cannot be in any candidate (too rare; found by a bit table of fixed size that never
misses a frequent word), and sends it to its prefix's group, packed, equal ones of a run of texts as one with a count.

A group's task sorts its suffixes: neighbours with a common prefix of d words lie below one node of the subtree at
depth d, and the node's frequency is the sum of its leaves. Nodes above the prefix that a suffix was grouped by are
spread over groups and summed afterwards. A phrase that fills a third of a corpus is one leaf a run, not a hot group.

Scores are exact: products are decimals of 38 digits, divided as integers.

Defined results: a null text is an empty one, a null language is ``und``; empty texts and pieces give nothing; words are
cut at space and tab alone, so other control characters belong to words; texts are read whole, a row is a text of its
own however often it repeats; ties go by frequency and then by the phrase's bytes; an empty table gives no rows. Other
columns are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.llm.common import prepare, runs_of, stored

LONGEST, LEAST, TOP, SHARE = 5, 100, 2000, 100
#: Suffixes a group may hold; slots for each prefix length; bits of the table of words that can be in a candidate.
BUDGET, SLOTS, WORD_BITS = 2_000_000, 1 << 12, 1 << 24
#: A task gathers texts of a language up to so many bytes, and sends their suffixes in runs of so many.
RUN_BYTES, FLUSH = 12 << 20, 2_000_000
_BREAKS = bytes(10 if chr(b) in ".,;:!?\n\x0b\x0c\r" else 32 if b in (9, 32) else b for b in bytes(range(256)).lower())
_WORD_SALT = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Pieces:
    """Words of a run of texts: ``codes`` into ``distinct``, ``owner`` the text, ``room`` how many words of the piece stand from here on."""

    codes: np.ndarray
    distinct: list[bytes]
    owner: np.ndarray
    room: np.ndarray


def pieces_of(column: pa.Array) -> Pieces:
    """Words ``[^\\x20\\x09]+`` of the pieces between ``[.,;:!?\\x0A-\\x0D]``, A-Z lower-cased; null has none."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    column = pa.concat_arrays([column, pa.array([], pa.large_binary())]) if len(column) else column
    if not len(column):
        return Pieces(np.empty(0, np.int64), [], np.empty(0, np.int64), np.empty(0, np.int64))
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = (raw.to_pybytes() if raw is not None else b"")[offsets[0]:offsets[-1]].translate(_BREAKS)
    offsets = offsets - offsets[0]
    a = np.frombuffer(data, np.uint8)
    inside = (a != 32) & (a != 10)
    first = np.zeros(len(a) + 1, bool)
    first[offsets] = True  # a text's first byte begins a word whatever stands before it
    begin = np.flatnonzero(inside & (first[:-1] | ~np.concatenate([[False], inside[:-1]])))
    end = np.flatnonzero(inside & (first[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
    owner = np.searchsorted(offsets, begin, side="right") - 1
    breaks = np.searchsorted(np.flatnonzero(a == 10), begin)
    last = np.ones(len(begin), bool)  # the last word of a piece
    last[:-1] = (breaks[1:] != breaks[:-1]) | (owner[1:] != owner[:-1])
    at = np.arange(len(begin))
    ends = np.flatnonzero(last)
    room = ends[np.searchsorted(ends, at)] - at + 1 if len(at) else at
    # The words lie apart in the buffer: squeezed together, they are one array of strings.
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(begin), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int64).tobytes()), pa.py_buffer(a[inside].tobytes())])
    found = words.dictionary_encode()
    return Pieces(found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary.to_pylist(), owner, room)


def word_hashes(lang: bytes, words: list[bytes]) -> np.ndarray:
    """XXH64 of the word, seeded by that of the language: Spark's ``xxhash64(lang, word)``, unsigned."""
    seed = xxhash.xxh64_intdigest(lang, 42)
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


@dataclass
class Suffixes:
    """Truncated suffixes of one language: row i begins at word ``at[i]`` and has ``length[i]`` words; ``prefix(d)`` hashes d of them."""

    words: Pieces
    hashes: np.ndarray
    at: np.ndarray
    length: np.ndarray

    def prefixes(self, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(d, rows with d words, hash of their first d words) for d from 1 on."""
        rows = np.arange(len(self.at))
        h = np.full(len(self.at), _WORD_SALT)
        for d in range(1, longest + 1):
            more = self.length[rows] >= d
            rows, h = rows[more], h[more]
            h = _mixed(h ^ self.hashes[self.words.codes[self.at[rows] + d - 1]])
            yield d, rows, h


def by_language(texts: pa.Array, langs: pa.Array) -> Iterator[tuple[bytes, pa.Array]]:
    """The texts of each language of a batch."""
    langs = pc.fill_null(langs.cast(pa.string()), "und")
    for lang in pc.unique(langs).to_pylist():
        yield lang.encode(), texts.filter(pc.equal(langs, lang))


def _slot(h: np.ndarray, slots: int) -> np.ndarray:
    return (h % np.uint64(slots)).astype(np.int64)


def _first_scan(longest: int, slots: int):
    """Rows (lang, word, n) of every run of texts, and at the end rows (null, null, place, n) of the slots."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loads = np.zeros(longest * slots, np.int64)
        for batch in batches:
            for lang, texts in by_language(batch.column(0), batch.column(1)):
                for part in runs_of(texts, 8 << 20):
                    words = pieces_of(part)
                    hashes = word_hashes(lang, words.distinct)
                    suffixes = Suffixes(words, hashes, np.arange(len(words.codes)), np.minimum(words.room, longest))
                    for d, _, h in suffixes.prefixes(longest):
                        loads[(d - 1) * slots:d * slots] += np.bincount(_slot(h, slots), minlength=slots)
                    n = len(words.distinct)
                    if n:
                        yield pa.RecordBatch.from_arrays([
                            pa.array([lang] * n, pa.binary()).cast(pa.string()), pa.array(words.distinct, pa.binary()).cast(pa.string()),
                            pa.nulls(n, pa.int64()), pa.array(np.bincount(words.codes, minlength=n), pa.int64())], ["lang", "word", "place", "n"])
        own = np.flatnonzero(loads)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(own), pa.string()), pa.nulls(len(own), pa.string()), pa.array(own, pa.int64()), pa.array(loads[own], pa.int64())],
            ["lang", "word", "place", "n"])

    return run


@dataclass
class Partition:
    """Which group a prefix slot belongs to, by prefix length; -1: the slot holds more than the budget. ``bits``: words that may be frequent."""

    group: np.ndarray
    groups: int
    bits: np.ndarray

    @property
    def longest(self) -> int:
        return len(self.group)

    def assign(self, suffixes: Suffixes) -> tuple[np.ndarray, np.ndarray]:
        """(group, prefix length it is grouped by) of each suffix; a length above ``longest``: every prefix is over the budget."""
        n = len(suffixes.at)
        group, depth, whole = np.full(n, -1), np.full(n, self.longest + 1), np.zeros(n, np.uint64)
        for d, rows, h in suffixes.prefixes(self.longest):
            whole[rows] = h
            free = group[rows] < 0
            own = self.group[d - 1, _slot(h[free], self.group.shape[1])]
            group[rows[free]] = own
            depth[rows[free][own >= 0]] = d
        left = group < 0
        group[left] = (whole[left] >> np.uint64(20)) % np.uint64(self.groups)
        return group, depth


def plan_groups(loads: np.ndarray, budget: int, bits: np.ndarray) -> Partition:
    """Slots of at most ``budget`` suffixes, packed in turn into groups of at most ``budget``."""
    group, at, room = np.full(loads.shape, -1, np.int64), -1, 0
    for d in range(len(loads)):
        for slot in np.argsort(-loads[d], kind="stable").tolist():
            load = int(loads[d, slot])
            if load > budget:
                continue
            if at < 0 or load > room:
                at, room = at + 1, budget
            group[d, slot] = at
            room -= load
        if not (group[d] < 0).any():
            break  # nothing is extended beyond this length
    return Partition(group, at + 1, bits)


def _pack(codes: np.ndarray, base: int) -> list[np.ndarray]:
    """Rows of small codes as sort keys, as many columns to a 64-bit key as fit; the first key leads."""
    per = max(1, 63 // max(1, int(base).bit_length()))
    keys = []
    for c in range(0, codes.shape[1], per):
        key = np.zeros(len(codes), np.uint64)
        for column in range(c, min(c + per, codes.shape[1])):
            key = key * np.uint64(base + 1) + codes[:, column].astype(np.uint64)
        keys.append(key)
    return keys


def _order(codes: np.ndarray, base: int) -> np.ndarray:
    keys = _pack(codes, base)
    return np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])


def _distinct(codes: np.ndarray, weights: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct rows, and the sum of the weights of each."""
    order = _order(codes, base)
    codes, weights = codes[order], weights[order]
    new = np.ones(len(codes), bool)
    new[1:] = (codes[1:] != codes[:-1]).any(1)
    at = np.flatnonzero(new)
    return codes[at], np.add.reduceat(weights, at, dtype=np.int64) if len(at) else weights


SENT = "grp int, lang string, words binary, packed binary, n long"


def _second_scan(shared, longest: int):
    """Truncated suffixes, one row a group and run of texts: its words, and columns of codes, depths and counts.

    A run gathers texts of a language over batches: the longer it is, the more suffixes share a row and its words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan: Partition = shared.value
        held: dict[bytes, list[pa.Array]] = {}
        size: dict[bytes, int] = {}

        def send(lang: bytes) -> Iterator[pa.RecordBatch]:
            texts = pa.concat_arrays(held.pop(lang))
            del size[lang]
            for part in runs_of(texts, RUN_BYTES):
                yield from _send(plan, lang, part, longest)

        for batch in batches:
            for lang, texts in by_language(batch.column(0), batch.column(1)):
                held.setdefault(lang, []).append(texts.cast(pa.large_binary()))
                size[lang] = size.get(lang, 0) + (pc.sum(pc.binary_length(texts)).as_py() or 0)
                if size[lang] >= RUN_BYTES:
                    yield from send(lang)
            while sum(size.values()) > 2 * RUN_BYTES:
                yield from send(max(size, key=size.get))
        for lang in list(held):
            yield from send(lang)

    return run


def _send(plan: Partition, lang: bytes, texts: pa.Array, longest: int) -> Iterator[pa.RecordBatch]:
    words = pieces_of(texts)
    hashes = word_hashes(lang, words.distinct)
    slot = (hashes % np.uint64(WORD_BITS)).astype(np.int64)
    frequent = ((plan.bits[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) > 0)[words.codes]
    # Words up to the next rare one, or to the end of the piece.
    at = np.arange(len(frequent))
    rare = np.append(np.flatnonzero(~frequent), len(frequent))
    length = np.minimum(np.minimum(words.room, longest), rare[np.searchsorted(rare, at)] - at)
    # Commoner words get smaller codes, which pack better; 0 is "no word".
    by_count = np.argsort(-np.bincount(words.codes, minlength=len(words.distinct)), kind="stable")
    code = np.empty(len(words.distinct), np.int32)
    code[by_count] = np.arange(1, len(by_count) + 1)
    at = at[length >= 2]
    for first in range(0, len(at), FLUSH):
        own = at[first:first + FLUSH]
        suffixes = Suffixes(words, hashes, own, length[own])
        rows = np.zeros((len(own), longest + 2), np.int32)
        rows[:, 0], rows[:, longest + 1] = plan.assign(suffixes)
        for d in range(longest):
            more = suffixes.length > d
            rows[more, d + 1] = code[words.codes[own[more] + d]]
        rows, counts = _distinct(rows, np.ones(len(rows), np.int32), max(len(words.distinct), plan.groups))
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(rows[:, 0])) + 1, [len(rows)]]) if len(rows) else np.array([0])
        packer = zstandard.ZstdCompressor(level=3)
        out = []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            used, local = np.unique(rows[a:b, 1:longest + 1], return_inverse=True)
            local = local.reshape(b - a, longest) + (0 if used[0] == 0 else 1)
            table = np.concatenate([local, rows[a:b, longest + 1:], counts[a:b, None]], 1).astype("<i4")
            # Byte by byte: all low bytes of a column, then the next ones, which are mostly zero.
            planes = np.ascontiguousarray(table.T).view(np.uint8).reshape(longest + 2, b - a, 4).transpose(0, 2, 1)
            spelled = b"\n".join(words.distinct[by_count[c - 1]] for c in used.tolist() if c)
            out.append((int(rows[a, 0]), packer.compress(spelled), packer.compress(planes.tobytes()), b - a))
        if out:
            yield pa.RecordBatch.from_arrays([
                pa.array([x[0] for x in out], pa.int32()), pa.array([lang.decode()] * len(out), pa.string()),
                pa.array([x[1] for x in out], pa.binary()), pa.array([x[2] for x in out], pa.binary()), pa.array([x[3] for x in out], pa.int64())],
                ["grp", "lang", "words", "packed", "n"])


def _subtrees(longest: int, least: int):
    """Frequencies of the phrases of a group: whole ones from ``least`` on, those spread over groups always."""
    def run(table: pa.Table) -> pa.Table:
        langs, phrases, lengths, sums = [], [], [], []
        names = table["lang"].combine_chunks()
        for lang in sorted(pc.unique(names).to_pylist()):
            for phrase, d, f in subtree(table.filter(pc.equal(table["lang"], lang)), longest, least):
                langs += [lang] * len(f)
                phrases.append(phrase)
                lengths += [d] * len(f)
                sums += f.tolist()
        return pa.table({"lang": pa.array(langs, pa.string()), "phrase": pa.concat_arrays(phrases) if phrases else pa.array([], pa.string()),
                         "m": pa.array(lengths, pa.int32()), "f": pa.array(sums, pa.int64())})

    return run


def subtree(table: pa.Table, longest: int, least: int) -> Iterator[tuple[pa.Array, int, np.ndarray]]:
    """(phrases, their number of words, frequencies) for each depth from 2 on."""
    unpacker = zstandard.ZstdDecompressor()
    spelled = [unpacker.decompress(x).split(b"\n") for x in table["words"].to_pylist()]
    joined = pa.array([w for x in spelled for w in x], pa.binary()).cast(pa.string()).dictionary_encode()
    own, bounds = joined.indices.to_numpy(zero_copy_only=False).astype(np.int32) + 1, np.cumsum([0, *map(len, spelled)])
    rows, weights = [], []
    for k, (packed, n) in enumerate(zip(table["packed"].to_pylist(), table["n"].to_pylist())):
        planes = np.frombuffer(unpacker.decompress(packed), np.uint8).reshape(longest + 2, 4, n)
        part = np.ascontiguousarray(planes.transpose(0, 2, 1)).reshape(longest + 2, n * 4).view("<i4")
        known = np.concatenate([np.zeros(1, np.int32), own[bounds[k]:bounds[k + 1]]])
        rows.append(np.concatenate([known[part[:longest]], part[longest:longest + 1]]).T)
        weights.append(part[longest + 1])
    leaves, counts = _distinct(np.concatenate(rows), np.concatenate(weights), max(len(joined.dictionary), longest + 1))
    below = np.concatenate([[0], np.cumsum(counts)])
    fresh = np.zeros(len(leaves), bool)  # the leaf shares fewer than d words with the one before it
    fresh[0] = True
    for d in range(1, longest + 1):
        fresh[1:] |= leaves[1:, d - 1] != leaves[:-1, d - 1]
        at = np.flatnonzero(fresh)
        f = below[np.append(at[1:], len(leaves))] - below[at]
        node = leaves[at]
        kept = (node[:, d - 1] > 0) & ((f >= least) | (node[:, longest] > d))
        if d > 1 and kept.any():
            parts = [joined.dictionary.take(pa.array(node[kept, c] - 1)) for c in range(d)]
            yield pc.binary_join_element_wise(*parts, " "), d, f[kept]


def phrase_frequencies(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, budget: int = BUDGET, slots: int = SLOTS,
                       text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, m, f) of every phrase of 1 to ``longest`` words that occurs ``least`` times or more; (lang, n) words)."""
    spark = prepare(docs.sparkSession)
    texts = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    scan = stored(texts.mapInArrow(_first_scan(longest, slots), "lang string, word string, place long, n long"), "words")
    words = stored(scan.where("place IS NULL").groupBy("lang", "word").agg(F.sum("n").alias("f")), "frequencies")
    loads = np.zeros(longest * slots, np.int64)
    held = scan.where("place IS NOT NULL").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    loads[held["place"].to_numpy()] = held["n"].to_numpy()
    slot = F.pmod(F.xxhash64("lang", "word"), F.lit(WORD_BITS))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))
    pages = words.where(F.col("f") >= least).groupBy((slot / 64).cast("long").alias("page")).agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros(WORD_BITS // 64, np.uint64)
    bits[pages["page"].to_numpy()] = pages["bits"].to_numpy().view(np.uint64)
    shared = spark.sparkContext.broadcast(plan_groups(loads.reshape(longest, slots), budget, bits))
    sent = texts.mapInArrow(_second_scan(shared, longest), SENT)
    found = sent.groupBy("grp").applyInArrow(_subtrees(longest, least), "lang string, phrase string, m int, f long")
    phrases = found.groupBy("lang", "phrase", "m").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    single = words.where(F.col("f") >= least).select("lang", F.col("word").alias("phrase"), F.lit(1).alias("m"), "f")
    return stored(phrases.unionByName(single), "phrases"), words.groupBy("lang").agg(F.sum("f").alias("n"))


def cut_score(a: str, n: str, l: str, r: str) -> Column:
    """floor(1000 a n / (l r)), exactly: a and n up to 17 digits each, their product in 38."""
    return F.expr(f"cast(cast(1000 * cast({a} as decimal(17,0)) as decimal(21,0)) * cast({n} as decimal(17,0)) as decimal(38,0))"
                  f" div cast(cast({l} as decimal(19,0)) * cast({r} as decimal(19,0)) as decimal(38,0))")


def mine_phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP, share: int = SHARE, budget: int = BUDGET, slots: int = SLOTS,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the first ``top`` phrases of each language.

    A phrase scores floor(1000 a n / (l r)) by its lowest cut into two parts of frequencies l and r. One that stands
    inside a longer candidate of at least ``share`` in a hundred of its frequency goes; frequencies fall along a chain of
    longer phrases, so the candidates of one word more decide that.
    """
    found, totals = phrase_frequencies(docs, longest, least, budget, slots, text_col, lang_col)
    candidates = found.where("m > 1").select("lang", "phrase", "m", F.col("f").alias("a"), F.split("phrase", " ", -1).alias("words"))
    part = found.select("lang", F.col("phrase").alias("part"), "f")
    cuts = candidates.select("lang", "phrase", "a", "words", "m", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("head"),
                       F.array_join(F.slice("words", F.col("k") + 1, F.col("m") - F.col("k")), " ").alias("rest"))
    scored = (cuts.join(part.select("lang", F.col("part").alias("head"), F.col("f").alias("l")), ["lang", "head"])
              .join(part.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
              .join(totals, "lang"))
    lowest = (scored.withColumn("score", cut_score("a", "n", "l", "r"))
              .groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("x")).select("lang", "phrase", "x.*"))
    inner = candidates.where("m > 2").select("lang", F.col("a").alias("longer"), F.explode(F.array(
        F.array_join(F.slice("words", F.lit(1), F.col("m") - 1), " "), F.array_join(F.slice("words", F.lit(2), F.col("m") - 1), " "))).alias("phrase"))
    kept = (lowest.join(inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer")), ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a"))))
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))))
    return ranked.where(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
