"""Packing of documents into training sequences by bin completion.

The largest piece left opens a sequence. Its fillings, of any number of pieces, are enumerated from tables of subset
sums as the search asks for them, least waste first, without those that an unused piece could improve (dominated
ones); a filling of few pieces without waste is looked for before the tables are made. A branch ends when its waste
exceeds what the best solution so far can still be beaten with; best fit decreasing gives the first such solution.
Pieces are counted by length, so a filling without waste is used as often as its lengths allow, then once less, and so on.

Lengths are dealt by hash to shards of about ``SHARD`` pieces, each packed in a task of its own; a shard wastes
less than a sequence more than one packing of all, so sequences are full to about 1/10,000.

Defined results: a null text is empty (the end id alone); rows that repeat an id are packed each for itself; other
columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.llm.common import prepare, stored
from rankforge.llm.subwords import encoder

#: Pieces in a shard; fillings kept by the quick look; search steps after which the best solution so far is taken.
SHARD, WIDTH, STEPS = 60_000, 4, 20_000

Pattern = tuple[int, ...]


def best_fit(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Best fit decreasing: each piece into the fullest sequence that still takes it."""
    room: list[int] = []  # the distinct room left, ascending
    open_: dict[int, list[list[int]]] = {}
    for length in np.flatnonzero(counts)[::-1].tolist():
        for _ in range(int(counts[length])):
            k = bisect.bisect_left(room, length)
            if k == len(room):
                own, left = [length], capacity - length
            else:
                r = room[k]
                own = open_[r].pop()
                if not open_[r]:
                    del open_[r], room[k]
                own.append(length)
                left = r - length
            if left not in open_:
                open_[left] = []
                bisect.insort(room, left)
            open_[left].append(own)
    return [tuple(x) for r in room for x in open_[r]]


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    total = int((counts * np.arange(len(counts))).sum())
    return max(-(-total // capacity), int(counts[capacity // 2 + 1:].sum()))


def fillings(counts: np.ndarray, room: int, width: int = WIDTH, depth: int = 4) -> list[Pattern]:
    """A quick look: undominated fillings of ``room`` by few pieces, least waste first, then those with the larger pieces."""
    if room <= 0:
        return [()]
    there = np.flatnonzero(counts[:room + 1])
    if not len(there):
        return [()]
    if there[-1] == room:
        return [(room,)]  # nothing can take the place of a piece that fits exactly
    found: dict[Pattern, int] = {(int(there[-1]),): room - int(there[-1])}
    stack: list[tuple[Pattern, int, int]] = [((), room, depth)]
    looked = 0
    while stack and looked < 64:
        chosen, left, levels = stack.pop()
        sizes = there[there <= left]
        if chosen:
            sizes = sizes[sizes <= chosen[-1]]
        if not len(sizes):
            continue
        looked += 1
        # The last piece of a filling is the largest that fits behind the one before it.
        rest = left - sizes
        at = np.searchsorted(there, np.minimum(rest, sizes), side="right") - 1
        last = np.where(at >= 0, there[at], 0)
        need = chosen.count
        short = (last == sizes) & (counts[sizes] < 2)
        last = np.where(short, np.where(at > 0, there[np.maximum(at - 1, 0)], 0), last)
        waste = rest - last
        for k in np.argsort(waste, kind="stable")[:width].tolist():
            own = chosen + ((int(sizes[k]), int(last[k])) if last[k] else (int(sizes[k]),))
            if all(counts[x] >= own.count(x) for x in set(own)):
                found.setdefault(own, int(waste[k]))
                if waste[k] == 0:
                    return sorted(found, key=lambda x: (found[x], -x[0], len(x)))[:width]
        if levels > 2:
            for s in sizes[::-1][:6][::-1].tolist():
                if counts[s] > need(s):
                    stack.append((chosen + (s,), left - s, levels - 1))
    order = sorted(found, key=lambda x: (found[x], -x[0], len(x)))

    def dominated(own: Pattern) -> bool:
        slack = found[own]
        return any(counts[x + 1:x + slack + 1].any() and any(counts[y] > own.count(y) for y in (x + 1 + np.flatnonzero(counts[x + 1:x + slack + 1])).tolist()) for x in set(own))

    return [x for x in order if not dominated(x)][:width] or order[:1]


def reachable(sizes: list[int], counts: np.ndarray, room: int) -> list[int]:
    """Bit s of the k-th number is set where pieces of the k smallest ``sizes`` can fill s."""
    full, table = (1 << (room + 1)) - 1, [1]
    for x in sizes:
        bits, left, step = table[-1], min(int(counts[x]), room // x), 1
        while left > 0:
            step = min(step, left)
            bits |= (bits << (step * x)) & full
            left, step = left - step, 2 * step
        table.append(bits)
    return table


def all_fillings(counts: np.ndarray, room: int) -> Iterator[Pattern]:
    """Every filling of ``room``, least waste first, then those with the larger pieces."""
    sizes = np.flatnonzero(counts[:room + 1]).tolist()
    table = reachable(sizes, counts, room)

    def fill(total: int, k: int) -> Iterator[Pattern]:
        if not total:
            yield ()
            return
        for j in range(min(k, bisect.bisect_right(sizes, total)) - 1, -1, -1):
            if not table[j + 1] >> total & 1:
                return
            x = sizes[j]
            for m in range(min(int(counts[x]), total // x), 0, -1):
                if table[j] >> (total - m * x) & 1:
                    for rest in fill(total - m * x, j):
                        yield (x,) * m + rest

    for total in range(room, -1, -1):
        if table[-1] >> total & 1:
            yield from fill(total, len(sizes))


def completions(counts: np.ndarray, head: int, capacity: int) -> Iterator[Pattern]:
    """Every sequence that ``head`` opens, one without waste first, then by least waste. The counts may change between
    two calls of ``next`` but are the same at each; the tables are made anew for every run of fillings, twice as long as
    the one before, so that a path of many open nodes keeps none of them."""
    room = capacity - head
    counts[head] -= 1
    first = fillings(counts, room)[0]
    counts[head] += 1
    exact = sum(first) == room
    if exact:
        yield (head, *first)
        if len(first) < 2:
            return  # nothing can take the place of a piece that fits exactly
    at, many = 0, 8
    while True:
        counts[head] -= 1
        run = list(islice(all_fillings(counts, room), at, at + many))
        counts[head] += 1
        for x in run:
            if not exact or x != first:
                yield (head, *x)
        if len(run) < many:
            return
        at, many = at + many, 2 * many


def dominated(counts: np.ndarray, pattern: Pattern, capacity: int) -> bool:
    """An unused piece fits beside the filling, or in the place of a smaller one of it."""
    slack = capacity - sum(pattern)
    if not slack:
        return False
    return any(counts[y] > pattern.count(y) for x in {0, *pattern[1:]} for y in (x + 1 + np.flatnonzero(counts[x + 1:x + slack + 1])).tolist())


def complete_bins(counts: np.ndarray, capacity: int, steps: int = STEPS) -> list[tuple[Pattern, int]]:
    """Branch and bound over fillings of the largest piece left: (pattern, how often) of the best solution found."""
    counts = counts.astype(np.int64).copy()
    best = [(p, 1) for p in best_fit(counts, capacity)]
    n_best, bound = len(best), lower_bound(counts, capacity)
    total = int((counts * np.arange(len(counts))).sum())
    path: list[tuple[Pattern, int, Iterator[Pattern], int]] = []  # pattern, times, others to try, waste before it
    waste = used = 0
    choices: Iterator[Pattern] | None = None
    for _ in range(steps):
        if n_best <= bound:
            break
        if choices is None:
            left = np.flatnonzero(counts)
            if not len(left) and used < n_best:
                best, n_best = [(p, t) for p, t, _, _ in path], used
            choices = completions(counts, int(left[-1]), capacity) if len(left) else iter(())
        pattern = next(choices, None)
        if pattern is None or capacity - sum(pattern) > (n_best - 1) * capacity - total - waste:
            if not path:
                break
            pattern, times, choices, waste = path.pop()
            used -= times
            for x in pattern:
                counts[x] += times
            if times > 1:  # once less, and another sequence for the head that this frees
                times -= 1
                path.append((pattern, times, choices, waste))
                used += times
                for x in pattern:
                    counts[x] -= times
                choices = filter(lambda other, own=pattern: other != own, completions(counts, pattern[0], capacity))
            continue
        if dominated(counts, pattern, capacity):
            continue
        lost = capacity - sum(pattern)
        times = min(int(counts[x]) // pattern.count(x) for x in set(pattern)) if lost == 0 else 1
        path.append((pattern, times, choices, waste))
        for x in pattern:
            counts[x] -= times
        waste, used, choices = waste + lost * times, used + times, None
    return best


def pack_lengths(lengths: np.ndarray, capacity: int, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece."""
    counts = np.bincount(lengths, minlength=capacity + 1)
    if len(counts) > capacity + 1 or counts[0]:
        raise ValueError("pieces have 1 to capacity tokens")
    order = np.argsort(lengths, kind="stable")
    nth = (np.cumsum(counts) - counts).tolist()
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    k = 0
    for pattern, times in complete_bins(counts, capacity, steps):
        for _ in range(times):
            at = 0
            for x in pattern:
                own = order[nth[x]]
                nth[x] += 1
                sequence[own], offset[own] = k, at
                at += x
            k += 1
    return sequence, offset


def cut_documents(docs: DataFrame, vocabulary: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode whole texts, end each with ``end_id``, and cut those longer than ``capacity``:
    piece_key (unique), doc_id, piece, start, length, ids (little-endian 32-bit)."""
    prepare(docs.sparkSession)

    def cut(batches):
        key = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids, ends = encoder(vocabulary).encode(batch.column(1))
            rows: tuple[list, ...] = ([], [], [], [], [], [])
            begin = 0
            for doc, end in zip(batch.column(0).to_pylist(), ends.tolist()):
                raw = np.append(ids[begin:end], end_id).astype("<u4").tobytes()
                n, begin = len(raw) // 4, end
                for k, start in enumerate(range(0, n, capacity)):
                    length = min(capacity, n - start)
                    for column, x in zip(rows, (key, doc, k, start, length, raw[4 * start:4 * (start + length)])):
                        column.append(x)
                    key += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(rows, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))],
                ["piece_key", "doc_id", "piece", "start", "length", "ids"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(cut, "piece_key long, doc_id long, piece int, start long, length long, ids binary")


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = 4096, shard: int = SHARD, steps: int = STEPS,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces with their ids, the sequence that each went to and its place there (gapless from 0).

    The pieces are written once; only keys and lengths are dealt to the shards, and the ids meet their
    places in one join by the unique key.
    """
    pieces = stored(cut_documents(docs, vocabulary, end_id, capacity, id_col, text_col), "pieces")
    shards = max(1, -(-pieces.count() // shard))

    def pack(rows: pa.Table) -> pa.Table:
        key = rows.column("piece_key").to_numpy()
        order = np.argsort(key)
        sequence, offset = pack_lengths(rows.column("length").to_numpy()[order], capacity, steps)
        number = rows.column("shard")[0].as_py()
        return pa.table({"piece_key": key[order], "sequence_id": (number << 40) + sequence, "offset": offset})

    dealt = pieces.select("piece_key", "length", F.pmod(F.xxhash64("piece_key"), F.lit(shards)).alias("shard"))
    placed = dealt.repartition(shards, "shard").groupBy("shard").applyInArrow(pack, "piece_key long, sequence_id long, offset long")
    return pieces.join(placed, "piece_key").drop("piece_key")
