from __future__ import annotations

import hashlib
import os
import re
import sys

import numpy as np
import pyarrow as pa
import pytest
import xxhash

sys.path.insert(0, os.path.dirname(__file__))

from helpers import ODD, alnum, lower, no_docs, odd_docs, rows_of, words  # noqa: E402

from rankforge.llm import queries, simhash_bk, suffix_rules, winnowing  # noqa: E402
from rankforge.llm.common import alnum_words, words_of  # noqa: E402


def test_words_of_texts():
    texts = [t for _, t, _ in ODD] + ["a\x0bb\x0cc\x1cd\x85e f g", "ÀB\x7fc{d`e@f/9:"]
    for cut in (words_of, alnum_words):
        for column in (pa.array(texts), pa.array(["skipped", *texts])[1:], pa.array([], pa.string())):
            found = cut(column)
            own = found.distinct.to_pylist()
            got = [[own[c] for c in found.codes[e - n:e]] for e, n in zip(found.ends, found.counts)]
            assert got == [words(lower(t)) if cut is words_of else alnum(t) for t in column.to_pylist()]


def longest_repeats(codes, owner):
    n = len(codes)
    out = np.zeros(n, int)
    for i in range(n):
        for j in range(n):
            if i != j and owner[i] == owner[j]:
                k = 0
                while max(i, j) + k < n and owner[i + k] == owner[i] and owner[j + k] == owner[j] and codes[i + k] == codes[j + k]:
                    k += 1
                out[i] = max(out[i], k)
    return out


@pytest.mark.parametrize("seed", range(40))
def test_repeat_lengths(seed):
    rng = np.random.default_rng(seed)
    n = rng.integers(0, 60)
    codes, owner = rng.integers(0, rng.integers(1, 6), n), np.sort(rng.integers(0, 4, n))
    assert (suffix_rules.repeat_lengths(codes, owner) == longest_repeats(codes, owner)).all()


def plain_repetition(text, least=suffix_rules.LEAST, covered=suffix_rules.MOST_COVERED, longest=suffix_rules.MOST_LONGEST):
    w = words(text)
    n = len(w)

    def cover(m):
        seen, out = {}, set()
        for i in range(n - m + 1):
            seen.setdefault(tuple(w[i:i + m]), []).append(i)
        for at in seen.values():
            if len(at) > 1:
                out.update(x for i in at for x in range(i, i + m))
        return out

    lines = [x for x in (text or "").split("\n") if words(x)]
    best = 0
    for m in range(least, n):
        if not cover(m):
            break
        best = m
    inside = len(cover(least)) if best else 0
    again = len(cover(3))
    failed = n < 50 or 100 * again > 50 * n
    kept = not failed and inside <= covered * n and best <= longest * n
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), again, failed, inside, best, kept)


def test_repetition_query(spark, small_dir):
    found = {r.doc_id: tuple(r)[1:] for r in queries.op6_suffix_repetition(spark, small_dir).collect()}
    texts = dict(rows_of(small_dir))
    assert found.keys() == texts.keys()
    for doc, text in texts.items():
        if len(text or "") < 6000:
            assert found[doc] == plain_repetition(text), doc


def test_repetition_of_odd_rows(spark):
    rng = np.random.default_rng(0)
    prose = " ".join(f"w{x}" for x in rng.permutation(300))
    part = prose[:400]
    texts = [t for _, t, _ in ODD if len(t or "") < 9000] + [prose, f"{prose} {part} {part}", f"{prose} {prose[600:760]} end"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").selectExpr("text", "1 AS kept", "2 AS n_words")
    rows = suffix_rules.judge_repetition(docs).collect()
    for r in rows:
        assert tuple(r.repetition) == plain_repetition(r.text), r.text
    assert [r.repetition.kept for r in rows[-3:]] == [True, False, True]
    assert suffix_rules.judge_repetition(no_docs(spark)).count() == 0
    assert suffix_rules.judge_repetition(odd_docs(spark)).count() == len(ODD)


def plain_fingerprint(text, n=3):
    w = [x.encode() for x in words(lower(text))]
    shingles = [b" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] or ([b" ".join(w)] if w else [])
    counts = [0] * 64
    for x in shingles:
        h = xxhash.xxh64_intdigest(x, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def components(items, radius):
    """Smallest id reachable over all pairs of fingerprints within the radius."""
    prints = sorted({f for _, f in items})
    root = {f: f for f in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if bin(a ^ b).count("1") <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    smallest = {}
    for d, f in items:
        if d is not None:
            smallest[find(f)] = min(d, smallest.get(find(f), d))
    return {(d, f): smallest.get(find(f)) for d, f in items}


def test_simhash_query(spark, small_dir):
    items = [(d, plain_fingerprint(t)) for d, t in rows_of(small_dir)]
    want = components(items, 2)
    rows = queries.op8_simhash_bk_trees(spark, small_dir).collect()
    assert {(r.doc_id, int(r.fingerprint, 16)): r.component_id for r in rows} == want and len(rows) == len(items)
    assert all(re.fullmatch("[0-9a-f]{16}", r.fingerprint) for r in rows)


def test_simhash_of_odd_rows(spark):
    rows = simhash_bk.near_duplicates(odd_docs(spark)).collect()
    items = [(d, plain_fingerprint(t)) for d, t, _ in ODD]
    want = components(items, 2)
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in rows), key=repr) == sorted(((d, f, want[d, f]) for d, f in items), key=repr)
    kept = simhash_bk.keep_one(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(({want[x] for x in want} - {None}) | ({None} if None in want.values() else set()), key=repr)
    assert simhash_bk.near_duplicates(no_docs(spark)).count() == 0 and simhash_bk.keep_one(no_docs(spark)).count() == 0


@pytest.mark.parametrize("tree", [8, 64, 100_000])
def test_links_with_few_or_many_shards(spark, tree):
    """Chains, a dense ball and strangers, in one tree, in many shards, and with hot shards cut into several trees."""
    rng = np.random.default_rng(5)
    far = rng.integers(-2**63, 2**63 - 1, 150)
    ball = far[0] ^ (np.int64(1) << rng.integers(0, 63, 60)) ^ (np.int64(1) << rng.integers(0, 63, 60))
    chain = [int(far[1])]
    for b in rng.permutation(63)[:40]:
        chain.append(chain[-1] ^ (1 << int(b)))
    prints = sorted({*far.tolist(), *ball.tolist(), *chain})
    nodes = spark.createDataFrame([(x,) for x in prints], "fp long")
    edges = simhash_bk.link_forests(nodes, 2, tree).collect()
    assert all(bin((e.a ^ e.b) % 2**64).count("1") <= 64 and e.a != e.b for e in edges) and len(edges) <= 4 * 3 * len(prints)
    members = {r.node: r.root for r in simhash_bk.star_components(simhash_bk.link_forests(nodes, 2, tree)).collect()}
    want = components([(x, x % 2**64) for x in prints], 2)
    groups, own = {}, {}
    for x in prints:
        groups.setdefault(members.get(x, x), set()).add(x)
        own.setdefault(want[x, x % 2**64], set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, own.values()))


def test_bk_tree_finds_all_within_the_radius():
    rng = np.random.default_rng(2)
    points = np.unique(np.concatenate([x := rng.integers(-2**63, 2**63 - 1, 500), x[:200] ^ (np.int64(1) << rng.integers(0, 63, 200))]))
    for radius in (0, 1, 2, 5):
        q, p = simhash_bk.BKTree(points).within(points, radius)
        near = np.argwhere(np.bitwise_count(points.view(np.uint64)[:, None] ^ points.view(np.uint64)[None]) <= radius)
        assert sorted(zip(q.tolist(), p.tolist())) == sorted(map(tuple, near.tolist()))
    assert len(simhash_bk.BKTree(points[:0]).within(points, 2)[0]) == 0


def plain_hits(text, items, window=10):
    windows = {}
    for item, t in items:
        w = alnum(t)
        m = min(window, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[i:i + m]), set()).add("" if item is None else str(item))
    w, hit, own = alnum(text), set(), set()
    for m in {len(x) for x in windows}:
        for i in range(len(w) - m + 1):
            if (found := windows.get(tuple(w[i:i + m]))) is not None:
                own |= found
                hit.update(range(i, i + m))
    return len(w), len(hit), sorted(own)


def test_winnowing_query(spark, small_dir):
    import duckdb

    items = duckdb.sql(f"SELECT item_id, text FROM '{small_dir}/benchmark.parquet'").fetchall()
    rows = {r.doc_id: r for r in queries.op9_winnowing(spark, small_dir).collect()}
    hits = 0
    for doc, text in rows_of(small_dir):
        n, hit, own = plain_hits(text, items)
        r = rows.pop(doc)
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(own), hit > 0)
        assert r.items_sha256 == hashlib.sha256(",".join(own).encode()).hexdigest()
        hits += hit > 0
    assert not rows and hits


ITEMS = [(1, "One two three."), (2, "a"), (3, None), (4, " .. "), (None, "text without an id"), (5, "word " * 12), (5, "word " * 12), (6, "One two three one TWO three one two three one two"), (7, "naïve ÉTÉ")]


@pytest.mark.parametrize("block", [1, 10, 1000])
def test_winnowing_of_odd_rows_in_blocks(spark, block):
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, doc_id string")
    docs = odd_docs(spark)
    rows = winnowing.mark_contamination(docs, benchmark, block_words=block, as_col="c").collect()
    assert len(rows) == len(ODD)
    for r in rows:
        found = (r.c.n_words, sum(s.end - s.start for s in r.c.spans), list(r.c["items"]))
        assert found == plain_hits(r.text, ITEMS), r.text
        assert all(a.end < b.start for a, b in zip(r.c.spans, r.c.spans[1:]))
    assert winnowing.mark_contamination(no_docs(spark), benchmark).count() == 0
    assert all(not r.c.spans for r in winnowing.mark_contamination(docs, benchmark.limit(0), as_col="c").collect())


@pytest.mark.parametrize("m", range(1, 11))
def test_no_shared_window_is_missed(m):
    rng = np.random.default_rng(m)
    k = (m + 1) // 2
    for _ in range(20):
        shared = rng.integers(1, 50, m)
        sides = [np.concatenate([rng.integers(1, 50, rng.integers(0, 9)), shared, rng.integers(1, 50, rng.integers(0, 9))]) for _ in range(2)]
        kept = [set(h[winnowing.winnow(h, m - k + 1)].tolist()) for h in (winnowing.gram_hashes(x, k) for x in sides)]
        assert kept[0] & kept[1]
