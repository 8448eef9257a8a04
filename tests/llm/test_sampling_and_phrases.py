from __future__ import annotations

import hashlib
import math
import os
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(__file__))

from helpers import ODD, alnum, lower, no_docs, odd_docs, words  # noqa: E402

from rankforge.llm import collocations, fair_mixing, importance  # noqa: E402


# ------------------------------------------------------------------ op11
def plain_features(text, longest=3):
    w = alnum(text)
    return len(w), [" ".join(w[i:i + m]) for m in range(1, longest + 1) for i in range(len(w) - m + 1)]


@pytest.mark.parametrize("longest", [1, 2, 3, 5])
def test_feature_counts(longest):
    pattern = importance.scanner(longest)
    texts = [t for _, t, _ in ODD] + ["a", "a b", " a\x00b ", "\x01 \x01", "Ünï Ünï ünï", "a b c d e f g a b c", "1-2_3"]
    for text in texts:
        n, counts = importance.feature_counts((text or "").encode(), pattern, longest, 97)
        own, features = plain_features(text, longest)
        assert n == own
        assert counts.tolist() == np.bincount([zlib.crc32(f.encode()) % 97 for f in features] or [], minlength=97).tolist()


def test_features_in_runs(monkeypatch):
    monkeypatch.setattr(importance, "RUN", 7)
    pattern = importance.scanner(3)
    for n in range(30):
        text = " ".join(f"w{i % 5}" for i in range(n))
        assert importance.feature_counts(text.encode(), pattern)[1].sum() == len(plain_features(text)[1])


def plain_resample(docs, target, percent=5, least=20, buckets=10000):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(bucket, plain_features(text)[1]))
    for text in target:
        t.update(map(bucket, plain_features(text)[1]))
    S, T = sum(s.values()), sum(t.values())
    out = []
    for i, text in docs:
        n, features = plain_features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1.0) * (S + buckets) / ((s[b] + 1.0) * (T + buckets)))) for b in map(bucket, features))
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((x for x in out if x[1] >= least), key=lambda x: (-x[4], x[0] is None, x[0], x[2]))
    rank = {id(x): k + 1 for k, x in enumerate(able) if k < percent * len(able) // 100}
    return sorted(((x[0], x[2], x[3], x[4], rank.get(id(x))) for x in out), key=str)


def test_resampling_of_odd_rows(spark):
    texts = [(i, t) for i, t, _ in ODD] + [(100 + k, " ".join(f"w{(k * j) % 23}" for j in range(15 + k))) for k in range(40)]
    docs = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in texts], "doc_id long, text string, score long, rank long, id long")
    target = ["w1 w2 w3 w4 one two three", None, ""]
    benchmark = spark.createDataFrame([(t, 1) for t in target], "text string, id int")
    for percent in (5, 50, 100):
        found = importance.resample(docs, benchmark, percent).collect()
        assert sorted((tuple(r) for r in found), key=str) == plain_resample(texts, target, percent)
    assert importance.resample(no_docs(spark), benchmark).count() == 0
    empty = importance.resample(docs, benchmark.limit(0)).collect()
    assert sorted((tuple(r) for r in empty), key=str) == plain_resample(texts, [])


# ------------------------------------------------------------------ op12
def plain_targets(sizes, weights=(5.0, 2.0, 1.0), share=1.5, limit=2):
    """Targets shared by weight; whatever is above a cap is shared again, as long as there is any."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, open_, target = share * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * level >= limit * sizes[s]}
        if not above:
            return target | {s: weight[s] * level for s in open_}
        target |= {s: float(limit * sizes[s]) for s in above}
        left -= sum(limit * sizes[s] for s in above)
        open_ -= above
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = np.random.default_rng(seed)
    sizes = {None if k == 0 else f"s{k}é": int(rng.integers(0, 10 ** rng.integers(1, 7))) for k in range(int(rng.integers(1, 40)))}
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found, budget = fair_mixing.source_targets(table)
    assert budget == math.floor(1.5 * sum(sizes.values()))
    expected = plain_targets(sizes)
    for r in found.collect():
        assert r.target == pytest.approx(expected[r.source], rel=1e-9, abs=1e-9)


def test_mix_comes_near_its_targets(spark):
    rng = np.random.default_rng(3)
    rows = [(k, " ".join(["x"] * int(rng.integers(0, 60))), "hot" if k % 3 == 0 else f"s{k % 17}") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first, again = (sorted(map(tuple, fair_mixing.mix_sources(d).collect())) for d in (docs, docs.repartition(7)))
    assert first == again
    source = {i: s for i, _, s in rows}
    taken, target, total = Counter(), {}, 0
    for i, size, _, wanted, words_taken in first:
        assert 0 <= words_taken <= 2 * size
        taken[source[i]] += words_taken
        target[source[i]] = wanted
        total += size
    assert sum(taken.values()) == 3 * total // 2
    for s in taken:
        assert abs(taken[s] - target[s]) <= 120


def test_mix_of_odd_rows(spark):
    docs = odd_docs(spark).withColumnRenamed("lang", "source")
    found = fair_mixing.mix_sources(docs).collect()
    assert sorted((r.id is None, r.id or 0, r.size) for r in found) == sorted((i is None, i or 0, len(words(t))) for i, t, _ in ODD)
    assert all(0 <= r.taken <= 2 * r.size for r in found)
    assert sum(r.taken for r in found) == 3 * sum(r.size for r in found) // 2
    assert fair_mixing.mix_sources(no_docs(spark).withColumnRenamed("lang", "source")).count() == 0
    wordless = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.taken) for r in fair_mixing.mix_sources(wordless).collect()] == [(0, 0.0, 0)] * 2


# ------------------------------------------------------------------ op13
def plain_pieces(text):
    return [w for w in (re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lower(text))) if w]


def test_pieces():
    texts = [t for _, t, _ in ODD] + ["a.b", ".", "a", " a\tb\x0bc d\x1ce", "Ä,ö;é!", "x", "x", "end. "]
    for column in (pa.array(texts), pa.array(["skipped.", *texts])[1:], pa.array([None, ""]), pa.array([], pa.string())):
        found = collocations.pieces_of(column)
        got = [(o, found.distinct[c].decode(), r) for o, c, r in zip(found.owner.tolist(), found.codes.tolist(), found.room.tolist())]
        assert got == [(k, w, len(p) - i) for k, t in enumerate(column.to_pylist()) for p in plain_pieces(t) for i, w in enumerate(p)]


def plain_phrases(rows, least, longest=5, top=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        for p in plain_pieces(text):
            n[lang or "und"] += len(p)
            for m in range(1, longest + 1):
                f[lang or "und"].update(tuple(p[i:i + m]) for i in range(len(p) - m + 1))
    out = []
    for lang, own in f.items():
        candidates = {p for p, a in own.items() if a >= least and len(p) > 1}
        kept = []
        for p in candidates:
            a = own[p]
            inside = any(len(q) > len(p) and 100 * own[q] >= 100 * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q in candidates)
            if not inside:
                score, k = min((1000 * a * n[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        out += [(lang, r + 1, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0]) for r, x in enumerate(sorted(kept)[:top])]
    return sorted(out)


def phrase_rows(seed, texts=60):
    rng = np.random.default_rng(seed)
    vocabulary = ["ab", "b", "ç", "dd", "é", "F", "the", "of"]
    share = np.array([8, 6, 4, 2, 2, 1, 9, 9.0])
    return [("".join(w + str(rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n"])) for w in rng.choice(vocabulary, int(rng.integers(0, 80)), p=share / share.sum())),
             [None, "en", "de"][int(rng.integers(0, 3))]) for _ in range(texts)]


@pytest.mark.parametrize("seed,budget,slots", [(0, 10 ** 6, 64), (1, 40, 8), (2, 5, 64), (3, 1, 4), (4, 300, 16)])
def test_phrases(spark, monkeypatch, seed, budget, slots):
    """Small budgets extend every prefix, up to whole suffixes that are over it and more groups than rows."""
    monkeypatch.setattr(collocations, "FLUSH", 50)
    rows = phrase_rows(seed)
    docs = spark.createDataFrame([(t, x, 1) for t, x in rows], "text string, lang string, f long").repartition(3)
    found = collocations.mine_phrases(docs, least=4, budget=budget, slots=slots, top=30).collect()
    assert sorted(map(tuple, found)) == plain_phrases(rows, 4, top=30)


def test_phrases_of_odd_rows(spark):
    docs = odd_docs(spark)
    found = collocations.mine_phrases(docs, least=2).collect()
    assert sorted(map(tuple, found)) == plain_phrases([(t, x) for _, t, x in ODD], 2)
    assert collocations.mine_phrases(no_docs(spark)).count() == 0


def test_scores_are_exact(spark):
    """Numbers whose products pass 64 bits keep every digit."""
    a, n, left, right = 4 * 10 ** 12 + 7, 9 * 10 ** 15 + 1, 8 * 10 ** 12 + 3, 6 * 10 ** 12 + 1
    frame = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long")
    assert frame.select(collocations.cut_score("a", "n", "l", "r").alias("s")).first()["s"] == 1000 * a * n // (left * right)


def test_groups_keep_to_the_budget():
    rng = np.random.default_rng(0)
    loads = rng.integers(0, 100, (5, 64))
    loads[0, 3] = loads[1, 7] = 1000
    plan = collocations.plan_groups(loads, 150, np.zeros(1, np.uint64))
    assert plan.group[0, 3] == plan.group[1, 7] == -1
    held = Counter()
    for d in range(3):
        for slot in range(64):
            if plan.group[d, slot] >= 0:
                held[plan.group[d, slot]] += loads[d, slot]
    assert max(held.values()) <= 150 and max(held) == plan.groups - 1
    assert (plan.group[3:] == -1).all()
