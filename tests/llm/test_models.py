from __future__ import annotations

import math
import os
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(__file__))

from helpers import ODD, fold, lower, no_docs, odd_docs, rows_of, words  # noqa: E402

from rankforge.llm import attention_lm, fm_toxicity, queries, rff_quality  # noqa: E402
from rankforge.llm.common import fold as fold_column  # noqa: E402

MIDDLE = "/root/testdata/sf0.01"


def labels(spark, column):
    return spark.createDataFrame([(i, int(i % 2)) for i in (1, 5, 6, 7, 9, 10)] + [(1, 0), (2, None), (None, 1), (999, 1)], f"doc_id long, {column} int")


def auc(score, label):
    order = np.argsort(np.argsort(score, kind="stable"), kind="stable") + 1
    return (order[label == 1].mean() - (label.sum() + 1) / 2) / (len(label) - label.sum())


@pytest.mark.parametrize("query,column,parts,out,least", [("op5_fourier_quality", "quality", 5, 0, 0.9), ("op10_factorization_toxicity", "toxic", 3, 1, 0.75)])
def test_scores_hold_on_rows_held_out(spark, query, column, parts, out, least):
    rows = queries.queries()[query](spark, MIDDLE).collect()
    known = {r.doc_id: r[column] for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{MIDDLE}/documents.parquet").count()
    limit = 0.3 if column == "quality" else 0.7
    for r in rows:
        assert r.held_out == (fold(r.doc_id, parts) == out) and 0 <= r.score <= 1 and r.predicted == int(r.score >= limit)
    held = [(r.score, known[r.doc_id]) for r in rows if r.held_out and r.doc_id in known]
    score, label = (np.array(x) for x in zip(*held))
    assert auc(score + np.arange(len(score)) * 1e-12, label) > least


def test_labels_of_the_fold_held_out_are_not_looked_at(spark):
    """Turning them round changes no score."""
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    own = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    from pyspark.sql import functions as F

    out = fold_column(F.col("doc_id"), 5) == 0
    turned = own.withColumn("quality", F.when(out, 1 - F.col("quality")).otherwise(F.col("quality")))
    learn = fold_column(F.col("id"), 5) != 0
    a, b = (sorted(map(tuple, rff_quality.score_quality(docs, x, learn).collect())) for x in (own, turned))
    assert [x[0] for x in a] == [x[0] for x in b] and np.allclose([x[1] for x in a], [x[1] for x in b], atol=1e-6)


def test_quality_of_odd_rows(spark):
    from pyspark.sql import functions as F

    found = rff_quality.score_quality(odd_docs(spark), labels(spark, "quality"), F.lit(True), features=16).collect()
    assert sorted((r.id for r in found), key=repr) == sorted((i for i, *_ in ODD), key=repr) and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.id == 7}) == 1
    assert rff_quality.score_quality(no_docs(spark), labels(spark, "quality"), F.lit(True)).count() == 0
    assert {r.score for r in rff_quality.score_quality(odd_docs(spark), labels(spark, "quality").limit(0), F.lit(True)).collect()} == {0.5}


def test_statistics_of_a_text():
    x = dict(zip(rff_quality.STATISTICS, rff_quality.statistics(pa.array(["skip", "AB cd CD\ncd! cd", None]))[1]))
    assert math.isclose(x["share_0"], 4 / 15) and math.isclose(x["distinct_words"], 4 / 5) and math.isclose(x["top_word"], 2 / 5)
    assert math.isclose(x["log_words"], math.log(6)) and math.isclose(x["word_length"], 11 / 5)
    assert not rff_quality.statistics(pa.array([None, ""])).any()


def test_fourier_features_approach_the_kernel():
    rng = np.random.default_rng(0)
    d = 5
    model = rff_quality.QualityModel(np.zeros(d), np.ones(d), rng.normal(0, np.sqrt(2 * 0.1), (d, 20_000)), rng.uniform(0, 2 * np.pi, 20_000), np.empty(0), np.empty(0), np.empty(0))
    x = rng.normal(size=(6, d))
    z = model.features(x)[:, :-1]
    assert np.abs(z @ z.T - np.exp(-0.1 * ((x[:, None] - x[None]) ** 2).sum(-1))).max() < 0.05


def test_isotonic_regression():
    sums, counts = np.array([1.0, 0, 3, 2, 9]), np.array([1.0, 2, 3, 4, 9])
    assert np.allclose(rff_quality.pool_adjacent(sums, counts), [1 / 3, 1 / 3, 5 / 7, 5 / 7, 1])
    assert len(rff_quality.pool_adjacent(np.empty(0), np.empty(0))) == 0


def test_partition_sums_equal_one_sum(spark):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(300, 4)), rng.integers(0, 2, 300)
    df = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, y)], "x array<double>, label double").repartition(7)
    model = rff_quality.train(df, 4, features=12)
    z = model.features(x)
    want = np.linalg.solve(z.T @ z + rff_quality.RIDGE * 300 * np.diag(np.r_[np.ones(12), 1e-9]) / 12, z.T @ y)
    assert np.allclose(model.weights, want, atol=1e-6)


def test_machine_s_margin_is_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    m = fm_toxicity.FactorizationMachine(np.arange(6), 0.3, rng.normal(size=6), rng.normal(size=(6, 3)))
    sets = [[0, 2, 5], [], [1], [0, 1, 2, 3, 4, 5]]
    doc = np.repeat(np.arange(4), [len(s) for s in sets])
    got = m.margin(doc, np.array(sum(sets, [])), 4)
    want = [0.3 + sum(m.linear[s]) + sum(m.factors[i] @ m.factors[j] for i in s for j in s if i < j) for s in sets]
    assert np.allclose(got, want)


def test_machine_learns_a_pair_that_additive_weights_miss():
    """Toxic: insult with group; either alone is not (an exclusive or of two more terms has no linear form)."""
    rng = np.random.default_rng(0)
    sets, label = [], []
    for _ in range(1500):
        a, b = rng.integers(0, 2, 2)
        sets.append([k for k, on in ((10, a), (11, 1 - a), (20, b), (21, 1 - b)) if on])
        label.append(float(a == b))
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    model = fm_toxicity.fit(doc, np.array(sum(sets, [])), np.array(label), buckets=64, weight=1.0, epochs=60, l2=0.0)
    own = model.feature[np.array(sum(sets, []))]
    assert (((model.margin(doc, own, len(sets)) > 0) == np.array(label)).mean()) > 0.99


def test_training_keeps_terms_that_matter_only_in_a_pair(spark):
    """Each word of the pair is as common in toxic texts as in others, and 1,200 words by chance are not."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(1)
    rows = []
    for k in range(3000):
        a, b = k % 2, k // 2 % 2
        rows.append((k, " ".join([("fool", "pal")[a], ("north", "south")[b], *(f"w{x}" for x in rng.integers(0, 1200, 3))]), int(a == b)))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = fm_toxicity.train(table.select("doc_id", "text"), table.select("doc_id", "toxic"), F.lit(True), weight=1.0, epochs=60, l2=0.0)
    score = model.score(pa.array(["fool north", "pal south", "fool south", "pal north"]))
    assert (score[:2] > 0.9).all() and (score[2:] < 0.1).all(), score


def test_terms_of_texts():
    doc, bucket = fm_toxicity.term_pairs(pa.array(["Abcdefgh abcdefgh, x", None, "x x"]))
    kinds = lambda w: {int(fm_toxicity._buckets(pa.array([w[:n] if n else w]), n, fm_toxicity.BUCKETS)[0]) for n in (0, *fm_toxicity.PREFIXES)}
    twice = lambda own: {int(fm_toxicity._often(np.array([b]), 2, fm_toxicity.BUCKETS)[0]) for b in own}
    x = int(fm_toxicity._buckets(pa.array(["x"]), 0, fm_toxicity.BUCKETS)[0])
    assert set(bucket[doc == 0].tolist()) == kinds("abcdefgh") | twice(kinds("abcdefgh")) | {x}
    assert set(bucket[doc == 2].tolist()) == {x} | twice({x}) and not (doc == 1).any()
    wanted = np.zeros(fm_toxicity.BUCKETS, bool)
    wanted[x] = True
    doc, bucket = fm_toxicity.term_pairs(pa.array(["Abcdefgh abcdefgh, x", None, "x x"]), wanted=wanted)
    assert {(d, b) for d, b in zip(doc.tolist(), bucket.tolist()) if wanted[b]} == {(0, x), (2, x)}


def test_toxicity_of_odd_rows(spark):
    from pyspark.sql import functions as F

    docs = odd_docs(spark)
    model = fm_toxicity.train(docs, labels(spark, "toxic"), F.lit(True), least=1, buckets=4096)
    found = docs.select("doc_id", fm_toxicity.toxicity(spark, model)("text").alias("p")).collect()
    assert len(found) == len(ODD) and all(0 <= r.p <= 1 for r in found)
    blank = {r.p for r in found if r.doc_id in (2, 3, 4)}
    assert len(blank) == 1
    untaught = fm_toxicity.train(docs, labels(spark, "toxic").limit(0), F.lit(True))
    assert {r[0] for r in docs.select(fm_toxicity.toxicity(spark, untaught)("text")).collect()} == {0.5}
    assert no_docs(spark).select(fm_toxicity.toxicity(spark, model)("text")).count() == 0
    few = fm_toxicity.train(docs, labels(spark, "toxic"), F.lit(True), most_rows=2, least=1, buckets=4096)
    assert len(few.feature) == 4096


# The language model.


def small_model(seed=0, vocabulary=40):
    rng = np.random.default_rng(seed)
    counts = rng.integers(0, 50, vocabulary).astype(float)
    head = np.full(vocabulary, attention_lm.HEADS - 1)
    head[:20] = np.arange(20)
    pairs = np.zeros((attention_lm.HEADS, attention_lm.HEADS))
    pairs[:20, :20] = rng.integers(0, 9, (20, 20))
    m = attention_lm.build_model(counts, pairs, head, 0)
    m.near[:] = rng.normal(0, 0.3, len(m.near))
    for p in ("q", "k", "v", "out"):
        getattr(m, p)[...] = rng.normal(0, 0.7, getattr(m, p).shape)
    return m


def plain_log10(m, ids, end_id, span, stride):
    """Subword by subword, each in the window that scores it."""
    inputs, total = [end_id, *ids], 0.0
    for t, target in enumerate([*ids, end_id]):
        first = max(0, t // stride * stride + stride - span)
        x = m.head[inputs[first:t + 1]]
        s = m.k[x].astype(float) @ m.q[x[-1]] + m.near[np.arange(len(x))[::-1]]
        a = np.exp(s - s.max())
        logits = m.after[x[-1]] + (a / a.sum()) @ m.v[x] @ m.out
        c = m.class_of[m.head[target]]
        total += logits[c] - np.log(np.exp(logits - logits.max()).sum()) - logits.max() + m.log_share[target]
    return total / math.log(10)


@pytest.mark.parametrize("span,stride", [(8, 6), (8, 8), (5, 1), (32, 24)])
def test_every_subword_is_scored_once_with_its_window(span, stride):
    rng = np.random.default_rng(span)
    m = small_model()
    texts = [rng.integers(0, 40, n) for n in (0, 1, 5, 7, 8, 9, 23, 24, 25, 60)]
    ends = np.cumsum([len(t) for t in texts])
    got = attention_lm.log_probabilities(m, np.concatenate(texts), ends, 0, span, stride)
    assert np.allclose(got, [plain_log10(m, t.tolist(), 0, span, stride) for t in texts], rtol=1e-4)


def test_probabilities_of_what_can_follow_sum_to_one():
    m = small_model()
    # P(first = i) for all i but the end: P(text i, then the end) / P(end after i) summed needs no closing factor here
    logits = attention_lm.attend(m, np.array([[attention_lm.HEADS] * 7 + [0]]), attention_lm.distance_mask(m.near, 8, 1))[0][0].astype(float)
    p = np.exp(logits) / np.exp(logits).sum()
    assert math.isclose((p[m.class_of[m.head]] * np.exp(m.log_share.astype(float))).sum(), p[np.unique(m.class_of[m.head])].sum(), rel_tol=1e-4)
    mass = np.bincount(m.class_of[m.head], weights=np.exp(m.log_share.astype(float)))
    assert np.allclose(mass[mass > 0], 1, atol=1e-3)


def test_gradient():
    m = small_model()
    rng = np.random.default_rng(4)
    x = rng.integers(0, 20, (3, attention_lm.SPAN))
    x[0, :9] = attention_lm.HEADS
    stride = attention_lm.STRIDE
    classes, real = rng.integers(0, attention_lm.CLASSES, (3, stride)), rng.random((3, stride)) < 0.8

    def loss(p, at, by):
        other = attention_lm.Trainer(m).m
        getattr(other, p)[at] += by
        logits = attention_lm.attend(other, x, attention_lm.distance_mask(other.near, attention_lm.SPAN, stride))[0].astype(float)
        logits -= np.log(np.exp(logits).sum(1, keepdims=True))
        return -(logits[np.arange(len(logits)), classes.ravel()] * real.ravel()).sum()

    trainer = attention_lm.Trainer(m, rate=1.0)
    trainer.step(x, classes, real)
    for p in m.PARAMETERS:
        # AdaGrad from ones: the step is g / sqrt(1 + g g), so g = step / sqrt(1 - step step)
        step = (getattr(m, p) - getattr(trainer.m, p)).astype(float)
        for at in [np.unravel_index(k, step.shape) for k in np.argsort(-np.abs(step).ravel() * (np.abs(step).ravel() < 0.9))[:4]]:
            g = step[at] / math.sqrt(1 - step[at] ** 2)
            assert math.isclose(g, (loss(p, at, 1e-2) - loss(p, at, -1e-2)) / 2e-2, rel_tol=0.05, abs_tol=0.02), (p, at)


def test_lm_query(spark, small_dir):
    texts = dict(rows_of(small_dir))
    cut = {d: [*words(lower(t)), None] for d, t in texts.items()}
    counts = Counter(w for d, ws in cut.items() if fold(d, 7) != 2 for w in ws)
    n, v = sum(counts.values()), len(counts)
    rows = queries.op3_attention_lm(spark, small_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ws = cut[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (fold(r.doc_id, 7) == 2, len(ws), sum(w in counts for w in ws), n)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
        assert math.isfinite(r.score) and r.score < 0


def test_training_helps_texts_held_out(spark):
    """Against the counted part alone, on texts that did not train."""
    import duckdb

    texts = duckdb.sql(f"SELECT doc_id, text FROM '{MIDDLE}/documents.parquet'").fetchall()
    enc = attention_lm.encoder(queries.VOCABULARY)
    train = spark.createDataFrame([(bytes(enc.encode(pa.array([t]))[0].astype("<u2").tobytes()),) for d, t in texts if d % 5], "ids binary").repartition(2)
    counts = np.bincount(np.concatenate([enc.encode(pa.array([t]))[0] for d, t in texts if d % 5]), minlength=enc.size).astype(float)
    counts[49407] += sum(d % 5 > 0 for d, _ in texts)
    model = attention_lm.train_model(train, counts, 49407, every=2)
    counted = attention_lm.replace(model, out=np.zeros_like(model.out))
    ids, ends = enc.encode(pa.array([t for d, t in texts if d % 5 == 0]))
    full, part = (attention_lm.log_probabilities(m, ids.astype(np.int64), ends, 49407).sum() for m in (model, counted))
    assert full > part


def test_runs_are_summed():
    rng = np.random.default_rng(6)
    rows = rng.integers(0, 9, (400, 5)).astype(np.float32)
    for many in (1, 7, 90, 400):
        begin = np.sort(np.append(0, 1 + rng.choice(399, many - 1, replace=False)))
        assert (attention_lm.sum_runs(rows, begin) == np.add.reduceat(rows, begin, axis=0)).all()


def test_attention_is_the_same_with_and_without_shifted_exponents():
    m = small_model()
    x = np.random.default_rng(8).integers(0, 20, (5, attention_lm.SPAN))
    x[1, :8] = attention_lm.HEADS
    mask = attention_lm.distance_mask(m.near, attention_lm.SPAN, attention_lm.STRIDE)
    chances = []
    for shifted in (False, True):
        p = np.exp(attention_lm.attend(m, x, mask, shifted=shifted)[0].astype(float))
        chances.append(p / p.sum(1, keepdims=True))
    assert np.allclose(*chances, atol=1e-5)
    m.k *= 1000
    assert attention_lm.wide(m) and np.isfinite(attention_lm.attend(m, x, mask)[0]).all()


def test_texts_stay_whole_in_runs():
    lengths = np.array([0, 3, 0, 0, 9, 2, 2, 40, 0])
    ids = np.arange(lengths.sum())
    for most in (1, 4, 10, 1000):
        runs = list(attention_lm.text_runs(ids, np.cumsum(lengths), most))
        assert np.concatenate([r[0] for r in runs]).tolist() == ids.tolist()
        assert np.concatenate([np.diff(r[1], prepend=0) for r in runs]).tolist() == lengths.tolist()
        assert all(len(r[0]) == r[1][-1] and (len(r[0]) <= most or (np.diff(r[1], prepend=0) > 0).sum() == 1) for r in runs)
    assert list(attention_lm.text_runs(ids[:0], np.cumsum(lengths[:0]))) == []


def test_every_window_trains_once_with_the_production_values():
    m = small_model()
    rng = np.random.default_rng(2)
    for lengths in (np.arange(100), np.arange(1, 23), np.array([0]), np.full(7, 600)):
        ids, ends = rng.integers(0, 40, lengths.sum()), np.cumsum(lengths)
        rounds = [attention_lm.training_windows(m, ids, ends, 0, attention_lm.EVERY, turn) for turn in range(attention_lm.ROUNDS)]
        assert sum(int(real.sum()) for _, _, real in rounds) == (lengths + 1).sum()
        alone = attention_lm.training_windows(m, ids, ends, 0, 1, 0)
        seen = sorted(x.tobytes() + c.tobytes() for xs, cs, _ in rounds for x, c in zip(xs, cs))
        assert seen == sorted(x.tobytes() + c.tobytes() for x, c in zip(*alone[:2]))


def test_short_texts_train_the_attention(spark):
    """Texts of 2 to 23 subwords, the end included."""
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 40, n) for n in range(1, 23)]
    train = spark.createDataFrame([(t.astype("<u2").tobytes(),) for t in texts], "ids binary")
    counts = np.bincount(np.concatenate(texts), minlength=2000).astype(float)
    counts[1999] += len(texts)
    model = attention_lm.train_model(train, counts, 1999)
    assert np.abs(model.near).max() > 0


def test_lm_of_odd_rows(spark):
    from pyspark.sql import functions as F

    def run(docs, held_out):
        return attention_lm.score_texts(docs, queries.VOCABULARY, 49407, held_out).collect()

    rows = run(odd_docs(spark), F.coalesce(F.col("doc_id") == 5, F.lit(False)))
    assert sorted((r.doc_id for r in rows), key=repr) == sorted((i for i, *_ in ODD), key=repr)
    assert sorted(r.n_tokens for r in rows) == sorted(len(words(t)) + 1 for _, t, _ in ODD)
    assert len({(r.score, r.base_score) for r in rows if r.doc_id == 7}) == 1
    assert run(no_docs(spark), F.lit(False)) == []
    rows = run(odd_docs(spark), F.lit(True))
    assert {(r.train_tokens, r.n_known, r.base_score) for r in rows} == {(0, 0, 0.0)} and all(math.isfinite(r.score) for r in rows)


def test_fitting_toxicity_takes_little_of_the_drivers_memory():
    """It held several 64-bit copies of all terms of the sample, 21 bytes a term here even of 32-bit input."""
    import tracemalloc

    n, each = 400, 2500
    rng = np.random.default_rng(3)
    bucket = np.sort(rng.integers(0, 1 << 14, (n, each)), axis=1).astype(np.int32).ravel()
    doc, label = np.repeat(np.arange(n, dtype=np.int32), each), (np.arange(n) % 3 == 0).astype(float)
    tracemalloc.start()
    fm_toxicity.fit(doc, bucket, label, 1 << 14, factors=1, epochs=0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 * len(bucket)
