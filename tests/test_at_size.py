"""What has to hold when tables grow: rows are sent, kept and made ready no more often than needed."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankforge.functions.text import char_ngrams, tokenize_keyword, tokenize_tfidf
from rankforge.operators import blocks, features, metrics, retrieval
from rankforge.operators.ranking import top_k


def test_short_texts_are_spread_before_their_ngrams(spark):
    docs = spark.createDataFrame([(1, "Ab a"), (2, "abab"), (1, "ab")], "item_id long, t string").coalesce(1)
    got = features.tfidf(docs, "t", analyzer="char", ngram=(2, 2))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan
    tf = {(1, "ab"): 2, (1, "b "): 1, (1, " a"): 1, (2, "ab"): 2, (2, "ba"): 1}
    df = {"ab": 2, "b ": 1, " a": 1, "ba": 1}
    raw = {k: n * (np.log(4 / (1 + df[k[1]])) + 1) for k, n in tf.items()}
    size = {i: np.sqrt(sum(v * v for k, v in raw.items() if k[0] == i)) for i in (1, 2)}
    rows = {(r.item_id, r.term): r.value for r in got.collect()}
    assert rows.keys() == tf.keys() and all(np.isclose(rows[k], raw[k] / size[k[0]]) for k in tf)


def test_vectors_are_not_sent_once_for_every_block(spark, monkeypatch):
    """Few tasks are worth one strip: left rows are sent once, right rows not at all, and the k best stay exact."""
    rng = np.random.default_rng(3)
    a, b = rng.integers(-3, 4, (23, 4)).astype(float), rng.integers(-3, 4, (31, 4)).astype(float)
    left = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(a)], "user_id long, vector array<double>")
    right = spark.createDataFrame([(100 + i, v.tolist()) for i, v in enumerate(b)], "item_id long, vector array<double>")
    out = {(i, 100 + (7 * i) % 31) for i in range(23)}
    exclude = spark.createDataFrame([*out], "user_id long, item_id long")
    s = a @ b.T
    want = {(i, 100 + j, rank) for i in range(23)
            for rank, j in enumerate(sorted((j for j in range(31) if (i, 100 + j) not in out), key=lambda j: (-s[i, j], j))[:5], 1)}
    for tasks in (1, 3, 64):
        monkeypatch.setattr(blocks, "BLOCK_TASKS", tasks)
        got = blocks.block_topk(left, right, 5, exclude=exclude, block=4)
        assert {(r.user_id, r.item_id, r["rank"]) for r in got.collect()} == want
        # Of the three tables, left and exclude alone are part of the plan.
        assert got._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 2


def test_diversity_of_each_trial(spark):
    vec = spark.createDataFrame([(i, [1.0, 0.0] if i % 2 else [0.0, 1.0]) for i in range(4)], "item_id long, vector array<double>")
    top = spark.createDataFrame([(0, 7, 0, 1), (0, 7, 1, 2), (1, 7, 1, 1), (1, 7, 3, 2)], "trial int, user_id long, item_id long, rank int")
    got = {r.trial: r.diversity for r in metrics.diversity(top, vec, 10, by=["trial"]).collect()}
    assert got == {0: 1.0, 1: 0.0}
    assert metrics.diversity(top.where(F.col("trial") == 1), vec).first().diversity == 0.0


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_ngrams_are_counted_once_and_never_looked_for_from_the_start(spark):
    text = "Ünï😀 x" * 3
    docs = spark.createDataFrame([(1, text), (2, ""), (3, "a"), (4, None)], "item_id long, t string")
    grams = docs.select("item_id", char_ngrams("t", 1, 3).alias("g"))
    assert "substring" not in _plan(grams)
    low = text.lower()
    got = {r.item_id: r.g for r in grams.collect()}
    assert got[1] == [low[i:i + n] for n in (1, 2, 3) for i in range(len(low) - n + 1)]
    assert got[2] == [] and got[3] == ["a"] and not got[4]
    # The counts are read for the vocabulary and for the values; the n-grams are made for neither again.
    assert "Generate" not in _plan(features.tfidf(docs, "t", analyzer="char"))


def test_tokens_are_made_once_for_each_text(spark):
    docs = spark.createDataFrame([(1, "ab cd ab"), (2, ""), (3, None)], "item_id long, t string")
    tf = features.term_counts(docs, tokenize_tfidf("t"))
    assert _plan(tf).count("regexp_extract_all") == 1
    assert {(r.item_id, r.term): r.tf for r in tf.collect()} == {(1, "ab"): 2, (1, "cd"): 1}


def test_a_content_block_works_out_no_explained_variance(spark, monkeypatch):
    def never(*_):
        raise AssertionError("variance worked out")

    items = spark.createDataFrame([(i,) for i in range(5)], "item_id long")
    long = spark.createDataFrame([(i, t, float(i + len(t) % 2)) for i in range(4) for t in ("a", "bb", "ccc")], "item_id long, feature string, value double")
    monkeypatch.setattr(features.F, "var_pop", never)
    rows = {r.item_id: r.vector for r in features._svd_block(long, 2, "item_id", "feature", items)[0].collect()}
    assert {len(v) for v in rows.values()} == {2} and rows[4] == [0.0, 0.0]


def test_keyword_tokens_are_the_runs_between_other_characters(spark):
    texts = ["A bc\td-ef  g", " \n x1y2!z ", "ÀB12 É c.d", "", "-", "K9 ab cd"]
    docs = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    plain = F.filter(F.split(F.trim(F.regexp_replace(F.lower("t"), r"[^a-z0-9\s]", " ")), r"\s+"), lambda x: F.length(x) > 1)
    assert all(r.a == r.b for r in docs.select(tokenize_keyword("t").alias("a"), plain.alias("b")).collect())


@pytest.mark.parametrize("digits", [None, 1])
def test_keyword_scores_of_all_pairs_stay_in_tasks(spark, digits):
    """Blocks of a few documents and one query: same best k as over the scores of all pairs, ids repeated or null."""
    rng = np.random.default_rng(7)
    words = [f"w{i}" for i in range(12)]
    text = lambda n: " ".join(rng.choice(words, n))
    docs = spark.createDataFrame([(None if i == 3 else str(i % 31), text(int(rng.integers(0, 9)))) for i in range(40)], "doc_id string, text string")
    queries = spark.createDataFrame([(q if q else None, text(4)) for q in range(5)] + [(2, "w1 w1"), (9, "none of these"), (10, None)], "query_id long, text string")
    index = retrieval.bm25_index(docs)
    everything = retrieval.bm25_scores(index, queries)
    rounded = everything if digits is None else everything.withColumn("score", F.round("score", digits))
    key = lambda rows: sorted((-1 if r.query_id is None else r.query_id, r["rank"], r.doc_id, round(r.score, 9)) for r in rows)
    want = key(top_k(rounded, 3, "query_id", "score", "doc_id").collect())
    best = retrieval.bm25_best(index, queries, 3, round_digits=digits, block=6, query_block=2)
    assert best.count() < everything.count()
    best = best if digits is None else best.withColumn("score", F.round("score", digits))
    assert want and key(top_k(best, 3, "query_id", "score", "doc_id").collect()) == want
    found = retrieval.bm25_search(index, queries, 3, round_digits=digits)
    assert "FlatMapGroupsInArrow" in _plan(found) and key(found.collect()) == want


@pytest.mark.parametrize("step", [4, 256])
def test_later_blocks_are_held_against_the_best_so_far(spark, monkeypatch, step):
    """Ties, masked pairs and fewer rows than k over many blocks and steps."""
    monkeypatch.setattr(blocks, "STEP", step)
    monkeypatch.setattr(blocks, "CELLS", step)
    rng = np.random.default_rng(3)
    left = spark.createDataFrame([(i, [float(x) for x in rng.integers(-2, 3, 3)]) for i in range(7)], "user_id long, vector array<double>")
    right = spark.createDataFrame([(i, [float(x) for x in rng.integers(-2, 3, 3)]) for i in range(90)], "item_id long, vector array<double>")
    seen = [(u, i) for u in range(7) for i in range(90) if (u + i) % 4 == 0 or u == 6 and i > 1]
    got = blocks.block_topk(left, right, 5, exclude=spark.createDataFrame(seen, "user_id long, item_id long"), block=9)
    score = {(a.user_id, b.item_id): float(np.dot(a.vector, b.vector)) for a in left.collect() for b in right.collect()}
    want = {(u, n + 1, i, s) for u in range(7)
            for n, (s, i) in enumerate(sorted(((s, i) for (w, i), s in score.items() if w == u and (u, i) not in seen), key=lambda x: (-x[0], x[1]))[:5])}
    assert {(r.user_id, r["rank"], r.item_id, r.score) for r in got.collect()} == want and sum(r[0] == 6 for r in want) < 5


def test_a_row_with_k_is_not_partitioned_again(monkeypatch):
    rng = np.random.default_rng(5)
    top, top_id = np.full((4, 3), -np.inf), np.zeros((4, 3), np.int64)
    first, later = rng.random((4, 20)), rng.random((4, 20)) / 1e3
    later[2, 7], later[1, 4], later[3, 3] = 2.0, np.nan, -np.inf
    blocks.keep_best(top, top_id, first, np.arange(20))
    monkeypatch.setattr(np, "partition", None)
    blocks.keep_best(top, top_id, later, np.arange(20, 40))
    every = np.nan_to_num(np.concatenate([first, later], axis=1), nan=-np.inf)
    order = np.argsort(-every, axis=1, kind="stable")[:, :3]
    assert (top_id == order).all() and (top == np.take_along_axis(every, order, 1)).all()


def test_rows_of_one_id_are_each_found(spark):
    left = spark.createDataFrame([(1, [1.0, 0.0])], "user_id long, vector array<double>")
    right = spark.createDataFrame([(5, [2.0, 0.0]), (5, [3.0, 0.0]), (6, [1.0, 1.0])], "item_id long, vector array<double>")
    assert [(r.item_id, r.score) for r in blocks.block_topk(left, right, 2).orderBy("rank").collect()] == [(5, 3.0), (5, 2.0)]


def test_known_widths_make_no_block_twice(spark):
    block = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0])], "item_id long, vector array<double>")
    other = spark.createDataFrame([(3, [1.0])], "item_id long, vector array<double>")
    wide = features.weighted_blocks([(block, 1.0, 2), (other, 2.0, 1)])
    assert "scalar-subquery" not in _plan(wide) and "scalar-subquery" in _plan(features.weighted_blocks([(block, 1.0), (other, 2.0)]))
    rows = {r.item_id: r.vector for r in wide.collect()}
    assert rows == {1: [0.6, 0.8, 0.0], 2: [0.0, 0.0, 0.0], 3: [0.0, 0.0, 1.0]}
