"""NumPy unit oracles for the grouped kernels and the dense-semantics operators."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F


def _dense(rows, key_a, key_b, val, shape):
    M = np.zeros(shape)
    for r in rows:
        M[r[key_a], r[key_b]] = r[val]
    return M


# ---------------------------------------------------------------- EASE (M-1) both forms = closed form
@pytest.mark.parametrize("form", ["column", "row"])
def test_ease_equals_closed_form(spark, form):
    from rankforge.operators.models import ease

    rng = np.random.default_rng(7)
    m, n, lam = 25, 9, 4.0
    X = (rng.random((m, n)) < 0.55).astype(float)
    df = spark.createDataFrame([(u, i, 1.0) for u in range(m) for i in range(n) if X[u, i]],
                               "user_id long, item_id long, weight double")
    P = np.linalg.inv(X.T @ X + lam * np.eye(n))
    ref = -P / (np.diag(P)[None, :] if form == "column" else np.diag(P)[:, None])
    np.fill_diagonal(ref, 0.0)
    B = _dense(ease.ease_fit(df, lam, form, tile=4).collect(), "src_item", "dst_item", "weight", (n, n))
    assert np.allclose(B, ref, atol=1e-10)
    assert np.allclose(np.diag(B), 0.0)
    # D1: the two forms are transposes and rank differently in general.
    if form == "row":
        Bc = _dense(ease.ease_fit(df, lam, "column").collect(), "src_item", "dst_item", "weight", (n, n))
        assert np.allclose(B, Bc.T, atol=1e-10)


def _history(rng, users, items, density=0.5):
    x = (rng.random((users, items)) < density) * rng.integers(1, 6, (users, items))
    x[0, :] = rng.integers(1, 6, items)  # a power user with every item
    return x.astype(float)


def _frame(spark, x):
    return spark.createDataFrame([(int(u), int(i) * 3 + 7, float(x[u, i])) for u, i in zip(*np.nonzero(x))], "user_id long, item_id long, weight double")


@pytest.mark.parametrize("tile", [1, 7, 64, 300])
def test_ease_of_200_items_is_the_closed_form(spark, tile):
    """Tiles that do and don't divide the matrix; items that never meet have weights too."""
    from rankforge.operators.item_matrix import matrix_scores, matrix_topk
    from rankforge.operators.models import ease

    n = 20 if tile == 1 else 200
    x = _history(np.random.default_rng(tile), 30, n, 0.04)
    df = _frame(spark, x)
    p = np.linalg.inv(x.T @ x + 9.0 * np.eye(n))
    ref = -p / np.diag(p)[None, :]
    np.fill_diagonal(ref, 0.0)
    m = ease.ease_model(df, 9.0, "column", tile=tile)
    got = np.zeros((n, n))
    for r in ease.ease_weights(m).collect():
        got[(r.src_item - 7) // 3, (r.dst_item - 7) // 3] = r.weight
    assert np.abs(got - ref).max() < 1e-9
    scores = x @ ref
    for r in matrix_scores(df, m).collect():
        assert abs(r.score - scores[r.user_id, (r.item_id - 7) // 3]) < 1e-9
    top = matrix_topk(df, m, 5, df).collect()
    for u in range(30):
        unseen = [i for i in range(n) if not x[u, i]]
        want = sorted(unseen, key=lambda i: (-round(scores[u, i], 9), i))[:5] if x[u].any() else []
        assert [(r.item_id - 7) // 3 for r in sorted((r for r in top if r.user_id == u), key=lambda r: r.rank)] == want


def test_influences_are_the_largest_contributions(spark):
    from rankforge.operators.models import ease

    x = _history(np.random.default_rng(5), 12, 30, 0.3)
    df = _frame(spark, x)
    m = ease.ease_model(df, 5.0, "column", tile=8)
    p = np.linalg.inv(x.T @ x + 5.0 * np.eye(30))
    b = -p / np.diag(p)[None, :]
    np.fill_diagonal(b, 0.0)
    pairs = spark.createDataFrame([(u, (u % 30) * 3 + 7) for u in range(12)] + [(3, 1_000_000)], "user_id long, item_id long")
    for r in ease.influences(df, m, pairs, 3).collect():
        d = (r.item_id - 7) // 3
        c = np.abs(x[r.user_id] * b[:, d])
        c[x[r.user_id] == 0] = -1
        assert (r.src_item - 7) // 3 == sorted(range(30), key=lambda i: (-round(c[i], 9), i))[r.rank - 1]


def test_tiles_invert_any_positive_definite_matrix(spark):
    from rankforge.operators.tiles import invert, store_tiles

    rng = np.random.default_rng(1)
    a = rng.normal(size=(23, 23))
    a = a @ a.T + 0.5 * np.eye(23)
    df = spark.createDataFrame([(i, j, float(a[i, j])) for i in range(23) for j in range(i, 23)], "i long, j long, v double")
    t = invert(spark, store_tiles(df, 23, 0.25, size=5))
    got = np.block([[t.read(i, j) for j in range(t.blocks)] for i in range(t.blocks)])
    assert np.allclose(got, np.linalg.inv(a + 0.25 * np.eye(23)))
    assert invert(spark, store_tiles(df.limit(0), 0)).blocks == 0


def test_knn_topk_with_a_power_user_equals_dense(spark):
    from rankforge.operators.models import knn

    x = _history(np.random.default_rng(8), 25, 40, 0.15)
    x[1, :] = 0
    x[1, 3] = 2.0
    norm = np.sqrt((x * x).sum(0))
    s = x @ ((x.T @ x) / np.outer(norm, norm))
    top = knn.knn_topk(_frame(spark, x).withColumnRenamed("weight", "rating"), 6, _frame(spark, x)).collect()
    for u in range(25):
        unseen = [i for i in range(40) if not x[u, i] and s[u, i]]
        want = sorted(unseen, key=lambda i: (-round(s[u, i], 9), i))[:6] if x[u].any() else []
        assert [(r.item_id - 7) // 3 for r in sorted((r for r in top if r.user_id == u), key=lambda r: r.rank)] == want


@pytest.mark.parametrize("values", [[1.0], [1, 1, 1, 5], list(range(100)), [1e300, -1e300, 0, 1e-300, 3, 3], [0.1, 0.1 + 1e-17, 0.1 + 2e-17, 0.3]])
def test_weighted_quantiles_equal_numpy(spark, values):
    from rankforge.operators.ranking import weighted_quantiles

    rng = np.random.default_rng(0)
    w = rng.integers(1, 5, len(values))
    qs = [0.0, 0.1, 0.5, 0.74, 0.9, 1.0]
    df = spark.createDataFrame([(float(v), float(k)) for v, k in zip(values, w)] + [(None, 3.0), (float("nan"), 2.0), (4.0, 0.0)], "v double, w double")
    want = np.quantile(np.repeat(np.array(values, float), w), qs)
    assert np.allclose(weighted_quantiles(df, qs, buckets=4), want)
    assert all(np.isnan(x) for x in weighted_quantiles(df.limit(0), qs))


# ---------------------------------------------------------------- Gram (J-1) with chunking
def test_gram_chunked_equals_dense(spark):
    from rankforge.operators.blocks import gram

    rng = np.random.default_rng(11)
    X = (rng.random((8, 30)) < 0.7) * rng.integers(1, 6, (8, 30))
    X[0, :] = rng.integers(1, 6, 30)          # one "hot" user with every item
    df = spark.createDataFrame([(u, i, float(X[u, i])) for u in range(8) for i in range(30) if X[u, i]],
                               "user_id long, item_id long, weight double")
    G = _dense(gram(df, chunk=4).collect(), "item_i", "item_j", "g", (30, 30))
    ref = np.triu(X.T @ X)
    assert np.allclose(G, ref)


# ---------------------------------------------------------------- blocked top-k (J-8 / RT-3)
@pytest.mark.parametrize("metric", ["dot", "cosine", "l2"])
def test_block_topk_equals_bruteforce(spark, metric):
    from rankforge.operators.blocks import block_topk

    rng = np.random.default_rng(5)
    A, B = rng.normal(size=(13, 4)), rng.normal(size=(17, 4))
    left = spark.createDataFrame([(i, A[i].tolist()) for i in range(13)], "user_id long, vector array<double>")
    right = spark.createDataFrame([(j, B[j].tolist()) for j in range(17)], "item_id long, vector array<double>")
    ex = spark.createDataFrame([(0, 1), (0, 2), (5, 7)], "user_id long, item_id long")
    got = block_topk(left, right, 3, exclude=ex, block=4, metric=metric).collect()
    if metric == "cosine":
        S = (A / np.linalg.norm(A, axis=1, keepdims=True)) @ (B / np.linalg.norm(B, axis=1, keepdims=True)).T
    elif metric == "l2":
        S = -np.linalg.norm(A[:, None, :] - B[None, :, :], axis=2)
    else:
        S = A @ B.T
    S[0, 1] = S[0, 2] = S[5, 7] = -np.inf
    for u in range(13):
        exp = sorted(range(17), key=lambda j: (-S[u, j], j))[:3]
        mine = [r["item_id"] for r in sorted([r for r in got if r["user_id"] == u], key=lambda r: r["rank"])]
        assert mine == exp


# ---------------------------------------------------------------- M-10 graph (D2)
def test_graph_three_hops_equals_dense(spark):
    from rankforge.operators.models.graph import propagate

    edges = [(0, 0), (0, 1), (1, 1), (1, 2), (2, 2)]
    nu = ni = 3
    A = np.zeros((nu + ni, nu + ni))
    for u, i in edges:
        A[u, nu + i] = A[nu + i, u] = 1
    d = A.sum(1)
    L = A / np.sqrt(np.outer(d, d))
    ref = np.linalg.matrix_power(L, 3)[:nu, nu:]
    assert np.allclose(np.linalg.matrix_power(L, 2)[:nu, nu:], 0)     # even hops: no user->item mass
    x = spark.createDataFrame([(u, i, 1.0) for u, i in edges], "user_id long, item_id long, rating double")
    got = _dense(propagate(x, 3, checkpoint=False).collect(), "user_id", "item_id", "score", (nu, ni))
    assert np.allclose(got, ref)
    with pytest.raises(ValueError):
        propagate(x, 2)


# ---------------------------------------------------------------- randomized SVD (FE-4 / M-4)
def test_randomized_svd_matches_numpy(spark):
    from rankforge.operators.linalg import randomized_svd

    rng = np.random.default_rng(0)
    # A clearly low-rank matrix plus noise: leading singular values are well separated.
    A = rng.normal(size=(40, 3)) @ np.diag([20.0, 10.0, 5.0]) @ rng.normal(size=(3, 25)) + 0.01 * rng.normal(size=(40, 25))
    df = spark.createDataFrame([(i, j, float(A[i, j])) for i in range(40) for j in range(25)],
                               "row long, col long, val double")
    u, s, vs = randomized_svd(df, 3)
    ref = np.linalg.svd(A, compute_uv=False)[:3]
    assert np.allclose(s, ref, rtol=1e-6)
    V = np.zeros((25, 3))
    for r in vs.collect():
        V[r["col"]] = r["vector"]
    _, _, Vt = np.linalg.svd(A)
    for c in range(3):
        refc = Vt[c] * ref[c]
        refc = refc * np.sign(refc[np.argmax(np.abs(refc))])
        assert np.allclose(V[:, c], refc, atol=1e-4)


# ---------------------------------------------------------------- BM25 (RT-1/2) by hand
def test_bm25_okapi_formula(spark):
    from rankforge.operators import retrieval as rt

    docs = ["apple banana", "apple cherry cherry", "apple banana date", "egg"]
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    q = spark.createDataFrame([(0, "apple apple banana")], "query_id long, text string")
    idx = rt.bm25_index(d)
    got = {r["doc_id"]: r["score"] for r in rt.bm25_scores(idx, q).collect()}
    toks = [t.split() for t in docs]
    N, avgdl = len(docs), np.mean([len(t) for t in toks])
    vocab = sorted({w for t in toks for w in t})
    raw = {w: np.log(N - sum(w in t for t in toks) + 0.5) - np.log(sum(w in t for t in toks) + 0.5) for w in vocab}
    eps = 0.25 * np.mean(list(raw.values()))
    idf = {w: (eps if v < 0 else v) for w, v in raw.items()}
    assert raw["apple"] < 0                      # apple is in 3 of 4 documents
    exp = {}
    for i, t in enumerate(toks):
        s = 0.0
        for w in ["apple", "apple", "banana"]:
            tf = t.count(w)
            s += idf[w] * tf * 2.5 / (tf + 1.5 * (1 - 0.75 + 0.75 * len(t) / avgdl))
        if s > 0:
            exp[i] = s
    assert got.keys() == exp.keys()
    assert all(np.isclose(got[i], exp[i]) for i in exp)


# ---------------------------------------------------------------- Rocchio (M-7)
def test_rocchio_equals_numpy(spark):
    from rankforge.operators.models.profiles import rocchio_profile

    V = np.array([[1.0, 0, 0], [0, 1.0, 0], [0, 0, 1.0], [1.0, 1.0, 0]])
    ratings = [(0, 0, 5.0), (0, 1, 1.0), (1, 2, 4.0), (1, 3, 4.0), (2, 0, 2.0)]
    r = spark.createDataFrame(ratings, "user_id long, item_id long, rating double")
    v = spark.createDataFrame([(i, V[i].tolist()) for i in range(4)], "item_id long, vector array<double>")
    got = {x["user_id"]: np.array(x["vector"]) for x in rocchio_profile(r, v, 0.5).collect()}
    p0 = np.maximum(V[0] - 0.5 * V[1], 0)
    p1 = (V[2] + V[3]) / 2
    assert np.allclose(got[0], p0 / (np.linalg.norm(p0) + 1e-8))
    assert np.allclose(got[1], p1 / (np.linalg.norm(p1) + 1e-8))
    assert 2 not in got                          # no liked item -> no profile (zero scores)


# ---------------------------------------------------------------- exact rank helpers
def test_top_k_prior_and_full_ranks_bruteforce(spark):
    from rankforge.operators import metrics as ev
    from rankforge.operators.ranking import top_k_prior

    rng = np.random.default_rng(9)
    nu, ni = 6, 15
    prior = rng.integers(0, 4, ni).astype(float)       # many ties: broken by item id
    seen = [(u, i) for u in range(nu) for i in range(ni) if rng.random() < 0.3]
    rel = [(u, i) for u in range(nu) for i in range(ni) if (u, i) not in seen and rng.random() < 0.2]
    P = spark.createDataFrame([(i, float(prior[i])) for i in range(ni)], "item_id long, score double")
    S = spark.createDataFrame(seen, "user_id long, item_id long")
    Rl = spark.createDataFrame(rel, "user_id long, item_id long")
    U = spark.createDataFrame([(u,) for u in range(nu)], "user_id long")
    top = top_k_prior(P, U, S, 4).collect()
    ranks = {(r["user_id"], r["item_id"]): r["rank"] for r in ev.full_ranks_prior(P, S, Rl).collect()}
    for u in range(nu):
        order = [i for i in sorted(range(ni), key=lambda i: (-prior[i], i)) if (u, i) not in seen]
        assert [r["item_id"] for r in sorted([r for r in top if r["user_id"] == u], key=lambda r: r["rank"])] == order[:4]
        for i in order:
            if (u, i) in rel:
                assert ranks[(u, i)] == order.index(i) + 1


def test_full_ranks_with_implicit_scores(spark):
    from rankforge.operators import metrics as ev

    rng = np.random.default_rng(4)
    nu, ni = 5, 12
    seen = {(u, i) for u in range(nu) for i in range(ni) if rng.random() < 0.25}
    expl = {(u, i): float(rng.normal()) for u in range(nu) for i in range(ni)
            if (u, i) not in seen and rng.random() < 0.4}
    implicit = {u: float(rng.normal() * 0.1) for u in range(nu)}
    rel = [(u, i) for u in range(nu) for i in range(ni) if (u, i) not in seen and rng.random() < 0.3]
    sc = spark.createDataFrame([(u, i, s) for (u, i), s in expl.items()], "user_id long, item_id long, score double")
    got = {(r["user_id"], r["item_id"]): r["rank"] for r in ev.full_ranks(
        sc, spark.createDataFrame(list(seen), "user_id long, item_id long"),
        spark.createDataFrame(rel, "user_id long, item_id long"),
        spark.createDataFrame([(i,) for i in range(ni)], "item_id long"),
        spark.createDataFrame(list(implicit.items()), "user_id long, implicit double")).collect()}
    for u in range(nu):
        unseen = [i for i in range(ni) if (u, i) not in seen]
        key = lambda i: (-expl.get((u, i), implicit[u]), i)
        order = sorted(unseen, key=key)
        for i in unseen:
            if (u, i) in rel:
                assert got[(u, i)] == order.index(i) + 1


def test_global_row_number_is_a_permutation(spark):
    from rankforge.operators.ranking import global_row_number

    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("v"))
    got = [r["rank"] for r in global_row_number(df, [F.col("v").desc()], n_parts=7).orderBy(F.col("v").desc()).collect()]
    assert got == list(range(1, 1001))


def test_cosines_of_chosen_items_are_whole_rows_of_all_cosines(spark):
    from rankforge.operators.models import knn

    x = _history(np.random.default_rng(5), 20, 30, 0.3)
    x[1, :] = 3  # more rows than a chunk
    df = _frame(spark, x).withColumnRenamed("weight", "rating")
    wanted = spark.createDataFrame([(7,), (3 * 4 + 7,), (3 * 29 + 7,), (3 * 29 + 7,), (1_000_000,)], "item_id long")
    whole = {(r.item_i, r.item_j): r.sim for r in knn.item_cosine(df, chunk=8).collect()}
    rows = knn.item_cosine(df, chunk=8, sources=wanted).collect()
    got = {(r.item_i, r.item_j): r.sim for r in rows}
    assert len(rows) == len(got) and set(got) == {p for p in whole if p[0] in (7, 19, 94)}
    assert all(abs(got[p] - whole[p]) < 1e-12 for p in got)


def test_query_users_similarities_leave_out_items_nobody_asked_for(spark, monkeypatch):
    from rankforge.operators.models import knn
    from rankforge.plans import q_pipelines

    rows = [(u, 10 * u + i, 4.0) for u in range(1, 6) for i in range(12)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    made, plain = [], knn.item_cosine
    monkeypatch.setattr(knn, "item_cosine", lambda *a, **k: made.append(plain(*a, **k)) or made[-1])
    queries = spark.createDataFrame([(2,), (None,), (99,)], "user_id long")
    got = {(r.user_id, r.item_id): r.score for r in q_pipelines.knn_scores_for_queries(df, queries).collect()}
    want = {(r.user_id, r.item_id): r.score for r in knn.score_with_weights(df.where("user_id = 2"), plain(df)).collect()}
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-9 for p in got)
    assert {r.item_i for r in made[0].select("item_i").distinct().collect()} == set(range(20, 32))


def test_exact_svd_of_long_rows_gathers_them_without_pairs(spark):
    """Repeated entries add up, a row without a key is no part of the fit; the plan of the factors has no join of rows with themselves."""
    from rankforge.operators.linalg import gram_svd

    rng = np.random.default_rng(3)
    a = (rng.random((50, 12)) < 0.4) * rng.integers(1, 5, (50, 12)).astype(float)
    rows = [(int(i), f"c{j:02d}", float(a[i, j])) for i, j in zip(*np.nonzero(a))]
    extra = [(3, "c01", 2.0), (None, "c00", 50.0)]
    a[3, 1] += 2.0
    df = spark.createDataFrame(rows + extra, "row long, col string, val double")
    u, s, vs = gram_svd(df, 4)
    want = np.linalg.svd(a)
    assert np.allclose(s, want[1][:4])
    got = {r["row"]: np.array(r["vector"]) * s for r in u.collect()}
    v = {r["col"]: np.array(r["vector"]) / s for r in vs.collect()}
    V = np.array([v[f"c{j:02d}"] for j in range(12)])
    assert all(np.allclose(got[i], a[i] @ V) for i in got if i is not None) and None in got
    assert "Join" not in u._jdf.queryExecution().executedPlan().toString()


def test_cold_item_factors_are_the_ridge_map(spark):
    from rankforge.operators.models.factors import cold_item_factors

    rng = np.random.default_rng(4)
    f, v = rng.normal(size=(30, 5)), rng.normal(size=(20, 3))
    features = spark.createDataFrame([(i, [float(x) for x in f[i]]) for i in range(30)], "item_id long, vector array<double>")
    warm = spark.createDataFrame([(i, [float(x) for x in v[i]]) for i in range(20)], "item_id long, vector array<double>")
    w = np.linalg.solve(f[:20].T @ f[:20] + 0.5 * np.eye(5), f[:20].T @ v)
    cold = cold_item_factors(warm, features, 0.5)
    got = {r["item_id"]: r["vector"] for r in cold.collect()}
    assert set(got) == set(range(20, 30)) and all(np.allclose(got[i], f[i] @ w) for i in got)
    assert "Generate" not in cold._jdf.queryExecution().executedPlan().toString()


def test_norms_and_texts_are_worked_out_once_a_row(spark):
    """Inside an entry's lambda only variables stand, no norm or clean-up of the whole row."""
    from rankforge.functions.text import char_ngrams
    from rankforge.functions.vectors import l2_normalize

    df = spark.createDataFrame([("Ab  c", [3.0, 4.0]), (None, None), ("x", [])], "t string, v array<double>")
    got = [tuple(r) for r in df.select(char_ngrams("t", 2, 3), l2_normalize("v", 0.0)).collect()]
    assert got[0] == (["ab", "b ", " c", "ab ", "b c"], [0.6, 0.8]) and got[1][1] is None and got[2] == ([], [])
    plan = df.select(char_ngrams("t", 2, 3).alias("g"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1
    assert df.select(l2_normalize("v").alias("g"))._jdf.queryExecution().optimizedPlan().toString().count("SQRT") == 1


# ---------------------------------------------------------------- sparse tiles of kNN and graph
def _sparse_entries(spark, n, seed):
    rng = np.random.default_rng(seed)
    m = np.triu((rng.random((n, n)) < 0.03) * rng.random((n, n))) + np.diag(rng.random(n) + 0.1)
    return m + np.triu(m, 1).T, spark.createDataFrame([(int(i), int(j), float(m[i, j])) for i, j in zip(*np.nonzero(m))], "item_i long, item_j long, v double")


@pytest.mark.parametrize("n, tile", [(130, 64), (128, 32)])
def test_a_sparse_matrix_takes_the_disk_of_its_entries(spark, n, tile):
    """Kept dense, its tiles took 8 bytes a pair."""
    import os

    from rankforge.operators.tiles import invert, store_tiles

    m, entries = _sparse_entries(spark, n, tile)
    rows = entries.select(F.col("item_i").alias("i"), F.col("item_j").alias("j"), "v")
    t = store_tiles(rows, n, size=tile)
    assert np.array_equal(np.block([[t.read(i, j) for j in range(t.blocks)] for i in range(t.blocks)]), m)
    folder = t.folder.removeprefix("file:")
    assert sum(os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder) if f.startswith("raw-")) < 12 * n * n / 4
    p = invert(spark, store_tiles(rows, n, 9.0, size=tile))  # an inverse is dense
    got = np.block([[p.read(i, j) for j in range(p.blocks)] for i in range(p.blocks)])
    assert np.allclose(got, np.linalg.inv(m + 9.0 * np.eye(n)), atol=1e-9)


@pytest.mark.parametrize("strip, products", [(16, 1 << 22), (1, 50), (3, 5)])
def test_products_of_sparse_tiles_equal_dense(spark, monkeypatch, strip, products):
    """Strips of any width, few products at once, a user with every item, and weights that are no numbers."""
    from rankforge.operators import item_matrix as im

    n = 130
    monkeypatch.setattr(im, "STRIP", strip)
    monkeypatch.setattr(im, "TASKS", 1)
    m, entries = _sparse_entries(spark, n, 5)
    rng = np.random.default_rng(8)
    x = (rng.random((20, n)) < 0.05) * rng.integers(1, 6, (20, n)).astype(float)
    x[0] = 1.0
    x[1, 3] = np.nan
    df = spark.createDataFrame([(int(u), int(i), float(x[u, i])) for u, i in zip(*np.nonzero(x))], "user_id long, item_id long, weight double")
    items = spark.range(n).select(F.col("id").alias("item_id"))
    mat = im.item_matrix(entries, items, tile=32)
    want = x @ m
    got = np.full((20, n), np.inf)
    for r in im.matrix_scores(df, mat).collect():
        got[r.user_id, r.item_id] = r.score
    assert np.isnan(got[1]).all()  # as 0 times no number is none
    assert np.allclose(np.delete(got, 1, 0), np.delete(want, 1, 0), atol=1e-12)
    # The task's own function, in this process, where few products are held at once.
    monkeypatch.setattr(im, "PRODUCTS", products)
    u, i = np.nonzero(x)
    own = np.hstack([im.block_products(u, i, x[u, i], 20, mat.p.rows(j), 32, lambda a, j=j: mat.kept(a, j), mat.p.blocks) for j in range(mat.p.blocks)])
    assert np.allclose(own, want, atol=1e-12, equal_nan=True)
    top = im.matrix_topk(df, mat, 4, df, reached=True).collect()
    for a in range(20):
        unseen = [] if a == 1 else [b for b in range(n) if not x[a, b] and want[a, b]]
        assert [r.item_id for r in sorted((r for r in top if r.user_id == a), key=lambda r: r.rank)] == sorted(unseen, key=lambda b: (-round(want[a, b], 9), b))[:4]


def test_best_of_block_is_the_whole_sort():
    from rankforge.operators.item_matrix import best_of_block

    s = np.random.default_rng(4).integers(0, 4, (30, 17)).astype(float)
    s[2], s[3, 5], s[4, :14], s[5, 3] = -np.inf, np.nan, -np.inf, np.inf
    items, users = np.arange(17) * 2, np.arange(30)
    for k in (1, 5, 17, 40):
        order = np.argsort(-np.round(s, 9), axis=1, kind="stable")[:, :k]
        want = [(u, items[c], s[u, c]) for u in users for c in order[u] if np.isfinite(s[u, c])]
        got = best_of_block(users, items, s, k)
        assert list(zip(got["user_id"], got["item_id"], got["score"])) == want


def test_ranks_in_strips_are_those_of_single_blocks(spark, monkeypatch):
    """A task takes several item blocks; what it leaves out and counts goes with each block."""
    from rankforge.operators import item_matrix as im
    from rankforge.operators.models import fused

    m, entries = _sparse_entries(spark, 130, 6)
    rng = np.random.default_rng(9)
    pairs = [(int(u), int(i), float(rng.integers(1, 6))) for u in range(12) for i in rng.choice(130, 6, replace=False)]
    df = spark.createDataFrame(pairs, "user_id long, item_id long, weight double")
    seen, aims = df.where("item_id % 2 = 0"), df.where("item_id % 2 = 1").select("user_id", "item_id")
    found = []
    for strip in (1, 3):
        monkeypatch.setattr(im, "STRIP", strip)
        monkeypatch.setattr(im, "TASKS", 1)
        items = spark.range(130).select(F.col("id").alias("item_id"))
        r = fused.Ranker(df.select("user_id"), items, tile=32).seen(seen).matrix("m", df, im.item_matrix(entries, items, tile=32))
        found.append(sorted(map(tuple, r.ranks_of(lambda b: b.scores["m"], aims).collect())))
    x = np.zeros((12, 130))
    for u, i, w in pairs:
        x[u, i] = w
    s = np.round(x @ m, 9)
    want = sorted((u, i, 1 + sum(1 for c in range(130) if not (x[u, c] and c % 2 == 0) and (-s[u, c], c) < (-s[u, i], i))) for u, i, _ in pairs if i % 2)
    assert found == [want, want]
