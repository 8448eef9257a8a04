"""Serving pipelines over a table of parsed queries (RT-9..RT-16) and their gates
(PF-7, PF-8, PF-9, PF-11, TK-2, TK-4, J-9, AG-11).

A query row: query_id, user_id (nullable), text, semantic_description,
hypothetical_ideal, genre_filter array, director_filter, year_min, year_max, n,
db_satisfiable, query vector (nullable). Every pipeline is a batch over all
query rows at once: filters are joins on query columns, rankings are windows
partitioned by query, nothing loops per query on the driver.

``scores`` is the personal model's (user_id, item_id, score) table (the
reference's trained hybrid; any model of this package fits). Documents share
the item id space (document i describes item i).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankforge.functions.scalars import display_score, hyde_gate, route_query
from rankforge.functions.vectors import cosine
from rankforge.operators import fusion as fu
from rankforge.operators import retrieval as rt
from rankforge.operators.common import with_scalars
from rankforge.session import cut_lineage

# Fusion defaults and fallback thresholds.
DEFAULT_ALPHA = 0.80
DEFAULT_BETA = 0.20
DENSE_CONFIDENCE = 0.30
MIX_CONFIDENCE = -0.5
RERANK_FLOOR = -2.0
RERANK_DROPPED = -90.0
PERSONAL_K = 20
DENSE_K = 30
RERANK_K = 20


# ---------------------------------------------------------------- PF-7
def metadata_filter(cands: DataFrame, queries: DataFrame, items: DataFrame) -> DataFrame:
    """Keep (query_id, item_id) rows whose item passes the query's filters, case-insensitively:
    any genre overlap; director equal after trim; year within [year_min, year_max] (a null
    year fails a bounded filter). A null filter passes everything. No relaxing."""
    q = queries.select("query_id", "genre_filter", "director_filter", "year_min", "year_max")
    it = items.select("item_id", F.col("genres").alias("_g"), F.col("director").alias("_d"), F.col("year").alias("_y"))
    j = cands.join(q, "query_id").join(it, "item_id", "left")
    gf = F.col("genre_filter")
    lower_arr = lambda c: F.transform(c, lambda x: F.lower(F.trim(x)))
    genre_ok = gf.isNull() | (F.size(gf) == 0) | F.coalesce(F.arrays_overlap(lower_arr(gf), lower_arr("_g")), F.lit(False))
    dir_ok = F.col("director_filter").isNull() | (F.lower(F.trim("director_filter")) == F.lower(F.trim("_d")))
    ymin_ok = F.col("year_min").isNull() | (F.col("_y").isNotNull() & (F.col("_y") >= F.col("year_min")))
    ymax_ok = F.col("year_max").isNull() | (F.col("_y").isNotNull() & (F.col("_y") <= F.col("year_max")))
    keep = genre_ok & F.coalesce(dir_ok, F.lit(False)) & ymin_ok & ymax_ok
    return j.where(keep).select(*cands.columns)


# ---------------------------------------------------------------- PF-8
def satisfiable_split(queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    ok = F.coalesce(F.col("db_satisfiable"), F.lit(True))
    return queries.where(ok), queries.where(~ok)


# ---------------------------------------------------------------- PF-9
def fallback_trigger(results: DataFrame, queries: DataFrame, dense: DataFrame | None = None) -> DataFrame:
    """(query_id, triggered, reason); first rule wins: too few results (< n); best dense
    similarity < 0.30; best personal score < -0.5 (a zero/absent mix score falls through
    to the fused score); best finite rerank score < -2.0."""
    agg = results.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("_cnt"),
        F.max(F.when(F.col("mix_score").isNull() | (F.col("mix_score") == 0), F.coalesce(F.col("fused_score"), F.lit(0.0)))
              .otherwise(F.col("mix_score"))).alias("_best_mix"),
        F.max(F.when(~F.isnan("rerank_score"), F.col("rerank_score"))).alias("_best_rr"))
    j = queries.select("query_id", "n").join(agg, "query_id", "left").fillna(0, ["_cnt"])
    if dense is not None:
        j = j.join(dense.groupBy("query_id").agg(F.max("score").alias("_best_dense")), "query_id", "left")
    else:
        j = j.withColumn("_best_dense", F.lit(None).cast("double"))
    reason = (F.when(F.col("_cnt") < F.col("n"), F.lit("too_few_results"))
              .when(F.col("_best_dense").isNotNull() & (F.col("_best_dense") < DENSE_CONFIDENCE), F.lit("weak_dense_match"))
              .when((F.col("_cnt") > 0) & (F.col("_best_mix") < MIX_CONFIDENCE), F.lit("weak_personal_score"))
              .when(F.col("_best_rr").isNotNull() & (F.col("_best_rr") < RERANK_FLOOR), F.lit("rerank_mismatch")))
    return j.select("query_id", reason.isNotNull().alias("triggered"), F.coalesce(reason, F.lit("")).alias("reason"))


# ---------------------------------------------------------------- personal candidates
def top_n(df: DataFrame, n: str, score: str, group: str = "query_id", item: str = "item_id") -> DataFrame:
    """Rows ranked 1..n per group, n a column of the rows (ties by item)."""
    w = Window.partitionBy(group).orderBy(F.col(score).desc_nulls_last(), F.col(item).asc())
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= F.col(n))


def personal_candidates(queries: DataFrame, scores: DataFrame, items: DataFrame, seen: DataFrame, k: int | str,
                        filtered: bool = True, popular: DataFrame | None = None) -> DataFrame:
    """(query_id, item_id, mix_score, rank): the user's unseen items by personal score,
    metadata filters applied before the ranking (filters never run after the cut).
    ``k``: a number, or the column of ``queries`` that holds one. A user without history
    gets the best k of ``popular`` (item_id, score), unfiltered."""
    limit = F.lit(k) if isinstance(k, int) else F.col(k)
    q = queries.where(F.col("user_id").isNotNull()).select("query_id", "user_id", limit.cast("long").alias("_k"))
    c = q.join(scores.select("user_id", "item_id", F.col("score").alias("mix_score")), "user_id") \
        .join(seen.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
    if filtered:
        c = metadata_filter(c, queries, items)
    # Ranking key rounded to 1e-9: equal scores computed in different orders tie by item id.
    c = top_n(c.withColumn("_rs", F.round("mix_score", 9)), "_k", "_rs").select("query_id", "item_id", "mix_score", "rank")
    if popular is None:
        return c
    cold = q.join(seen.select("user_id").distinct(), "user_id", "left_anti")
    most = cold.agg(F.max("_k")).first()[0]
    if not most:
        return c
    # The list has as many rows as the largest request.
    best = (popular.select("item_id", "score").orderBy(F.round("score", 9).desc(), "item_id").limit(int(most))
            .agg(F.array_sort(F.collect_list(F.struct((-F.round("score", 9)).alias("o"), "item_id", "score"))).alias("_list"))
            .select(F.transform("_list", lambda e: e["item_id"]).alias("_ids"), F.transform("_list", lambda e: e["score"]).alias("_scores")))
    listed = with_scalars(cold, best).select("query_id", F.posexplode(F.slice("_ids", F.lit(1), F.col("_k").cast("int"))).alias("_pos", "item_id"), "_scores")
    listed = listed.select("query_id", "item_id", F.element_at("_scores", F.col("_pos") + 1).alias("mix_score"), (F.col("_pos") + 1).alias("rank"))
    return c.unionByName(listed)


def dense_candidates(queries: DataFrame, vectors: DataFrame, k: int, text_vector: str = "vector") -> DataFrame:
    q = queries.where(F.col(text_vector).isNotNull()).select("query_id", F.col(text_vector).alias("vector"))
    return rt.dense_search(q, vectors.select(F.col("item_id").alias("doc_id"), "vector"), k, round_digits=9) \
        .select("query_id", F.col("doc_id").alias("item_id"), F.col("score").alias("dense_score"), "rank")


def _rerank(c: DataFrame, queries: DataFrame, docs: DataFrame, query_col: str = "text", scorer=None) -> DataFrame:
    pairs = (c.join(queries.select("query_id", F.col(query_col).alias("query_text")), "query_id")
             .join(docs.select(F.col("doc_id").alias("item_id"), F.col("text").alias("doc_text")), "item_id", "left")
             .withColumn("doc_text", rt.rerank_text(F.col("doc_text"), None, None, F.col("item_id"))))
    r = rt.rerank(pairs, "query_text", "doc_text", scorer, "query_id", "item_id")
    return r.drop("query_text", "doc_text")


def _rich_text(queries: DataFrame) -> DataFrame:
    """``_rich``: the gated hypothetical text and the semantic description."""
    hyde = hyde_gate("text", "hypothetical_ideal", "semantic_description")
    return queries.withColumn("_hyde", hyde).withColumn("_rich", F.trim(F.concat_ws(" ", F.col("_hyde"), F.col("semantic_description"))))


def _with_lookup(pers: DataFrame, found: DataFrame, queries: DataFrame, scores: DataFrame) -> DataFrame:
    """J-9: personal rows, and for ids that only the other engine found the user's score by lookup
    (seen items too)."""
    only = found.join(pers.select("query_id", "item_id"), ["query_id", "item_id"], "left_anti") \
        .join(queries.select("query_id", "user_id"), "query_id")
    back = only.join(scores.select("user_id", "item_id", F.col("score").alias("mix_score")), ["user_id", "item_id"])
    return pers.select("query_id", "item_id", "mix_score").unionByName(back.select("query_id", "item_id", "mix_score"))


# ---------------------------------------------------------------- RT-9: P1 sequential
def p1_sequential(queries, scores, items, docs, seen, scorer=None, popular=None) -> DataFrame:
    """Filters -> personal top-n -> metadata -> rerank by the semantic description -> TK-4 cut."""
    c = personal_candidates(queries, scores, items, seen, "n", True, popular).drop("rank")
    r = _rerank(c, queries, docs, "semantic_description", scorer)
    return r.select("query_id", "item_id", "mix_score", F.lit(None).cast("double").alias("fused_score"),
                    "rerank_score", F.col("rerank_rank").alias("rank"), F.lit("P1").alias("pipeline"))


# ---------------------------------------------------------------- RT-10 / RT-12: P2 dual, P4 HyDE
def _dual_arms(queries, scores, items, docs, vectors, seen, hyde, scorer, popular):
    """Queries with their rich text, the column to rerank by, and the candidates: personal ones, dense ones, and the
    personal ones with the dense-only ids looked up."""
    q = _rich_text(queries)
    text = "_rich" if hyde else "semantic_description"
    pers = personal_candidates(q, scores, items, seen, PERSONAL_K, True, popular).drop("rank")
    de = _rerank(dense_candidates(q, vectors, DENSE_K).drop("rank"), q, docs, text, scorer) \
        .where(F.col("rerank_rank") <= RERANK_K).select("query_id", "item_id", "dense_score", "rerank_score")
    personal = _with_lookup(pers, de, q, scores)
    return q, text, pers, de, personal


def dual_alpha_sweep(queries, scores, items, docs, vectors, seen, alphas: list[float], k: int = 10, hyde=False,
                     scorer=None, popular=None) -> DataFrame:
    """TU-4: (trial, query_id, item_id, fused_score, rank), the best k of P2's (``hyde``: P4's) candidates at each fusion
    weight alpha, beta = 1 - alpha, the candidates made once."""
    _, _, pers, de, personal = _dual_arms(queries, scores, items, docs, vectors, seen, hyde, scorer, popular)
    return fu.fusion_sweep(personal.withColumnRenamed("mix_score", "score"), de.withColumnRenamed("dense_score", "score"),
                           alphas, k, own_a=pers)


def p2_dual(queries, scores, items, docs, vectors, seen, alpha=DEFAULT_ALPHA, beta=DEFAULT_BETA, hyde=False,
            scorer=None, popular=None) -> DataFrame:
    """Personal top-20 with filters + dense top-30 reranked to 20, dense-only ids scored by lookup
    (J-9), z-fusion over the union (FU-8/9; an engine that found nothing itself has no weight),
    best n. P2 keeps the fused order, with the dense side's rerank score (0 for ids it did not
    find); P4 reads hypothetical and semantic text together and reranks the best n by them."""
    q, text, pers, de, personal = _dual_arms(queries, scores, items, docs, vectors, seen, hyde, scorer, popular)
    f = fu.candidate_z_fusion(personal.withColumnRenamed("mix_score", "score"), de.withColumnRenamed("dense_score", "score"),
                              alpha, beta, group="query_id", own_a=pers)
    f = f.withColumnRenamed("score_a", "mix_score").drop("score_b").join(q.select("query_id", "n"), "query_id")
    t = top_n(f.withColumn("_rs", F.round("fused_score", 9)), "n", "_rs").select("query_id", "item_id", "mix_score", "fused_score", "rank")
    if hyde:
        r = _rerank(t.drop("rank"), q, docs, text, scorer).withColumnRenamed("rerank_rank", "rank")
    else:
        r = t.join(de.select("query_id", "item_id", "rerank_score"), ["query_id", "item_id"], "left").fillna(0.0, ["rerank_score"])
    return r.select("query_id", "item_id", "mix_score", "fused_score", "rerank_score", "rank",
                    F.lit("P4" if hyde else "P2").alias("pipeline"))


# ---------------------------------------------------------------- RT-11: P3 RAG (no user signal)
def p3_rag(queries, items, docs, vectors, scorer=None) -> DataFrame:
    """Exact dense search, among the director's items where one is given; each query fetches its n, or
    max(3n, 30) before a genre filter; rerank budget max(n, 20), in-list min-max of the dense
    score, best n by the rerank score."""
    has_genre = F.coalesce(F.size("genre_filter") > 0, F.lit(False))
    budget = F.when(has_genre, F.greatest(F.col("n") * 3, F.lit(30))).otherwise(F.col("n"))
    q = queries.where(F.col("vector").isNotNull()).withColumn("_budget", budget)
    free, directed = q.where(F.col("director_filter").isNull()), q.where(F.col("director_filter").isNotNull())
    most = free.agg(F.max("_budget")).first()[0] or 1
    de = dense_candidates(free, vectors, int(most)).select("query_id", "item_id", "dense_score")
    own = (directed.select("query_id", F.col("vector").alias("_qv"), F.lower(F.trim("director_filter")).alias("_d"))
           .join(items.select("item_id", F.lower(F.trim("director")).alias("_d")), "_d").join(vectors, "item_id")
           .select("query_id", "item_id", F.round(cosine("_qv", "vector", 1e-12), 9).alias("dense_score")))
    de = top_n(de.unionByName(own).join(q.select("query_id", "_budget"), "query_id"), "_budget", "dense_score").drop("rank", "_budget")
    none = F.lit(None)
    genre_only = queries.withColumns({"director_filter": none.cast("string"), "year_min": none.cast("int"), "year_max": none.cast("int")})
    de = metadata_filter(de, genre_only, items).join(queries.select("query_id", F.greatest("n", F.lit(RERANK_K)).alias("_kept")), "query_id")
    de = top_n(de, "_kept", "dense_score").select("query_id", "item_id", "dense_score")
    de = fu.minmax_rows(de, "query_id", "dense_score", "dense_norm")
    r = _rerank(de, queries, docs, "semantic_description", scorer).join(queries.select("query_id", "n"), "query_id") \
        .where(F.col("rerank_rank") <= F.col("n"))
    return r.select("query_id", "item_id", F.lit(None).cast("double").alias("mix_score"),
                    F.col("dense_norm").alias("fused_score"), "rerank_score", F.col("rerank_rank").alias("rank"),
                    F.lit("P3").alias("pipeline"))


# ---------------------------------------------------------------- RT-13: P5 deep hybrid
def p5_deep(queries, subs, scores, items, docs, vectors, index, seen, alpha=DEFAULT_ALPHA, beta=DEFAULT_BETA,
            scorer=None, popular=None) -> DataFrame:
    """Satisfiable queries: candidate pool (hypothetical text at 0.75 + sub-queries, max-merged),
    personal top-30, pool-only ids scored by lookup, z-fusion, best 2n reranked after fusion by
    hypothetical and semantic text, cut to n. Unsatisfiable queries produce no rows here (their
    fallback is flagged by ``fallback_trigger``)."""
    ok, _ = satisfiable_split(_rich_text(queries))
    hyde = ok.select("query_id", F.col("_hyde").alias("text"), "vector")
    pool = rt.candidate_pool(index, hyde, subs.join(ok.select("query_id"), "query_id", "left_semi"), vectors.select(
        F.col("item_id").alias("doc_id"), "vector"), 30, round_digits=9).withColumnRenamed("doc_id", "item_id")
    pers = personal_candidates(ok, scores, items, seen, 30, True, popular).drop("rank")
    personal = _with_lookup(pers, pool, ok, scores)
    f = fu.candidate_z_fusion(personal.withColumnRenamed("mix_score", "score"), pool, alpha, beta, group="query_id", own_a=pers)
    f = f.withColumnRenamed("score_a", "mix_score").drop("score_b").join(ok.select("query_id", (F.col("n") * 2).alias("_2n")), "query_id")
    head = top_n(f.withColumn("_rs", F.round("fused_score", 9)), "_2n", "_rs").select("query_id", "item_id", "mix_score", "fused_score")
    r = _rerank(head, ok, docs, "_rich", scorer)
    # A scorer that gave every candidate <= -90 carries no signal: keep the fused order then.
    w = Window.partitionBy("query_id")
    dropped = F.max("rerank_score").over(w) <= RERANK_DROPPED
    fw = Window.partitionBy("query_id").orderBy(F.round("fused_score", 9).desc(), F.col("item_id"))
    r = r.withColumn("_fr", F.row_number().over(fw)).withColumn("_drop", dropped) \
        .withColumn("rank", F.when(F.col("_drop"), F.col("_fr")).otherwise(F.col("rerank_rank"))) \
        .withColumn("rerank_score", F.when(~F.col("_drop"), F.col("rerank_score")))
    r = r.join(ok.select("query_id", "n"), "query_id").where(F.col("rank") <= F.col("n"))
    return r.select("query_id", "item_id", "mix_score", "fused_score", "rerank_score", "rank", F.lit("P5").alias("pipeline"))


# ---------------------------------------------------------------- RT-14: router
def recommend(queries, scores, items, docs, vectors, seen, subs=None, index=None, forced: str | None = None,
              scorer=None, popular=None) -> DataFrame:
    """Route every query row (FN-14) and union the pipelines' rows; TK-4 cut to the requested n;
    PF-11 display score. 'none' rows (blank text) produce nothing, a route that does not exist
    one row of pipeline 'error' without an item. ``forced``: a route for all rows, or the column
    of ``queries`` that names one."""
    route = None if forced is None else F.col(forced) if forced in queries.columns else F.lit(forced)
    routed = queries.withColumn("route", route_query("text", "user_id", route))
    by = {p: routed.where(F.col("route") == p) for p in ("P1", "P2", "P3", "P4", "P5")}
    parts = [p1_sequential(by["P1"], scores, items, docs, seen, scorer, popular),
             p2_dual(by["P2"], scores, items, docs, vectors, seen, scorer=scorer, popular=popular),
             p3_rag(by["P3"], items, docs, vectors, scorer),
             p2_dual(by["P4"], scores, items, docs, vectors, seen, hyde=True, scorer=scorer, popular=popular)]
    if subs is not None and index is not None:
        parts.append(p5_deep(by["P5"], subs, scores, items, docs, vectors, index, seen, scorer=scorer, popular=popular))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.join(queries.select("query_id", "n"), "query_id").where(F.col("rank") <= F.col("n")).drop("n")
    out = out.withColumn("display_score", display_score("fused_score", "mix_score", "rerank_score"))
    failed = routed.where(F.col("route") == "error").select("query_id", *[
        (F.lit("error") if f.name == "pipeline" else F.lit(None)).cast(f.dataType).alias(f.name) for f in out.schema.fields if f.name != "query_id"])
    return out.unionByName(failed)


# ---------------------------------------------------------------- RT-16 / AG-11
def overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    """(query_id, n_a, n_b, n_common) of two pipelines' result sets."""
    ca = a.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_a"))
    cb = b.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_b"))
    common = a.select("query_id", "item_id").join(b.select("query_id", "item_id"), ["query_id", "item_id"]) \
        .groupBy("query_id").agg(F.count(F.lit(1)).alias("n_common"))
    return ca.join(cb, "query_id", "full").join(common, "query_id", "left").fillna(0, ["n_a", "n_b", "n_common"])


def compare_pipelines(queries, scores, items, docs, vectors, seen, scorer=None, popular=None) -> DataFrame:
    """P1..P4 side by side: (query_id, rank, p1..p4: the item each pipeline has at that rank) for every
    query with a user, with the size of the P1 / P4 overlap."""
    q = queries.where(F.col("user_id").isNotNull())
    p1 = p1_sequential(q, scores, items, docs, seen, scorer, popular)
    p2 = p2_dual(q, scores, items, docs, vectors, seen, scorer=scorer, popular=popular)
    p3 = p3_rag(q, items, docs, vectors, scorer)
    p4 = p2_dual(q, scores, items, docs, vectors, seen, hyde=True, scorer=scorer, popular=popular)
    rows = cut_lineage(p1.unionByName(p2).unionByName(p3).unionByName(p4).select("query_id", "rank", "pipeline", "item_id"))
    side = rows.groupBy("query_id", "rank").pivot("pipeline", ["P1", "P2", "P3", "P4"]).agg(F.first("item_id"))
    both = overlap(rows.where("pipeline = 'P1'"), rows.where("pipeline = 'P4'"))
    return side.join(both.select("query_id", F.col("n_common").alias("p1_p4_common")), "query_id", "left").fillna(0, ["p1_p4_common"])
