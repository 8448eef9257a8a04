"""Registered queries: keyword and dense retrieval RT-1..RT-8 (+ W-11, TK-2).

Corpus: ``documents`` (document i describes part i); document vectors: the
``embeddings`` row with the same id. Queries: every ``benchmark`` passage
(whole, as query text and as hypothetical text) with the vector of the same id when one exists. Rankings order by scores
rounded to 1e-9 (the oracle's rule) so float summation order cannot flip ties.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from rankforge.operators import fusion as fu
from rankforge.operators import ranking
from rankforge.operators import retrieval as rt
from rankforge.plans.registry import register
from rankforge.plans.sqlparts import with_, wrap
from rankforge.sources import tables as tb
from rankforge.sources.writers import scratch_path

RD = 9


def kw_sql(col: str) -> str:
    return (f"list_filter(string_split_regex(trim(regexp_replace(lower(coalesce({col}, '')), '[^a-z0-9\\s]', ' ', 'g')), "
            f"'\\s+'), lambda x: length(x) > 1)")


INDEX = dict(
    dt=f"SELECT doc_id, {kw_sql('text')} AS toks FROM documents",
    dl="SELECT doc_id, CAST(len(toks) AS DOUBLE) AS dl FROM dt",
    post="SELECT term, doc_id, CAST(count(*) AS DOUBLE) AS tf FROM (SELECT doc_id, unnest(toks) AS term FROM dt) z GROUP BY term, doc_id",
    corp="SELECT count(*) AS n_docs, avg(dl) AS avgdl FROM dl",
    rawidf="""SELECT term, count(*) AS df, ln((SELECT n_docs FROM corp) - count(*) + 0.5) - ln(count(*) + 0.5) AS idf0
              FROM post GROUP BY term""",
    terms="SELECT term, df, CASE WHEN idf0 < 0 THEN 0.25 * (SELECT avg(idf0) FROM rawidf) ELSE idf0 END AS idf FROM rawidf",
)

BQ = """SELECT b.item_id AS query_id, b.text AS text, b.text AS full_text, CAST(e.embedding AS DOUBLE[]) AS vector
        FROM benchmark b LEFT JOIN embeddings e ON e.vec_id = b.item_id"""


def bm25_sql(q: str, textcol: str = "text") -> str:
    return f"""SELECT qt.query_id, post.doc_id,
  sum(qt.qf * terms.idf * (post.tf * 2.5) / (post.tf + 1.5 * (1 - 0.75 + 0.75 * dl.dl / (SELECT avgdl FROM corp)))) AS score
FROM (SELECT query_id, term, count(*) AS qf FROM (SELECT query_id, unnest({kw_sql(textcol)}) AS term FROM {q}) y
      GROUP BY query_id, term) qt
JOIN terms USING (term) JOIN post USING (term) JOIN dl USING (doc_id)
GROUP BY qt.query_id, post.doc_id HAVING sum(qt.qf * terms.idf * (post.tf * 2.5) / (post.tf + 1.5 * (1 - 0.75 + 0.75 * dl.dl / (SELECT avgdl FROM corp)))) > 0"""


def topk_sql(src: str, k: int, score: str = "score", item: str = "doc_id", group: str = "query_id") -> str:
    return f"""SELECT * FROM (SELECT {group}, {item}, round({score}, {RD}) AS score,
  row_number() OVER (PARTITION BY {group} ORDER BY round({score}, {RD}) DESC, {item}) AS rank FROM {src}) z WHERE rank <= {k}"""


def dense_sql(q: str) -> str:
    return f"""SELECT q.query_id, e.vec_id AS doc_id, list_cosine_similarity(q.vector, CAST(e.embedding AS DOUBLE[])) AS score
FROM {q} q CROSS JOIN embeddings e WHERE q.vector IS NOT NULL"""


def hybrid_sql(q: str, alpha: str, prefix: str, top: int = 30, cand: int = 60) -> dict:
    """CTEs computing a hybrid search for query CTE ``q`` (columns query_id, text, vector,
    and the alpha expression)."""
    return {
        f"{prefix}kws": bm25_sql(q),
        f"{prefix}kw": topk_sql(f"{prefix}kws", cand),
        f"{prefix}des": dense_sql(q),
        f"{prefix}de": topk_sql(f"{prefix}des", cand),
        f"{prefix}al": f"SELECT query_id, {alpha} AS alpha FROM {q}",
        f"{prefix}f": f"""SELECT query_id, doc_id, sum(c) AS score FROM (
            SELECT k.query_id, k.doc_id, (1 - a.alpha) / (60 + k.rank) AS c FROM {prefix}kw k JOIN {prefix}al a USING (query_id)
            UNION ALL SELECT d.query_id, d.doc_id, a.alpha / (60 + d.rank) FROM {prefix}de d JOIN {prefix}al a USING (query_id)) z
            GROUP BY query_id, doc_id""",
        f"{prefix}top": topk_sql(f"{prefix}f", top),
    }


def index(spark, sf_dir):
    return rt.bm25_index(tb.keyword_docs(spark, sf_dir))


def stored_index(spark, sf_dir):
    return rt.store_bm25_index(tb.keyword_docs(spark, sf_dir), scratch_path(spark, "keyword-index"))


def doc_vectors(spark, sf_dir):
    return tb.vectors(spark, sf_dir).select(F.col("item_id").alias("doc_id"),
                                            F.col("vector").cast("array<double>").alias("vector"))


def queries(spark, sf_dir):
    q = tb.benchmark_queries(spark, sf_dir)
    full = tb.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("full_text"))
    v = doc_vectors(spark, sf_dir).withColumnRenamed("doc_id", "query_id")
    return q.join(full, "query_id").join(v, "query_id", "left")


@register("rt01_bm25_index", wrap(with_(**INDEX) + "SELECT term, CAST(df AS BIGINT) AS df, idf FROM terms", ["idf"]))
def q_rt01(spark, sf_dir):
    """RT-1: keyword index term statistics (Okapi idf, negative idf -> 0.25 x mean idf) over whole documents."""
    return index(spark, sf_dir).terms


@register("rt01_bm25_corpus", wrap(with_(**INDEX) + "SELECT CAST(n_docs AS BIGINT) AS n_docs, avgdl FROM corp", ["avgdl"]))
def q_rt01b(spark, sf_dir):
    """RT-1: corpus summary (documents, mean token length)."""
    return index(spark, sf_dir).corpus


@register("rt02_bm25_search", wrap(with_(**INDEX, bq=BQ, s=bm25_sql("bq")) + topk_sql("s", 10)
                                   .replace("SELECT * FROM", "SELECT query_id, doc_id, score, CAST(rank AS INTEGER) AS rank FROM"),
                                   ["score"]))
def q_rt02(spark, sf_dir):
    """RT-2: BM25 top-10 documents for every benchmark query (score > 0 only)."""
    r = rt.bm25_search(index(spark, sf_dir), queries(spark, sf_dir), 10, round_digits=RD)
    return r.select("query_id", "doc_id", "score", F.col("rank").cast("int").alias("rank"))


@register("rt01_stored_index", wrap(with_(**INDEX) + """
SELECT terms.term, CAST(df AS BIGINT) AS n_postings, max(idf * (tf * 2.5) / (tf + 1.5 * (1 - 0.75 + 0.75 * dl.dl / (SELECT avgdl FROM corp)))) AS top
FROM terms JOIN post USING (term) JOIN dl USING (doc_id) GROUP BY terms.term, df""", ["top"]))
def q_rt01c(spark, sf_dir):
    """RT-1: the keyword index written in impact-ordered blocks and opened again: postings and largest impact of each term."""
    i = stored_index(spark, sf_dir)
    n = i.blocks.groupBy("term_id").agg(F.sum(F.size("postings")).alias("n_postings"), F.max("most").alias("top"))
    return i.terms.select("term", "term_id").join(n, "term_id").select("term", "n_postings", "top")


@register("rt02_stored_search", wrap(with_(**INDEX, bq=BQ, s=bm25_sql("bq")) + topk_sql("s", 10)
                                     .replace("SELECT * FROM", "SELECT query_id, doc_id, score, CAST(rank AS INTEGER) AS rank FROM"),
                                     ["score"]))
def q_rt02b(spark, sf_dir):
    """RT-2: BM25 top-10 from the stored index, skipping terms, blocks and documents that cannot reach the k-th score."""
    r = rt.bm25_search(stored_index(spark, sf_dir), queries(spark, sf_dir), 10, round_digits=RD)
    return r.select("query_id", "doc_id", "score", F.col("rank").cast("int").alias("rank"))


@register("rt03_dense_self_knn", wrap(with_(
    q="SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS vector FROM embeddings",
    s="""SELECT q.query_id, e.vec_id AS doc_id, list_cosine_similarity(q.vector, CAST(e.embedding AS DOUBLE[])) AS score
         FROM q CROSS JOIN embeddings e WHERE e.vec_id <> q.query_id""") +
    topk_sql("s", 10).replace("SELECT * FROM", "SELECT query_id, doc_id, score, CAST(rank AS INTEGER) AS rank FROM"),
    ["score"]))
def q_rt03(spark, sf_dir):
    """RT-3: exact cosine 10-nearest neighbours of every vector among all others (blocked GEMM)."""
    v = doc_vectors(spark, sf_dir)
    q = v.withColumnRenamed("doc_id", "query_id")
    ex = v.select(F.col("doc_id").alias("query_id"), "doc_id")
    return rt.dense_search(q, v, 10, exclude=ex, round_digits=RD).select("query_id", "doc_id", "score", "rank")


@register("rt04_distance_similarity", wrap(with_(
    q="SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS vector FROM embeddings",
    s="""SELECT q.query_id, e.vec_id AS doc_id, -list_distance(q.vector, CAST(e.embedding AS DOUBLE[])) AS score
         FROM q CROSS JOIN embeddings e WHERE e.vec_id <> q.query_id""",
    t=topk_sql("s", 10)) + """
SELECT query_id, doc_id, -score AS distance,
  1 - (-score - min(-score) OVER w) / CASE WHEN max(-score) OVER w = min(-score) OVER w THEN 1.0
                                            ELSE max(-score) OVER w - min(-score) OVER w END AS similarity
FROM t WINDOW w AS (PARTITION BY query_id)""", ["distance", "similarity"]))
def q_rt04(spark, sf_dir):
    """RT-4: L2 10-nearest neighbours, distances turned into in-list similarity 1 - (d - min) / range."""
    v = doc_vectors(spark, sf_dir)
    q = v.withColumnRenamed("doc_id", "query_id")
    ex = v.select(F.col("doc_id").alias("query_id"), "doc_id")
    r = rt.dense_search(q, v, 10, metric="l2", exclude=ex, round_digits=RD).withColumn("distance", -F.col("score"))
    return rt.distance_to_similarity(r).select("query_id", "doc_id", "distance", "similarity")


@register("rt05_hybrid_search", wrap(with_(**INDEX, bq=BQ, **hybrid_sql("bq", "0.5", "h")) +
                                     "SELECT query_id, doc_id, score, CAST(rank AS INTEGER) AS rank FROM htop", ["score"]))
def q_rt05(spark, sf_dir):
    """RT-5 / FU-10 / W-11: keyword top-60 + dense top-60, weighted RRF (alpha 0.5), best 30 per query."""
    r = rt.hybrid_search(index(spark, sf_dir), queries(spark, sf_dir), doc_vectors(spark, sf_dir), 0.5,
                         round_digits=RD)
    return r.select("query_id", "doc_id", "score", F.col("rank").cast("int").alias("rank"))


@register("rt06_filtered_dense", wrap(with_(bq=BQ, s="""
SELECT q.query_id, e.vec_id AS doc_id, list_cosine_similarity(q.vector, CAST(e.embedding AS DOUBLE[])) AS score
FROM bq q CROSS JOIN embeddings e JOIN documents d ON d.doc_id = e.vec_id WHERE q.vector IS NOT NULL AND d.lang = 'en'""",
    t=topk_sql("s", 30),
    f="SELECT t.query_id, t.doc_id, t.score FROM t JOIN documents d USING (doc_id) WHERE d.n_chars > 1000") +
    topk_sql("f", 10).replace("SELECT * FROM", "SELECT query_id, doc_id, score, CAST(rank AS INTEGER) AS rank FROM"),
    ["score"]))
def q_rt06(spark, sf_dir):
    """RT-6 / TK-2: English documents only (pre-filter), over-fetch max(3k, 30), keep n_chars > 1000, top 10."""
    meta = tb.table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    r = rt.filtered_dense_search(queries(spark, sf_dir).where(F.col("vector").isNotNull()), doc_vectors(spark, sf_dir),
                                 meta, 10, pre_filter=F.col("lang") == "en", post_filter=F.col("n_chars") > 1000,
                                 round_digits=RD)
    return r.select("query_id", "doc_id", "score", F.col("rank").cast("int").alias("rank"))


SUBS = """SELECT query_id, CAST(sub_id - 1 AS INTEGER) AS sub_id, string_split(full_text, '. ')[sub_id] AS text, vector,
  CASE WHEN sub_id = 1 THEN 0.3 ELSE 0.7 END AS alpha
FROM (SELECT *, unnest(range(1, len(string_split(full_text, '. ')) + 1)) AS sub_id FROM bq) z"""


@register("rt07_candidate_pool", wrap(with_(**INDEX, bq=BQ, hq="SELECT query_id, full_text AS text, vector FROM bq",
                                            **hybrid_sql("hq", "0.75", "a", 30, 60), subs=SUBS,
                                            sq="SELECT row_number() OVER (ORDER BY query_id, sub_id) AS query_id, query_id AS orig, text, vector, alpha FROM subs",
                                            **hybrid_sql("sq", "alpha", "b", 30, 60)) + """
SELECT query_id, doc_id, max(score) AS score FROM (
  SELECT query_id, doc_id, score FROM atop
  UNION ALL SELECT sq.orig, btop.doc_id, btop.score FROM btop JOIN sq USING (query_id)) z GROUP BY query_id, doc_id""",
                                      ["score"]))
def q_rt07(spark, sf_dir):
    """RT-7 / SO-1: hypothetical text (whole passage) at alpha 0.75 plus a sub-query for every sentence at
    alphas 0.3 (first) / 0.7, hybrid top-30 each, merged by max score per document."""
    q = queries(spark, sf_dir)
    hyde = q.select("query_id", F.col("full_text").alias("text"), "vector")
    subs = q.select("query_id", F.posexplode(F.split("full_text", r"\. ")).alias("sub_id", "text"), "vector") \
        .withColumn("alpha", F.when(F.col("sub_id") == 0, 0.3).otherwise(0.7))
    return rt.candidate_pool(index(spark, sf_dir), hyde, subs, doc_vectors(spark, sf_dir), 30, round_digits=RD)


def _overlap_sql(q: str, d: str) -> str:
    qt, dt = f"list_distinct({kw_sql(q)})", f"list_distinct({kw_sql(d)})"
    return (f"round(CASE WHEN sqrt(len({qt}) * len({dt})) > 0 THEN len(list_intersect({qt}, {dt})) / sqrt(len({qt}) * len({dt})) "
            f"ELSE 0.0 END, {RD})")


@register("rt08_rerank", wrap(with_(**INDEX, bq=BQ, **hybrid_sql("bq", "0.5", "h"),
                                    p=f"""SELECT h.query_id, h.doc_id, {_overlap_sql('q.text', 'd.text')} AS rerank_score
                                          FROM htop h JOIN bq q USING (query_id) JOIN documents d USING (doc_id)""") + f"""
SELECT query_id, doc_id, rerank_score,
  CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(rerank_score, {RD}) DESC, doc_id) AS INTEGER) AS rerank_rank
FROM p""", ["rerank_score"]))
def q_rt08(spark, sf_dir):
    """RT-8: hybrid top-30 re-scored by the default token-overlap scorer on whole texts, re-ranked per query."""
    q = queries(spark, sf_dir)
    h = rt.hybrid_search(index(spark, sf_dir), q, doc_vectors(spark, sf_dir), 0.5, round_digits=RD)
    pairs = (h.join(q.select("query_id", F.col("text").alias("query_text")), "query_id")
             .join(tb.keyword_docs(spark, sf_dir).select("doc_id", F.col("text").alias("doc_text")), "doc_id"))
    rr = rt.rerank(pairs.withColumn("_k", F.lit(1)), "query_text", "doc_text",
                   scorer=lambda a, b: F.round(rt.token_overlap_score(a, b), RD))
    return rr.select("query_id", "doc_id", "rerank_score", F.col("rerank_rank").cast("int").alias("rerank_rank"))


@register("fu08_retrieval_fusion", wrap(with_(**INDEX, bq=BQ, s=bm25_sql("bq"), kw=topk_sql("s", 20), des=dense_sql("bq"),
                                              de=topk_sql("des", 20)) + """
, j AS (SELECT query_id, doc_id, k.score AS sa, d.score AS sb FROM kw k FULL OUTER JOIN de d USING (query_id, doc_id)),
k2 AS (SELECT *, count(sa) OVER (PARTITION BY query_id) AS na, count(sb) OVER (PARTITION BY query_id) AS nb,
              coalesce(sa, 0.0) AS xa, coalesce(sb, 0.0) AS xb FROM j),
z AS (SELECT *, (xa - avg(xa) OVER w) / (stddev_pop(xa) OVER w + 1e-8) AS za,
                (xb - avg(xb) OVER w) / (stddev_pop(xb) OVER w + 1e-8) AS zb FROM k2 WINDOW w AS (PARTITION BY query_id))
SELECT query_id, doc_id, xa AS score_a, xb AS score_b,
  CASE WHEN na = 0 THEN 0.0 WHEN nb = 0 THEN 1.0 ELSE 0.8 END * za
  + CASE WHEN na = 0 THEN 1.0 WHEN nb = 0 THEN 0.0 ELSE 0.2 END * zb AS fused_score FROM z""",
                                        ["score_a", "score_b", "fused_score"]))
def q_fu08b(spark, sf_dir):
    """FU-8 / FU-9 on retrieval candidates: keyword top-20 and dense top-20 per query, z-fused
    0.8 / 0.2 over the union; queries without a vector fall back to keyword only."""
    q = queries(spark, sf_dir)
    kw = rt.bm25_search(index(spark, sf_dir), q, 20, round_digits=RD)
    de = rt.dense_search(q.where(F.col("vector").isNotNull()), doc_vectors(spark, sf_dir), 20, round_digits=RD)
    return fu.candidate_z_fusion(kw.withColumnRenamed("doc_id", "item_id"), de.withColumnRenamed("doc_id", "item_id"),
                                 0.8, 0.2).withColumnRenamed("item_id", "doc_id")


@register("w11_engine_ranks", with_(**INDEX, bq=BQ, s=bm25_sql("bq"), kw=topk_sql("s", 20), des=dense_sql("bq"),
                                    de=topk_sql("des", 20)) + """
SELECT query_id, engine, doc_id, CAST(row_number() OVER (PARTITION BY query_id, engine ORDER BY score DESC, doc_id) AS INTEGER) AS rank
FROM (SELECT query_id, 'keyword' AS engine, doc_id, score FROM kw UNION ALL SELECT query_id, 'dense', doc_id, score FROM de) z""")
def q_w11(spark, sf_dir):
    """W-11: distinct rank lists per (query, engine), the input of rank fusion."""
    q = queries(spark, sf_dir)
    kw = rt.bm25_search(index(spark, sf_dir), q, 20, round_digits=RD).withColumn("engine", F.lit("keyword"))
    de = rt.dense_search(q.where(F.col("vector").isNotNull()), doc_vectors(spark, sf_dir), 20,
                         round_digits=RD).withColumn("engine", F.lit("dense"))
    u = kw.select("query_id", "engine", "doc_id", "score").unionByName(de.select("query_id", "engine", "doc_id", "score"))
    r = ranking.engine_ranks(u, item="doc_id")
    return r.select("query_id", "engine", "doc_id", F.col("rank").cast("int").alias("rank"))
