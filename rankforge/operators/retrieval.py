"""Keyword and dense retrieval over query tables (RT-1..RT-8).

Keyword index = three tables: postings (term, doc_id, tf), doc lengths
(doc_id, dl) and term statistics (term, df, idf), plus a one-row corpus
summary (N, avgdl). Search sends the postings of the queries' terms by block of
documents and scores block by block inside tasks (``bm25_best``).
Dense search is the exact blocked top-k (``blocks.block_topk``).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.functions.text import one_a_row, tokenize_keyword
from rankforge.operators.blocks import block_topk
from rankforge.operators.common import with_scalars
from rankforge.operators.fusion import minmax_rows, rrf
from rankforge.operators.keyword_index import KeywordIndex, search, write_index
from rankforge.operators.ranking import global_row_number, top_k, union_max
from rankforge.operators.tiles import new_tiles
from rankforge.session import cut_lineage, stored

# Okapi BM25 defaults of the keyword index.
BM25_K1 = 1.5
BM25_B = 0.75
BM25_EPSILON = 0.25
HYBRID_TOP_K = 30
HYBRID_CANDIDATE_K = 60
HYDE_ALPHA = 0.75
RERANK_QUERY_CHARS = 500
RERANK_DOC_CHARS = 512
#: Documents and queries of a block of the keyword search.
DOC_BLOCK, QUERY_BLOCK = 4096, 256


@dataclass(frozen=True)
class BM25Index:
    postings: DataFrame   # term, doc_id, tf
    lengths: DataFrame    # doc_id, dl
    terms: DataFrame      # term, df, idf
    corpus: DataFrame     # one row: n_docs, avgdl


# ---------------------------------------------------------------- RT-1
def bm25_index(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> BM25Index:
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    # Texts are tokenised once; everything else is read from the stored postings.
    postings = stored(one_a_row(tokenize_keyword("_text"), "term", texts, "doc_id")
                           .groupBy("term", "doc_id").agg(F.count(F.lit(1)).cast("double").alias("tf")))
    counted = postings.groupBy("doc_id").agg(F.sum("tf").alias("dl"))
    lengths = stored(docs.select(F.col(doc_id).alias("doc_id")).join(counted, "doc_id", "left").fillna(0.0, ["dl"]))
    corpus = lengths.agg(F.count(F.lit(1)).alias("n_docs"), F.avg("dl").alias("avgdl"))
    df = stored(postings.groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    raw = with_scalars(df, corpus).select(
        "term", "df", (F.log(F.col("n_docs") - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)).alias("_idf"))
    # Negative idf -> epsilon * mean idf, the mean taken over the raw values (negatives included).
    mean_idf = raw.agg(F.avg("_idf").alias("_mean"))
    terms = with_scalars(raw, mean_idf).select(
        "term", "df", F.when(F.col("_idf") < 0, F.lit(BM25_EPSILON) * F.col("_mean")).otherwise(F.col("_idf")).alias("idf"))
    return BM25Index(postings, lengths, terms, corpus)


def store_bm25_index(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id", k1: float = BM25_K1, b: float = BM25_B) -> KeywordIndex:
    """The index of ``docs`` in impact-ordered blocks under ``path`` (``keyword_index``); ``open_index`` reads it again."""
    i = bm25_index(docs, text, doc_id)
    return write_index(i.postings, i.lengths, i.terms, i.corpus, path, k1, b)


# ---------------------------------------------------------------- RT-2
def bm25_search(index: BM25Index | KeywordIndex, queries: DataFrame, k: int, text: str = "text", query_id: str = "query_id",
                k1: float = BM25_K1, b: float = BM25_B, round_digits: int | None = None) -> DataFrame:
    """(query_id, doc_id, score, rank): Okapi score summed over query tokens (a repeated
    token counts each time), only score > 0, top-k by score then doc id. A stored index
    brings its own k1 and b, and skips postings that cannot win."""
    if isinstance(index, KeywordIndex):
        return search(index, queries, k, text, query_id, round_digits)
    s = bm25_best(index, queries, k, text, query_id, k1, b, round_digits)
    if round_digits is not None:
        s = s.withColumn("score", F.round("score", round_digits))
    return top_k(s, k, "query_id", "score", "doc_id")


def query_tokens(queries: DataFrame, text: str, query_id: str) -> DataFrame:
    """(query_id, term, _qf): a repeated token counts each time."""
    q = queries.select(F.col(query_id).alias("query_id"), F.col(text).alias("_text"))
    return one_a_row(tokenize_keyword("_text"), "term", q, "query_id").groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("_qf"))


def bm25_best(index: BM25Index, queries: DataFrame, k: int, text: str = "text", query_id: str = "query_id",
              k1: float = BM25_K1, b: float = BM25_B, round_digits: int | None = None,
              block: int = DOC_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, doc_id, score) of ``bm25_scores``, of each block of documents only a query's best k (by score, rounded
    if asked for, then doc id). Postings of the queries' terms are sent once, by block of documents; query blocks lie in the
    shared folder and are read one after the other, so the scores of all pairs exist only inside tasks, block x block."""
    spark = queries.sparkSession
    asked = cut_lineage(query_tokens(queries, text, query_id))
    used = cut_lineage(global_row_number(asked.select("term").distinct().join(index.terms.select("term", "idf"), "term"), [F.col("term").asc()], out="_t"))
    weights = asked.join(used, "term").groupBy("query_id").agg(F.collect_list(F.struct("_t", (F.col("_qf") * F.col("idf")).alias("w"))).alias("_w"))
    numbered = cut_lineage(global_row_number(weights, [F.col("query_id").asc()], out="_q").withColumn("_at", F.col("_q") - 1))
    store = new_tiles(spark, 0)

    def keep(rows: pa.Table) -> pa.Table:
        """The terms of a block of queries, by term."""
        own, at = rows.column("_b")[0].as_py(), rows.column("_at").to_numpy()
        order = np.argsort(rows.column("_t").to_numpy(), kind="stable")
        for name, values, kind in (("term", rows.column("_t").to_numpy(), np.int64), ("query", at - own * query_block, np.int64), ("weight", rows.column("w").to_numpy(), np.float64)):
            store.write(name, own, own, values[order], kind)
        return pa.table({"_b": pa.array([own], pa.int32())})

    flat = numbered.select(F.floor(F.col("_at") / query_block).cast("int").alias("_b"), "_at", F.explode("_w").alias("_e")).select("_b", "_at", "_e._t", "_e.w")
    blocks = sorted(r["_b"] for r in flat.groupBy("_b").applyInArrow(keep, "_b int").collect())
    totals = index.corpus.first()
    avgdl, parts = totals["avgdl"], max(1, -(-totals["n_docs"] // block))

    def score(rows: pa.Table) -> pa.Table:
        a_doc = rows.column("_t").is_null()
        own, posted = rows.filter(a_doc), rows.filter(pc.invert(a_doc))
        own = own.take(pc.sort_indices(own.column("doc_id")))
        ids = own.column("doc_id").combine_chunks()
        dl, copies = own.column("_v").to_numpy(), own.column("_n").to_numpy()
        term, tf = posted.column("_t").to_numpy(), posted.column("_v").to_numpy()
        at = pc.index_in(posted.column("doc_id").combine_chunks(), value_set=ids).to_numpy(zero_copy_only=False)
        order = np.argsort(term, kind="stable")
        term, tf, at = term[order], tf[order], at[order]
        impact = copies[at] * (tf * (k1 + 1)) / (tf + k1 * (1 - b + b * dl[at] / avgdl))
        terms, starts = np.unique(term, return_index=True)
        ends = np.append(starts[1:], len(term))
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for q in blocks:
            asked_, queries_, weight = (store.read_raw(name, q, q, kind) for name, kind in (("term", np.int64), ("query", np.int64), ("weight", np.float64)))
            s = np.zeros((int(queries_.max()) + 1, len(ids)))
            theirs, first = np.unique(asked_, return_index=True)
            last = np.append(first[1:], len(asked_))
            _, i, j = np.intersect1d(terms, theirs, assume_unique=True, return_indices=True)
            for x, y in zip(i, j):
                d, o = slice(starts[x], ends[x]), slice(first[y], last[y])
                s[queries_[o][:, None], at[d]] += weight[o][:, None] * impact[d]
            there = s > 0
            by = np.where(there, s if round_digits is None else np.round(s, round_digits), -np.inf)
            if k < by.shape[1]:
                there &= by >= -np.partition(-by, k - 1, axis=1)[:, k - 1:k]
            r, c = np.nonzero(there)
            order = np.lexsort((c, -by[r, c], r))
            r, c = r[order], c[order]
            best = np.arange(len(r)) - np.searchsorted(r, r) < k
            found.append((r[best] + q * query_block, c[best], s[r[best], c[best]]))
        r, c, v = (np.concatenate(x) for x in zip(*found))
        return pa.table({"_at": r, "doc_id": ids.take(pa.array(c)), "score": v})

    postings = index.postings.join(used.select("term", "_t"), "term").select("doc_id", F.col("_t").cast("long").alias("_t"), F.col("tf").cast("double").alias("_v"), F.lit(0).cast("long").alias("_n"))
    # Rows of one document id count as often as there are.
    lengths = index.lengths.groupBy("doc_id").agg(F.max("dl").cast("double").alias("_v"), F.count(F.lit(1)).alias("_n")).withColumn("_t", F.lit(None).cast("long"))
    rows = postings.unionByName(lengths).where(F.col("doc_id").isNotNull()).withColumn("_part", F.pmod(F.xxhash64("doc_id"), F.lit(parts)))
    made = rows.groupBy("_part").applyInArrow(score, f"_at long, doc_id {index.postings.schema['doc_id'].dataType.simpleString()}, score double")
    return made.join(numbered.select("_at", "query_id"), "_at").select("query_id", "doc_id", "score")


def bm25_scores(index: BM25Index, queries: DataFrame, text: str = "text", query_id: str = "query_id",
                k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
    """(query_id, doc_id, score) for every document sharing a token with the query, score > 0."""
    p = (query_tokens(queries, text, query_id).join(index.terms.select("term", "idf"), "term")
         .join(index.postings, "term")
         .join(index.lengths, "doc_id")
         .transform(lambda t: with_scalars(t, index.corpus.select("avgdl"))))
    tf = F.col("tf")
    part = F.col("_qf") * F.col("idf") * (tf * (k1 + 1)) / (tf + k1 * (1 - b + b * F.col("dl") / F.col("avgdl")))
    return p.groupBy("query_id", "doc_id").agg(F.sum(part).alias("score")).where(F.col("score") > 0)


# ---------------------------------------------------------------- RT-3
def dense_search(queries: DataFrame, vectors: DataFrame, k: int, metric: str = "cosine",
                 query_id: str = "query_id", doc_id: str = "doc_id", exclude: DataFrame | None = None,
                 block: int = 2048, round_digits: int | None = None) -> DataFrame:
    """(query_id, doc_id, score, rank): exact nearest neighbours. Scores are
    similarities (higher = closer): cosine, dot, or negative L2 distance for 'l2'."""
    q = queries.select(F.col(query_id).alias("query_id"), "vector")
    v = vectors.select(F.col(doc_id).alias("doc_id"), "vector")
    return block_topk(q, v, k, "query_id", "doc_id", "vector", exclude=exclude, block=block, metric=metric,
                      round_digits=round_digits)


# ---------------------------------------------------------------- RT-4
def distance_to_similarity(results: DataFrame, group: str = "query_id", distance: str = "distance") -> DataFrame:
    """In-list similarity 1 - (d - min) / range (range 1 when all equal)."""
    return minmax_rows(results, group, distance, "similarity", invert=True)


# ---------------------------------------------------------------- RT-5
def hybrid_search(index: BM25Index | KeywordIndex, queries: DataFrame, vectors: DataFrame, alpha: float | str,
                  top_k_: int = HYBRID_TOP_K, candidate_k: int = HYBRID_CANDIDATE_K, text: str = "text",
                  round_digits: int | None = None) -> DataFrame:
    """Keyword top candidate_k and dense top candidate_k per query, weighted RRF
    ((1-alpha) keyword, alpha dense), best ``top_k_``. ``alpha`` may name a column of
    ``queries``. Returns (query_id, doc_id, score, rank)."""
    kw = bm25_search(index, queries, candidate_k, text, round_digits=round_digits)
    de = dense_search(queries.where(F.col("vector").isNotNull()), vectors, candidate_k, round_digits=round_digits)
    if isinstance(alpha, str):
        al = queries.select("query_id", alpha)
        kw, de = kw.join(al, "query_id"), de.join(al, "query_id")
    fused = rrf(kw, de, alpha, "query_id", "doc_id")
    if round_digits is not None:
        fused = fused.withColumn("score", F.round("score", round_digits))
    return top_k(fused, top_k_, "query_id", "score", "doc_id")


# ---------------------------------------------------------------- RT-6
def filtered_dense_search(queries: DataFrame, vectors: DataFrame, docs_meta: DataFrame, k: int,
                          pre_filter: Column | None = None, post_filter: Column | None = None,
                          metric: str = "cosine", round_digits: int | None = None) -> DataFrame:
    """Pre-filter documents (e.g. director equality) before the exact search, post-filter
    (e.g. genre overlap) after it. With an exact search the pre-filter loses nothing; the
    post-filter needs the over-fetched budget max(3k, 30)."""
    from rankforge.operators.ranking import over_fetch

    v = vectors.join(docs_meta, "doc_id")
    if pre_filter is not None:
        v = v.where(pre_filter)
    r = dense_search(queries, v.select("doc_id", "vector"), over_fetch(k, "filter") if post_filter is not None else k,
                     metric, round_digits=round_digits)
    if post_filter is not None:
        r = r.join(docs_meta, "doc_id").where(post_filter).drop("rank")
        r = top_k(r, k, "query_id", "score", "doc_id")
    return r


# ---------------------------------------------------------------- RT-7
def candidate_pool(index: BM25Index, hyde: DataFrame, subs: DataFrame, vectors: DataFrame,
                   candidate_k: int = 30, round_digits: int | None = None) -> DataFrame:
    """Hybrid search for the hypothetical text at alpha 0.75 and for each sub-query at its own
    alpha (rows of ``subs``: query_id, sub_id, text, vector, alpha), merged by max score per doc."""
    h = hybrid_search(index, hyde.withColumn("_alpha", F.lit(HYDE_ALPHA)), vectors, "_alpha", candidate_k,
                      round_digits=round_digits)
    # A number of its own for each (query, sub-query), however many sub-queries there are: the
    # dense kernel keeps long ids.
    s = cut_lineage(global_row_number(subs.select("query_id", "sub_id", "text", "vector", "alpha"),
                                      [F.col("query_id").asc(), F.col("sub_id").asc()], out="_qid"))
    sr = hybrid_search(index, s.select(F.col("_qid").alias("query_id"), "text", "vector", "alpha"),
                       vectors, "alpha", candidate_k, round_digits=round_digits)
    sr = sr.join(s.select(F.col("_qid").alias("query_id"), F.col("query_id").alias("_orig")), "query_id") \
        .select(F.col("_orig").alias("query_id"), "doc_id", "score")
    return union_max([h.select("query_id", "doc_id", "score"), sr], ["query_id", "doc_id"])


# ---------------------------------------------------------------- RT-8
def token_overlap_score(query: Column, doc: Column) -> Column:
    """Default pair scorer: cosine of the binary keyword-token sets of query and document
    text, both whole. A scorer with an input limit cuts for itself (``with_input_limit``)."""
    q = F.array_distinct(tokenize_keyword(query))
    d = F.array_distinct(tokenize_keyword(doc))
    inter = F.size(F.array_intersect(q, d)).cast("double")
    den = F.sqrt(F.size(q).cast("double") * F.size(d).cast("double"))
    return F.when(den > 0, inter / den).otherwise(F.lit(0.0))


def with_input_limit(scorer, query_chars: int = RERANK_QUERY_CHARS, doc_chars: int = RERANK_DOC_CHARS):
    """A pair scorer whose model takes only so many characters of query and document."""
    return lambda query, doc: scorer(F.substring(query, 1, query_chars), F.substring(doc, 1, doc_chars))


def rerank_text(text_key: Column | None, overview: Column | None, title: Column | None, item_id: Column) -> Column:
    """Document text for the scorer: given key -> overview -> title -> id, first non-blank."""
    opts = [c for c in (text_key, overview, title) if c is not None]
    blank = lambda c: F.when(F.trim(c) != "", c)
    return F.coalesce(*[blank(c.cast("string")) for c in opts], item_id.cast("string"))


def rerank(pairs: DataFrame, query_col: str = "query_text", doc_col: str = "doc_text", scorer=None,
           group: str = "query_id", item: str = "doc_id", top: int | None = None) -> DataFrame:
    """Score (query, doc) pairs with ``scorer(query_col, doc_col) -> Column`` (a built-in
    expression or a pandas_udf), NaN/null -> 0, rank per query by the new score."""
    sc = scorer or token_overlap_score
    s = pairs.withColumn("rerank_score", F.coalesce(F.nanvl(sc(F.col(query_col), F.col(doc_col)).cast("double"),
                                                            F.lit(0.0)), F.lit(0.0)))
    w = Window.partitionBy(group).orderBy(F.col("rerank_score").desc(), F.col(item).asc())
    s = s.withColumn("rerank_rank", F.row_number().over(w))
    return s.where(F.col("rerank_rank") <= top) if top else s
