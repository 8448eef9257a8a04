"""Registered queries: item features FE-1..FE-18."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankforge.functions import scalars
from rankforge.operators import features as fe
from rankforge.plans.registry import register
from rankforge.plans.sqlparts import INTERACTIONS, with_, wrap
from rankforge.sources import tables as tb

GENRE_ROWS = "SELECT DISTINCT p_partkey AS item_id, 'genre:' || unnest(string_split(p_name, ' ')) AS feature FROM part"


@register("fe01_multi_hot", with_(g=GENRE_ROWS) + "SELECT item_id, feature, CAST(1.0 AS DOUBLE) AS value FROM g")
def q_fe01(spark, sf_dir):
    """FE-1: genre multi-hot rows (item, genre:<word>, 1.0)."""
    return fe.multi_hot(tb.items(spark, sf_dir), "genres", "genre")


@register("fe01_multi_hot_dense", with_(g=GENRE_ROWS) + """
, v AS (SELECT feature, CAST(row_number() OVER (ORDER BY feature) - 1 AS BIGINT) AS idx FROM (SELECT DISTINCT feature FROM g))
SELECT p_partkey AS item_id, CAST((SELECT count(*) FROM v) AS INTEGER) AS width,
       CAST(count(g.feature) AS DOUBLE) AS n_ones, min(v.idx) AS first_idx, max(v.idx) AS last_idx
FROM part LEFT JOIN g ON g.item_id = p_partkey LEFT JOIN v ON v.feature = g.feature GROUP BY p_partkey""")
def q_fe01b(spark, sf_dir):
    """FE-1: dense multi-hot over the sorted vocabulary (width, ones, first/last set index)."""
    it = tb.items(spark, sf_dir)
    mh = fe.multi_hot(it, "genres", "genre")
    voc = fe.vocabulary(mh)
    d = fe.to_dense(mh, voc, items=it)
    pos = d.select("item_id", F.size("vector").alias("width"),
                   F.aggregate("vector", F.lit(0.0), lambda a, x: a + x).alias("n_ones"),
                   F.posexplode("vector").alias("_i", "_x"))
    return (pos.groupBy("item_id", "width", "n_ones")
            .agg(F.min(F.when(F.col("_x") > 0, F.col("_i"))).cast("bigint").alias("first_idx"),
                 F.max(F.when(F.col("_x") > 0, F.col("_i"))).cast("bigint").alias("last_idx")))


def tfidf_sql(src: str, tok: str, max_features: int | None, min_df: int = 1, id_name: str = "doc_id") -> str:
    lim = f"LIMIT {max_features}" if max_features else ""
    return with_(
        d=src,
        t=f"SELECT id, unnest({tok}) AS term FROM d",
        tf="SELECT id, term, CAST(count(*) AS DOUBLE) AS tf FROM t GROUP BY id, term",
        st=f"""SELECT term, count(*) AS df, sum(tf) AS total FROM tf GROUP BY term
               HAVING count(*) >= {min_df} ORDER BY total DESC, term {lim}""",
        v="SELECT tf.id, tf.term, tf.tf * (ln((1 + (SELECT count(*) FROM d)) / (1 + st.df)) + 1) AS w FROM tf JOIN st USING (term)",
    ) + f"SELECT id AS {id_name}, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS value FROM v"


TF_DOC = "regexp_extract_all(lower(coalesce(text, '')), '[\\pL\\pN_]{2,}')"


@register("fe02_tfidf", wrap(tfidf_sql("SELECT doc_id AS id, text FROM documents", TF_DOC, 100, 2), ["value"]))
def q_fe02(spark, sf_dir):
    """FE-2: word TF-IDF of every whole document, 100 terms by total count, min_df 2, L2 rows."""
    return fe.tfidf(tb.keyword_docs(spark, sf_dir), "text", "doc_id", max_features=100, min_df=2)


#: No cap in SQL: more than any vocabulary here.
EVERY = 10 ** 9


@register("fe02_tfidf_whole", wrap(tfidf_sql("SELECT doc_id AS id, text FROM documents", TF_DOC, EVERY, 2), ["value"]))
def q_fe02b(spark, sf_dir):
    """FE-2: word TF-IDF with the whole vocabulary, min_df 2, L2 rows."""
    return fe.tfidf(tb.keyword_docs(spark, sf_dir), "text", "doc_id", min_df=2)


CHAR_BRAND = ("list_concat([substr(s, i, 2) for i in range(1, length(s))], "
              "[substr(s, i, 3) for i in range(1, length(s) - 1)])")


@register("fe03_char_tfidf", wrap(tfidf_sql(
    "SELECT p_partkey AS id, regexp_replace(lower(p_brand), '\\s\\s+', ' ', 'g') AS s FROM part", CHAR_BRAND, 30, id_name="item_id"), ["value"]))
def q_fe03(spark, sf_dir):
    """FE-3: character 2-3-gram TF-IDF of the brand (director) names, 30 features."""
    it = tb.items(spark, sf_dir)
    return fe.tfidf(it, "director", "item_id", max_features=30, analyzer="char", ngram=(2, 3))


@register("fe03_char_tfidf_whole", wrap(tfidf_sql(
    "SELECT p_partkey AS id, regexp_replace(lower(p_brand), '\\s\\s+', ' ', 'g') AS s FROM part", CHAR_BRAND, EVERY, id_name="item_id"), ["value"]))
def q_fe03b(spark, sf_dir):
    """FE-3: character 2-3-gram TF-IDF of the brand (director) names, every n-gram."""
    return fe.tfidf(tb.items(spark, sf_dir), "director", "item_id", analyzer="char", ngram=(2, 3))


@register("fe04_truncated_svd")
def q_fe04(spark, sf_dir):
    """FE-4: rank-8 SVD of the document TF-IDF (100 terms): the factors of every document (signs fixed by the
    largest loading), zeros for one without any of the terms."""
    docs = tb.keyword_docs(spark, sf_dir)
    t = fe.tfidf(docs, "text", "doc_id", max_features=100, min_df=2)
    factors, comp = fe.truncated_svd(t.withColumnRenamed("doc_id", "item_id"), 8)
    return fe.with_all_rows(factors.withColumnRenamed("item_id", "doc_id"), docs, comp.count(), "doc_id").select(
        "doc_id", F.posexplode("vector").alias("component", "value"))


@register("fe05_binary_counts", with_(
    t=f"SELECT DISTINCT doc_id, unnest({TF_DOC}) AS feature FROM documents",
    k="SELECT feature FROM t GROUP BY feature HAVING count(*) >= 3") +
    "SELECT doc_id, feature, CAST(1.0 AS DOUBLE) AS value FROM t JOIN k USING (feature)")
def q_fe05(spark, sf_dir):
    """FE-5: binary document-token presence, tokens in >= 3 documents."""
    d = tb.keyword_docs(spark, sf_dir).select("doc_id", F.array_distinct(
        F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"[\p{L}\p{N}_]{2,}"), 0)).alias("toks"))
    return fe.binary_counts(d, "toks", min_df=3, item="doc_id")


NUM_ITEMS = """SELECT p_partkey AS item_id, CAST(p_retailprice AS DOUBLE) AS price, CAST(p_size AS DOUBLE) AS size,
  CAST(coalesce(c.n, 0) AS DOUBLE) AS votes FROM part LEFT JOIN (SELECT item_id, count(*) AS n FROM r GROUP BY item_id) c
  ON c.item_id = p_partkey"""


def num_items(spark, sf_dir):
    r = tb.interactions(spark, sf_dir)
    c = r.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    return (tb.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("item_id"),
                                                 F.col("p_retailprice").cast("double").alias("price"),
                                                 F.col("p_size").cast("double").alias("size"))
            .join(c, "item_id", "left").select("item_id", "price", "size",
                                              F.coalesce(F.col("n"), F.lit(0)).cast("double").alias("votes")))


@register("fe06_log_zscore", wrap(with_(r=INTERACTIONS, n=NUM_ITEMS) + """
, l AS (SELECT item_id, ln(1 + price) AS price, ln(1 + size) AS size, ln(1 + votes) AS votes FROM n)
SELECT item_id, (price - avg(price) OVER ()) / (stddev_pop(price) OVER () + 1e-8) AS price,
       (size - avg(size) OVER ()) / (stddev_pop(size) OVER () + 1e-8) AS size,
       (votes - avg(votes) OVER ()) / (stddev_pop(votes) OVER () + 1e-8) AS votes FROM l""",
          ["price", "size", "votes"]))
def q_fe06(spark, sf_dir):
    """FE-6: log1p then z (population std + 1e-8) of numeric item columns."""
    return fe.log_zscore(num_items(spark, sf_dir), ["price", "size", "votes"])


@register("fe07_minmax", wrap(with_(r=INTERACTIONS, n=NUM_ITEMS) + """
SELECT item_id, CASE WHEN max(price) OVER () > min(price) OVER () THEN (price - min(price) OVER ()) / (max(price) OVER () - min(price) OVER ()) ELSE 0.0 END AS price,
  CASE WHEN max(size) OVER () > min(size) OVER () THEN (size - min(size) OVER ()) / (max(size) OVER () - min(size) OVER ()) ELSE 0.0 END AS size,
  CASE WHEN max(votes) OVER () > min(votes) OVER () THEN (votes - min(votes) OVER ()) / (max(votes) OVER () - min(votes) OVER ()) ELSE 0.0 END AS votes
FROM n""", ["price", "size", "votes"]))
def q_fe07(spark, sf_dir):
    """FE-7: min-max scaling of numeric item columns."""
    return fe.minmax_scale(num_items(spark, sf_dir), ["price", "size", "votes"])


def _bins_sql(col: str) -> str:
    return f"""SELECT item_id, '{col}_bin_' || CAST(len(list_filter(e.edges, lambda x: x <= {col})) AS VARCHAR) AS feature, CAST(1.0 AS DOUBLE) AS value
FROM n, (SELECT CASE WHEN max({col}) > 0 THEN quantile_cont({col}, [0.2, 0.4, 0.6, 0.8]) FILTER (WHERE {col} > 0)
                     ELSE quantile_cont({col}, [0.2, 0.4, 0.6, 0.8]) END AS edges FROM n) e"""


@register("fe08_percentile_bins", with_(r=INTERACTIONS, n=NUM_ITEMS) +
          " UNION ALL ".join(f"({_bins_sql(c)})" for c in ["price", "size", "votes"]))
def q_fe08(spark, sf_dir):
    """FE-8: 5 percentile bins of positive values per numeric column, one-hot rows."""
    return fe.percentile_bins(num_items(spark, sf_dir), ["price", "size", "votes"])


@register("fe09_era_one_hot", """
SELECT p_partkey AS item_id, 'era:' || CASE WHEN 1950 + p_size < 1970 THEN 'pre_1970' WHEN 1950 + p_size < 1980 THEN '1970s'
  WHEN 1950 + p_size < 1990 THEN '1980s' WHEN 1950 + p_size < 2000 THEN '1990s' WHEN 1950 + p_size < 2010 THEN '2000s'
  ELSE '2010s' END AS feature, CAST(1.0 AS DOUBLE) AS value FROM part""")
def q_fe09(spark, sf_dir):
    """FE-9: era one-hot rows."""
    return fe.era_one_hot(tb.items(spark, sf_dir))


@register("fe09_top_values", """
WITH t AS (SELECT source AS v FROM documents WHERE source IS NOT NULL GROUP BY source ORDER BY count(*) DESC, source LIMIT 10)
SELECT doc_id, CASE WHEN t.v IS NOT NULL THEN 'source:' || d.source ELSE 'source:other' END AS feature, CAST(1.0 AS DOUBLE) AS value
FROM documents d LEFT JOIN t ON t.v = d.source WHERE d.source IS NOT NULL""")
def q_fe09b(spark, sf_dir):
    """FE-9: top-10 value one-hot with a separate 'other' slot (document sources)."""
    return fe.top_value_one_hot(tb.table(spark, sf_dir, "documents"), "source", 10, "source", item="doc_id")


@register("fe10_entity_tags", """
WITH e AS (SELECT p_partkey AS item_id, p_brand AS v FROM part),
t AS (SELECT v FROM e WHERE v IS NOT NULL GROUP BY v ORDER BY count(*) DESC, v LIMIT 10),
j AS (SELECT e.item_id, e.v, t.v AS top FROM e LEFT JOIN t ON t.v = e.v)
SELECT item_id, CASE WHEN count(top) > 0 THEN 'director:' || max(top) WHEN count(v) > 0 THEN 'director:other'
  ELSE 'director:unknown' END AS feature, CAST(1.0 AS DOUBLE) AS value FROM j GROUP BY item_id""")
def q_fe10(spark, sf_dir):
    """FE-10: director tags for the 10 most frequent brands, ':other' otherwise."""
    it = tb.items(spark, sf_dir).select("item_id", F.array("director").alias("directors"))
    return fe.entity_tags(it, "directors", "director", 10)


@register("fe11_top_tfidf_tags", tfidf_sql("SELECT doc_id AS id, text FROM documents", TF_DOC, 100, 2)
          .replace("SELECT id AS doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS value FROM v", """
, x AS (SELECT id AS doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS value FROM v),
y AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(value, 12) DESC, term) AS r FROM x)
SELECT doc_id, 'tfidf:' || term AS feature, CAST(1.0 AS DOUBLE) AS value FROM y WHERE r <= 5"""))
def q_fe11(spark, sf_dir):
    """FE-11: each document's five highest TF-IDF terms as tags."""
    t = fe.tfidf(tb.keyword_docs(spark, sf_dir), "text", "doc_id", max_features=100, min_df=2)
    return fe.top_tfidf_tags(t.withColumn("value", F.round("value", 12)), 5, item="doc_id")


@register("fe11_top_tfidf_tags_whole", tfidf_sql("SELECT doc_id AS id, text FROM documents", TF_DOC, EVERY, 2)
          .replace("SELECT id AS doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS value FROM v", """
, x AS (SELECT id AS doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS value FROM v),
y AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(value, 9) DESC, term) AS r FROM x)
SELECT doc_id, 'tfidf:' || term AS feature, CAST(1.0 AS DOUBLE) AS value FROM y WHERE r <= 5"""))
def q_fe11b(spark, sf_dir):
    """FE-11: each document's five highest TF-IDF terms of the whole vocabulary as tags."""
    t = fe.tfidf(tb.keyword_docs(spark, sf_dir), "text", "doc_id", min_df=2)
    return fe.top_tfidf_tags(t.withColumn("value", F.round("value", 9)), 5, item="doc_id")


@register("fe12_assemble_tags", with_(r=INTERACTIONS, g=GENRE_ROWS) + """
, v AS (SELECT item_id, avg(rating) * 2 AS va FROM r GROUP BY item_id),
q AS (SELECT p_partkey AS item_id, CASE WHEN coalesce(v.va, 6.34) < 5.5 THEN 'quality:low' WHEN coalesce(v.va, 6.34) < 6.5
  THEN 'quality:mid' WHEN coalesce(v.va, 6.34) < 7.5 THEN 'quality:high' ELSE 'quality:excellent' END AS feature
  FROM part LEFT JOIN v ON v.item_id = p_partkey),
u AS (SELECT DISTINCT * FROM (SELECT item_id, feature FROM g UNION ALL SELECT item_id, feature FROM q) z
      WHERE starts_with(feature, 'quality:'))
SELECT item_id, feature, CAST(1.0 AS DOUBLE) AS value FROM u
UNION ALL SELECT p_partkey, 'genre:unknown', CAST(1.0 AS DOUBLE) FROM part WHERE p_partkey NOT IN (SELECT item_id FROM u)""")
def q_fe12(spark, sf_dir):
    """FE-12: tag families assembled, ablated to the 'quality' family; untagged -> genre:unknown."""
    it = tb.items(spark, sf_dir)
    r = tb.interactions(spark, sf_dir)
    v = r.groupBy("item_id").agg((F.avg("rating") * 2).alias("va"))
    q = it.join(v, "item_id", "left").select("item_id", scalars.quality_tag("va").alias("feature"))
    return fe.assemble_tags([fe.multi_hot(it, "genres", "genre"), q], it, keep_prefixes=["quality"])


@register("fe13_weighted_blocks", wrap(with_(r=INTERACTIONS, g=GENRE_ROWS, n=NUM_ITEMS) + """
, vv AS (SELECT feature, row_number() OVER (ORDER BY feature) - 1 AS idx FROM (SELECT DISTINCT feature FROM g)),
l AS (SELECT item_id, ln(1 + price) AS price, ln(1 + size) AS size FROM n),
z AS (SELECT item_id, (price - avg(price) OVER ()) / (stddev_pop(price) OVER () + 1e-8) AS price,
             (size - avg(size) OVER ()) / (stddev_pop(size) OVER () + 1e-8) AS size FROM l),
cells AS (SELECT p_partkey AS item_id, vv.idx, CASE WHEN g.feature IS NULL THEN 0.0 ELSE 1.0 END * 1.0 AS x
          FROM part CROSS JOIN vv LEFT JOIN g ON g.item_id = p_partkey AND g.feature = vv.feature
          UNION ALL SELECT item_id, (SELECT count(*) FROM vv), price * 0.5 FROM z
          UNION ALL SELECT item_id, (SELECT count(*) FROM vv) + 1, size * 0.5 FROM z)
SELECT item_id, CAST(idx AS INTEGER) AS idx,
  CASE WHEN sqrt(sum(x * x) OVER (PARTITION BY item_id)) > 0 THEN x / sqrt(sum(x * x) OVER (PARTITION BY item_id)) ELSE 0.0 END AS value
FROM cells""", ["value"]))
def q_fe13(spark, sf_dir):
    """FE-13: genre block (weight 1) + log-z numeric block (weight 0.5), L2 per item, as (item, idx, value)."""
    it = tb.items(spark, sf_dir)
    mh = fe.multi_hot(it, "genres", "genre")
    g = fe.to_dense(mh, fe.vocabulary(mh), items=it)
    nz = fe.numeric_block(fe.log_zscore(num_items(spark, sf_dir), ["price", "size"]), ["price", "size"])
    v = fe.weighted_blocks([(g, 1.0), (nz, 0.5)])
    return v.select("item_id", F.posexplode("vector").alias("idx", "value"))


@register("fe18_label_encode", """
SELECT c_custkey AS user_id, c_mktsegment AS segment,
       CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS segment_code FROM customer""")
def q_fe18(spark, sf_dir):
    """FE-18: label encoding in sorted order (customer segments)."""
    u = tb.users(spark, sf_dir).select("user_id", "segment")
    return fe.label_encode(u, "segment", "segment_code")
