"""Registered queries: interaction prep (PF-*), folds (W-7), aggregates (AG-*), sources (SRC-11/12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankforge.operators import prep
from rankforge.plans.registry import register
from rankforge.plans.sqlparts import FOLDED, INTERACTIONS, RAW_RATINGS, with_, wrap
from rankforge.sources import quality
from rankforge.sources import tables as tb

R = with_(r=INTERACTIONS)


@register("pf01_positives_binarize", wrap(R + """
SELECT user_id, item_id, rating,
       CASE WHEN rating > 3.5 THEN 1.0 ELSE 0.0 END AS weight
FROM r WHERE rating >= 4""", ["rating", "weight"]))
def q_pf01(spark, sf_dir):
    """PF-1: positives (rating >= 4) and the 3.5 binarisation."""
    r = tb.interactions(spark, sf_dir)
    return prep.binarize(prep.positives(r)).select("user_id", "item_id", "rating", "weight")


@register("pf02_confidence_weight", wrap(R + """
SELECT user_id, item_id, 1 + 0.5 * rating AS weight FROM r WHERE rating >= 4""", ["weight"]))
def q_pf02(spark, sf_dir):
    """PF-2: confidence 1 + alpha * r on positives, alpha 0.5."""
    r = prep.positives(tb.interactions(spark, sf_dir))
    return prep.confidence_weight(r, 0.5).select("user_id", "item_id", "weight")


@register("pf03_time_decay", wrap(R + """
SELECT user_id, item_id,
       rating * pow(0.5, ((SELECT max(epoch(ts)) FROM r) - epoch(ts)) / 86400.0 / 365.0) AS weight
FROM r""", ["weight"]))
def q_pf03(spark, sf_dir):
    """PF-3: rating * 0.5^(age_days / 365), age from the newest rating."""
    r = tb.interactions(spark, sf_dir)
    return prep.time_decay(r, 365.0).select("user_id", "item_id", "weight")


@register("pf04_penalize_negatives", wrap(R + """
SELECT user_id, item_id, CASE WHEN rating < 3 THEN -0.5 * rating ELSE rating END AS weight FROM r""", ["weight"]))
def q_pf04(spark, sf_dir):
    """PF-4: r < 3 -> -p * r with p = 0.5."""
    r = tb.interactions(spark, sf_dir)
    return prep.penalize_negatives(r, 0.5).select("user_id", "item_id", "weight")


@register("pf05_sentiment_counts", R + """
SELECT user_id,
  CAST(sum(CASE WHEN rating >= 4 THEN 1 ELSE 0 END) AS BIGINT) AS liked,
  CAST(sum(CASE WHEN rating > 0 AND rating < 3 THEN 1 ELSE 0 END) AS BIGINT) AS hated,
  CAST(sum(CASE WHEN rating = 3 THEN 1 ELSE 0 END) AS BIGINT) AS neutral
FROM r GROUP BY user_id""")
def q_pf05(spark, sf_dir):
    """PF-5: liked / hated / neutral counts per user."""
    s = prep.sentiment_split(tb.interactions(spark, sf_dir))
    return s.groupBy("user_id").agg(
        *[F.sum(F.when(F.col("sentiment") == k, 1).otherwise(0)).cast("bigint").alias(k)
          for k in ("liked", "hated", "neutral")])


@register("pf12_dedup_policies", wrap(with_(raw=RAW_RATINGS) + """
SELECT user_id, item_id, max(rating) AS rating_max, avg(rating) AS rating_mean,
       arg_min(rating, (ts, order_key, line_no, rating)) AS rating_first,
       CAST(count(*) AS BIGINT) AS n
FROM raw GROUP BY user_id, item_id""", ["rating_max", "rating_mean", "rating_first"]))
def q_pf12(spark, sf_dir):
    """PF-12: max / mean / first policies side by side per (customer, part)."""
    raw = tb.raw_ratings(spark, sf_dir)
    mx = prep.dedup(raw.select("user_id", "item_id", "rating"), "max").withColumnRenamed("rating", "rating_max")
    mn = prep.dedup(raw.select("user_id", "item_id", "rating"), "mean").withColumnRenamed("rating", "rating_mean")
    first = prep.dedup(raw, "first", order_cols=["ts", "order_key", "line_no", "rating"]) \
        .select("user_id", "item_id", F.col("rating").alias("rating_first"))
    n = raw.groupBy("user_id", "item_id").agg(F.count(F.lit(1)).alias("n"))
    return mx.join(mn, ["user_id", "item_id"]).join(first, ["user_id", "item_id"]).join(n, ["user_id", "item_id"])


@register("pf12_duplicate_report", with_(raw=RAW_RATINGS) + """
SELECT CAST(count(*) AS BIGINT) AS n_pairs,
       CAST(sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pairs_single,
       CAST(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS pairs_multi,
       CAST(sum(n - 1) AS BIGINT) AS duplicate_rows
FROM (SELECT user_id, item_id, count(*) AS n FROM raw GROUP BY 1, 2) t""")
def q_pf12b(spark, sf_dir):
    """PF-12: duplicate report over the raw purchase rows."""
    return prep.duplicate_report(tb.raw_ratings(spark, sf_dir).select("user_id", "item_id"))


@register("w07_folds", with_(r=INTERACTIONS, f=FOLDED) + "SELECT user_id, item_id, fold FROM f")
def q_w07(spark, sf_dir):
    """W-7: 5 folds stratified by user (deterministic item-order rule)."""
    return prep.stratified_folds(tb.interactions(spark, sf_dir), 5, order="item").select("user_id", "item_id", "fold")


@register("w07_fold_sizes", with_(r=INTERACTIONS, f=FOLDED) + """
SELECT fold, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT user_id) AS BIGINT) AS users FROM f GROUP BY fold""")
def q_w07b(spark, sf_dir):
    """W-7 / SRC-11: rows and users per fold."""
    return quality.fold_sizes(prep.stratified_folds(tb.interactions(spark, sf_dir), 5, order="item"))


@register("ag01_item_counts", wrap(R + """
SELECT item_id, CAST(count(*) AS BIGINT) AS n, ln(1 + count(*)) AS log_pop,
       count(*) / (SELECT count(DISTINCT user_id) FROM r) AS pop_ratio
FROM r GROUP BY item_id""", ["log_pop", "pop_ratio"]))
def q_ag01(spark, sf_dir):
    """AG-1: interactions per item, log1p popularity, share of users."""
    return prep.item_counts(tb.interactions(spark, sf_dir))


@register("ag02_item_mean_rating", wrap(R + "SELECT item_id, avg(rating) AS mean_rating FROM r GROUP BY item_id",
                                        ["mean_rating"]))
def q_ag02(spark, sf_dir):
    """AG-2: mean rating per item."""
    return prep.item_mean_rating(tb.interactions(spark, sf_dir))


ITEM_VOTES = "SELECT item_id, avg(rating) * 2 AS vote_average, count(*) AS vote_count FROM r GROUP BY item_id"


def item_votes(spark, sf_dir):
    r = tb.interactions(spark, sf_dir)
    return r.groupBy("item_id").agg((F.avg("rating") * 2).alias("vote_average"),
                                    F.count(F.lit(1)).alias("vote_count"))


@register("ag04_vote_bayes", wrap(with_(r=INTERACTIONS, v=ITEM_VOTES) + """
SELECT item_id, vote_count / (vote_count + m) * vote_average + m / (vote_count + m) * c AS bayes_rating
FROM v, (SELECT quantile_cont(vote_count, 0.9) AS m, avg(vote_average) AS c FROM v) s""", ["bayes_rating"]))
def q_ag04(spark, sf_dir):
    """AG-4: vote-count Bayesian rating with m = 90th percentile of counts."""
    return prep.vote_bayes(item_votes(spark, sf_dir), "vote_average", "vote_count").select("item_id", "bayes_rating")


@register("ag05_rating_bayes", wrap(R + """
SELECT item_id, (50 * 3.53 + sum(CASE WHEN rating >= 4 THEN 1 ELSE 0 END) * avg(rating))
                / (50 + sum(CASE WHEN rating >= 4 THEN 1 ELSE 0 END)) AS bayes_avg
FROM r GROUP BY item_id""", ["bayes_avg"]))
def q_ag05(spark, sf_dir):
    """AG-5: (C*mu + n_pos*avg) / (C + n_pos), C = 50, mu = 3.53."""
    return prep.rating_bayes(tb.interactions(spark, sf_dir))


@register("ag13_negative_sampling", wrap(R + """
, f AS (SELECT item_id, count(*) AS freq, pow(count(*), 0.75) AS fa FROM r WHERE rating >= 4 GROUP BY item_id)
SELECT item_id, CAST(freq AS BIGINT) AS freq, fa / (SELECT sum(fa) FROM f) AS p,
       row_number() OVER (ORDER BY fa DESC, item_id) <= floor((SELECT count(*) FROM f) * 0.05) AS in_top
FROM f""", ["p"]))
def q_ag13(spark, sf_dir):
    """AG-13: f^0.75 / sum sampling distribution and the top-5 % flag."""
    return prep.negative_sampling_dist(tb.interactions(spark, sf_dir))


@register("ag15_item_temperature", R + """
SELECT p_partkey AS item_id, CAST(coalesce(c.n_pos, 0) AS BIGINT) AS n_pos,
       CASE WHEN coalesce(c.n_pos, 0) >= 12 THEN 'warm' WHEN coalesce(c.n_pos, 0) > 0 THEN 'cold' ELSE 'unseen' END
         AS temperature
FROM part LEFT JOIN (SELECT item_id, count(*) AS n_pos FROM r WHERE rating >= 4 GROUP BY item_id) c
  ON c.item_id = p_partkey""")
def q_ag15(spark, sf_dir):
    """AG-15: warm (>= 12 positives) / cold / unseen items over the whole catalogue."""
    return prep.item_temperature(tb.interactions(spark, sf_dir), tb.items(spark, sf_dir), threshold=12)


@register("src12_profile", wrap(R + """
, b AS (SELECT count(*) AS rows, count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items,
              sum(CASE WHEN rating >= 4 THEN 1 ELSE 0 END) * 100.0 / count(*) AS positives_pct,
              count(user_id) * 100.0 / count(*) AS coverage_user_id, count(item_id) * 100.0 / count(*) AS coverage_item_id,
              count(rating) * 100.0 / count(*) AS coverage_rating, count(ts) * 100.0 / count(*) AS coverage_ts FROM r)
SELECT metric, CAST(value AS DOUBLE) AS value FROM (
  SELECT 'rows' AS metric, rows AS value FROM b UNION ALL SELECT 'users', users FROM b
  UNION ALL SELECT 'items', items FROM b UNION ALL SELECT 'positives_pct', positives_pct FROM b
  UNION ALL SELECT 'coverage_user_id', coverage_user_id FROM b UNION ALL SELECT 'coverage_item_id', coverage_item_id FROM b
  UNION ALL SELECT 'coverage_rating', coverage_rating FROM b UNION ALL SELECT 'coverage_ts', coverage_ts FROM b
  UNION ALL SELECT 'sparsity_pct', (1 - rows / (users * items)) * 100.0 FROM b
  UNION ALL SELECT 'rating_' || CAST(CAST(rating AS INTEGER) AS VARCHAR), count(*) FROM r GROUP BY rating) t""",
          ["value"]))
def q_src12(spark, sf_dir):
    """SRC-12: data profile (coverage, histogram, users, items, sparsity, positives)."""
    return quality.profile(tb.interactions(spark, sf_dir))


@register("src11_validate", R + """
SELECT * FROM (
  SELECT 'rows' AS "check", CAST(count(*) AS BIGINT) AS observed, CAST(NULL AS BIGINT) AS expected, true AS ok FROM r
  UNION ALL SELECT 'max_user', CAST(max(user_id) AS BIGINT), CAST(NULL AS BIGINT), true FROM r
  UNION ALL SELECT 'max_item', CAST(max(item_id) AS BIGINT), CAST(NULL AS BIGINT), true FROM r
  UNION ALL SELECT 'bad_rating', CAST(sum(CASE WHEN rating < 1 OR rating > 5 OR rating IS NULL THEN 1 ELSE 0 END) AS BIGINT),
                   CAST(0 AS BIGINT), sum(CASE WHEN rating < 1 OR rating > 5 OR rating IS NULL THEN 1 ELSE 0 END) = 0 FROM r
  UNION ALL SELECT 'null_ids', CAST(sum(CASE WHEN user_id IS NULL OR item_id IS NULL THEN 1 ELSE 0 END) AS BIGINT),
                   CAST(0 AS BIGINT), sum(CASE WHEN user_id IS NULL OR item_id IS NULL THEN 1 ELSE 0 END) = 0 FROM r) t""")
def q_src11(spark, sf_dir):
    """SRC-11: validation checks as a violations table."""
    return quality.validate(tb.interactions(spark, sf_dir))
