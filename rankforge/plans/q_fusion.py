"""Registered queries: normalisation windows (W-4..6) and fusion / routing (FU-*).

Two score arms with different key sets, both derived from the interactions:
  arm A: time-decayed rating (half-life 365 days) of liked pairs (rating >= 4);
  arm B: raw rating of pairs from the last 730 days.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from rankforge.operators import fusion as fu
from rankforge.operators import prep, ranking
from rankforge.operators.common import with_scalars
from rankforge.plans.registry import register
from rankforge.plans.sqlparts import INTERACTIONS, with_, wrap
from rankforge.sources import tables as tb

ARMS = dict(
    r=INTERACTIONS,
    mx="SELECT max(epoch(ts)) AS m FROM r",
    a="""SELECT user_id, item_id, rating * pow(0.5, ((SELECT m FROM mx) - epoch(ts)) / 86400.0 / 365.0) AS score
         FROM r WHERE rating >= 4""",
    b="SELECT user_id, item_id, rating AS score FROM r WHERE epoch(ts) >= (SELECT m FROM mx) - 730 * 86400",
)


def arms(spark, sf_dir):
    r = tb.interactions(spark, sf_dir)
    a = prep.time_decay(prep.positives(r), 365.0, reference=r).select("user_id", "item_id", F.col("weight").alias("score"))
    mx = r.agg(F.max(F.unix_timestamp("ts")).alias("_m"))
    b = (with_scalars(r, mx).where(F.unix_timestamp("ts") >= F.col("_m") - 730 * 86400)
         .select("user_id", "item_id", F.col("rating").alias("score")))
    return a, b


def n_catalogue(spark, sf_dir) -> int:
    return tb.items(spark, sf_dir).count()


STATS = """SELECT user_id, sum(score) / (SELECT count(*) FROM part) AS mu,
  sqrt(greatest(sum(score * score) / (SELECT count(*) FROM part) - pow(sum(score) / (SELECT count(*) FROM part), 2), 0)) AS sd
  FROM {src} GROUP BY user_id"""


@register("fu01_linear_blend", wrap(with_(**ARMS) + """
SELECT user_id, item_id, 0.4 * coalesce(a.score, 0) + 0.6 * coalesce(b.score, 0) AS score
FROM a FULL OUTER JOIN b USING (user_id, item_id)""", ["score"]))
def q_fu01(spark, sf_dir):
    """FU-1: raw linear blend 0.4 * A + 0.6 * B over the union of pairs."""
    a, b = arms(spark, sf_dir)
    return fu.linear_blend(a, b, 0.4, 0.6)


@register("w04_zscore_catalogue", wrap(with_(**ARMS, st=STATS.format(src="a")) + """
SELECT a.user_id, a.item_id, (a.score - st.mu) / (st.sd + 1e-8) AS z, -st.mu / (st.sd + 1e-8) AS implicit
FROM a JOIN st USING (user_id)""", ["z", "implicit"]))
def q_w04(spark, sf_dir):
    """W-4: per-user z over the whole catalogue (unscored items = 0), with the implicit z."""
    a, _ = arms(spark, sf_dir)
    z, imp = fu.zscore_catalogue(a, n_catalogue(spark, sf_dir))
    return z.join(imp, "user_id").select("user_id", "item_id", "z", "implicit")


@register("fu02_z_ensemble", wrap(with_(**ARMS, sa=STATS.format(src="a"), sb=STATS.format(src="b")) + """
, za AS (SELECT a.user_id, a.item_id, (a.score - sa.mu) / (sa.sd + 1e-8) AS z FROM a JOIN sa USING (user_id)),
zb AS (SELECT b.user_id, b.item_id, (b.score - sb.mu) / (sb.sd + 1e-8) AS z FROM b JOIN sb USING (user_id)),
j AS (SELECT user_id, item_id, za.z AS z1, zb.z AS z2 FROM za FULL OUTER JOIN zb USING (user_id, item_id))
SELECT j.user_id, j.item_id,
  1.0 * coalesce(j.z1, -sa.mu / (sa.sd + 1e-8), 0.0) + 0.5 * coalesce(j.z2, -sb.mu / (sb.sd + 1e-8), 0.0) AS score
FROM j LEFT JOIN sa USING (user_id) LEFT JOIN sb USING (user_id)""", ["score"]))
def q_fu02(spark, sf_dir):
    """FU-2: 1.0 * z(A) + 0.5 * z(B), catalogue z-scores, a missing arm contributes its implicit z."""
    a, b = arms(spark, sf_dir)
    fused, _ = fu.z_ensemble([(a, 1.0), (b, 0.5)], n_catalogue(spark, sf_dir))
    return fused


@register("w05_minmax_rows", wrap(with_(**ARMS) + """
SELECT user_id, item_id, CASE WHEN max(score) OVER w = min(score) OVER w THEN (score - min(score) OVER w) / 1.0
  ELSE (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) END AS norm
FROM a WINDOW w AS (PARTITION BY user_id)""", ["norm"]))
def q_w05(spark, sf_dir):
    """W-5: per-user min-max to [0, 1], zero range -> divide by 1."""
    a, _ = arms(spark, sf_dir)
    return fu.minmax_rows(a).select("user_id", "item_id", "norm")


@register("w06_l2_rows", wrap(with_(**ARMS) + """
SELECT user_id, item_id, CASE WHEN sqrt(sum(score * score) OVER (PARTITION BY user_id)) > 0
  THEN score / sqrt(sum(score * score) OVER (PARTITION BY user_id)) ELSE 0.0 END AS l2 FROM b""", ["l2"]))
def q_w06(spark, sf_dir):
    """W-6: per-user L2 normalisation."""
    _, b = arms(spark, sf_dir)
    return fu.l2_rows(b).select("user_id", "item_id", "l2")


@register("fu04_l2_weighted_sum", wrap(with_(**ARMS) + """
, na AS (SELECT user_id, item_id, CASE WHEN sqrt(sum(score * score) OVER (PARTITION BY user_id)) > 0
    THEN score / sqrt(sum(score * score) OVER (PARTITION BY user_id)) ELSE 0.0 END AS n FROM a),
nb AS (SELECT user_id, item_id, CASE WHEN sqrt(sum(score * score) OVER (PARTITION BY user_id)) > 0
    THEN score / sqrt(sum(score * score) OVER (PARTITION BY user_id)) ELSE 0.0 END AS n FROM b)
SELECT user_id, item_id, 2.0 / 3.0 * coalesce(na.n, 0.0) + 1.0 / 3.0 * coalesce(nb.n, 0.0) AS score
FROM na FULL OUTER JOIN nb USING (user_id, item_id)""", ["score"]))
def q_fu04(spark, sf_dir):
    """FU-4: L2-normalised arms, weights (2, 1) divided by their sum."""
    a, b = arms(spark, sf_dir)
    return fu.l2_weighted_sum([(a, 2.0), (b, 1.0)])


ROUTE = """
, c AS (SELECT item_id, count(*) AS n FROM r GROUP BY item_id),
j AS (SELECT user_id, item_id, a.score AS sa, b.score AS sb FROM {a} a FULL OUTER JOIN {b} b USING (user_id, item_id))
SELECT user_id, item_id, CASE WHEN coalesce(c.n, 0) >= 12 THEN 'warm' ELSE 'cold' END AS route,
       CASE WHEN coalesce(c.n, 0) >= 12 THEN sa ELSE sb END AS score
FROM j LEFT JOIN c USING (item_id) WHERE (CASE WHEN coalesce(c.n, 0) >= 12 THEN sa ELSE sb END) IS NOT NULL"""


@register("fu05_warm_cold_route", wrap(with_(**ARMS) + ROUTE.format(a="a", b="b"), ["score"]))
def q_fu05(spark, sf_dir):
    """FU-5: items with >= 12 interactions take arm A, others arm B; no blending."""
    a, b = arms(spark, sf_dir)
    counts = prep.item_counts(tb.interactions(spark, sf_dir))
    return fu.warm_cold_route(a, b, counts, 12)


MM = """SELECT user_id, item_id, CASE WHEN max(score) OVER w = min(score) OVER w THEN score - min(score) OVER w
  ELSE (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) END AS score FROM {src} WINDOW w AS (PARTITION BY user_id)"""


@register("fu06_minmax_route", wrap(with_(**ARMS, ma=MM.format(src="a"), mb=MM.format(src="b")) +
                                    ROUTE.format(a="ma", b="mb"), ["score"]))
def q_fu06(spark, sf_dir):
    """FU-6: both arms min-max scaled per user, then routed warm/cold."""
    a, b = arms(spark, sf_dir)
    counts = prep.item_counts(tb.interactions(spark, sf_dir))
    return fu.minmax_route(a, b, counts, 12)


@register("fu07_bayesian_blend", wrap(with_(**ARMS) + """
, ba AS (SELECT item_id, (50 * 3.53 + sum(CASE WHEN rating >= 4 THEN 1 ELSE 0 END) * avg(rating))
                         / (50 + sum(CASE WHEN rating >= 4 THEN 1 ELSE 0 END)) AS bayes_avg FROM r GROUP BY item_id),
s AS (SELECT b.user_id, b.item_id, b.score, coalesce(ba.bayes_avg, 3.53) AS bv FROM b LEFT JOIN ba USING (item_id))
SELECT user_id, item_id,
  0.8 * (score - avg(score) OVER w) / greatest(stddev_pop(score) OVER w, 1e-8)
  + 0.2 * (bv - avg(bv) OVER w) / greatest(stddev_pop(bv) OVER w, 1e-8) AS score
FROM s WINDOW w AS (PARTITION BY user_id)""", ["score"]))
def q_fu07(spark, sf_dir):
    """FU-7: 0.8 * z(score) + 0.2 * z(Bayesian average) over each user's candidates (std floored at 1e-8)."""
    _, b = arms(spark, sf_dir)
    return fu.bayesian_blend(b, prep.rating_bayes(tb.interactions(spark, sf_dir)), 0.8)


@register("fu08_candidate_z_fusion", wrap(with_(**ARMS) + """
, j AS (SELECT user_id, item_id, a.score AS sa, b.score AS sb FROM a FULL OUTER JOIN b USING (user_id, item_id)),
k AS (SELECT *, count(sa) OVER (PARTITION BY user_id) AS na, count(sb) OVER (PARTITION BY user_id) AS nb,
             coalesce(sa, 0.0) AS xa, coalesce(sb, 0.0) AS xb FROM j),
z AS (SELECT *, (xa - avg(xa) OVER w) / (stddev_pop(xa) OVER w + 1e-8) AS za,
                (xb - avg(xb) OVER w) / (stddev_pop(xb) OVER w + 1e-8) AS zb FROM k WINDOW w AS (PARTITION BY user_id))
SELECT user_id, item_id, xa AS score_a, xb AS score_b,
  CASE WHEN na = 0 THEN 0.0 WHEN nb = 0 THEN 1.0 ELSE 0.8 END * za
  + CASE WHEN na = 0 THEN 1.0 WHEN nb = 0 THEN 0.0 ELSE 0.2 END * zb AS fused_score FROM z""",
                                          ["score_a", "score_b", "fused_score"]))
def q_fu08(spark, sf_dir):
    """FU-8 / FU-9 / J-6: 0.8 * z(A) + 0.2 * z(B) over the union of each user's candidates
    (missing 0.0); a user with one empty side gets weights (1,0) / (0,1)."""
    a, b = arms(spark, sf_dir)
    return fu.candidate_z_fusion(a, b, 0.8, 0.2, group="user_id")


@register("fu10_rrf", wrap(with_(**ARMS) + """
, ra AS (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM a),
rb AS (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM b)
SELECT user_id, item_id, sum(c) AS score FROM (
  SELECT user_id, item_id, (1 - 0.3) / (60 + rank) AS c FROM ra
  UNION ALL SELECT user_id, item_id, 0.3 / (60 + rank) FROM rb) t GROUP BY user_id, item_id""", ["score"]))
def q_fu10(spark, sf_dir):
    """FU-10 / W-11: weighted reciprocal rank fusion, 0.7 / (60 + rank_A) + 0.3 / (60 + rank_B)."""
    a, b = arms(spark, sf_dir)
    return fu.rrf(ranking.full_rank(a), ranking.full_rank(b), 0.3, group="user_id", item="item_id")
