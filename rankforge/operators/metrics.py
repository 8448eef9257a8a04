"""Ranking metrics (EV-*), fold summaries (AG-9) and model selection (AG-12).

Conventions (the reference's): relevant = test rating >= 4; users without a
relevant item are skipped; users with no hit score 0; ranks are 1-based with
ties broken by item id.

``topk`` inputs are ``(user_id, item_id, rank)`` with rank <= k. Full-ranking
metrics (EV-2, EV-4) rank every unseen catalogue item: scores are sparse and
every unscored unseen item carries the user's implicit score (0 unless given),
so a relevant item's full rank is computed exactly from counts, never by
materialising users x items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.functions.scalars import self_information
from rankforge.functions.vectors import dot
from rankforge.operators.common import with_scalars
from rankforge.operators.prep import LIKED_THRESHOLD
from rankforge.operators.ranking import global_row_number


def relevant_items(test: DataFrame, threshold: float | None = LIKED_THRESHOLD) -> DataFrame:
    t = test if threshold is None else test.where(F.col("rating") >= threshold)
    return t.select("user_id", "item_id").distinct()


def _idcg(n: Column) -> Column:
    return F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0.0),
                       lambda acc, r: acc + F.lit(1.0) / F.log2(r + F.lit(1)))


def per_user_at_k(topk: DataFrame, relevant: DataFrame, k: int = 10,
                  item_stats: DataFrame | None = None, ap_variant: str = "standard",
                  by: list[str] | None = None) -> DataFrame:
    """One row per evaluated user: ap, ndcg, precision, recall, hit, n_rel, n_hits
    (+ serendipity and novelty when ``item_stats`` (item_id, pop_ratio, perhaps columns of ``by``) is given).

    ``ap_variant='hits'`` divides the AP sum by the hits found (EV-11). ``by`` adds
    grouping columns present in both inputs (e.g. a sweep parameter), so a whole
    parameter grid is evaluated in one plan.
    """
    by = list(by or [])
    keys = by + ["user_id"]
    rel = relevant.select(*keys, "item_id", F.lit(1).alias("_hit"))
    n_rel = rel.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rel"))
    t = topk.where(F.col("rank") <= k).select(*keys, "item_id", "rank").join(n_rel, keys)
    t = t.join(rel, keys + ["item_id"], "left").fillna(0, ["_hit"])
    if item_stats is not None:
        own = [c for c in by if c in item_stats.columns] + ["item_id"]
        t = t.join(item_stats.select(*own, "pop_ratio"), own, "left").fillna(0.0, ["pop_ratio"])
    w = Window.partitionBy(*keys).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("_cum", F.sum("_hit").over(w))
    aggs = [
        F.sum(F.when(F.col("_hit") == 1, F.col("_cum") / F.col("rank"))).alias("_apsum"),
        F.sum("_hit").alias("n_hits"),
        F.sum(F.when(F.col("_hit") == 1, F.lit(1.0) / F.log2(F.col("rank") + 1))).alias("_dcg"),
    ]
    if item_stats is not None:
        aggs += [F.sum(F.col("_hit") * (F.lit(1.0) - F.col("pop_ratio"))).alias("_ser"),
                 F.avg(self_information(F.col("pop_ratio"))).alias("novelty")]
    per = t.groupBy(*keys).agg(*aggs)
    per = n_rel.join(per, keys, "left").fillna(0, ["n_hits"])
    denom = F.least(F.col("n_rel"), F.lit(k)).cast("double")
    ap_den = F.col("n_hits").cast("double") if ap_variant == "hits" else denom
    cols = [
        *keys, "n_rel", F.col("n_hits").cast("long").alias("n_hits"),
        F.when(F.col("n_hits") > 0, F.col("_apsum") / ap_den).otherwise(F.lit(0.0)).alias("ap"),
        F.coalesce(F.col("_dcg") / _idcg(F.least(F.col("n_rel"), F.lit(k))), F.lit(0.0)).alias("ndcg"),
        (F.col("n_hits") / F.lit(float(k))).alias("precision"),
        (F.col("n_hits") / F.col("n_rel")).alias("recall"),
        F.when(F.col("n_hits") > 0, F.lit(1.0)).otherwise(F.lit(0.0)).alias("hit"),
    ]
    if item_stats is not None:
        cols += [F.coalesce(F.col("_ser") / denom, F.lit(0.0)).alias("serendipity"), "novelty"]
    return per.select(*cols)


def summarize_at_k(per_user: DataFrame, k: int = 10, by: list[str] | None = None) -> DataFrame:
    """Means over evaluated users (one row, or one per ``by`` group)."""
    names = [c for c in ("ap", "ndcg", "precision", "recall", "hit", "serendipity", "novelty")
             if c in per_user.columns]
    label = {"ap": f"map_at_{k}", "ndcg": f"ndcg_at_{k}", "precision": f"precision_at_{k}",
             "recall": f"recall_at_{k}", "hit": f"hit_rate_at_{k}", "serendipity": "serendipity",
             "novelty": "novelty"}
    aggs = [F.count(F.lit(1)).alias("n_users"), *[F.avg(c).alias(label[c]) for c in names]]
    return per_user.groupBy(*by).agg(*aggs) if by else per_user.agg(*aggs)


# ---------------------------------------------------------------- EV-2 / EV-4 support
def full_ranks(scores: DataFrame, seen: DataFrame, relevant: DataFrame, catalogue: DataFrame,
               implicit: DataFrame | None = None) -> DataFrame:
    """Exact 1-based rank of each relevant (user, item) among all unseen catalogue items.

    ``scores``: explicit (user_id, item_id, score) rows for unseen items.
    Every other unseen catalogue item has the user's implicit score (``implicit``
    table (user_id, implicit) or 0). rank = 1 + #explicit rows beating it +
    #implicit rows beating it, where (s, -id) orders.
    """
    users = relevant.select("user_id").distinct()
    imp = (implicit.select("user_id", "implicit") if implicit is not None
           else users.select("user_id", F.lit(0.0).alias("implicit")))
    sc = scores.join(users, "user_id", "left_semi").select("user_id", "item_id", "score")
    rel = relevant.select("user_id", "item_id").join(imp, "user_id", "left").fillna(0.0, ["implicit"])
    rel = (rel.join(sc, ["user_id", "item_id"], "left")
           .withColumn("_explicit", F.col("score").isNotNull())
           .withColumn("score", F.coalesce("score", "implicit")))
    # A: explicit candidates beating each relevant item (window by score order).
    a_rows = (sc.select("user_id", "item_id", "score", F.lit(1).alias("_c"), F.lit(0).alias("_r"))
              .unionByName(rel.where(~F.col("_explicit"))
                           .select("user_id", "item_id", "score", F.lit(0).alias("_c"), F.lit(1).alias("_r"))))
    wa = Window.partitionBy("user_id").orderBy(F.col("score").desc(), F.col("item_id").asc()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    a = (a_rows.withColumn("_a", F.coalesce(F.sum("_c").over(wa), F.lit(0)))
         .select("user_id", "item_id", "_a"))
    # Per-user counts and id-ordered counts of seen / explicit rows below each relevant id.
    seen_u = seen.join(users, "user_id", "left_semi").select("user_id", "item_id")
    b_rows = (seen_u.select("user_id", "item_id", F.lit(1).alias("_k"))
              .unionByName(sc.select("user_id", "item_id", F.lit(1).alias("_k")))
              .unionByName(rel.where(~F.col("_explicit")).select("user_id", "item_id", F.lit(0).alias("_k"))))
    wb = Window.partitionBy("user_id").orderBy("item_id").rowsBetween(Window.unboundedPreceding, -1)
    below = (b_rows.withColumn("_below", F.coalesce(F.sum("_k").over(wb), F.lit(0)))
             .withColumn("_tot", F.sum("_k").over(Window.partitionBy("user_id")))
             .select("user_id", "item_id", "_below", "_tot"))
    cat = catalogue.select("item_id").distinct()
    n_cat = cat.agg(F.count(F.lit(1)).alias("_ncat"))
    cpos = global_row_number(cat, [F.col("item_id").asc()], out="_cpos")
    r = (rel.join(a, ["user_id", "item_id"], "left")
         .join(below, ["user_id", "item_id"], "left")
         .join(cpos, "item_id", "left"))
    r = with_scalars(r, n_cat)
    s, i0 = F.col("score"), F.col("implicit")
    implicit_all = F.col("_ncat") - F.col("_tot")
    implicit_below = (F.col("_cpos") - 1) - F.col("_below")
    b = (F.when(s > i0, F.lit(0)).when(s < i0, implicit_all - F.when(~F.col("_explicit"), 1).otherwise(0))
         .otherwise(implicit_below))
    return r.select("user_id", "item_id", (F.col("_a") + b + 1).cast("long").alias("rank"))


def full_ranks_prior(prior: DataFrame, seen: DataFrame, relevant: DataFrame) -> DataFrame:
    """Exact full-catalogue ranks when every item scores ``prior[item]`` for every user.

    rank(u, i) = position of i in the catalogue order (score desc, id asc) minus the
    number of u's seen items ahead of it: one distributed global order plus one
    window over each user's own seen and relevant rows (no users x items rows)."""
    order = global_row_number(prior.select("item_id", "score"), [F.col("score").desc(), F.col("item_id").asc()],
                              out="_pos")
    rows = (seen.select("user_id", "item_id", F.lit(1).alias("_s"))
            .unionByName(relevant.select("user_id", "item_id", F.lit(0).alias("_s")))
            .join(relevant.select("user_id").distinct(), "user_id", "left_semi")
            .join(order, "item_id"))
    w = Window.partitionBy("user_id").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    r = rows.withColumn("_ahead", F.coalesce(F.sum("_s").over(w), F.lit(0)))
    return r.where(F.col("_s") == 0).select("user_id", "item_id", (F.col("_pos") - F.col("_ahead")).cast("long").alias("rank"))


def per_user_full(ranks: DataFrame) -> DataFrame:
    """AP (full) and nDCG (full) per user from the exact ranks of all relevant items."""
    w = Window.partitionBy("user_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    t = ranks.withColumn("_cum", F.count(F.lit(1)).over(w))
    per = t.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_rel"),
                                   F.sum(F.col("_cum") / F.col("rank")).alias("_apsum"),
                                   F.sum(F.lit(1.0) / F.log2(F.col("rank") + 1)).alias("_dcg"))
    return per.select("user_id", (F.col("_apsum") / F.col("n_rel")).alias("ap_full"),
                      (F.col("_dcg") / _idcg(F.col("n_rel"))).alias("ndcg_full"))


# ---------------------------------------------------------------- EV-8
def coverage(topk: DataFrame, catalogue: DataFrame, users: DataFrame | None = None, k: int = 10) -> DataFrame:
    t = topk.where(F.col("rank") <= k)
    if users is not None:
        t = t.join(users.select("user_id").distinct(), "user_id", "left_semi")
    n_rec = t.agg(F.countDistinct("item_id").alias("n_recommended"))
    n_cat = catalogue.agg(F.countDistinct("item_id").alias("n_catalogue"))
    return with_scalars(n_rec, n_cat).withColumn("coverage_pct",
                                             F.col("n_recommended") * 100.0 / F.col("n_catalogue"))


# ---------------------------------------------------------------- EV-10
def diversity(topk: DataFrame, features: DataFrame, k: int = 10, vector: str = "vector", by: list[str] | None = None) -> DataFrame:
    """Per user (and ``by``, e.g. a trial) 1 - mean pairwise dot of (row-normalised) feature vectors in the top-k.

    Pairs are formed inside each user's top-k only (k(k-1)/2 rows per user, k fixed).
    """
    keys = [*(by or []), "user_id"]
    t = topk.where(F.col("rank") <= k).join(features.select("item_id", vector), "item_id")
    a = t.select(*keys, F.col("rank").alias("ra"), F.col(vector).alias("va"))
    b = t.select(*keys, F.col("rank").alias("rb"), F.col(vector).alias("vb"))
    pairs = a.join(b, keys).where(F.col("ra") < F.col("rb"))
    return pairs.groupBy(*keys).agg((F.lit(1.0) - F.avg(dot("va", "vb"))).alias("diversity"))


# ---------------------------------------------------------------- AG-9
def fold_summary(metrics_long: DataFrame, group: list[str] | None = None) -> DataFrame:
    """(model, metric) -> mean, std_sample, std_population, n_folds over the fold rows."""
    g = group or ["model", "metric"]
    return metrics_long.groupBy(*g).agg(F.avg("value").alias("mean"),
                                        F.stddev_samp("value").alias("std_sample"),
                                        F.stddev_pop("value").alias("std_population"),
                                        F.count(F.lit(1)).alias("n_folds"))


def to_long(wide: DataFrame, id_cols: list[str]) -> DataFrame:
    """Wide metric columns -> (ids..., metric, value) via stack."""
    ms = [c for c in wide.columns if c not in id_cols]
    expr = "stack({}, {}) as (metric, value)".format(
        len(ms), ", ".join(f"'{m}', cast(`{m}` as double)" for m in ms))
    return wide.selectExpr(*[f"`{c}`" for c in id_cols], expr)


# ---------------------------------------------------------------- AG-12
def select_model(summary: DataFrame, metric: str = "map_at_10", tolerance: float = 0.01,
                 complexity: str = "complexity") -> DataFrame:
    """Best model by mean ``metric``; any model within ``tolerance`` (relative) of the best
    and simpler (lower complexity, then name) wins. One row."""
    s = summary.where(F.col("metric") == metric)
    best = s.agg(F.max("mean").alias("_best"))
    near = with_scalars(s, best).where(F.col("mean") >= F.col("_best") * (1 - tolerance))
    w = Window.orderBy(F.col(complexity).asc(), F.col("mean").desc(), F.col("model").asc())
    return near.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "_best")
