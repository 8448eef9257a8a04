"""Score normalisation windows and fusion/routing operators (W-4..6, FU-*).

Score tables are long ``(group, item_id, score)``. Catalogue-wide statistics
(W-4) use the sum / sum-of-squares identity with the catalogue size, so
unscored items count as 0 without materialising them; the per-group value an
unscored item would get is returned as an ``implicit`` table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.operators.ranking import top_k

EPS = 1e-8
RRF_K = 60                      # fixed value: reciprocal-rank constant
WARM_MIN_INTERACTIONS = 5       # fixed value: warm item threshold


def _groups(group: str | list[str]) -> list[str]:
    return [group] if isinstance(group, str) else list(group)


# ---------------------------------------------------------------- W-4
def zscore_catalogue(scores: DataFrame, n_catalogue: Column | int, group: str = "user_id",
                     score: str = "score", out: str = "z", eps: float = EPS) -> tuple[DataFrame, DataFrame]:
    """Per-group z over the whole catalogue (unscored = 0), population std, + eps.

    Returns (scored rows with ``out``, implicit table (group, implicit)).
    """
    n = n_catalogue if isinstance(n_catalogue, Column) else F.lit(float(n_catalogue))
    stats = scores.groupBy(group).agg(F.sum(score).alias("_s1"), F.sum(F.col(score) * F.col(score)).alias("_s2"))
    stats = stats.select(group, (F.col("_s1") / n).alias("_mu"),
                         F.sqrt(F.greatest(F.col("_s2") / n - (F.col("_s1") / n) ** 2, F.lit(0.0))).alias("_sd"))
    z = (scores.join(stats, group)
         .withColumn(out, (F.col(score) - F.col("_mu")) / (F.col("_sd") + F.lit(eps)))
         .drop("_mu", "_sd"))
    implicit = stats.select(group, ((-F.col("_mu")) / (F.col("_sd") + F.lit(eps))).alias("implicit"))
    return z, implicit


def zscore_rows(scores: DataFrame, group: str | list[str] = "user_id", score: str = "score",
                out: str = "z", eps: float = EPS, floor: bool = False) -> DataFrame:
    """Per-group z over the given rows only, population std; ``+eps`` (default) or
    ``max(std, eps)`` when ``floor``."""
    w = Window.partitionBy(*_groups(group))
    mu = F.avg(score).over(w)
    sd = F.stddev_pop(score).over(w)
    den = F.greatest(sd, F.lit(eps)) if floor else sd + F.lit(eps)
    return scores.withColumn(out, (F.col(score) - mu) / den)


# ---------------------------------------------------------------- W-5 / RT-4
def minmax_rows(scores: DataFrame, group: str | list[str] = "user_id", score: str = "score",
                out: str = "norm", invert: bool = False) -> DataFrame:
    """(s - min) / range per group, range 1 when all equal; ``invert`` gives 1 - that."""
    w = Window.partitionBy(*_groups(group))
    mn, mx = F.min(score).over(w), F.max(score).over(w)
    rng = F.when(mx == mn, F.lit(1.0)).otherwise(mx - mn)
    v = (F.col(score) - mn) / rng
    return scores.withColumn(out, F.lit(1.0) - v if invert else v)


# ---------------------------------------------------------------- W-6
def l2_rows(scores: DataFrame, group: str | list[str] = "user_id", score: str = "score",
            out: str = "l2", eps: float = 0.0) -> DataFrame:
    w = Window.partitionBy(*_groups(group))
    nrm = F.sqrt(F.sum(F.col(score) * F.col(score)).over(w))
    return scores.withColumn(out, F.col(score) / (nrm + F.lit(eps)) if eps else
                             F.when(nrm > 0, F.col(score) / nrm).otherwise(F.lit(0.0)))


# ---------------------------------------------------------------- FU-1
def linear_blend(a: DataFrame, b: DataFrame, wa: float = 0.6, wb: float = 0.4,
                 keys: list[str] | None = None) -> DataFrame:
    """wa * a.score + wb * b.score over the union of keys (missing = 0)."""
    keys = keys or ["user_id", "item_id"]
    j = (a.select(*keys, F.col("score").alias("_a")).join(b.select(*keys, F.col("score").alias("_b")), keys, "full")
         .fillna(0.0, ["_a", "_b"]))
    return j.select(*keys, (F.lit(wa) * F.col("_a") + F.lit(wb) * F.col("_b")).alias("score"))


# ---------------------------------------------------------------- FU-2
def z_ensemble(arms: list[tuple[DataFrame, float]], n_catalogue: int, group: str = "user_id",
               item: str = "item_id") -> tuple[DataFrame, DataFrame]:
    """sum_i w_i * z_i(score) over the catalogue; an arm missing a row contributes its implicit z.

    Returns (fused rows, implicit fused value per group)."""
    fused, implicit = None, None
    for idx, (df, w) in enumerate(arms):
        z, imp = zscore_catalogue(df, n_catalogue, group)
        z = z.select(group, item, F.col("z").alias(f"_z{idx}"))
        imp = imp.select(group, F.col("implicit").alias(f"_i{idx}"))
        fused = z if fused is None else fused.join(z, [group, item], "full")
        implicit = imp if implicit is None else implicit.join(imp, group, "full")
    fused = fused.join(implicit, group, "left")
    expr = sum((F.lit(float(w)) * F.coalesce(F.col(f"_z{i}"), F.col(f"_i{i}"), F.lit(0.0))
                for i, (_, w) in enumerate(arms)), F.lit(0.0))
    imp_expr = sum((F.lit(float(w)) * F.coalesce(F.col(f"_i{i}"), F.lit(0.0)) for i, (_, w) in enumerate(arms)),
                   F.lit(0.0))
    return (fused.select(group, item, expr.alias("score")),
            implicit.select(group, imp_expr.alias("implicit")))


# ---------------------------------------------------------------- FU-4
def l2_weighted_sum(arms: list[tuple[DataFrame, float]], group: str = "user_id", item: str = "item_id") -> DataFrame:
    """Each arm L2-normalised per group, weights divided by their sum, summed (missing = 0)."""
    tot = sum(w for _, w in arms)
    fused = None
    for idx, (df, w) in enumerate(arms):
        n = l2_rows(df, group).select(group, item, F.col("l2").alias(f"_n{idx}"))
        fused = n if fused is None else fused.join(n, [group, item], "full")
    expr = sum((F.lit(w / tot) * F.coalesce(F.col(f"_n{i}"), F.lit(0.0)) for i, (_, w) in enumerate(arms)),
               F.lit(0.0))
    return fused.select(group, item, expr.alias("score"))


# ---------------------------------------------------------------- FU-5 / FU-6
def warm_cold_route(model_a: DataFrame, model_b: DataFrame, counts: DataFrame,
                    threshold: int = WARM_MIN_INTERACTIONS, keys: list[str] | None = None) -> DataFrame:
    """Per (user, item) candidate: items with count >= threshold take model A's score, else
    model B's. No blending. Adds ``route`` ('warm'/'cold')."""
    keys = keys or ["user_id", "item_id"]
    j = (model_a.select(*keys, F.col("score").alias("_a"))
         .join(model_b.select(*keys, F.col("score").alias("_b")), keys, "full")
         .join(counts.select("item_id", F.col("n").alias("_n")), "item_id", "left"))
    warm = F.coalesce(F.col("_n"), F.lit(0)) >= threshold
    return j.select(*keys, F.when(warm, F.lit("warm")).otherwise(F.lit("cold")).alias("route"),
                    F.when(warm, F.col("_a")).otherwise(F.col("_b")).alias("score")).where(F.col("score").isNotNull())



def minmax_route(model_a: DataFrame, model_b: DataFrame, counts: DataFrame,
                 threshold: int = WARM_MIN_INTERACTIONS) -> DataFrame:
    """FU-6: both models min-max scaled per user first, then routed as FU-5."""
    a = minmax_rows(model_a).select("user_id", "item_id", F.col("norm").alias("score"))
    b = minmax_rows(model_b).select("user_id", "item_id", F.col("norm").alias("score"))
    return warm_cold_route(a, b, counts, threshold)


# ---------------------------------------------------------------- FU-7
def bayesian_blend(scores: DataFrame, bayes: DataFrame, w: float, group: str = "user_id") -> DataFrame:
    """w * z(score) + (1 - w) * z(bayes_avg), z over the user's unseen (finite) candidates,
    std floored at 1e-8."""
    s = scores.join(bayes.select("item_id", "bayes_avg"), "item_id", "left") \
        .fillna({"bayes_avg": 3.53})
    s = zscore_rows(s, group, "score", "_zs", floor=True)
    s = zscore_rows(s, group, "bayes_avg", "_zb", floor=True)
    return s.select(group, "item_id", (F.lit(w) * F.col("_zs") + F.lit(1 - w) * F.col("_zb")).alias("score"))


# ---------------------------------------------------------------- FU-8 / FU-9
def candidate_z(a: DataFrame, b: DataFrame, group: str = "query_id", item: str = "item_id", own_a: DataFrame | None = None) -> DataFrame:
    """The union of both engines' candidates per group: scores ``_a`` and ``_b`` (missing = 0.0), their z-scores ``_za``
    and ``_zb`` (population std + 1e-8), and how many rows each engine found in the group (``_na``, ``_nb``)."""
    own = own_a if own_a is not None else a
    j = (a.select(group, item, F.col("score").alias("_a"))
         .join(own.select(group, item, F.lit(1).alias("_own")), [group, item], "left")
         .join(b.select(group, item, F.col("score").alias("_b")), [group, item], "full"))
    w = Window.partitionBy(group)
    na = F.count("_own").over(w)
    nb = F.count("_b").over(w)
    j = j.withColumn("_na", na).withColumn("_nb", nb).fillna(0.0, ["_a", "_b"])
    return zscore_rows(zscore_rows(j, group, "_a", "_za"), group, "_b", "_zb")


def candidate_z_fusion(a: DataFrame, b: DataFrame, alpha: float, beta: float,
                       group: str = "query_id", item: str = "item_id", own_a: DataFrame | None = None) -> DataFrame:
    """alpha * z(a) + beta * z(b) over the union of candidate ids per group (missing = 0.0),
    population std + 1e-8. If one side is empty for a group the weights become (0,1)/(1,0);
    both empty gives no rows. ``own_a``: the rows that engine A found itself, where ``a``
    also holds scores looked up for B's candidates; emptiness is decided on these."""
    j = candidate_z(a, b, group, item, own_a)
    al = F.when(F.col("_na") == 0, F.lit(0.0)).when(F.col("_nb") == 0, F.lit(1.0)).otherwise(F.lit(float(alpha)))
    be = F.when(F.col("_na") == 0, F.lit(1.0)).when(F.col("_nb") == 0, F.lit(0.0)).otherwise(F.lit(float(beta)))
    return j.select(group, item, F.col("_a").alias("score_a"), F.col("_b").alias("score_b"),
                    (al * F.col("_za") + be * F.col("_zb")).alias("fused_score"))


# ---------------------------------------------------------------- FU-8 at many weights (TU-2, TU-4)
def fusion_sweep(a: DataFrame, b: DataFrame, alphas: list[float], k: int, group: str = "query_id", item: str = "item_id",
                 own_a: DataFrame | None = None) -> DataFrame:
    """(trial, group, item, fused_score, rank): the best k of ``candidate_z_fusion`` at each alpha, beta = 1 - alpha,
    for all alphas (trial: its place in the list) in one plan.

    A fused score is linear in alpha, so that its values at 1 and at 0 give it everywhere: the candidates are joined and
    scaled once, whatever the number of weights."""
    j = candidate_z(a, b, group, item, own_a)
    at_one = F.when(F.col("_na") == 0, F.col("_zb")).otherwise(F.col("_za"))
    at_zero = F.when(F.col("_nb") == 0, F.col("_za")).otherwise(F.col("_zb"))
    ends = j.select(group, item, at_one.alias("_one"), at_zero.alias("_zero"))
    t = ends.select("*", F.posexplode(F.array(*[F.lit(float(x)) for x in alphas])).alias("trial", "_alpha"))
    t = t.withColumn("fused_score", F.col("_alpha") * F.col("_one") + (1 - F.col("_alpha")) * F.col("_zero"))
    top = top_k(t.withColumn("_rs", F.round("fused_score", 9)), k, ["trial", group], "_rs", item)
    return top.select("trial", group, item, "fused_score", "rank")


# ---------------------------------------------------------------- FU-10
def rrf(keyword: DataFrame, dense: DataFrame, alpha: float | str, group: str = "query_id",
        item: str = "item_id", k: int = RRF_K) -> DataFrame:
    """Weighted reciprocal rank fusion: (1-alpha)/(k+rank_kw) + alpha/(k+rank_dense).

    Inputs carry 1-based ``rank`` per group (W-11). ``alpha`` may name a column
    present in both frames (per-query weight)."""
    a = F.col(alpha) if isinstance(alpha, str) else F.lit(float(alpha))
    kw = keyword.select(group, item, ((F.lit(1.0) - a) / (F.lit(k) + F.col("rank"))).alias("_c"))
    de = dense.select(group, item, (a / (F.lit(k) + F.col("rank"))).alias("_c"))
    return kw.unionByName(de).groupBy(group, item).agg(F.sum("_c").alias("score"))
