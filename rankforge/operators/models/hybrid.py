"""AG-6 on score tables: a global percentile of per-user z-scores in which unscored items count.

Sparse scores stay a long table; a user's catalogue statistics are mean = sum / N and
var = sum_sq / N - mean^2 (unscored items are 0), and each user's implicit z value enters the exact distributed
selection (``ranking.weighted_quantile``) with the number of its unscored items as weight. Rankers over
model scores are in ``fused``, which stores no scores at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.operators.common import with_scalars
from rankforge.session import cut_lineage

EPS = 1e-8


def sparse_stats(scores: DataFrame, n_items: DataFrame, prefix: str) -> DataFrame:
    """(user_id, <prefix>_mu, <prefix>_sd, <prefix>_n) over the catalogue, unscored = 0."""
    st = scores.groupBy("user_id").agg(F.sum("score").alias("_s1"), F.sum(F.col("score") ** 2).alias("_s2"),
                                       F.count(F.lit(1)).alias(f"{prefix}_n"))
    st = with_scalars(st, n_items)
    mu = F.col("_s1") / F.col("_N")
    return st.select("user_id", mu.alias(f"{prefix}_mu"),
                     F.sqrt(F.greatest(F.col("_s2") / F.col("_N") - mu * mu, F.lit(0.0))).alias(f"{prefix}_sd"),
                     f"{prefix}_n")


def cf_percentile(cf: DataFrame, stats: DataFrame, users: DataFrame, n_items: DataFrame, perc: float) -> DataFrame:
    """One row (_gate): exact percentile (linear interpolation) of z(cf) over users x catalogue,
    unscored items entering with their user's implicit z and a frequency. Computed by the
    distributed weighted selection ``ranking.weighted_quantile`` (no single-task buffer)."""
    from rankforge.operators.ranking import weighted_quantile
    z = cf.join(stats, "user_id").select(
        ((F.col("score") - F.col("cf_mu")) / (F.col("cf_sd") + F.lit(EPS))).alias("_z"), F.lit(1).alias("_f"))
    imp = (with_scalars(users.select("user_id").distinct().join(stats, "user_id", "left"), n_items)
           .select((-F.coalesce(F.col("cf_mu"), F.lit(0.0)) / (F.coalesce(F.col("cf_sd"), F.lit(0.0)) + F.lit(EPS)))
                   .alias("_z"), (F.col("_N") - F.coalesce(F.col("cf_n"), F.lit(0))).cast("long").alias("_f"))
           .where(F.col("_f") > 0))
    # Every pass of the selection reads the z-scores: join them once.
    gate = weighted_quantile(cut_lineage(z.unionByName(imp)), perc / 100.0, "_z", "_f")
    return cf.sparkSession.createDataFrame([(float(gate),)], "_gate double")
