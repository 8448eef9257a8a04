"""Parameter search (TU-1..TU-6) as Spark plans.

A grid or a seeded draw is a small parameter table (its size is the number of
trials the caller asks for, a proven bound); it is broadcast against the
scored candidates so a whole sweep is one plan. Fits that cannot be
vectorised over parameters (EASE per lambda) reuse their expensive part (the
Gram) across the grid.
"""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankforge.operators.common import expand, with_scalars

KNEE_GAIN = 0.003               # fixed value: marginal-gain knee


def grid(spark: SparkSession, **axes) -> DataFrame:
    """Cartesian product of small fixed axes as a parameter table."""
    names = list(axes)
    rows = list(itertools.product(*[axes[n] for n in names]))
    return spark.createDataFrame([tuple(float(v) for v in r) for r in rows], ", ".join(f"{n} double" for n in names))


def seeded_draws(n: int, seed: int, **ranges: tuple[float, float]) -> list[dict]:
    """Deterministic uniform draws for a random search (TU-2)."""
    rng = np.random.default_rng(seed)
    cols = {k: rng.uniform(lo, hi, n) for k, (lo, hi) in ranges.items()}
    return [{"trial": i, **{k: round(float(v[i]), 6) for k, v in cols.items()}} for i in range(n)]


def marginal_gain(df: DataFrame, order: str, value: str, knee: float = KNEE_GAIN) -> DataFrame:
    """W-8: gain over the previous variant and the knee (first variant whose gain < knee)."""
    w = Window.orderBy(order)        # one row per variant: a handful of rows
    g = df.withColumn("gain", F.col(value) - F.lag(value).over(w))
    first = g.where(F.col("gain") < knee).agg(F.min(order).alias("_k"))
    return with_scalars(g, first).withColumn("is_knee", F.coalesce(F.col(order) == F.col("_k"), F.lit(False))) \
        .drop("_k")


def grid_pivot(df: DataFrame, row: str, col: str, value: str) -> DataFrame:
    """AG-14: (row x col -> value) table."""
    return df.groupBy(row).pivot(col).agg(F.first(value))


def objective_with_diversity(trials: DataFrame, weight: float = 0.1) -> DataFrame:
    """TU-3: MAP@10 + weight * diversity."""
    return trials.withColumn("objective", F.col("map_at_10") + F.lit(weight) * F.col("diversity"))


def best_trial(trials: DataFrame, metric: str = "map_at_10", key: str | None = None) -> DataFrame:
    """Argmax of the metric rounded to 1e-9 (ties by trial number), per key when given."""
    w = Window.partitionBy(key) if key else Window.partitionBy(F.lit(1))
    o = w.orderBy(F.round(F.col(metric), 9).desc(), F.col("trial").asc())
    return trials.withColumn("_r", F.row_number().over(o)).where("_r = 1").drop("_r")


def route_counts(item_counts: DataFrame, thresholds: list[int]) -> DataFrame:
    """TU-1: per cold threshold the items that go to the cold model (``n`` below it) and to the warm one."""
    t = expand(item_counts, "threshold", thresholds)
    return t.groupBy("threshold").agg(F.sum(F.when(F.col("n") < F.col("threshold"), 1).otherwise(0)).alias("n_cold"),
                                      F.sum(F.when(F.col("n") >= F.col("threshold"), 1).otherwise(0)).alias("n_warm"))
