"""Data checks (SRC-11) and data profile (SRC-12), each one aggregate pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile(r: DataFrame, threshold: float = 4.0) -> DataFrame:
    """Long (metric, value): rows, distinct users/items, sparsity %, positives %,
    per-column non-null coverage %, and the rating histogram (rating_<v> counts)."""
    cols = r.columns
    base = r.agg(
        F.count(F.lit(1)).cast("double").alias("rows"),
        F.countDistinct("user_id").cast("double").alias("users"),
        F.countDistinct("item_id").cast("double").alias("items"),
        (F.sum(F.when(F.col("rating") >= threshold, 1).otherwise(0)) * 100.0 / F.count(F.lit(1))).alias("positives_pct"),
        *[(F.count(c) * 100.0 / F.count(F.lit(1))).alias(f"coverage_{c}") for c in cols],
    )
    base = base.withColumn("sparsity_pct", (F.lit(1.0) - F.col("rows") / (F.col("users") * F.col("items"))) * 100.0)
    names = [c for c in base.columns]
    stack = "stack({}, {}) as (metric, value)".format(len(names), ", ".join(f"'{n}', `{n}`" for n in names))
    hist = (r.groupBy("rating").agg(F.count(F.lit(1)).cast("double").alias("value"))
            .select(F.concat(F.lit("rating_"), F.col("rating").cast("int").cast("string")).alias("metric"), "value"))
    return base.selectExpr(stack).unionByName(hist)


def validate(r: DataFrame, expect_rows: int | None = None, max_user: int | None = None,
             max_item: int | None = None, rating_range: tuple[float, float] = (1.0, 5.0)) -> DataFrame:
    """Violations table (check, observed, expected, ok): one conditional-count aggregate."""
    lo, hi = rating_range
    agg = r.agg(F.count(F.lit(1)).alias("rows"), F.max("user_id").alias("max_user"),
                F.max("item_id").alias("max_item"),
                F.sum(F.when((F.col("rating") < lo) | (F.col("rating") > hi) | F.col("rating").isNull(), 1)
                      .otherwise(0)).alias("bad_rating"),
                F.sum(F.when(F.col("user_id").isNull() | F.col("item_id").isNull(), 1).otherwise(0)).alias("null_ids"))
    checks = [("rows", "rows", expect_rows), ("max_user", "max_user", max_user), ("max_item", "max_item", max_item),
              ("bad_rating", "bad_rating", 0), ("null_ids", "null_ids", 0)]
    parts = []
    for name, col, exp in checks:
        e = F.lit(exp).cast("bigint")
        parts.append(agg.select(F.lit(name).alias("check"), F.col(col).cast("bigint").alias("observed"),
                                e.alias("expected"),
                                (e.isNull() | (F.coalesce(F.col(col).cast("bigint"), F.lit(0)) == e)).alias("ok")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fold_sizes(folded: DataFrame) -> DataFrame:
    """(fold, n, users): rows and users per fold."""
    return folded.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("users"))
