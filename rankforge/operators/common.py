"""Small shared helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate (max timestamp, catalogue size, quantile...) to every row.

    The row is a scalar subquery of the plan: no job runs before the action, and no join (and no cross join) is
    planned. No row gives nulls; more than one is an error of the action."""
    row = one_row.select(F.struct(*[F.col(f"`{c}`") for c in one_row.columns])).scalar()
    rows = df.withColumn("__scalars", row)
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], *[F.col("__scalars").getField(c).alias(c) for c in one_row.columns])


def expand(df: DataFrame, name: str, values: list) -> DataFrame:
    """One copy of each row per value of a small fixed parameter list (a sweep axis)."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
