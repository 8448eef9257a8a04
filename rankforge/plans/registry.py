"""Registry of named queries: a Spark builder and, where SQL can say it, a DuckDB oracle.

Both sides round every double to 6 places (and add 0.0 so -0.0 becomes 0.0);
rankings inside queries order by the score rounded to 1e-9 so that float
summation order cannot reorder ties.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doc: str


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")

        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            return finish(fn(spark, sf_dir))

        REGISTRY[name] = Query(name, build, sql, (fn.__doc__ or "").strip())
        return fn

    return deco


def finish(df: DataFrame, places: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append((F.round(F.col(f.name).cast("double"), places) + F.lit(0.0)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def rscore(col: str = "score") -> Column:
    """Ranking key: the score rounded to 1e-9 (same rule in the SQL oracles)."""
    return F.round(F.col(col), 9)
