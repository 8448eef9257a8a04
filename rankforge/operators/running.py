"""Running totals over a total order, without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.session import cut_lineage


def running_totals(df: DataFrame, order: list[Column], values: list[str], by: str | list[str] | None = None,
                   keep: Callable[[DataFrame], DataFrame] = cut_lineage) -> DataFrame:
    """``df`` with ``<value>_to``: the sum of each value from the first row up to this one in ``order``
    (for each ``by`` on its own, null being a value like others).

    Rows are range-partitioned by (``by``, ``order``), so a ``by`` that holds a third of all rows spreads over
    many partitions; each partition sums its own rows, and the totals of the partitions before it, a table of one
    row a partition and ``by``, are added. ``keep`` materialises the partitioned rows, so that partition numbers
    are the same whoever reads them. Rows that are equal in ``order`` come in any order among themselves: add a
    column that tells them apart where that matters, or where very many are equal.
    """
    by = [by] if isinstance(by, str) else list(by or [])
    parted = keep(df.repartitionByRange(*[F.col(c).asc_nulls_last() for c in by], *order).withColumn("_pid", F.spark_partition_id()))
    groups = ["_pid", *by]
    local = Window.partitionBy(*groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inside = parted.select("*", *[F.sum(v).over(local).alias(f"{v}_to") for v in values])
    sums = parted.groupBy(*groups).agg(*[F.sum(v).alias(v) for v in values])
    earlier = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col("_pid").alias("_opid"), *[F.col(c).alias(f"_oby{k}") for k, c in enumerate(by)],
                          *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"_off_{v}") for v in values])
    same = F.col("_pid") == F.col("_opid")
    for k, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_oby{k}"))
    return (inside.join(offsets, same)
            .select(*[F.col(c) for c in df.columns], *[(F.col(f"{v}_to") + F.col(f"_off_{v}")).alias(f"{v}_to") for v in values]))
