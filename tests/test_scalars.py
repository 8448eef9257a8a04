"""One-row values are scalar subqueries: nothing runs before the action."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from rankforge.operators import prep
from rankforge.operators.common import with_scalars
from rankforge.sources import tables


def jobs_of(spark, build):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "test")
    try:
        df = build()
        return df, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_no_job_before_the_action(spark, small_dir):
    r = tables.interactions(spark, small_dir)
    for build in (lambda: with_scalars(r, r.agg(F.max("rating").alias("_m"))), lambda: prep.time_decay(r, 180.0)):
        df, jobs = jobs_of(spark, build)
        assert jobs == 0
        assert df.count() == r.count()


def test_values_names_and_types(spark):
    rows = spark.range(4).withColumn("a.b", F.lit("x"))
    one = rows.agg(F.max("id").alias("most"), F.lit(None).cast("double").alias("none"), F.array(F.lit(1)).alias("list"))
    got = with_scalars(rows, one)
    assert got.columns == ["id", "a.b", "most", "none", "list"]
    assert {(r[0], r[1], r[2], r[3], tuple(r[4])) for r in got.collect()} == {(k, "x", 3, None, (1,)) for k in range(4)}


def test_no_row_gives_nulls_and_two_rows_fail(spark):
    rows = spark.range(3)
    assert {r["v"] for r in with_scalars(rows, rows.where("id > 9").select(F.col("id").alias("v"))).collect()} == {None}
    assert with_scalars(rows.where("id > 9"), rows.agg(F.sum("id").alias("v"))).collect() == []
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS|more than one row"):
        with_scalars(rows, rows.select(F.col("id").alias("v"))).collect()
