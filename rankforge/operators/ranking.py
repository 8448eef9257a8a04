"""Ranking windows, top-k cuts and set operations.

Ties are always broken by ``score desc, item asc`` (never by an unstable
sort). ``top_k`` is ``row_number() <= k`` over a partitioned window, which
Catalyst turns into a WindowGroupLimit that also runs partially before the
shuffle, so only k rows per group and map task cross the network.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.operators.common import with_scalars
from rankforge.operators.running import running_totals
from rankforge.session import cut_lineage, stored


def _order(score: str, item: str) -> list[Column]:
    return [F.col(score).desc_nulls_last(), F.col(item).asc()]


# ---------------------------------------------------------------- W-1 / TK-4
def top_k(df: DataFrame, k: int, group: str | list[str] = "user_id", score: str = "score",
          item: str = "item_id", rank_col: str = "rank") -> DataFrame:
    groups = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*groups).orderBy(*_order(score, item))
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


# ---------------------------------------------------------------- W-2
def full_rank(df: DataFrame, group: str | list[str] = "user_id", score: str = "score",
              item: str = "item_id", rank_col: str = "rank") -> DataFrame:
    groups = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*groups).orderBy(*_order(score, item))
    return df.withColumn(rank_col, F.row_number().over(w))


# ---------------------------------------------------------------- W-9
def rank_of(ranked: DataFrame, pairs: DataFrame, group: str = "user_id", item: str = "item_id",
            rank_col: str = "rank") -> DataFrame:
    """Rank (and the ranked row's other columns) of each requested (user, item); rank -1 when absent."""
    r = ranked
    return (pairs.select(group, item).join(r, [group, item], "left")
            .withColumn(rank_col, F.coalesce(F.col(rank_col), F.lit(-1))))


# ---------------------------------------------------------------- distributed global rank
def global_row_number(df: DataFrame, order: list[Column], out: str = "rank",
                      n_parts: int | None = None, by: list[str] | None = None) -> DataFrame:
    """1-based position in a total order, or in one for each ``by``, without funnelling rows through one task.

    Range-partition by the order, checkpoint so partition ids are stable, number
    rows inside each partition, then add the row counts of all earlier
    partitions (a table with one row per partition).
    """
    if by:
        one = running_totals(df.withColumn("_one", F.lit(1).cast("long")), order, ["_one"], by)
        return one.withColumnRenamed("_one_to", out).drop("_one")
    spark = df.sparkSession
    n = n_parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    parted = cut_lineage(df.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id()))
    local = parted.withColumn("_local", F.row_number().over(Window.partitionBy("_pid").orderBy(*order)))
    counts = parted.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    # One row per partition: the cumulative sum is a tiny unpartitioned window.
    offsets = counts.withColumn(
        "_off", F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
    offsets = offsets.select("_pid", F.coalesce("_off", F.lit(0)).alias("_off"))
    return (local.join(F.broadcast(offsets), "_pid")
            .withColumn(out, F.col("_local") + F.col("_off"))
            .drop("_pid", "_local", "_off"))


# ---------------------------------------------------------------- TK-1 / M-13
def popular_list(items: DataFrame, n: int, score: Column | None = None, item: str = "item_id") -> DataFrame:
    """Cold-start list: vote_average * log1p(vote_count), best n (TakeOrdered: partial top-n per task)."""
    s = score if score is not None else F.col("vote_average") * F.log1p(F.col("vote_count"))
    return (items.withColumn("score", s)
            .orderBy(F.col("score").desc(), F.col(item).asc()).limit(n)
            .withColumn("rank", F.row_number().over(Window.orderBy(F.col("score").desc(), F.col(item)))))


# ---------------------------------------------------------------- TK-2
def over_fetch(n: int, mode: str) -> int:
    """Candidate budget before a costly stage: 2n before rerank, max(3n, 30) before a filter."""
    if mode == "rerank":
        return 2 * n
    if mode == "filter":
        return max(3 * n, 30)
    raise ValueError(mode)


# ---------------------------------------------------------------- TK-3
def cap_users(df: DataFrame, max_users: int, user: str = "user_id") -> DataFrame:
    """Deterministic cap on evaluated users: the first ``max_users`` user ids."""
    keep = df.select(user).distinct().orderBy(user).limit(max_users)
    return df.join(keep, user, "left_semi")


# ---------------------------------------------------------------- SO-1
def union_max(frames: list[DataFrame], keys: list[str], score: str = "score") -> DataFrame:
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f)
    return u.groupBy(*keys).agg(F.max(score).alias(score))


# ---------------------------------------------------------------- SO-2
def difference(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.join(b.select(*keys), keys, "left_anti")


# ---------------------------------------------------------------- SO-3
def intersection(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.select(*keys).intersect(b.select(*keys))


# ---------------------------------------------------------------- W-11
def engine_ranks(df: DataFrame, group: str = "query_id", engine: str = "engine", score: str = "score",
                 item: str = "item_id") -> DataFrame:
    """Distinct rank per (query, engine), 1-based, the input of rank fusion."""
    d = df.groupBy(group, engine, item).agg(F.max(score).alias(score))
    return full_rank(d, [group, engine], score, item)


# ---------------------------------------------------------------- dense item prior top-k
def top_k_prior(prior: DataFrame, users: DataFrame, exclude: DataFrame, k: int, score: str = "score",
                item: str = "item_id", user: str = "user_id", by: list[str] | None = None) -> DataFrame:
    """Exact top-k per user when every unseen item scores ``prior[item]`` (a popularity list). With ``by``, columns of
    ``prior`` and ``users`` (a fold, a trial), the lists of all its values come from one ranking; an
    ``exclude`` without some of these columns holds for all their values.

    Items get one distributed global position by (score desc, item asc). The list of a user with e excluded items ends
    before position k + e, so only the positions up to k and the largest e are kept (of a large catalogue a few, which a
    join can then broadcast), and only excluded items among these are looked at. Between two of a user's excluded
    positions all are free, and a free position's rank is the position less the excluded ones before it, so users are
    expanded to their k positions alone.
    """
    by = list(by or [])
    order = global_row_number(prior.select(*by, item, score), [F.col(score).desc(), F.col(item).asc()], out="_pos", by=by)
    own = [c for c in by if c in exclude.columns]
    out_of = exclude.select(*own, user, item)
    repeated = order.groupBy(*by, item).count().where(F.col("count") > 1).limit(1).count() > 0
    # Where items come once in the prior, any bound of e will do.
    n_ex = (out_of.distinct() if repeated else out_of).groupBy(*own, user).agg(F.count(F.lit(1)).alias("_e"))
    most = n_ex.agg(F.max("_e").alias("_most"))
    order = stored(with_scalars(order, most).where(F.col("_pos") <= F.coalesce("_most", F.lit(0)) + F.lit(int(k))).drop("_most"))
    known = out_of.dropna(subset=[*own, user])
    taken = known.join(order.select(*by, item, "_pos"), [*own, item]).select(*by, user, "_pos")
    ends = users.select(*by, user).distinct().select(*by, user, F.lit(None).cast("long").alias("_pos"))
    w = Window.partitionBy(*by, user).orderBy(F.col("_pos").asc_nulls_last())
    rows = taken.join(users.select(*by, user).distinct(), [*by, user], "left_semi").unionByName(ends)
    gaps = rows.select(*by, user, "_pos", F.coalesce(F.lag("_pos").over(w), F.lit(0)).alias("_last"), (F.dense_rank().over(w) - 1).cast("long").alias("_before"))
    last_free = F.least(F.col("_pos") - 1, F.col("_before") + F.lit(int(k)))
    free = (gaps.where(last_free > F.col("_last")).select(*by, user, "_before", F.explode(F.sequence(F.col("_last") + 1, last_free)).alias("_pos"))
            .select(*by, user, "_pos", (F.col("_pos") - F.col("_before")).cast("int").alias("rank")))
    if repeated:  # an item that comes twice takes two positions of a list that counts it once
        free = free.join(n_ex, [*own, user], "left").where(F.col("_pos") <= F.coalesce("_e", F.lit(0)) + F.lit(int(k))).drop("_e")
    return free.join(order, [*by, "_pos"]).select(*by, user, item, score, "rank")


# ---------------------------------------------------------------- exact weighted quantile (AG-6)
def weighted_quantile(df: DataFrame, q: float, value: str = "v", weight: str = "w", buckets: int = 1024) -> float:
    """One quantile of ``weighted_quantiles``."""
    return weighted_quantiles(df, [q], value, weight, buckets)[0]


def weighted_quantiles(df: DataFrame, qs: list[float], value: str = "v", weight: str = "w",
                       buckets: int = 1024) -> list[float]:
    """Exact quantiles with linear interpolation (the ``numpy.percentile`` rule) of a value
    column where each row stands for ``weight`` copies; NaN for each when there is no row.

    Distributed selection: a pass aggregates the brackets that hold the wanted positions
    (both neighbours of every quantile, all at once) into at most ``buckets`` equal-width
    buckets each, and each position goes on in its bucket until that holds a single value.
    Only bucket rows reach the driver, and no pass funnels the values through one task."""
    d = df.select(F.col(value).cast("double").alias("_v"), F.col(weight).cast("double").alias("_w")) \
        .where(F.col("_v").isNotNull() & ~F.isnan("_v") & (F.col("_w") > 0))
    tot = d.agg(F.sum("_w").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi")).first()
    if tot is None or tot["n"] is None:
        return [float("nan")] * len(qs)
    at = [q * (tot["n"] - 1) for q in qs]
    wanted = sorted({int(np.floor(p)) for p in at} | {int(np.ceil(p)) for p in at})
    # position -> (lowest value, highest value, weight below) of the bracket that holds it
    bracket = {k: (tot["lo"], tot["hi"], 0.0) for k in wanted}
    while open_ := sorted({b for b in bracket.values() if b[0] != b[1]}):
        which, bucket = F.lit(None).cast("int"), F.lit(None).cast("int")
        for i, (lo, hi, _) in enumerate(open_):
            inside = (F.col("_v") >= lo) & (F.col("_v") <= hi)
            # Dividing first keeps the steps finite and apart for any two doubles.
            place = F.floor((F.col("_v") / F.lit(buckets) - F.lit(lo / buckets)) / F.lit(hi / buckets - lo / buckets) * F.lit(buckets))
            which = F.when(inside, F.lit(i)).otherwise(which)
            bucket = F.when(inside, F.greatest(F.lit(0), F.least(place, F.lit(buckets - 1)))).otherwise(bucket)
        hist = (d.select(which.alias("_i"), bucket.cast("int").alias("_b"), "_v", "_w").where("_i IS NOT NULL")
                .groupBy("_i", "_b").agg(F.sum("_w").alias("_w"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")).collect())
        for k, b in bracket.items():
            if b[0] == b[1]:
                continue
            below, own = b[2], open_.index(b)
            rows = sorted((r for r in hist if r["_i"] == own), key=lambda r: r["_b"])
            for r in rows:
                if below + r["_w"] > k or r is rows[-1]:
                    bracket[k] = (r["_lo"], r["_hi"], below)
                    break
                below += r["_w"]
    out = []
    for p in at:
        v0, v1 = bracket[int(np.floor(p))][0], bracket[int(np.ceil(p))][0]
        out.append(float(v0 + (p - np.floor(p)) * (v1 - v0)))
    return out
