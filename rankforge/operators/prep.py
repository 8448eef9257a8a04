"""Interaction preparation: filters, weights, dedup, folds, and the simple aggregates.

Rows are long ``(user_id, item_id, rating, ts)``; nothing here densifies.
Scalars such as the global maximum timestamp are computed by a one-row
aggregate and cross-joined as a broadcast literal table (size 1, proven).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.operators.common import with_scalars
from rankforge.operators.ranking import global_row_number, weighted_quantile
from rankforge.session import cut_lineage

# Fixed values shared with the reference's scoring rules.
LIKED_THRESHOLD = 4.0          # relevant / liked: rating >= 4
HATED_BELOW = 3.0              # hated: 0 < rating < 3
BINARIZE_AT = 3.5              # alternative binarisation cut
SECONDS_PER_DAY = 86400.0


# ---------------------------------------------------------------- PF-1
def positives(r: DataFrame, threshold: float = LIKED_THRESHOLD, col: str = "rating") -> DataFrame:
    return r.where(F.col(col) >= F.lit(threshold))


def binarize(r: DataFrame, cut: float = BINARIZE_AT, col: str = "rating", out: str = "weight") -> DataFrame:
    return r.withColumn(out, F.when(F.col(col) > F.lit(cut), F.lit(1.0)).otherwise(F.lit(0.0)))


# ---------------------------------------------------------------- PF-2
def confidence_weight(r: DataFrame, alpha: float, col: str = "rating", out: str = "weight") -> DataFrame:
    """1 when alpha == 0, else 1 + alpha * rating (applied to the positive rows given)."""
    w = F.lit(1.0) if alpha == 0 else F.lit(1.0) + F.lit(float(alpha)) * F.col(col)
    return r.withColumn(out, w)


# ---------------------------------------------------------------- PF-3 / J-11
def scalar_max(df: DataFrame, col: str, alias: str) -> DataFrame:
    return df.agg(F.max(col).alias(alias))


def time_decay(r: DataFrame, half_life_days: float, reference: DataFrame | None = None,
               ts: str = "ts", col: str = "rating", out: str = "weight") -> DataFrame:
    """rating * 0.5 ** ((max_ts - ts) / 86400 / H); max over ``reference`` (default: all rows of r).

    The reference maximum is taken over all ratings (train and test), so pass
    the full table as ``reference`` when ``r`` is a fold.
    """
    ref = r if reference is None else reference
    mx = scalar_max(ref.select(F.unix_timestamp(F.col(ts)).alias("_t")), "_t", "_max_ts")
    age_days = (F.col("_max_ts") - F.unix_timestamp(F.col(ts))) / F.lit(SECONDS_PER_DAY)
    return (with_scalars(r, mx)
             .withColumn(out, F.col(col) * F.pow(F.lit(0.5), age_days / F.lit(float(half_life_days))))
             .drop("_max_ts"))


# ---------------------------------------------------------------- PF-4
def penalize_negatives(r: DataFrame, penalty: float, col: str = "rating", out: str = "weight") -> DataFrame:
    """r < 3 -> -penalty * r; others keep r."""
    return r.withColumn(out, F.when(F.col(col) < F.lit(HATED_BELOW), -F.lit(float(penalty)) * F.col(col))
                        .otherwise(F.col(col)))


# ---------------------------------------------------------------- PF-5
def sentiment(col: str = "rating") -> Column:
    c = F.col(col)
    return (F.when(c >= F.lit(LIKED_THRESHOLD), F.lit("liked"))
             .when((c > 0) & (c < F.lit(HATED_BELOW)), F.lit("hated"))
             .otherwise(F.lit("neutral")))


def sentiment_split(r: DataFrame, col: str = "rating") -> DataFrame:
    return r.withColumn("sentiment", sentiment(col))


# ---------------------------------------------------------------- PF-6 / J-4
def mask_seen(scores: DataFrame, seen: DataFrame, keys: tuple[str, ...] = ("user_id", "item_id")) -> DataFrame:
    return scores.join(seen.select(*keys), list(keys), "left_anti")


# ---------------------------------------------------------------- PF-12
def dedup(r: DataFrame, policy: str = "last", keys: tuple[str, ...] = ("user_id", "item_id"),
          order_cols: list[str] | None = None, col: str = "rating") -> DataFrame:
    """One row per pair. last/first by ``order_cols`` (default ts); max/mean of ``col``.

    ``last``/``first`` use row_number()==1 so Catalyst inserts a partial
    window-group limit before the shuffle; ``max``/``mean`` are hash aggregates
    with map-side partial aggregation.
    """
    order_cols = order_cols or ["ts"]
    keys = list(keys)
    if policy in ("last", "first"):
        desc = policy == "last"
        order = [F.col(c).desc() if desc else F.col(c).asc() for c in order_cols]
        w = Window.partitionBy(*keys).orderBy(*order)
        return r.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    if policy == "max":
        others = [c for c in r.columns if c not in keys + [col]]
        return r.groupBy(*keys).agg(F.max(col).alias(col), *[F.max(c).alias(c) for c in others])
    if policy == "mean":
        others = [c for c in r.columns if c not in keys + [col]]
        return r.groupBy(*keys).agg(F.avg(col).alias(col), *[F.max(c).alias(c) for c in others])
    raise ValueError(f"unknown dedup policy {policy!r}")


def duplicate_report(r: DataFrame, keys: tuple[str, ...] = ("user_id", "item_id")) -> DataFrame:
    """(n_pairs, pairs_single, pairs_multi, duplicate_rows)."""
    per = r.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).cast("bigint").alias("pairs_single"),
        F.sum(F.when(F.col("n") > 1, 1).otherwise(0)).cast("bigint").alias("pairs_multi"),
        F.sum(F.col("n") - 1).cast("bigint").alias("duplicate_rows"),
    )


# ---------------------------------------------------------------- W-7
def stratified_folds(r: DataFrame, k: int = 5, seed: int = 42, user: str = "user_id",
                     item: str = "item_id", order: str = "hash") -> DataFrame:
    """Add ``fold`` in [0, k): each user's rows shuffled by a seeded hash, dealt round robin.

    Per user the fold sizes differ by at most one; the start fold is offset by a
    user hash so small users do not all land in fold 0. The window is
    partitioned by user (one sort per user, no global order).
    ``order="item"`` deals rows in item order with offset user_id (no hashing;
    the rule the SQL oracles reproduce).
    """
    if order == "item":
        w = Window.partitionBy(user).orderBy(F.col(item))
        offset = F.col(user)
    else:
        w = Window.partitionBy(user).orderBy(F.xxhash64(F.lit(seed), F.col(user), F.col(item)), F.col(item))
        offset = F.pmod(F.xxhash64(F.lit(seed + 1), F.col(user)), F.lit(k))
    return r.withColumn("fold", F.pmod(F.row_number().over(w) - 1 + offset, F.lit(k)).cast("int"))


def training_rows(folded: DataFrame, k: int = 5, fold: str = "fold") -> DataFrame:
    """All folds' training rows in one table: each row once for every fold but its own, that fold as ``fold``."""
    return (folded.withColumn("_own", F.col(fold)).withColumn(fold, F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
            .where(F.col(fold) != F.col("_own")).drop("_own"))


def fold_split(r_with_fold: DataFrame, fold: int) -> tuple[DataFrame, DataFrame]:
    train = r_with_fold.where(F.col("fold") != fold)
    test = r_with_fold.where(F.col("fold") == fold)
    return train, test


# ---------------------------------------------------------------- AG-1
def item_counts(r: DataFrame, users: DataFrame | None = None, item: str = "item_id",
                user: str = "user_id", by: list[str] | None = None) -> DataFrame:
    """(item_id, n, log_pop = log1p(n), pop_ratio = n / n_users), for each ``by``, columns of ``r``, on its own."""
    if by:
        counted = r.groupBy(*by, item).agg(F.count(F.lit(1)).alias("n"))
        return (counted.join(r.groupBy(*by).agg(F.countDistinct(user).alias("_n_users")), by)
                .select(*by, item, "n", F.log1p("n").alias("log_pop"), (F.col("n") / F.col("_n_users")).alias("pop_ratio")))
    n_users_df = (users if users is not None else r.select(user)).agg(
        F.countDistinct(user).alias("_n_users"))
    return (r.groupBy(item).agg(F.count(F.lit(1)).alias("n"))
             .transform(lambda t: with_scalars(t, n_users_df))
             .select(item, "n", F.log1p("n").alias("log_pop"),
                     (F.col("n") / F.col("_n_users")).alias("pop_ratio")))


# ---------------------------------------------------------------- AG-2
def item_mean_rating(r: DataFrame, item: str = "item_id", col: str = "rating") -> DataFrame:
    return r.groupBy(item).agg(F.avg(col).alias("mean_rating"))


# ---------------------------------------------------------------- AG-4
def vote_bayes(items_df: DataFrame, avg_col: str, count_col: str, q: float = 0.90) -> DataFrame:
    """v/(v+m)*R + m/(v+m)*C with m = q-quantile of vote counts and C = mean of R."""
    items_df = cut_lineage(items_df)
    m = weighted_quantile(items_df.withColumn("_w1", F.lit(1.0)), q, count_col, "_w1")
    stats = items_df.agg(F.lit(m).alias("_m"), F.avg(avg_col).alias("_c"))
    v, m, R, C = F.col(count_col), F.col("_m"), F.col(avg_col), F.col("_c")
    return (with_scalars(items_df, stats)
            .withColumn("bayes_rating", v / (v + m) * R + m / (v + m) * C)
            .drop("_m", "_c"))


# ---------------------------------------------------------------- AG-5
GLOBAL_MEAN_RATING = 3.53      # fixed value
BAYES_C = 50.0                 # fixed value


def rating_bayes(r: DataFrame, c: float = BAYES_C, mu: float = GLOBAL_MEAN_RATING,
                 threshold: float = LIKED_THRESHOLD) -> DataFrame:
    """(item_id, bayes_avg): (C*mu + n*avg) / (C + n), n = positive count, avg over all ratings."""
    agg = r.groupBy("item_id").agg(
        F.sum(F.when(F.col("rating") >= threshold, 1).otherwise(0)).alias("n_pos"),
        F.avg("rating").alias("avg_rating"))
    return agg.select("item_id", ((F.lit(c) * F.lit(mu) + F.col("n_pos") * F.col("avg_rating"))
                                  / (F.lit(c) + F.col("n_pos"))).alias("bayes_avg"))


# ---------------------------------------------------------------- AG-13
def negative_sampling_dist(r: DataFrame, alpha: float = 0.75, top_share: float = 0.05,
                           threshold: float = LIKED_THRESHOLD) -> DataFrame:
    """Per item p = f^alpha / sum f^alpha over positive counts, plus ``in_top``: item among
    the top ``top_share`` fraction of items by p (ties by item id)."""
    f = positives(r, threshold).groupBy("item_id").agg(F.count(F.lit(1)).alias("freq"))
    f = f.withColumn("fa", F.pow(F.col("freq").cast("double"), F.lit(float(alpha))))
    f = cut_lineage(f)
    tot = f.agg(F.sum("fa").alias("_tot"), F.count(F.lit(1)).alias("_n"))
    ranked = global_row_number(f, [F.col("fa").desc(), F.col("item_id").asc()], out="_rk")
    return (with_scalars(ranked, tot)
            .withColumn("p", F.col("fa") / F.col("_tot"))
            .withColumn("in_top", F.col("_rk") <= F.floor(F.col("_n") * F.lit(top_share)))
            .select("item_id", "freq", "p", "in_top"))


# ---------------------------------------------------------------- AG-15
def item_temperature(train: DataFrame, catalogue: DataFrame, threshold: int = 5,
                     threshold_rating: float = LIKED_THRESHOLD) -> DataFrame:
    """(item_id, n_pos, temperature): warm n >= threshold, cold 0 < n < threshold, unseen n == 0."""
    cnt = positives(train, threshold_rating).groupBy("item_id").agg(F.count(F.lit(1)).alias("n_pos"))
    t = catalogue.select("item_id").join(cnt, "item_id", "left").fillna(0, ["n_pos"])
    return t.withColumn("temperature",
                        F.when(F.col("n_pos") >= threshold, "warm")
                         .when(F.col("n_pos") > 0, "cold").otherwise("unseen"))


# ---------------------------------------------------------------- AG-10
def user_top_genres(r, items, k: int = 3, threshold: float = 4.0):
    """AG-10: (user_id, genre, n, rank) top-k genres of each user's liked items."""
    liked = r.where(F.col("rating") >= threshold).select("user_id", "item_id")
    g = liked.join(items.select("item_id", F.explode("genres").alias("genre")), "item_id")
    c = g.groupBy("user_id", "genre").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("user_id").orderBy(F.col("n").desc(), F.col("genre").asc())
    return c.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
