"""M-14 scoring of external items with stored profiles, and J-7 title matching.

External items (e.g. a web-search result table) are featurised with the
*training* statistics (numeric mean/std stored with the model), scored as
alpha_s * struct_profile . struct_vec + alpha_e * embed_profile . embed_vec.
An external title that matches a catalogue title (lower + trim, first match
by item id) takes the catalogue item's full score instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankforge.functions.vectors import EPS, dot
from rankforge.operators.common import with_scalars


def title_match(external: DataFrame, catalogue: DataFrame, title: str = "title") -> DataFrame:
    """external rows + item_id of the first catalogue item whose normalised title is equal."""
    norm = lambda c: F.lower(F.trim(F.col(c)))
    cat = catalogue.select(norm("title").alias("_nt"), "item_id")
    w = Window.partitionBy("_nt").orderBy("item_id")
    first = cat.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
    return external.withColumn("_nt", norm(title)).join(first, "_nt", "left").drop("_nt")


def fit_statistics(train: DataFrame, cols: list[str]) -> DataFrame:
    """One row: mean and population std of log1p of each numeric column (null as 0), stored with the model."""
    logs = [F.log1p(F.coalesce(F.col(c).cast("double"), F.lit(0.0))).alias(c) for c in cols]
    return train.select(*logs).agg(*[F.avg(c).alias(f"_mean_{c}") for c in cols], *[F.stddev_pop(c).alias(f"_std_{c}") for c in cols])


def featurise(rows: DataFrame, statistics: DataFrame, cols: list[str], key: str) -> DataFrame:
    """(key, vector): numeric features scaled with the *training* statistics, whatever rows are given."""
    j = with_scalars(rows.select(key, *[F.log1p(F.coalesce(F.col(c).cast("double"), F.lit(0.0))).alias(c) for c in cols]), statistics)
    return j.select(key, F.array(*[(F.col(c) - F.col(f"_mean_{c}")) / (F.col(f"_std_{c}") + F.lit(EPS)) for c in cols]).alias("vector"))


def score_external(external: DataFrame, users: DataFrame, alpha_struct: float, alpha_embed: float,
                   struct_profiles: DataFrame, embed_profiles: DataFrame | None = None,
                   catalogue_scores: DataFrame | None = None, catalogue: DataFrame | None = None) -> DataFrame:
    """(user_id, ext_id, score, matched): each external row belongs to the request of one
    ``user_id`` and carries ``struct_vec`` (and ``embed_vec``) built with training
    statistics; score = raw sum of arm dot products (no normalisation, as the reference
    code). Title matches use ``catalogue_scores``."""
    j = users.select("user_id").join(struct_profiles.select("user_id", F.col("vector").alias("_ps")), "user_id")
    if embed_profiles is not None:
        j = j.join(embed_profiles.select("user_id", F.col("vector").alias("_pe")), "user_id", "left")
    pairs = external.join(j, "user_id")
    s = F.lit(float(alpha_struct)) * dot("_ps", "struct_vec")
    if embed_profiles is not None:
        s = s + F.lit(float(alpha_embed)) * F.coalesce(dot("_pe", "embed_vec"), F.lit(0.0))
    out = pairs.select("user_id", "ext_id", "title", s.alias("score"))
    if catalogue_scores is not None and catalogue is not None:
        m = title_match(out, catalogue.select("item_id", "title"), "title")
        m = m.join(catalogue_scores.select("user_id", "item_id", F.col("score").alias("_cs")), ["user_id", "item_id"], "left")
        return m.select("user_id", "ext_id", F.coalesce("_cs", "score").alias("score"),
                        F.col("item_id").isNotNull().alias("matched"))
    return out.select("user_id", "ext_id", "score", F.lit(False).alias("matched"))
