"""Document building (SRC-9) and the embedding cache plan (SRC-10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TEMPLATE_CAST = 3               # fixed value: cast members in the document text
TEMPLATE_KEYWORDS = 10          # fixed value: keywords in the document text
META_OVERVIEW_CHARS = 300       # fixed value: overview cut in the metadata


def build_documents(items: DataFrame) -> DataFrame:
    """(item_id, text, metadata columns). Text template:
    "<title> (<year>). Overview: <overview>. Keywords: <k1, .. k10>. Genres: <g, ..>.
    Director: <d>. Cast: <c1, c2, c3>. Rating: <vote_average>/10. Runtime: <runtime> min."
    Missing year -> 'unknown'; runtime missing or <= 0 -> 'unknown'; missing rating -> 0.0;
    missing lists -> empty."""
    lst = lambda c, n=None: F.array_join(F.slice(F.coalesce(F.col(c), F.array()), 1, n) if n else
                                         F.coalesce(F.col(c), F.array()), ", ")
    year = F.coalesce(F.col("year").cast("int").cast("string"), F.lit("unknown"))
    runtime = F.when(F.col("runtime") > 0, F.col("runtime").cast("int").cast("string")).otherwise(F.lit("unknown"))
    rating = F.coalesce(F.col("vote_average").cast("double"), F.lit(0.0)).cast("string")
    text = F.concat(F.col("title"), F.lit(" ("), year, F.lit("). Overview: "), F.coalesce("overview", F.lit("")),
                    F.lit(". Keywords: "), lst("movie_keywords", TEMPLATE_KEYWORDS), F.lit(". Genres: "), lst("genres"),
                    F.lit(". Director: "), F.coalesce("director", F.lit("")), F.lit(". Cast: "),
                    lst("top_cast", TEMPLATE_CAST), F.lit(". Rating: "), rating, F.lit("/10. Runtime: "), runtime,
                    F.lit(" min."))
    return items.select(F.col("item_id"), text.alias("text"), F.col("title"),
                        F.coalesce(F.col("year").cast("int"), F.lit(0)).alias("meta_year"),
                        F.substring(F.coalesce("overview", F.lit("")), 1, META_OVERVIEW_CHARS).alias("meta_overview"))


def embedding_cache_plan(docs: DataFrame, cache: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, reason): documents needing a (re)embedding: no cached vector ('missing') or a
    cached vector built from a different text ('stale', xxhash64 of the text differs).
    ``cache``: (id, text_hash). Reuses everything else (the reference redoes all)."""
    d = docs.select(F.col(id_col).alias("_id"), F.xxhash64("text").alias("_h"))
    c = cache.select(F.col(id_col).alias("_id"), F.col("text_hash").alias("_ch"))
    j = d.join(c, "_id", "left")
    reason = F.when(F.col("_ch").isNull(), "missing").when(F.col("_ch") != F.col("_h"), "stale")
    return j.select(F.col("_id").alias(id_col), reason.alias("reason")).where(F.col("reason").isNotNull())
