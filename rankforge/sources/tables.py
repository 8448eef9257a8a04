"""Driver tables mapped onto the recommender's data model.

ratings   <- lineitem JOIN orders (customer rates part; quantity 1..50 -> rating 1..5)
items     <- part (words of the name are the genre list, brand is the director)
users     <- customer
documents <- documents (keyword corpus), benchmark (query texts)
vectors   <- embeddings (64-d)

Each reader selects only the columns it needs so the Parquet scan prunes the
rest, and the only shuffle in ``interactions`` is the order-key join plus the
per-pair latest-row pick.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (customer, part) purchase as a rating row, duplicates kept."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        (F.floor((F.col("l_quantity") - 1) / 10).cast("double") + 1).alias("rating"),
        F.col("o_orderdate").alias("ts"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_no"),
    )


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, item_id, rating, ts): latest row per pair (PF-12 policy ``last``)."""
    from rankforge.operators.prep import dedup

    return dedup(raw_ratings(spark, sf_dir), policy="last",
                 order_cols=["ts", "order_key", "line_no", "rating"]).select("user_id", "item_id", "rating", "ts")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id, title, genres array, director, year, popularity, family)."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("title"),
        F.split(F.col("p_name"), " ").alias("genres"),
        F.col("p_brand").alias("director"),
        (F.lit(1950) + F.col("p_size")).alias("year"),
        F.col("p_retailprice").alias("popularity"),
        F.col("p_type").alias("family"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_nationkey").alias("nation"),
    )


def keyword_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", "text")


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query table (query_id, text): every benchmark passage, whole, is one query."""
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vector"), "label")
