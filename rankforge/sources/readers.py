"""Readers for the reference's on-disk formats (SRC-1..SRC-5), with explicit schemas.

Every reader is one ``spark.read`` with a declared schema (no inference)
followed by column expressions; nothing is parsed in Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.functions.lists import to_list
from rankforge.functions.scalars import FILL_POPULARITY, FILL_RUNTIME, FILL_VOTE_AVERAGE, FILL_YEAR

RATING_SCHEMA = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("item_id", T.LongType()),
                              T.StructField("rating", T.DoubleType()), T.StructField("timestamp", T.LongType())])

# The 19 genre flag columns of the raw item file, in file order.
RAW_GENRES = ("unknown", "Action", "Adventure", "Animation", "Children's", "Comedy", "Crime", "Documentary", "Drama",
              "Fantasy", "Film-Noir", "Horror", "Musical", "Mystery", "Romance", "Sci-Fi", "Thriller", "War", "Western")
RAW_DEFAULTS = {"vote_average": FILL_VOTE_AVERAGE, "popularity": FILL_POPULARITY, "runtime": FILL_RUNTIME,
                "vote_count": 50, "language": "en"}


# ---------------------------------------------------------------- SRC-1
def read_ratings(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """user_id, item_id, rating, ts (epoch seconds -> timestamp)."""
    df = spark.read.schema(RATING_SCHEMA).option("sep", sep).csv(path)
    return df.select("user_id", "item_id", "rating", F.timestamp_seconds("timestamp").alias("ts"))


# ---------------------------------------------------------------- SRC-2
def read_folds(spark: SparkSession, directory: str, sep: str = "\t") -> DataFrame:
    """All ``u<k>.base`` / ``u<k>.test`` files in one read; fold and split from the file name."""
    df = spark.read.schema(RATING_SCHEMA).option("sep", sep).csv(f"{directory}/u*.*")
    name = F.input_file_name()
    return df.select("user_id", "item_id", "rating", F.timestamp_seconds("timestamp").alias("ts"),
                     F.regexp_extract(name, r"u(\d+)\.(base|test)", 1).cast("int").alias("fold"),
                     F.regexp_extract(name, r"u(\d+)\.(base|test)", 2).alias("split"))


# ---------------------------------------------------------------- SRC-3
# The columns of the metadata file and their kinds.
ITEM_FIELDS = {
    "movie_id": "long", "title": "text", "year": "int", "language": "text", "genres": "list", "director": "text",
    "top_cast": "list", "overview": "text", "movie_keywords": "list", "vote_average": "double", "vote_count": "double",
    "popularity": "double", "runtime": "double", "budget": "double", "revenue": "double",
    "production_companies": "list", "production_countries": "list",
}


def read_items(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Item metadata CSV, fields found by the names in the header, in whatever order: id renamed,
    list fields -> arrays, numbers typed; a field that the file lacks is null (an empty list).

    Quoted text may hold line ends, so a file is one task; ``multi_line=False`` splits files
    whose records are single lines."""
    df = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"').csv(path)
    out = []
    for name, kind in ITEM_FIELDS.items():
        c = F.col(name) if name in df.columns else F.lit(None).cast("string")
        c = c if kind == "text" else to_list(c) if kind == "list" else c.try_cast(kind)
        out.append(c.alias("item_id" if name == "movie_id" else name))
    return df.select(*out)


# ---------------------------------------------------------------- SRC-4
def read_items_raw(spark: SparkSession, path: str) -> DataFrame:
    """'|'-separated latin-1 item file with 19 genre flags: genres array of set flags (not
    'unknown'), year from dd-MMM-yyyy (unparsable -> 1990), a synthetic overview
    "<title>. A <g1, g2> film from <year>." and the fixed defaults."""
    fields = [T.StructField("item_id", T.LongType()), T.StructField("title", T.StringType()),
              T.StructField("release_date", T.StringType()), T.StructField("video_date", T.StringType()),
              T.StructField("imdb_url", T.StringType())] + [T.StructField(f"g{i}", T.IntegerType())
                                                             for i in range(len(RAW_GENRES))]
    df = spark.read.schema(T.StructType(fields)).option("sep", "|").option("encoding", "ISO-8859-1").csv(path)
    flags = F.array(*[F.when(F.col(f"g{i}") == 1, F.lit(g)) for i, g in enumerate(RAW_GENRES) if g != "unknown"])
    genres = F.filter(flags, lambda x: x.isNotNull())
    year = F.coalesce(F.year(F.try_to_timestamp(F.col("release_date"), F.lit("dd-MMM-yyyy"))), F.lit(FILL_YEAR))
    out = df.select("item_id", "title", genres.alias("genres"), year.alias("year"))
    out = out.withColumn("overview", F.format_string("%s. A %s film from %d.", F.col("title"),
                                                     F.array_join("genres", ", "), F.col("year")))
    for c, v in RAW_DEFAULTS.items():
        out = out.withColumn(c, F.lit(v))
    return out


# ---------------------------------------------------------------- SRC-5
def read_users(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("age", T.IntegerType()),
                           T.StructField("gender", T.StringType()), T.StructField("occupation", T.StringType()),
                           T.StructField("zip", T.StringType())])
    return spark.read.schema(schema).option("sep", "|").csv(path)
