"""Cleaning and packing of ``documents`` in five stages, each an operator of ``rankforge.llm``.

A stage takes what the one before it kept, written as Parquet in the shared folder and read again. All but the last
return the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm import bin_packing, fm_toxicity, simhash_bk, suffix_rules, winnowing
from rankforge.llm.common import fold, new_folder, own_name, table
from rankforge.llm.queries import VOCABULARY

#: Some stages have no SQL form (suffix arrays, a fitted model, XXH64 fingerprints, tokenizers).
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or repeat themselves too much go."""
    name = own_name(docs, "repetition")
    return suffix_rules.judge_repetition(docs, as_col=name).filter(F.col(name)["kept"]).drop(name)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go; the model is fitted on the labelled ones among ``docs``."""
    model = fm_toxicity.train(docs, table(spark, sf_dir, "labels"), fold(F.col("id"), 3) != 1)
    name = own_name(docs, "toxicity")
    return docs.withColumn(name, fm_toxicity.toxicity(spark, model)("text")).filter(F.col(name) < 0.7).drop(name)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return simhash_bk.keep_one(docs, shingle=3, radius=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    name = own_name(docs, "contamination")
    marked = winnowing.mark_contamination(docs, table(spark, sf_dir, "benchmark"), window=10, as_col=name)
    return marked.filter(F.size(F.col(name)["spans"]) == 0).drop(name)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens and their places in sequences."""
    packed = bin_packing.pack_documents(docs, VOCABULARY, 1, 4096)
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxicity),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            folder = new_folder(spark, f"stage{number}")
            docs.write.parquet(folder)
            docs = spark.read.parquet(folder)
    return docs
