"""The registered queries of this subpackage: thin derivations from its operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm import attention_lm, bin_packing, collocations, fair_mixing, fm_toxicity, importance, rff_quality, simhash_bk, suffix_rules, token_blocks, url_rules, winnowing, zip_warc
from rankforge.llm.common import fold, table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

#: Host and path rules, and patterns for what they leave open.
URL_RULES = [url_rules.parse_rule(x) for x in ("allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/")]
URL_PATTERNS = [
    url_rules.Pattern(r"\bad[-_.]track", ("ad",)),
    url_rules.Pattern(r"\bads[-_.]track", ("ads",)),
    url_rules.Pattern(r"\bspam[-_.]farm\b", ("spam", "farm")),
    url_rules.Pattern(r"\bcasino([-_.](win|bet|slots))?\b", ("casino",)),
    url_rules.Pattern(r"\bcheap[-_.]pill\b", ("cheap", "pill")),
    url_rules.Pattern(r"\bcheap[-_.]pills\b", ("cheap", "pills")),
    url_rules.Pattern(r"\badult[-_.][a-z0-9]+", ("adult",)),
    url_rules.Pattern(r"[?&]utm_source=spam\b", ("utm", "source", "spam")),
]


def op1_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_blocks.encode_and_read(table(spark, sf_dir, "documents"), VOCABULARY, 2)


def op2_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = bin_packing.pack_documents(table(spark, sf_dir, "documents"), VOCABULARY, 1, 4096)
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op3_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.score_texts(table(spark, sf_dir, "documents"), VOCABULARY, 49407, fold(F.col("doc_id"), 7) == 2)


def op4_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zip_warc.archive_and_read(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_fourier_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = rff_quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fold(F.col("id"), 5) != 0)
    return scored.select(F.col("id").alias("doc_id"), (fold(F.col("id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_suffix_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_rules.judge_repetition(docs, as_col="r").select("doc_id", "r.*")


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), URL_RULES, URL_PATTERNS)


def op8_simhash_bk_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_bk.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select("doc_id", simhash_bk.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = winnowing.mark_contamination(docs, table(spark, sf_dir, "benchmark"), window=10, as_col="c")
    hit = winnowing.n_hit(F.col("c"))
    return found.select(
        "doc_id", F.col("c.n_words").alias("n_words"), hit.alias("n_hit"), F.size("c.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("c.items", ",").cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def op10_factorization_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fm_toxicity.train(docs, table(spark, sf_dir, "labels"), fold(F.col("id"), 3) != 1)
    scored = docs.select("doc_id", fm_toxicity.toxicity(spark, model)("text").alias("score"))
    return scored.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.withColumnRenamed("id", "doc_id")


def op12_fair_queueing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fair_mixing.mix_sources(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op13_suffix_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine_phrases(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_token_blocks, op2_bin_completion, op3_attention_lm, op4_zip_warc, op5_fourier_quality, op6_suffix_repetition, op7_url_rules, op8_simhash_bk_trees,
        op9_winnowing, op10_factorization_toxicity, op11_importance_resampling, op12_fair_queueing, op13_suffix_collocations, pipeline)}
