"""Mixing sources to target weights by weighted fair queueing.

Sources in code-point order (null last) take the weights in turn and share ``share`` times all words; a target stops at
``limit`` times its source's words and what is left over is shared again by weight, until no target is above. Each
source's documents are shuffled by a hash of seed and id and stand in that order ``limit`` times, one round after the
other; a copy's virtual finish time is the source's words up to its end divided by the source's target. All
copies are range-sorted by finish time and cut off where the whole budget is used up: the copy at the cut gives its
first words only, so the mix has exactly the budget's words (rounded down).

Rows are (source, size, hash) from the first step on, no text is shuffled. A source with a third of all rows spreads
over many range partitions; the number of sources has no bound either: weights and targets come from running totals
over the sources' table. What reaches the driver is single rows of totals.

Defined results: a null text has no words; a null source is a source; a null id counts as the empty text in the shuffle;
documents without words are taken 0 times; each row stands for itself, equal rows may swap their places; an empty
table gives no rows. Other columns are neither read nor returned.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.llm.common import prepare, stored
from rankforge.operators.running import running_totals

WEIGHTS, SHARE, LIMIT, SEED = (5.0, 2.0, 1.0), 1.5, 2, 42


def n_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+``: each is put as one letter, then what is left between them goes."""
    marked = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[^\x20\x09-\x0D]+", "x")
    return F.length(F.translate(marked, " \t\n\x0b\f\r", "")).cast("long")


def place(doc_id: Column, seed: int) -> Column:
    """The document's place in the shuffle: 60 bits of md5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, limit: int = LIMIT) -> tuple[DataFrame, int]:
    """(source, source_size, number, target) of a table (source, source_size), and the budget in words.

    The level at which targets stop comes from one pass in order of cap / weight: a source is capped if, with every
    source after it at the same level, the budget is not used up yet.
    """
    numbered = stored(running_totals(sizes.withColumn("one", F.lit(1)), [F.col("source").asc_nulls_last()], ["one"], keep=lambda d: stored(d, "sources")), "numbered")
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("one_to") - 1) % len(weights) + 1).cast("int"))
    capped = numbered.select("source", "source_size", F.col("one_to").alias("number"), turn.alias("weight"), (F.col("source_size") * limit).alias("cap"))
    all_ = capped.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    budget = share * (all_["words"] or 0)
    ratio = F.col("cap") / F.col("weight")
    levels = running_totals(capped.withColumn("ratio", ratio), [F.col("ratio"), F.col("number")], ["cap", "weight"], keep=lambda d: stored(d, "levels"))
    full = F.col("cap_to") + F.col("ratio") * (F.lit(all_["weight"]) - F.col("weight_to")) <= F.lit(budget)
    levels = stored(levels.withColumn("full", full), "capped")
    used = levels.agg(F.sum(F.when(F.col("full"), F.col("cap"))).alias("cap"), F.sum(F.when(~F.col("full"), F.col("weight"))).alias("weight")).first()
    level = (budget - (used["cap"] or 0)) / used["weight"] if used["weight"] else 0.0
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("weight") * F.lit(level))
    return levels.select("source", "source_size", "number", target.alias("target")), math.floor(budget)


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, limit: int = LIMIT, seed: int = SEED,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, size, source_size, target, taken) of every row: ``taken`` words of it are in the mix, repeats counted."""
    prepare(docs.sparkSession)
    rows = stored(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), n_words(F.col(text_col)).alias("size"),
        place(F.col(id_col), seed).alias("place"), F.xxhash64(F.monotonically_increasing_id()).alias("salt")), "sizes")
    targets, budget = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, limit)
    shuffled = running_totals(rows, [F.col("place"), F.col("id"), F.col("size"), F.col("salt")], ["size"], by="source", keep=lambda d: stored(d, "shuffled"))
    queued = stored(shuffled.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of", "salt", "place"), "queued")

    def finish(turn: Column) -> Column:
        return F.when(F.col("size") > 0, (F.col("size_to") + turn * F.col("source_size")) / F.col("target"))

    copies = queued.where("size > 0").select("size", "number", F.explode(F.array(*[finish(F.lit(k)) for k in range(limit)])).alias("finish"))
    sent = running_totals(copies, [F.col("finish"), F.col("number")], ["size"], keep=lambda d: stored(d, "sent"))
    cut = sent.where(F.col("size_to") >= budget).agg(F.min(F.struct("finish", "number", (F.col("size_to") - F.col("size")).alias("before"))).alias("cut")).first()["cut"]
    if cut is None:
        taken = F.col("size") * limit
    else:
        at, words = F.struct(F.lit(cut["finish"]).alias("finish"), F.lit(cut["number"]).cast("long").alias("number")), F.lit(budget - cut["before"])
        own = [F.struct(finish(F.lit(k)).alias("finish"), F.col("number").cast("long").alias("number")) for k in range(limit)]
        taken = sum((F.when(x < at, F.col("size")).when(x == at, words).otherwise(0) for x in own), F.lit(0))
    return queued.select("id", "size", "source_size", "target", F.when(F.col("size") > 0, taken).otherwise(0).cast("long").alias("taken"))
