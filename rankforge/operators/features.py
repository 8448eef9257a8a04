"""Item features (FE-*): long sparse tables ``(item_id, feature, value)`` and dense
``array<double>`` vectors for the small fixed-width blocks.

Vocabulary statistics are aggregates (explode + groupBy); vocabulary order is
assigned by a distributed global row number, never by a driver-side sort.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.functions.scalars import era_bucket
from rankforge.functions.text import char_ngrams, one_a_row, tokenize_tfidf
from rankforge.functions.vectors import norm, once
from rankforge.operators.common import with_scalars
from rankforge.operators.ranking import global_row_number, weighted_quantiles
from rankforge.session import stored

EPS = 1e-8
GRAM_SVD_MAX_FEATURES = 4096    # feature Gram (c x c) small enough for an exact driver-side eigen
NUMERIC_BINS = 5               # fixed value: percentile bins per numeric column
TOP_LANGUAGES = 10             # fixed value


# ---------------------------------------------------------------- vocabulary helpers
def vocabulary(long_df: DataFrame, feature: str = "feature") -> DataFrame:
    """(feature, idx) 0-based in sorted feature order."""
    v = long_df.select(feature).distinct()
    return global_row_number(v, [F.col(feature).asc()], out="idx").withColumn("idx", F.col("idx") - 1)


def to_dense(long_df: DataFrame, vocab: DataFrame, item: str = "item_id", feature: str = "feature",
             value: str = "value", items: DataFrame | None = None, out: str = "vector") -> DataFrame:
    """Long (item, feature, value) -> (item, array<double>) of vocabulary width.

    Only for small vocabularies (a few hundred columns); the width is the
    vocabulary size, checked by the caller."""
    n = vocab.agg(F.count(F.lit(1)).alias("_w"))
    j = long_df.join(vocab, feature).select(item, "idx", value)
    per = j.groupBy(item).agg(F.map_from_entries(F.collect_list(F.struct("idx", value))).alias("_m"))
    if items is not None:
        per = items.select(item).distinct().join(per, item, "left")
    per = with_scalars(per, n)
    return per.select(item, F.transform(F.sequence(F.lit(0), F.col("_w") - 1),
                                        lambda i: F.coalesce(F.try_element_at(F.col("_m"), i), F.lit(0.0)).cast("double")
                                        ).alias(out))


# ---------------------------------------------------------------- FE-1
def multi_hot(items: DataFrame, list_col: str, prefix: str | None = None, item: str = "item_id") -> DataFrame:
    """(item, feature, 1.0) per distinct list value."""
    f = F.col("_v") if prefix is None else F.concat(F.lit(prefix + ":"), F.col("_v"))
    return (items.select(item, F.explode_outer(list_col).alias("_v")).where(F.col("_v").isNotNull())
            .select(item, f.alias("feature")).distinct().withColumn("value", F.lit(1.0)))


# ---------------------------------------------------------------- FE-2 / FE-3
def term_counts(docs: DataFrame, tokens: Column, item: str = "item_id") -> DataFrame:
    return (one_a_row(tokens, "term", docs, item)
            .groupBy(item, "term").agg(F.count(F.lit(1)).cast("double").alias("tf")))


def select_vocabulary(tf: DataFrame, n_docs: DataFrame, max_features: int | None = None,
                      min_df: float = 1, max_df: float = 1.0) -> DataFrame:
    """(term, df, total): df within [min_df, max_df] (ints are counts, floats proportions),
    then the ``max_features`` terms with the highest total count (ties by term)."""
    st = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))
    st = with_scalars(st, n_docs)
    lo = F.lit(min_df) if isinstance(min_df, int) else F.ceil(F.lit(min_df) * F.col("_n"))
    hi = F.lit(max_df) if isinstance(max_df, int) else F.floor(F.lit(max_df) * F.col("_n"))
    st = st.where((F.col("df") >= lo) & (F.col("df") <= hi))
    if max_features:
        # Top-n of the (small) term statistics table: TakeOrdered keeps n rows per task.
        st = st.orderBy(F.col("total").desc(), F.col("term").asc()).limit(int(max_features))
    return st.select("term", "df", "_n")


def tfidf(docs: DataFrame, text_col: str, item: str = "item_id", max_features: int | None = None,
          min_df: float = 1, max_df: float = 1.0, analyzer: str = "word", ngram: tuple[int, int] = (2, 3),
          stop_words: list[str] | None = None, strip_accents: bool = False) -> DataFrame:
    """Long TF-IDF ``(item_id, term, value)``: raw counts x (ln((1+n)/(1+df)) + 1), rows L2-normalised.

    n counts every document (also empty ones), as the vectoriser does."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    if analyzer == "char":
        # n-grams are many times their text: a file of short texts, read by one task, is spread before they are made.
        docs = docs.select(item, text.alias("_text")).repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), item, "_text")
        text = F.col("_text")
    toks = char_ngrams(text, *ngram) if analyzer == "char" else tokenize_tfidf(text, stop_words, strip_accents)
    tf = stored(term_counts(docs, toks, item))  # read for the vocabulary and for the values
    n_docs = docs.agg(F.count(F.lit(1)).alias("_n"))
    vocab = select_vocabulary(tf, n_docs, max_features, min_df, max_df)
    v = tf.join(vocab, "term").select(
        item, "term", (F.col("tf") * (F.log((1 + F.col("_n")) / (1 + F.col("df"))) + 1)).alias("_v"))
    w = Window.partitionBy(item)
    nrm = F.sqrt(F.sum(F.col("_v") * F.col("_v")).over(w))
    return v.select(item, "term", F.when(nrm > 0, F.col("_v") / nrm).otherwise(F.lit(0.0)).alias("value"))


# ---------------------------------------------------------------- FE-4
def truncated_svd(long_df: DataFrame, k: int, item: str = "item_id", feature: str = "term",
                  value: str = "value", iters: int = 6, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Rank-k SVD of the item x feature matrix: (item, factors = U * sigma) and
    (component, singular_value, explained_variance_ratio).

    k is capped at n_features - 1. A capped vocabulary takes the exact route, others randomized
    subspace iteration on the long table (``operators.linalg``): no densified matrix.
    Signs: each component's largest-magnitude feature loading is positive."""
    long_df, factors, sig = _svd_fit(long_df, k, item, feature, value, iters, seed)
    n_items = long_df.select(item).distinct().agg(F.count(F.lit(1)).alias("_n"))
    tot = (long_df.groupBy(feature).agg(F.sum(value).alias("_s"), F.sum(F.col(value) ** 2).alias("_s2"))
           .transform(lambda t: with_scalars(t, n_items))
           .agg(F.sum(F.col("_s2") / F.col("_n") - (F.col("_s") / F.col("_n")) ** 2).alias("_tv")))
    comp = long_df.sparkSession.createDataFrame([(i, sig[i]) for i in range(len(sig))], "component int, singular_value double")
    fac_var = (factors.select(F.posexplode("factors").alias("component", "_f"))
               .groupBy("component").agg(F.var_pop("_f").alias("_var")))
    comp = (with_scalars(comp.join(fac_var, "component"), tot)
            .select("component", "singular_value", (F.col("_var") / F.col("_tv")).alias("explained_variance_ratio")))
    return factors, comp


def _svd_fit(long_df: DataFrame, k: int, item: str = "item_id", feature: str = "term", value: str = "value",
             iters: int = 6, seed: int = 42) -> tuple[DataFrame, DataFrame, list[float]]:
    """(the stored entries, the factors, the singular values) of ``truncated_svd``."""
    from rankforge.operators.linalg import gram_svd, randomized_svd

    long_df = stored(long_df.select(item, feature, value))  # read by the fit, the totals and the counts
    nf = long_df.select(feature).distinct().count()
    kk = int(max(1, min(k, nf - 1)))
    ent = long_df.select(F.col(item).alias("row"), F.col(feature).alias("col"), F.col(value).alias("val"))
    # A capped vocabulary keeps the feature Gram small: exact eigen route; otherwise randomized.
    if nf <= GRAM_SVD_MAX_FEATURES:
        u, sig, _ = gram_svd(ent, kk)
    else:
        u, sig, _ = randomized_svd(ent, kk, iters=iters, seed=seed)
    sl = F.array(*[F.lit(float(x)) for x in sig])
    factors = u.select(F.col("row").alias(item), F.zip_with("vector", sl, lambda a, b: a * b).alias("factors"))
    return long_df, factors, sig


# ---------------------------------------------------------------- FE-5
def binary_counts(items: DataFrame, list_col: str, min_df: int = 1, item: str = "item_id",
                  prefix: str | None = None) -> DataFrame:
    """Binary presence of list values that occur in at least ``min_df`` items."""
    mh = multi_hot(items, list_col, prefix, item)
    keep = mh.groupBy("feature").agg(F.count(F.lit(1)).alias("_df")).where(F.col("_df") >= min_df)
    return mh.join(keep.select("feature"), "feature").select(item, "feature", "value")


# ---------------------------------------------------------------- FE-6
def log_zscore(items: DataFrame, cols: list[str], item: str = "item_id", fill: float = 0.0) -> DataFrame:
    """log1p(x, null -> fill) then z with population std + 1e-8, per column (one pass)."""
    logs = items.select(item, *[F.log1p(F.coalesce(F.col(c).cast("double"), F.lit(fill))).alias(c) for c in cols])
    st = logs.agg(*[F.avg(c).alias(f"_m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"_s_{c}") for c in cols])
    j = with_scalars(logs, st)
    return j.select(item, *[((F.col(c) - F.col(f"_m_{c}")) / (F.col(f"_s_{c}") + F.lit(EPS))).alias(c) for c in cols])


# ---------------------------------------------------------------- FE-7
def minmax_scale(items: DataFrame, cols: list[str], item: str = "item_id") -> DataFrame:
    """(x - min) / (max - min) per column; constant columns -> 0."""
    st = items.agg(*[F.min(c).alias(f"_lo_{c}") for c in cols], *[F.max(c).alias(f"_hi_{c}") for c in cols])
    j = with_scalars(items, st)
    out = []
    for c in cols:
        lo, hi = F.col(f"_lo_{c}"), F.col(f"_hi_{c}")
        out.append(F.when(hi > lo, (F.col(c) - lo) / (hi - lo)).otherwise(F.lit(0.0)).alias(c))
    return j.select(item, *out)


# ---------------------------------------------------------------- FE-8
def percentile_bins(items: DataFrame, cols: list[str], bins: int = NUMERIC_BINS, item: str = "item_id") -> DataFrame:
    """One-hot percentile bins: edges are percentiles 0..100 of the positive values (all
    values when none is positive), outer edges infinite; value v goes to bin
    #(inner edges <= v). Long output (item, feature '<col>_bin_<b>', 1.0)."""
    qs = [i / bins for i in range(1, bins)]
    out = None
    for c in cols:
        v = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        vals = items.select(v.alias("_v"), F.lit(1.0).alias("_w"))
        vals = vals.where(F.col("_v") > 0) if vals.where(F.col("_v") > 0).limit(1).count() else vals
        edges = [e for e in weighted_quantiles(vals, qs, "_v", "_w") if e == e]
        b = items.select(item, F.size(F.filter(F.array(*[F.lit(e) for e in edges]).cast("array<double>"),
                                               lambda e: e <= v)).alias("_b"))
        part = b.select(item, F.concat(F.lit(f"{c}_bin_"), F.col("_b").cast("string")).alias("feature"),
                        F.lit(1.0).alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


# ---------------------------------------------------------------- FE-9
def era_one_hot(items: DataFrame, year: str = "year", item: str = "item_id") -> DataFrame:
    e = era_bucket(year)
    return items.select(item, F.concat(F.lit("era:"), e).alias("feature"), F.lit(1.0).alias("value")) \
        .where(e.isNotNull())


def top_value_one_hot(items: DataFrame, col: str, top_n: int = TOP_LANGUAGES, prefix: str = "language",
                      item: str = "item_id") -> DataFrame:
    """One-hot of the ``top_n`` most frequent values (ties by value); every other
    non-null value goes to a separate ``<prefix>:other`` slot."""
    top = vocab_top(items.select(item, F.col(col).alias("_v")).where(F.col("_v").isNotNull()), top_n)
    j = items.select(item, F.col(col).alias("_v")).where(F.col("_v").isNotNull()) \
        .join(F.broadcast(top.select("_v", F.lit(1).alias("_top"))), "_v", "left")
    f = F.when(F.col("_top") == 1, F.concat(F.lit(prefix + ":"), F.col("_v"))).otherwise(F.lit(prefix + ":other"))
    return j.select(item, f.alias("feature"), F.lit(1.0).alias("value"))


# ---------------------------------------------------------------- AG-7
def value_counts(items: DataFrame, list_col: str, item: str = "item_id") -> DataFrame:
    """(value, n_items) for a list field."""
    return (items.select(item, F.explode(list_col).alias("value")).distinct()
            .groupBy("value").agg(F.count(F.lit(1)).alias("n_items")))


def vocab_top(vals: DataFrame, top_n: int) -> DataFrame:
    """The ``top_n`` most frequent ``_v`` (ties by value). A bounded top-n (TakeOrdered)."""
    return (vals.groupBy("_v").agg(F.count(F.lit(1)).alias("_cnt"))
            .orderBy(F.col("_cnt").desc(), F.col("_v").asc()).limit(int(top_n)))


# ---------------------------------------------------------------- FE-10
def entity_tags(items: DataFrame, list_col: str, prefix: str, top_n: int, item: str = "item_id") -> DataFrame:
    """Tags '<prefix>:<entity>' for entities among the ``top_n`` most frequent (by occurrence,
    ties by entity); items with entities but none frequent get '<prefix>:other', items
    without entities '<prefix>:unknown'."""
    ex = items.select(item, F.explode_outer(list_col).alias("_v"))
    top = vocab_top(ex.where(F.col("_v").isNotNull()), top_n).select("_v", F.lit(1).alias("_top"))
    j = ex.join(F.broadcast(top), "_v", "left")
    per = j.groupBy(item).agg(
        F.collect_set(F.when(F.col("_top") == 1, F.concat(F.lit(prefix + ":"), F.col("_v")))).alias("_tags"),
        F.count("_v").alias("_n"))
    tags = (F.when(F.size("_tags") > 0, F.col("_tags"))
            .when(F.col("_n") > 0, F.array(F.lit(prefix + ":other")))
            .otherwise(F.array(F.lit(prefix + ":unknown"))))
    return per.select(item, F.explode(tags).alias("feature"), F.lit(1.0).alias("value"))


# ---------------------------------------------------------------- FE-11
def top_tfidf_tags(tfidf_long: DataFrame, n: int = 5, item: str = "item_id", prefix: str = "tfidf") -> DataFrame:
    w = Window.partitionBy(item).orderBy(F.col("value").desc(), F.col("term").asc())
    return (tfidf_long.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n)
            .select(item, F.concat(F.lit(prefix + ":"), F.col("term")).alias("feature"), F.lit(1.0).alias("value")))


# ---------------------------------------------------------------- FE-12
def assemble_tags(families: list[DataFrame], items: DataFrame, keep_prefixes: list[str] | None = None,
                  item: str = "item_id") -> DataFrame:
    """Union of tag families; ``keep_prefixes`` selects families (ablation); an item left
    without any tag gets 'genre:unknown'."""
    u = families[0].select(item, "feature")
    for f in families[1:]:
        u = u.unionByName(f.select(item, "feature"))
    if keep_prefixes:
        cond = None
        for p in keep_prefixes:
            c = F.col("feature").startswith(p + ":")
            cond = c if cond is None else cond | c
        u = u.where(cond)
    u = u.distinct()
    missing = items.select(item).distinct().join(u.select(item).distinct(), item, "left_anti") \
        .select(item, F.lit("genre:unknown").alias("feature"))
    return u.unionByName(missing).withColumn("value", F.lit(1.0))


# ---------------------------------------------------------------- FE-13
def weighted_blocks(blocks: list[tuple], item: str = "item_id", out: str = "vector") -> DataFrame:
    """Concatenate dense blocks (item, vector) each scaled by its weight, then L2-normalise
    the row (a zero row stays zero). A missing block counts as zeros of its width, which is
    the block's third entry, or else looked for in its rows (so that they are made twice)."""
    j = None
    widths = []
    for idx, (b, w, *width) in enumerate(blocks):
        widths.append(width[0] if width and width[0] else b.select(F.size("vector").alias("_w")).agg(F.max("_w").alias(f"_w{idx}")))
        part = b.select(item, F.transform("vector", lambda x: x * F.lit(float(w))).alias(f"_b{idx}"))
        j = part if j is None else j.join(part, item, "full")
    for idx, width in enumerate(widths):
        j = j.withColumn(f"_w{idx}", F.lit(width)) if isinstance(width, int) else with_scalars(j, width)
    parts = [F.coalesce(F.col(f"_b{i}"), F.array_repeat(F.lit(0.0), F.col(f"_w{i}"))) for i in range(len(blocks))]
    unit = lambda c: once(norm(c), lambda n: F.transform(c, lambda x: F.when(n > 0, x / n).otherwise(F.lit(0.0))))
    return j.select(item, once(F.concat(*parts), unit).alias(out))


def numeric_block(numeric: DataFrame, cols: list[str], item: str = "item_id") -> DataFrame:
    return numeric.select(item, F.array(*[F.col(c).cast("double") for c in cols]).alias("vector"))


# ---------------------------------------------------------------- FE-18
def label_encode(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Integer codes in sorted order of the distinct values (0-based)."""
    codes = global_row_number(df.select(col).distinct(), [F.col(col).asc()], out="_code")
    return df.join(codes, col, "left").withColumn(
        out or f"{col}_code", (F.col("_code") - 1).cast("int")).drop("_code")


# ---------------------------------------------------------------- FE-14 .. FE-17 compositions
def _svd_block(long_df: DataFrame, k: int, item: str, feature: str, items: DataFrame) -> tuple[DataFrame, int]:
    """Rank-k SVD factors of a long (item, feature, value) table as a dense block (missing items = zeros), and its width."""
    _, f, sig = _svd_fit(long_df.select(item, F.col(feature).cast("string").alias("term"), "value")
                         .withColumnRenamed(item, "item_id"), k)
    # The rank can be smaller than k (few features); every row has that many entries.
    return with_all_rows(f, items, len(sig)), len(sig)


def with_all_rows(factors: DataFrame, items: DataFrame, width: int, item: str = "item_id") -> DataFrame:
    """(item, vector) for every row of ``items``; one without any feature is a zero row of the matrix, and so has zeros."""
    return items.select(item).join(factors, item, "left").select(
        item, F.coalesce("factors", F.array_repeat(F.lit(0.0), int(width))).alias("vector"))


def content_vector_79(meta: DataFrame, numeric: list[str]) -> DataFrame:
    """FE-14: genre multi-hot | overview TF-IDF(100, min_df 2) -> SVD 32 | keywords TF-IDF(50) -> SVD 8 |
    director char 2-3-grams TF-IDF(30) -> SVD 4 | cast char n-grams -> SVD 4 | log1p-z numerics; L2 per item."""
    mh = multi_hot(meta, "genres", "genre")
    genres = vocabulary(mh)
    genre = to_dense(mh, genres, items=meta)
    ov = tfidf(meta, "overview", max_features=100, min_df=2)
    kw = tfidf(meta.withColumn("_kw", F.array_join(F.slice(F.coalesce("movie_keywords", F.array()), 1, 20), " ")),
               "_kw", max_features=50)
    di = tfidf(meta, "director", max_features=30, analyzer="char")
    ca = tfidf(meta.withColumn("_cast", F.array_join(F.coalesce("top_cast", F.array()), " ")), "_cast",
               max_features=30, analyzer="char")
    svd = [_svd_block(long, k, "item_id", "term", meta) for long, k in ((ov, 32), (kw, 8), (di, 4), (ca, 4))]
    return weighted_blocks([(genre, 1.0, genres.count()), *[(block, 1.0, width) for block, width in svd],
                            (numeric_block(log_zscore(meta, numeric), numeric), 1.0, len(numeric))])


def content_vector_bins(meta: DataFrame, numeric: list[str], year: str = "year", language: str | None = None) -> DataFrame:
    """FE-15: genre multi-hot | percentile-bin one-hot numerics | era one-hot (| top-10 language + other);
    L2 per item, dense over the sorted vocabulary of all these tags."""
    parts = [multi_hot(meta, "genres", "genre"), percentile_bins(meta, numeric), era_one_hot(meta, year)]
    if language:
        parts.append(top_value_one_hot(meta, language))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return weighted_blocks([(to_dense(u, vocabulary(u), items=meta), 1.0)])


def content_vector_svd(meta: DataFrame, list_cols: list[str], numeric: list[str], k: int = 100,
                       min_df: int = 2) -> DataFrame:
    """FE-16: SVD-k of the binary multi-hot of several list fields (min_df) | min-max numerics; L2 per item."""
    long = None
    for c in list_cols:
        b = binary_counts(meta, c, min_df, prefix=c)
        long = b if long is None else long.unionByName(b)
    n_feat = long.select("feature").distinct().count()
    svd, width = _svd_block(long, int(max(1, min(k, n_feat - 1))), "item_id", "feature", meta)
    return weighted_blocks([(svd, 1.0, width), (numeric_block(minmax_scale(meta, numeric), numeric), 1.0, len(numeric))])


def content_vector_phi(meta: DataFrame, text_vectors: DataFrame, numeric: list[str], k_genre: int = 16) -> DataFrame:
    """FE-17: supplied text vector | genre multi-hot SVD-16 | min-max numerics (each block as is, no L2)."""
    mh = multi_hot(meta, "genres", "genre")
    n_feat = mh.select("feature").distinct().count()
    g, _ = _svd_block(mh, int(max(1, min(k_genre, n_feat - 1))), "item_id", "feature", meta)
    tv = meta.select("item_id").join(text_vectors.select("item_id", "vector"), "item_id", "left")
    width = text_vectors.select(F.max(F.size("vector"))).first()[0] or 0
    tv = tv.select("item_id", F.coalesce("vector", F.array_repeat(F.lit(0.0), F.lit(width))).cast("array<double>").alias("_t"))
    nb = numeric_block(minmax_scale(meta, numeric), numeric).withColumnRenamed("vector", "_n")
    return (tv.join(g.withColumnRenamed("vector", "_g"), "item_id").join(nb, "item_id")
            .select("item_id", F.concat("_t", "_g", "_n").alias("vector")))
