"""The grouped kernels: co-occurrence Gram and blocked dot-product top-k.

These are the only places where work leaves Catalyst for NumPy, and every
group they build has a size bound that does not grow with the data:

* ``gram``: the outer-product sum X^T X. A user's history is split into
  hash chunks of at most ``chunk`` rows; pairs are produced per
  (user, chunk_a, chunk_b) group, so no group emits more than chunk^2 pairs
  even for a user holding a third of all rows. Products are pre-aggregated
  map-side (partial HashAggregate) before the shuffle on (i, j).
* ``block_topk``: exact top-k of left.vector . right.vector. Rows are hashed
  into blocks of about ``block`` rows on each side; a task multiplies one
  left block with right blocks it reads from the shared folder, one GEMM a block, masks
  excluded pairs, keeps its top-k per left row, and a final row_number merges
  the partial lists. Per task memory is block x block, whatever the skew.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.operators.tiles import new_tiles


# ---------------------------------------------------------------- Gram (J-1 + AG-3)
def gram(x: DataFrame, user: str = "user_id", item: str = "item_id", weight: str = "weight",
         chunk: int = 512, lam: float = 0.0, fold: str | None = None, folds: int = 0) -> DataFrame:
    """Upper-triangular Gram ``(item_i, item_j, g)`` with i <= j and g = sum_u w_ui * w_uj.

    ``lam`` is added on the diagonal. Only co-occurring pairs are produced. With ``fold``, the column that says
    which of ``folds`` a row belongs to, columns g0, g1, ... are the Grams of the training rows of each fold: the
    whole one less every product with a row of that fold. All come from the one join.
    """
    x = x.select(F.col(user).alias("_u"), F.col(item).alias("_i"), F.col(weight).cast("double").alias("_w"),
                 F.col(fold).cast("int").alias("_f") if fold else F.lit(0).alias("_f"))
    # Number of chunks per user from its history length (an aggregate, then a
    # join that AQE splits if one user is hot).
    n_chunks = (x.groupBy("_u").agg(F.count(F.lit(1)).alias("_h"))
                .select("_u", F.greatest(F.lit(1), F.ceil(F.col("_h") / F.lit(chunk))).cast("int").alias("_nc")))
    xc = (x.join(n_chunks, "_u")
          .withColumn("_c", F.pmod(F.xxhash64(F.col("_i")), F.col("_nc")).cast("int")))
    # Left copy goes to every chunk pair (c, b) with b >= c; right copy to (a, c) with a <= c.
    left = xc.select("_u", F.col("_c").alias("_ca"),
                     F.explode(F.sequence(F.col("_c"), F.col("_nc") - 1)).alias("_cb"),
                     F.col("_i").alias("_a"), F.col("_w").alias("_wa"), F.col("_f").alias("_fa"))
    right = xc.select("_u", F.explode(F.sequence(F.lit(0), F.col("_c"))).alias("_ca"),
                      F.col("_c").alias("_cb"), F.col("_i").alias("_b"), F.col("_w").alias("_wb"), F.col("_f").alias("_fb"))
    pairs = (left.join(right, ["_u", "_ca", "_cb"])
             .where((F.col("_ca") < F.col("_cb")) | (F.col("_a") <= F.col("_b")))
             .select(F.least("_a", "_b").alias("item_i"), F.greatest("_a", "_b").alias("item_j"),
                     (F.col("_wa") * F.col("_wb")).alias("_p"), *(["_fa", "_fb"] if fold else [])))
    kept = [F.sum(F.when((F.col("_fa") != k) & (F.col("_fb") != k), F.col("_p")).otherwise(0.0)).alias(f"g{k}") for k in range(folds if fold else 0)]
    g = pairs.groupBy("item_i", "item_j").agg(F.sum("_p").alias("g"), *kept)
    if lam:
        g = g.withColumn("g", F.when(F.col("item_i") == F.col("item_j"), F.col("g") + F.lit(float(lam)))
                         .otherwise(F.col("g")))
    return g


def gram_rows(x: DataFrame, rows: DataFrame, user: str = "user_id", item: str = "item_id", weight: str = "weight",
              chunk: int = 512) -> DataFrame:
    """``(item_i, item_j, g)`` of the Gram's rows item_i in ``rows(item)`` alone, whole rows: every co-occurring item_j
    before, at and after item_i. Pairs of users without any of these items are never made."""
    x = x.select(F.col(user).alias("_u"), F.col(item).alias("_i"), F.col(weight).cast("double").alias("_w"))
    n_chunks = (x.groupBy("_u").agg(F.count(F.lit(1)).alias("_h"))
                .select("_u", F.greatest(F.lit(1), F.ceil(F.col("_h") / F.lit(chunk))).cast("int").alias("_nc")))
    xc = (x.join(n_chunks, "_u")
          .withColumn("_c", F.pmod(F.xxhash64(F.col("_i")), F.col("_nc")).cast("int")))
    wanted = rows.select(F.col(item).alias("_i")).distinct()
    every = F.explode(F.sequence(F.lit(0), F.col("_nc") - 1))
    left = xc.join(wanted, "_i", "left_semi").select("_u", F.col("_c").alias("_ca"), every.alias("_cb"), F.col("_i").alias("item_i"), F.col("_w").alias("_wa"))
    right = xc.select("_u", every.alias("_ca"), F.col("_c").alias("_cb"), F.col("_i").alias("item_j"), F.col("_w").alias("_wb"))
    return left.join(right, ["_u", "_ca", "_cb"]).groupBy("item_i", "item_j").agg(F.sum(F.col("_wa") * F.col("_wb")).alias("g"))


def symmetric(g: DataFrame) -> DataFrame:
    """Both halves of an upper-triangular long matrix (diagonal once)."""
    off = g.where(F.col("item_i") != F.col("item_j"))
    return g.unionByName(off.select(F.col("item_j").alias("item_i"), F.col("item_i").alias("item_j"), "g"))


# ---------------------------------------------------------------- blocked pair scoring + top-k
def n_blocks(df: DataFrame, block: int) -> int:
    """Block count from a one-row count (the only driver round trip)."""
    n = df.count()
    return max(1, math.ceil(n / block))


def keep_best(top: np.ndarray, top_id: np.ndarray, S: np.ndarray, rids: np.ndarray) -> None:
    """Merge a block of scores ``S`` of the rows ``rids`` into the best k so far of each left row, ``top`` and ``top_id``
    (-inf where there is none yet). A row that has k already is compared with its k-th alone, not partitioned."""
    kk = top.shape[1]
    # What reaches the k best so far; of rows with many such the best k and their ties.
    cand = S >= top[:, -1:]
    many = np.flatnonzero(np.count_nonzero(cand, axis=1) > kk)
    if len(many):
        # NaN is no score: it comes last here and is no candidate.
        worst = np.where(np.isnan(S[many]), np.inf, -S[many])
        cand[many] &= worst <= np.partition(worst, kk - 1, axis=1)[:, kk - 1:kk]
    rr, cc = np.divmod(np.flatnonzero(cand), max(1, S.shape[1]))
    there = np.isfinite(S[rr, cc])
    rr, cc = rr[there], cc[there]
    # Merged with what these rows have, in an exact order (score desc, id asc).
    own = np.unique(rr)
    r, s, ids = (np.concatenate(x) for x in ((np.repeat(own, kk), rr), (top[own].ravel(), S[rr, cc]), (top_id[own].ravel(), rids[cc])))
    order = np.lexsort((ids, -s, r))
    order = order[np.arange(len(r)) - np.searchsorted(r[order], r[order]) < kk]
    top[own], top_id[own] = s[order].reshape(-1, kk), ids[order].reshape(-1, kk)


VEC = T.ArrayType(T.DoubleType())
#: Tasks of a blocked top-k that are worth sending left rows more than once for.
BLOCK_TASKS = 64
#: Right rows, at least, and scores that are worked out at a time, few enough to stay in a core's cache.
STEP, CELLS = 256, 1 << 19


def block_pair_topk(left: DataFrame, right: DataFrame, k: int, scorer, left_id: str = "user_id",
                    right_id: str = "item_id", left_payload: str = "vector", right_payload: str = "vector",
                    pairs: dict[str, DataFrame] | None = None, exclude: DataFrame | None = None,
                    block: int = 2048, out_score: str = "score", round_digits: int | None = None) -> DataFrame:
    """Exact top-k right rows per left row of ``scorer(L, R, P)``, computed block pair by block pair.

    left/right carry an ``array<double>`` payload per row. ``pairs`` are sparse
    (left_id, right_id, value) tables handed to the scorer as dense block
    matrices (0 where absent); ``exclude`` pairs are masked. Right blocks lie in the
    shared folder, each a file, so no vector is shuffled once for every block it meets:
    a task takes one left block along a strip of right blocks, reads those one after
    the other and keeps the best k. Left rows are sent once a strip, and there are the fewer
    strips the more left blocks. Memory is bounded by the block sizes whatever the key skew.
    ``scorer(L, R, P)`` gets L (n_l x w_l),
    R (n_r x w_r) float arrays and P {name: n_l x n_r array} and returns the
    n_l x n_r score matrix.
    """
    pairs = pairs or {}
    nl = n_blocks(left, block)
    nr = n_blocks(right, block)
    strips = min(nr, -(-BLOCK_TASKS // nl))
    width = -(-nr // strips)
    lb = lambda c: F.pmod(F.xxhash64(F.col(c)), F.lit(nl)).cast("int")
    rb = lambda c: F.pmod(F.xxhash64(F.col(c)), F.lit(nr)).cast("int")
    store = new_tiles(left.sparkSession, 0)

    def keep(pdf: pd.DataFrame) -> pd.DataFrame:
        b = int(pdf["_rb"].iloc[0])
        store.write("ids", b, b, pdf["_rid"].to_numpy(np.int64), np.int64)
        store.write("rows", b, b, np.vstack(pdf["_v"].to_numpy()).astype(np.float64))
        return pd.DataFrame({"_rb": [b]})

    kept = {r["_rb"] for r in right.select(rb(right_id).alias("_rb"), F.col(right_id).cast("long").alias("_rid"), F.col(right_payload).cast(VEC).alias("_v"))
            .groupBy("_rb").applyInPandas(keep, "_rb int").collect()}
    parts = left.select(lb(left_id).alias("_lb"), F.explode(F.sequence(F.lit(0), F.lit(nr - 1), F.lit(width))).alias("_rb"),
                        F.lit(0).alias("_kind"), F.col(left_id).cast("long").alias("_lid"),
                        F.lit(None).cast("long").alias("_rid"), F.lit(None).cast("double").alias("_val"),
                        F.col(left_payload).cast(VEC).alias("_v"))
    names = list(pairs)
    sparse = [(2, exclude.select(left_id, right_id, F.lit(0.0).alias("_value")))] if exclude is not None else []
    sparse += [(3 + i, pairs[n]) for i, n in enumerate(names)]
    for kind, df in sparse:
        vcol = df.columns[2]
        parts = parts.unionByName(df.select(
            lb(left_id).alias("_lb"), rb(right_id).alias("_rb"), F.lit(kind).alias("_kind"),
            F.col(left_id).cast("long").alias("_lid"), F.col(right_id).cast("long").alias("_rid"),
            F.col(vcol).cast("double").alias("_val"), F.lit(None).cast(VEC).alias("_v")))

    kk = int(k)
    schema = T.StructType([T.StructField("_lid", T.LongType()), T.StructField("_rid", T.LongType()),
                           T.StructField("_s", T.DoubleType())])

    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        lrows = pdf[pdf["_kind"] == 0]
        first = int(pdf["_rb"].iloc[0]) // width * width
        if len(lrows) == 0:
            return pd.DataFrame({"_lid": np.zeros(0, np.int64), "_rid": np.zeros(0, np.int64), "_s": np.zeros(0)})
        lids = lrows["_lid"].to_numpy(np.int64)
        A = np.vstack(lrows["_v"].to_numpy()).astype(np.float64)
        lix = pd.Index(lids)
        step = max(STEP, CELLS // len(lids))
        top, top_id = np.full((len(lids), kk), -np.inf), np.zeros((len(lids), kk), np.int64)  # the best k of a left row so far
        given = {b: own for b, own in pdf[pdf["_kind"] > 0].groupby("_rb")}
        for b in range(first, min(first + width, nr)):
            if b not in kept:
                continue
            rids = store.read_vector("ids", b, np.int64)
            Bm = store.read_vector("rows", b).reshape(len(rids), -1)
            own = given.get(b, pdf[:0])
            rix = pd.Index(rids)
            mats = {}
            for i, name in enumerate(names):
                sub = own[own["_kind"] == 3 + i]
                M = np.zeros((len(lids), len(rids)))
                if len(sub):
                    lp = lix.get_indexer(sub["_lid"].to_numpy(np.int64))
                    rp = rix.get_indexer(sub["_rid"].to_numpy(np.int64))
                    ok = (lp >= 0) & (rp >= 0)
                    np.add.at(M, (lp[ok], rp[ok]), sub["_val"].to_numpy(np.float64)[ok])
                mats[name] = M
            ex = own[own["_kind"] == 2]
            lp = rp = np.zeros(0, np.int64)
            if len(ex):
                lp = lix.get_indexer(ex["_lid"].to_numpy(np.int64))
                rp = rix.get_indexer(ex["_rid"].to_numpy(np.int64))
                ok = (lp >= 0) & (rp >= 0)
                lp, rp = lp[ok], rp[ok]
            for a in range(0, len(rids), step):
                S = np.asarray(scorer(A, Bm[a:a + step], {n: M[:, a:a + step] for n, M in mats.items()}), dtype=np.float64)
                if round_digits is not None:
                    S = np.round(S, round_digits)
                here = (rp >= a) & (rp < a + step)
                S[lp[here], rp[here] - a] = -np.inf
                keep_best(top, top_id, S, rids[a:a + step])
        rr, cc = np.nonzero(top > -np.inf)
        return pd.DataFrame({"_lid": lids[rr], "_rid": top_id[rr, cc], "_s": top[rr, cc]})

    partial = parts.withColumn("_strip", F.floor(F.col("_rb") / width).cast("int")).groupBy("_lb", "_strip").applyInPandas(kernel, schema)
    w = Window.partitionBy("_lid").orderBy(F.col("_s").desc(), F.col("_rid").asc())
    return (partial.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= kk)
            .select(F.col("_lid").alias(left_id), F.col("_rid").alias(right_id),
                    F.col("_s").alias(out_score), F.col("_rk").cast("int").alias("rank")))


def dot_scorer(metric: str = "dot"):
    def score(A, Bm, _):
        if metric == "cosine":
            A = A / (np.linalg.norm(A, axis=1, keepdims=True) + 1e-12)
            Bm = Bm / (np.linalg.norm(Bm, axis=1, keepdims=True) + 1e-12)
        S = A @ Bm.T
        if metric == "l2":
            d2 = np.sum(A * A, 1)[:, None] - 2 * S + np.sum(Bm * Bm, 1)[None, :]
            return -np.sqrt(np.maximum(d2, 0.0))
        return S
    return score


def block_topk(left: DataFrame, right: DataFrame, k: int, left_id: str = "user_id",
               right_id: str = "item_id", vector: str = "vector", exclude: DataFrame | None = None,
               block: int = 2048, out_score: str = "score", metric: str = "dot",
               round_digits: int | None = None) -> DataFrame:
    """Exact top-k right rows per left row by dot product, cosine, or negative L2 distance
    (``metric='l2'``: higher is closer). ``exclude`` pairs (e.g. seen items) are masked
    inside their block pair, so k eligible rows survive per left row whenever k exist."""
    return block_pair_topk(left, right, k, dot_scorer(metric), left_id, right_id, vector, vector,
                           exclude=exclude, block=block, out_score=out_score, round_digits=round_digits)
