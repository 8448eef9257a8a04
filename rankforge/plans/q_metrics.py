"""Registered queries: evaluation (EV-*), fold summaries (AG-9), model selection (AG-12),
warm/cold breakdown (EV-13), plus W-2 / W-9 / TK / SO / J rows.

Protocol: 5 folds by the deterministic item-order rule, fold 0 is the test
split unless stated; relevant = test rating >= 4. The base model is item
popularity (train interaction count) ranked over the whole catalogue with
seen items masked (exact, via ``top_k_prior``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from rankforge.operators import features as fe
from rankforge.operators import metrics as ev
from rankforge.operators import prep, ranking
from rankforge.operators.cooccurrence import cooccurrence_ranks
from rankforge.operators.item_matrix import matrix_topk
from rankforge.operators.models import ease, knn
from rankforge.plans.registry import register
from rankforge.plans.sqlparts import FOLDED, INTERACTIONS, rs, with_, wrap
from rankforge.session import cut_lineage
from rankforge.sources import tables as tb

K = 10


# ---------------------------------------------------------------- Spark side helpers
def folds(spark, sf_dir):
    """Folded interactions, checkpointed (reliably, in the shared checkpoint directory):
    every model and metric below reads them several times."""
    return cut_lineage(prep.stratified_folds(tb.interactions(spark, sf_dir), 5, order="item"))


def split(spark, sf_dir, fold: int = 0):
    return prep.fold_split(folds(spark, sf_dir), fold)


def catalogue(spark, sf_dir):
    return tb.items(spark, sf_dir).select("item_id")


def pop_prior(train, cat, positive_only: bool = False):
    t = prep.positives(train) if positive_only else train
    c = t.groupBy("item_id").agg(F.count(F.lit(1)).cast("double").alias("score"))
    return cat.join(c, "item_id", "left").fillna(0.0, ["score"])


def pop_topk(train, test, cat, k: int = K, positive_only: bool = False, threshold: float | None = 4.0):
    rel = ev.relevant_items(test, threshold)
    users = rel.select("user_id").distinct()
    return ranking.top_k_prior(pop_prior(train, cat, positive_only), users, train, k), rel


def summary_for(train, test, cat, topk, rel, k: int = K):
    stats = prep.item_counts(train).select("item_id", "pop_ratio")
    per = ev.per_user_at_k(topk, rel, k, item_stats=stats)
    return ev.summarize_at_k(per, k)


# ---------------------------------------------------------------- SQL side
def base_sql(fold: int = 0, threshold: str = "rating >= 4", positive_only: bool = False) -> dict:
    cnt_src = "(SELECT * FROM train WHERE rating >= 4)" if positive_only else "train"
    return dict(
        r=INTERACTIONS, f=FOLDED,
        train=f"SELECT * FROM f WHERE fold <> {fold}",
        test=f"SELECT * FROM f WHERE fold = {fold}",
        rel=f"SELECT DISTINCT user_id, item_id FROM test WHERE {threshold}",
        cnt=f"""SELECT p_partkey AS item_id, CAST(coalesce(c.n, 0) AS DOUBLE) AS score FROM part
                LEFT JOIN (SELECT item_id, count(*) AS n FROM {cnt_src} GROUP BY item_id) c ON c.item_id = p_partkey""",
        cand="""SELECT u.user_id, c.item_id, c.score FROM (SELECT DISTINCT user_id FROM rel) u CROSS JOIN cnt c
                ANTI JOIN train t ON t.user_id = u.user_id AND t.item_id = c.item_id""",
        ranked="SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM cand",
        top=f"SELECT * FROM ranked WHERE rank <= {K}",
    )


def per_user_sql(ap_den: str = "least(n_rel, 10)") -> dict:
    return dict(
        pop="""SELECT item_id, count(*) / (SELECT count(DISTINCT user_id) FROM train) AS pop_ratio
               FROM train GROUP BY item_id""",
        nrel="SELECT user_id, count(*) AS n_rel FROM rel GROUP BY user_id",
        th="""SELECT t.user_id, t.item_id, t.rank, CASE WHEN rel.item_id IS NULL THEN 0 ELSE 1 END AS hit,
                     coalesce(pop.pop_ratio, 0.0) AS pop_ratio
              FROM top t LEFT JOIN rel USING (user_id, item_id) LEFT JOIN pop USING (item_id)""",
        thc="SELECT *, sum(hit) OVER (PARTITION BY user_id ORDER BY rank ROWS UNBOUNDED PRECEDING) AS cum FROM th",
        agg="""SELECT n.user_id, n.n_rel, coalesce(sum(hit), 0) AS n_hits,
                      sum(CASE WHEN hit = 1 THEN cum / rank END) AS apsum,
                      sum(CASE WHEN hit = 1 THEN 1.0 / log2(rank + 1) END) AS dcg,
                      sum(hit * (1.0 - pop_ratio)) AS ser, avg(-log2(greatest(pop_ratio, 1e-9))) AS novelty
               FROM nrel n LEFT JOIN thc USING (user_id) GROUP BY n.user_id, n.n_rel""",
        per=f"""SELECT user_id, n_rel, n_hits,
                  CASE WHEN n_hits > 0 THEN apsum / {ap_den} ELSE 0.0 END AS ap,
                  coalesce(dcg / list_sum([1.0 / log2(x + 1) for x in range(1, least(n_rel, 10) + 1)]), 0.0) AS ndcg,
                  n_hits / 10.0 AS precision, n_hits / n_rel AS recall,
                  CASE WHEN n_hits > 0 THEN 1.0 ELSE 0.0 END AS hit,
                  coalesce(ser / least(n_rel, 10), 0.0) AS serendipity, novelty FROM agg""",
    )


SUMMARY_SELECT = """SELECT CAST(count(*) AS BIGINT) AS n_users, avg(ap) AS map_at_10, avg(ndcg) AS ndcg_at_10,
  avg(precision) AS precision_at_10, avg(recall) AS recall_at_10, avg(hit) AS hit_rate_at_10,
  avg(serendipity) AS serendipity, avg(novelty) AS novelty FROM per"""
SUMMARY_COLS = ["map_at_10", "ndcg_at_10", "precision_at_10", "recall_at_10", "hit_rate_at_10", "serendipity", "novelty"]


@register("ev01_at_k_popularity", wrap(with_(**base_sql(), **per_user_sql()) + SUMMARY_SELECT, SUMMARY_COLS))
def q_ev01(spark, sf_dir):
    """EV-1, EV-3, EV-5, EV-6, EV-7, EV-9: MAP / nDCG / precision / recall / hit rate /
    serendipity / novelty @10 of the popularity ranker on fold 0."""
    train, test = split(spark, sf_dir)
    topk, rel = pop_topk(train, test, catalogue(spark, sf_dir))
    return summary_for(train, test, None, topk, rel)


@register("ev01_per_user", wrap(with_(**base_sql(), **per_user_sql()) +
                                "SELECT user_id, CAST(n_rel AS BIGINT) AS n_rel, CAST(n_hits AS BIGINT) AS n_hits, ap, ndcg, "
                                "precision, recall, hit FROM per", ["ap", "ndcg", "precision", "recall", "hit"]))
def q_ev01b(spark, sf_dir):
    """EV-1..6 per evaluated user (fold 0, popularity ranker)."""
    train, test = split(spark, sf_dir)
    topk, rel = pop_topk(train, test, catalogue(spark, sf_dir))
    per = ev.per_user_at_k(topk, rel, K)
    return per.select("user_id", F.col("n_rel").cast("bigint").alias("n_rel"), "n_hits", "ap", "ndcg", "precision",
                      "recall", "hit")


@register("ev11_ap_hits_all_ratings", wrap(with_(**base_sql(threshold="true"), **per_user_sql("n_hits")) +
                                           "SELECT avg(ap) AS map_hits FROM per", ["map_hits"]))
def q_ev11(spark, sf_dir):
    """EV-11: AP divided by hits found, every test rating relevant."""
    train, test = split(spark, sf_dir)
    topk, rel = pop_topk(train, test, catalogue(spark, sf_dir), threshold=None)
    per = ev.per_user_at_k(topk, rel, K, ap_variant="hits")
    return per.agg(F.avg("ap").alias("map_hits"))


@register("ev02_full_ranking", wrap(with_(**base_sql()) + """
, allr AS (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM cand),
rr AS (SELECT a.user_id, a.rank FROM allr a JOIN rel USING (user_id, item_id)),
rc AS (SELECT *, count(*) OVER (PARTITION BY user_id ORDER BY rank ROWS UNBOUNDED PRECEDING) AS cum FROM rr),
pu AS (SELECT user_id, sum(cum / rank) / count(*) AS ap_full,
              sum(1.0 / log2(rank + 1)) / list_sum([1.0 / log2(x + 1) for x in range(1, count(*) + 1)]) AS ndcg_full
       FROM rc GROUP BY user_id)
SELECT avg(ap_full) AS map_full, avg(ndcg_full) AS ndcg_full FROM pu""", ["map_full", "ndcg_full"]))
def q_ev02(spark, sf_dir):
    """EV-2 / EV-4: MAP and nDCG over the full catalogue ranking of the popularity ranker
    (exact ranks: catalogue position minus the user's seen items ahead)."""
    train, test = split(spark, sf_dir)
    cat = catalogue(spark, sf_dir)
    rel = ev.relevant_items(test)
    ranks = ev.full_ranks_prior(pop_prior(train, cat), train, rel)
    return ev.per_user_full(ranks).agg(F.avg("ap_full").alias("map_full"), F.avg("ndcg_full").alias("ndcg_full"))


@register("ev08_coverage", wrap(with_(**base_sql()) + """
SELECT CAST(count(DISTINCT item_id) AS BIGINT) AS n_recommended, CAST((SELECT count(*) FROM part) AS BIGINT) AS n_catalogue,
       count(DISTINCT item_id) * 100.0 / (SELECT count(*) FROM part) AS coverage_pct FROM top""", ["coverage_pct"]))
def q_ev08(spark, sf_dir):
    """EV-8: catalogue coverage of the evaluated users' top-10 lists."""
    train, test = split(spark, sf_dir)
    cat = catalogue(spark, sf_dir)
    topk, _ = pop_topk(train, test, cat)
    return ev.coverage(topk, cat)


@register("ev10_diversity", wrap(with_(**base_sql()) + """
, g AS (SELECT p_partkey AS item_id, list_distinct(string_split(p_name, ' ')) AS gs FROM part),
tg AS (SELECT t.user_id, t.rank, g.gs FROM top t JOIN g USING (item_id)),
pr AS (SELECT a.user_id, len(list_intersect(a.gs, b.gs)) / sqrt(len(a.gs) * len(b.gs)) AS sim
       FROM tg a JOIN tg b ON a.user_id = b.user_id AND a.rank < b.rank)
SELECT avg(d) AS diversity FROM (SELECT user_id, 1.0 - avg(sim) AS d FROM pr GROUP BY user_id) t""", ["diversity"]))
def q_ev10(spark, sf_dir):
    """EV-10: 1 - mean pairwise cosine of genre vectors within each top-10, averaged."""
    train, test = split(spark, sf_dir)
    it = tb.items(spark, sf_dir)
    topk, _ = pop_topk(train, test, it.select("item_id"))
    mh = fe.multi_hot(it, "genres", "genre")
    vec = fe.weighted_blocks([(fe.to_dense(mh, fe.vocabulary(mh), items=it), 1.0)])
    return ev.diversity(topk, vec, K).agg(F.avg("diversity").alias("diversity"))


@register("ev13_warm_cold", wrap(with_(**base_sql()) + """
, pc AS (SELECT item_id, count(*) AS n_pos FROM train WHERE rating >= 4 GROUP BY item_id),
rt AS (SELECT rel.user_id, rel.item_id, CASE WHEN coalesce(pc.n_pos, 0) >= 12 THEN 'warm'
          WHEN coalesce(pc.n_pos, 0) > 0 THEN 'cold' ELSE 'unseen' END AS temperature,
          CASE WHEN top.item_id IS NULL THEN 0 ELSE 1 END AS hit
       FROM rel LEFT JOIN pc USING (item_id) LEFT JOIN top USING (user_id, item_id))
SELECT temperature, CAST(count(*) AS BIGINT) AS n_relevant, CAST(sum(hit) AS BIGINT) AS n_hit,
       sum(hit) * 1.0 / count(*) AS recall FROM rt GROUP BY temperature""", ["recall"]))
def q_ev13(spark, sf_dir):
    """EV-13 / AG-15: recall@10 of relevant test items split by item temperature (threshold 12)."""
    train, test = split(spark, sf_dir)
    cat = catalogue(spark, sf_dir)
    topk, rel = pop_topk(train, test, cat)
    temp = prep.item_temperature(train, cat, threshold=12).select("item_id", "temperature")
    t = (rel.join(temp, "item_id", "left")
         .join(topk.select("user_id", "item_id", F.lit(1).alias("hit")), ["user_id", "item_id"], "left")
         .fillna(0, ["hit"]))
    return t.groupBy("temperature").agg(F.count(F.lit(1)).alias("n_relevant"),
                                        F.sum("hit").cast("bigint").alias("n_hit"),
                                        (F.sum("hit") / F.count(F.lit(1))).alias("recall"))


def cross_validate(folded, fit_topk, model: str, cat=None, k: int = 5):
    """EV-12: the table (model, fold, metric, value) of any model. ``fit_topk(train, users)`` fits on a
    fold's training rows and gives (user_id, item_id, rank, ...) for the users that its test rows judge."""
    out = None
    for f in range(k):
        train, test = prep.fold_split(folded, f)
        rel = ev.relevant_items(test)
        topk = fit_topk(train, rel.select("user_id").distinct())
        s = summary_for(train, test, cat, topk, rel).drop("n_users")
        long = ev.to_long(s.withColumn("fold", F.lit(f)).withColumn("model", F.lit(model)), ["model", "fold"])
        out = long if out is None else out.unionByName(long)
    return out


def cross_validate_priors(folded, cat, models: dict[str, bool], k: int = 5):
    """EV-12 of popularity rankers (name: positives only?), model and fold as columns: one scan of the folds, one
    ranking of all priors, one measuring of all lists."""
    train = prep.training_rows(folded, k)
    names = F.explode(F.array(*[F.struct(F.lit(n).alias("model"), F.lit(p).alias("positive")) for n, p in models.items()])).alias("_m")
    runs = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("fold")
    # A fold's training count is the whole count less the fold's own.
    own = folded.groupBy("item_id", "fold").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("rating") >= prep.LIKED_THRESHOLD).cast("long")).alias("n_pos"))
    whole = own.groupBy("item_id").agg(F.sum("n").alias("all_"), F.sum("n_pos").alias("all_pos"))
    counts = (cat.select("item_id", runs).join(whole, "item_id", "left").join(own, ["item_id", "fold"], "left").fillna(0)
              .select("item_id", "fold", (F.col("all_") - F.col("n")).alias("n"), (F.col("all_pos") - F.col("n_pos")).alias("n_pos"), names))
    prior = counts.select("_m.model", "fold", "item_id", F.when(F.col("_m.positive"), F.col("n_pos")).otherwise(F.col("n")).cast("double").alias("score"))
    by = ["model", "fold"]
    rel = folded.where(F.col("rating") >= prep.LIKED_THRESHOLD).select("fold", "user_id", "item_id").distinct().select("*", names).select("_m.model", "fold", "user_id", "item_id")
    topk = ranking.top_k_prior(prior, rel.select(*by, "user_id"), train, K, by=by)
    per = ev.per_user_at_k(topk, rel, K, item_stats=prep.item_counts(train, by=["fold"]).select("fold", "item_id", "pop_ratio"), by=by)
    return ev.to_long(ev.summarize_at_k(per, K, by=by).drop("n_users"), by)


def cv_long(spark, sf_dir, models: dict[str, bool] | None = None):
    """EV-12 of the popularity rankers."""
    return cross_validate_priors(folds(spark, sf_dir), catalogue(spark, sf_dir), models or {"popularity": False})


BOTH = {"popularity": False, "positive_popularity": True}


def knn_topk(train, users):
    """The item-kNN ranker as a model for cross-validation."""
    return knn.knn_topk(train, K, train, users=users)


def ease_topk(train, users):
    """EASE (lambda 500, column form) as a model for cross-validation."""
    x = prep.positives(train).select("user_id", "item_id", F.lit(1.0).alias("weight"))
    return matrix_topk(x.join(users, "user_id", "left_semi"), ease.ease_model(x, 500.0, "column"), K, train)


def _cv_sql(positive_only: bool, model: str) -> str:
    parts = []
    for f in range(5):
        b = base_sql(f, positive_only=positive_only)
        parts.append(with_(**b, **per_user_sql()) + f"""
SELECT '{model}' AS model, {f} AS fold, metric, value FROM (
  SELECT avg(ap) AS map_at_10, avg(ndcg) AS ndcg_at_10, avg(precision) AS precision_at_10, avg(recall) AS recall_at_10,
         avg(hit) AS hit_rate_at_10, avg(serendipity) AS serendipity, avg(novelty) AS novelty FROM per)
UNPIVOT (value FOR metric IN (map_at_10, ndcg_at_10, precision_at_10, recall_at_10, hit_rate_at_10, serendipity, novelty))""")
    return " UNION ALL ".join(f"({p})" for p in parts)


CV_SQL = _cv_sql(False, "popularity")


@register("ev12_cross_validate", wrap(f"SELECT model, CAST(fold AS INTEGER) AS fold, metric, CAST(value AS DOUBLE) AS value FROM ({CV_SQL}) t",
                                      ["value"]))
def q_ev12(spark, sf_dir):
    """EV-12: 5-fold cross-validation of the popularity ranker, long metric table."""
    return cv_long(spark, sf_dir)


def _knn_fold_sql(f: int) -> str:
    b = {k: v for k, v in base_sql(f).items() if k not in ("cand", "ranked", "top")}
    return with_(**b, **knn_sql_on("train"),
                 kun="SELECT sc.* FROM sc JOIN (SELECT DISTINCT user_id FROM rel) u USING (user_id) ANTI JOIN train USING (user_id, item_id)",
                 kr=f"SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {rs('score')} DESC, item_id) AS rank FROM kun",
                 top=f"SELECT * FROM kr WHERE rank <= {K}", **per_user_sql()) + f"""
SELECT 'item_knn' AS model, CAST({f} AS INTEGER) AS fold, metric, CAST(value AS DOUBLE) AS value FROM (
  SELECT avg(ap) AS map_at_10, avg(ndcg) AS ndcg_at_10, avg(precision) AS precision_at_10, avg(recall) AS recall_at_10,
         avg(hit) AS hit_rate_at_10, avg(serendipity) AS serendipity, avg(novelty) AS novelty FROM per)
UNPIVOT (value FOR metric IN (map_at_10, ndcg_at_10, precision_at_10, recall_at_10, hit_rate_at_10, serendipity, novelty))"""


def knn_sql_on(src: str) -> dict:
    return dict(
        g=f"SELECT a.item_id AS i, b.item_id AS j, sum(a.rating * b.rating) AS g FROM {src} a JOIN {src} b USING (user_id) GROUP BY 1, 2",
        n="SELECT i, sqrt(g) AS nrm FROM g WHERE i = j",
        s="SELECT g.i, g.j, g.g / (ni.nrm * nj.nrm) AS sim FROM g JOIN n ni ON g.i = ni.i JOIN n nj ON g.j = nj.i",
        sc=f"SELECT x.user_id, s.j AS item_id, sum(x.rating * s.sim) AS score FROM {src} x JOIN s ON x.item_id = s.i GROUP BY 1, 2",
    )


@register("ev12_cross_validate_knn", wrap(" UNION ALL ".join(f"SELECT * FROM ({_knn_fold_sql(f)}) f{f}" for f in range(5)), ["value"]))
def q_ev12_knn(spark, sf_dir):
    """EV-12: 5-fold cross-validation of the item-kNN ranker through the model callable."""
    return cross_validate(folds(spark, sf_dir), knn_topk, "item_knn")


@register("ev12_cross_validate_ease")
def q_ev12_ease(spark, sf_dir):
    """EV-12: 5-fold cross-validation of EASE through the model callable."""
    return cross_validate(folds(spark, sf_dir), ease_topk, "ease")


@register("ag09_fold_summary", wrap(f"""
SELECT model, metric, avg(value) AS mean, stddev_samp(value) AS std_sample, stddev_pop(value) AS std_population,
       CAST(count(*) AS BIGINT) AS n_folds FROM ({CV_SQL}) t GROUP BY model, metric""",
                                    ["mean", "std_sample", "std_population"]))
def q_ag09(spark, sf_dir):
    """AG-9: mean, sample std and population std over the 5 folds."""
    return ev.fold_summary(cv_long(spark, sf_dir))


@register("ag12_select_model", wrap(f"""
WITH s AS (SELECT model, metric, avg(value) AS mean, CASE model WHEN 'popularity' THEN 1 ELSE 2 END AS complexity
           FROM ({CV_SQL} UNION ALL {_cv_sql(True, "positive_popularity")}) t GROUP BY model, metric),
m AS (SELECT * FROM s WHERE metric = 'map_at_10')
SELECT model, metric, mean, complexity FROM m WHERE mean >= (SELECT max(mean) FROM m) * 0.99
ORDER BY complexity, mean DESC, model LIMIT 1""", ["mean"]))
def q_ag12(spark, sf_dir):
    """AG-12: best MAP@10 model; within 1 % the simpler one wins (popularity vs positive popularity)."""
    s = ev.fold_summary(cv_long(spark, sf_dir, BOTH)).select("model", "metric", "mean", F.when(F.col("model") == "popularity", 1).otherwise(2).alias("complexity"))
    return ev.select_model(s, "map_at_10", 0.01)


# ---------------------------------------------------------------- full ranking of a model (EV-2 / EV-4)
@register("ev02_full_ranking_knn", wrap(with_(**{k: v for k, v in base_sql().items() if k not in ("cand", "ranked", "top", "cnt")}, **knn_sql_on("train"),
    cand=f"""SELECT u.user_id, c.p_partkey AS item_id, {rs('coalesce(sc.score, 0.0)')} AS score FROM (SELECT DISTINCT user_id FROM rel) u CROSS JOIN part c
             LEFT JOIN sc ON sc.user_id = u.user_id AND sc.item_id = c.p_partkey ANTI JOIN train t ON t.user_id = u.user_id AND t.item_id = c.p_partkey""",
    allr="SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM cand",
    rr="SELECT a.user_id, a.rank FROM allr a JOIN rel USING (user_id, item_id)",
    rc="SELECT *, count(*) OVER (PARTITION BY user_id ORDER BY rank ROWS UNBOUNDED PRECEDING) AS cum FROM rr",
    pu="""SELECT user_id, sum(cum / rank) / count(*) AS ap_full,
                 sum(1.0 / log2(rank + 1)) / list_sum([1.0 / log2(x + 1) for x in range(1, count(*) + 1)]) AS ndcg_full FROM rc GROUP BY user_id""") + """
SELECT avg(ap_full) AS map_full, avg(ndcg_full) AS ndcg_full FROM pu""", ["map_full", "ndcg_full"]))
def q_ev02_knn(spark, sf_dir):
    """EV-2 / EV-4 of the item-kNN ranker on fold 0: the place of each relevant item in the whole catalogue, counted block by block."""
    train, test = split(spark, sf_dir)
    cat, rel = catalogue(spark, sf_dir), ev.relevant_items(test)
    ranks = cooccurrence_ranks(train, rel, train, cat, "rating")
    return ev.per_user_full(ranks).agg(F.avg("ap_full").alias("map_full"), F.avg("ndcg_full").alias("ndcg_full"))


# ---------------------------------------------------------------- item-kNN metrics (the flagship model)
@register("ev_knn_at_10", wrap(with_(**{k: v for k, v in base_sql().items() if k not in ("cand", "ranked", "top")},
                                      **knn_sql_on("train"),
                                      kun="SELECT sc.* FROM sc JOIN (SELECT DISTINCT user_id FROM rel) u USING (user_id) ANTI JOIN train USING (user_id, item_id)",
                                      kr=f"SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {rs('score')} DESC, item_id) AS rank FROM kun",
                                      top=f"SELECT * FROM kr WHERE rank <= {K}",
                                      **per_user_sql()) + SUMMARY_SELECT, SUMMARY_COLS))
def q_ev_knn(spark, sf_dir):
    """EV-1..9 for the item-kNN ranker (flagship model) on fold 0."""
    train, test = split(spark, sf_dir)
    rel = ev.relevant_items(test)
    topk = knn_topk(train, rel.select("user_id").distinct())
    return summary_for(train, test, None, topk, rel)


# ---------------------------------------------------------------- W-2 / W-9 / TK / SO / J
@register("w02_full_rank", with_(r=INTERACTIONS) + """
SELECT user_id, item_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS INTEGER) AS rank FROM r""")
def q_w02(spark, sf_dir):
    """W-2: full rank of every user's items (rating desc, item asc)."""
    r = tb.interactions(spark, sf_dir).select("user_id", "item_id", F.col("rating").alias("score"))
    return ranking.full_rank(r).select("user_id", "item_id", "rank")


@register("w09_rank_of", with_(r=INTERACTIONS) + """
, lr AS (SELECT user_id, arg_max(item_id, (ts, item_id)) AS item_id FROM r GROUP BY user_id),
pr AS (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS rank
       FROM r WHERE rating >= 4)
SELECT lr.user_id, lr.item_id, CAST(coalesce(pr.rank, -1) AS INTEGER) AS rank FROM lr LEFT JOIN pr USING (user_id, item_id)""")
def q_w09(spark, sf_dir):
    """W-9: rank of each user's latest item among their liked items, -1 when absent."""
    r = tb.interactions(spark, sf_dir)
    w = F.max_by("item_id", F.struct("ts", "item_id"))
    latest = r.groupBy("user_id").agg(w.alias("item_id"))
    liked = ranking.full_rank(prep.positives(r).select("user_id", "item_id", F.col("rating").alias("score")))
    return ranking.rank_of(liked, latest).select("user_id", "item_id", F.col("rank").cast("int").alias("rank"))


@register("tk01_popular_list", wrap(with_(r=INTERACTIONS) + """
, v AS (SELECT item_id, avg(rating) * 2 * ln(1 + count(*)) AS score FROM r GROUP BY item_id)
SELECT item_id, score, CAST(row_number() OVER (ORDER BY score DESC, item_id) AS INTEGER) AS rank
FROM v ORDER BY score DESC, item_id LIMIT 20""", ["score"]))
def q_tk01(spark, sf_dir):
    """TK-1 / M-13: cold-start list vote_average * log1p(vote_count), best 20."""
    r = tb.interactions(spark, sf_dir)
    v = r.groupBy("item_id").agg((F.avg("rating") * 2).alias("vote_average"), F.count(F.lit(1)).alias("vote_count"))
    return ranking.popular_list(v, 20).select("item_id", "score", F.col("rank").cast("int").alias("rank"))


@register("tk03_cap_users", with_(r=INTERACTIONS) + """
SELECT user_id, CAST(count(*) AS BIGINT) AS n FROM r
WHERE user_id IN (SELECT DISTINCT user_id FROM r ORDER BY user_id LIMIT 100) GROUP BY user_id""")
def q_tk03(spark, sf_dir):
    """TK-3: the evaluation cap is the feature here: the first 100 user ids, rows per user."""
    r = ranking.cap_users(tb.interactions(spark, sf_dir), 100)
    return r.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@register("so01_union_max", with_(r=INTERACTIONS) + """
SELECT item_id, max(score) AS score FROM (
  SELECT item_id, CAST(count(*) AS DOUBLE) AS score FROM r WHERE rating >= 4 GROUP BY item_id
  UNION ALL SELECT item_id, CAST(count(*) AS DOUBLE) FROM r WHERE rating <= 2 GROUP BY item_id) t GROUP BY item_id""")
def q_so01(spark, sf_dir):
    """SO-1: union of two candidate score lists keeping the max per item."""
    r = tb.interactions(spark, sf_dir)
    a = r.where("rating >= 4").groupBy("item_id").agg(F.count(F.lit(1)).cast("double").alias("score"))
    b = r.where("rating <= 2").groupBy("item_id").agg(F.count(F.lit(1)).cast("double").alias("score"))
    return ranking.union_max([a, b], ["item_id"])


@register("so02_difference", with_(r=INTERACTIONS) + """
SELECT p_partkey AS item_id FROM part WHERE p_partkey NOT IN (SELECT item_id FROM r WHERE rating >= 4)""")
def q_so02(spark, sf_dir):
    """SO-2: catalogue items nobody liked (set difference)."""
    cat = tb.items(spark, sf_dir).select("item_id")
    return ranking.difference(cat, prep.positives(tb.interactions(spark, sf_dir)), ["item_id"])


@register("so03_intersection", with_(r=INTERACTIONS) + """
SELECT item_id FROM r JOIN customer ON c_custkey = user_id WHERE c_mktsegment = 'BUILDING'
INTERSECT SELECT item_id FROM r JOIN customer ON c_custkey = user_id WHERE c_mktsegment = 'AUTOMOBILE'""")
def q_so03(spark, sf_dir):
    """SO-3: items bought by both the BUILDING and the AUTOMOBILE segments."""
    r = tb.interactions(spark, sf_dir).join(tb.users(spark, sf_dir), "user_id")
    return ranking.intersection(r.where("segment = 'BUILDING'"), r.where("segment = 'AUTOMOBILE'"), ["item_id"])


@register("j07_title_match", """
WITH ext AS (SELECT DISTINCT '  ' || upper(p_name) || ' ' AS ext_title FROM part)
SELECT ext_title, min(p_partkey) AS item_id FROM ext JOIN part ON lower(trim(p_name)) = lower(trim(ext_title))
GROUP BY ext_title""")
def q_j07(spark, sf_dir):
    """J-7: exact title match after lower+trim, first catalogue match (lowest id) wins."""
    from rankforge.operators.models.external import title_match

    p = tb.items(spark, sf_dir)
    ext = p.select(F.concat(F.lit("  "), F.upper("title"), F.lit(" ")).alias("ext_title")).distinct()
    return title_match(ext, p, "ext_title").select("ext_title", "item_id")


@register("j10_user_attributes", wrap(with_(r=INTERACTIONS) + """
SELECT user_id, item_id, c_mktsegment AS segment, c_acctbal AS balance FROM r JOIN customer ON c_custkey = user_id
WHERE rating >= 4""", ["balance"]))
def q_j10(spark, sf_dir):
    """J-10: user attributes joined onto the training pairs."""
    r = prep.positives(tb.interactions(spark, sf_dir))
    return r.join(tb.users(spark, sf_dir), "user_id").select("user_id", "item_id", "segment", "balance")
