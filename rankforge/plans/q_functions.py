"""Registered queries: scalar functions FN-1..FN-18 over columns of the driver tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from rankforge.functions import lists, scalars, text, vectors
from rankforge.operators import prep
from rankforge.operators.common import with_scalars
from rankforge.operators.prep import user_top_genres
from rankforge.plans.registry import register
from rankforge.plans.sqlparts import INTERACTIONS, with_, wrap
from rankforge.sources import tables as tb


def _to_list_sql(s: str, max_items: int | None = None) -> str:
    arr = (f"CASE WHEN {s} IS NULL OR trim({s}) IN ('', 'nan', '[]') THEN []::VARCHAR[] "
           f"WHEN starts_with(trim({s}), '[') THEN regexp_extract_all(trim({s}), '[''\"]([^''\"]*)[''\"]', 1) "
           f"WHEN contains(trim({s}), '|') THEN string_split(trim({s}), '|') ELSE string_split(trim({s}), ',') END")
    arr = f"list_filter(list_transform({arr}, lambda x: trim(x)), lambda x: x <> '')"
    return f"{arr}[1:{max_items}]" if max_items else arr


ENC = ("SELECT p_partkey AS item_id, '[''' || replace(p_name, ' ', ''', ''') || ''']' AS enc_py, "
       "replace(p_name, ' ', '|') AS enc_pipe, replace(p_name, ' ', ', ') AS enc_comma FROM part")


@register("fn01_to_list", with_(e=ENC) + f"""
SELECT item_id, array_to_string({_to_list_sql('enc_py')}, ';') AS from_literal,
       array_to_string({_to_list_sql('enc_pipe')}, ';') AS from_pipe,
       array_to_string({_to_list_sql('enc_comma', 1)}, ';') AS first_from_comma,
       CAST(len({_to_list_sql('enc_py')}) AS INTEGER) AS n_items
FROM e""")
def q_fn01(spark, sf_dir):
    """FN-1: list literal / pipe / comma encodings of each part name -> arrays."""
    p = tb.table(spark, sf_dir, "part")
    e = p.select(F.col("p_partkey").alias("item_id"),
                 F.concat(F.lit("['"), F.regexp_replace("p_name", " ", "', '"), F.lit("']")).alias("enc_py"),
                 F.regexp_replace("p_name", " ", "|").alias("enc_pipe"),
                 F.regexp_replace("p_name", " ", ", ").alias("enc_comma"))
    return e.select("item_id", F.array_join(lists.to_list("enc_py"), ";").alias("from_literal"),
                    F.array_join(lists.to_list("enc_pipe"), ";").alias("from_pipe"),
                    F.array_join(lists.to_list("enc_comma", max_items=1), ";").alias("first_from_comma"),
                    F.size(lists.to_list("enc_py")).alias("n_items"))


@register("fn02_compound_tokens", """
SELECT p_partkey AS item_id, replace(p_name, ' ', '_') || ' ' || replace(p_brand, ' ', '_') AS tokens FROM part""")
def q_fn02(spark, sf_dir):
    """FN-2: multi-word values joined as single tokens."""
    p = tb.table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("item_id"),
                    lists.compound_tokens(F.array("p_name", "p_brand")).alias("tokens"))


KW_SQL = ("list_filter(string_split_regex(trim(regexp_replace(lower(text), '[^a-z0-9\\s]', ' ', 'g')), '\\s+'), "
          "lambda x: length(x) > 1)")


@register("fn03_tokenize_keyword", f"""
SELECT doc_id, CAST(len({KW_SQL}) AS INTEGER) AS n_tokens, array_to_string({KW_SQL}, ' ') AS tokens
FROM documents""")
def q_fn03(spark, sf_dir):
    """FN-3: keyword-index tokens of every whole document."""
    d = tb.table(spark, sf_dir, "documents")
    t = text.tokenize_keyword("text")
    return d.select("doc_id", F.size(t).alias("n_tokens"), F.array_join(t, " ").alias("tokens"))


TF_SQL = "regexp_extract_all(lower(text), '[\\pL\\pN_]{2,}')"


@register("fn04_tokenize_tfidf", f"""
SELECT doc_id, CAST(len({TF_SQL}) AS INTEGER) AS n_tokens, array_to_string({TF_SQL}, ' ') AS tokens
FROM documents""")
def q_fn04(spark, sf_dir):
    """FN-4: vectoriser tokens (Unicode word runs of length >= 2) of every whole document."""
    d = tb.table(spark, sf_dir, "documents")
    t = text.tokenize_tfidf("text")
    return d.select("doc_id", F.size(t).alias("n_tokens"), F.array_join(t, " ").alias("tokens"))


@register("fn05_char_ngrams", with_(b="SELECT p_partkey AS item_id, regexp_replace(lower(p_brand), '\\s\\s+', ' ', 'g') AS s FROM part") + """
SELECT item_id, array_to_string(list_concat([substr(s, i, 2) for i in range(1, length(s))],
                                            [substr(s, i, 3) for i in range(1, length(s) - 1)]), '|') AS ngrams
FROM b""")
def q_fn05(spark, sf_dir):
    """FN-5: character 2- and 3-grams of each brand."""
    p = tb.table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("item_id"), F.array_join(text.char_ngrams("p_brand"), "|").alias("ngrams"))


R = with_(r=INTERACTIONS)


@register("fn06_math", wrap(R + """
, c AS (SELECT item_id, count(*) / (SELECT count(DISTINCT user_id) FROM r) AS pop_ratio FROM r GROUP BY item_id)
SELECT p_partkey AS item_id, -log2(greatest(coalesce(c.pop_ratio, 0), 1e-9)) AS self_information,
       exp(-0.05 * ((SELECT max(1950 + p_size) FROM part) - (1950 + p_size))) AS recency,
       ln(1 + p_retailprice) AS log_price, pow(0.5, p_size / 10.0) AS size_decay
FROM part LEFT JOIN c ON c.item_id = p_partkey""", ["self_information", "recency", "log_price", "size_decay"]))
def q_fn06(spark, sf_dir):
    """FN-6: self-information, year recency, log1p, power decay."""
    c = prep.item_counts(tb.interactions(spark, sf_dir)).select("item_id", "pop_ratio")
    it = tb.items(spark, sf_dir)
    my = it.agg(F.max("year").alias("_my"))
    j = with_scalars(it.join(c, "item_id", "left"), my)
    return j.select("item_id", scalars.self_information(F.coalesce("pop_ratio", F.lit(0.0))).alias("self_information"),
                    scalars.year_recency("year", "_my").alias("recency"),
                    F.log1p("popularity").alias("log_price"),
                    scalars.pow_decay(F.col("year") - 1950, 10.0).alias("size_decay"))


VOTES = "SELECT item_id, avg(rating) * 2 AS vote_average, avg(rating) AS mean_rating FROM r GROUP BY item_id"


@register("fn07_tags", with_(r=INTERACTIONS, v=VOTES) + """
SELECT p_partkey AS item_id,
  'decade:' || CAST(CAST(floor((1950 + p_size) / 10) * 10 AS BIGINT) AS VARCHAR) || 's' AS decade,
  CASE WHEN coalesce(v.vote_average, 6.34) < 5.5 THEN 'quality:low' WHEN coalesce(v.vote_average, 6.34) < 6.5 THEN 'quality:mid'
       WHEN coalesce(v.vote_average, 6.34) < 7.5 THEN 'quality:high' ELSE 'quality:excellent' END AS quality,
  CASE WHEN ln(1 + coalesce(v.mean_rating, 6.32)) < 1.2 THEN 'popularity:low' WHEN ln(1 + coalesce(v.mean_rating, 6.32)) < 1.8 THEN 'popularity:mid'
       WHEN ln(1 + coalesce(v.mean_rating, 6.32)) < 2.5 THEN 'popularity:high' ELSE 'popularity:viral' END AS popularity
FROM part LEFT JOIN v ON v.item_id = p_partkey""")
def q_fn07(spark, sf_dir):
    """FN-7: decade / quality / popularity tags (vote average = 2 x mean rating, popularity = mean rating)."""
    r = tb.interactions(spark, sf_dir)
    v = r.groupBy("item_id").agg((F.avg("rating") * 2).alias("vote_average"), F.avg("rating").alias("mean_rating"))
    j = tb.items(spark, sf_dir).join(v, "item_id", "left")
    return j.select("item_id", scalars.decade_tag("year").alias("decade"),
                    scalars.quality_tag("vote_average").alias("quality"),
                    scalars.popularity_tag("mean_rating").alias("popularity"))


@register("fn08_era", """
SELECT p_partkey AS item_id, CASE WHEN 1950 + p_size < 1970 THEN 'pre_1970' WHEN 1950 + p_size < 1980 THEN '1970s'
  WHEN 1950 + p_size < 1990 THEN '1980s' WHEN 1950 + p_size < 2000 THEN '1990s' WHEN 1950 + p_size < 2010 THEN '2000s'
  WHEN 1950 + p_size < 2030 THEN '2010s' END AS era FROM part""")
def q_fn08(spark, sf_dir):
    """FN-8: era bucket of the item year."""
    return tb.items(spark, sf_dir).select("item_id", scalars.era_bucket("year").alias("era"))


@register("fn09_hash_bucket")
def q_fn09(spark, sf_dir):
    """FN-9: seeded xxhash64 bucket (mod 256) of each document's source (rows check only)."""
    d = tb.table(spark, sf_dir, "documents")
    return d.select("doc_id", scalars.hash_bucket("source").alias("bucket"))


VEC = "CAST(embedding AS DOUBLE[])"


@register("fn10_vectors", wrap(f"""
SELECT vec_id, sqrt(list_sum(list_transform({VEC}, lambda x: x * x))) AS norm,
  list_sum(list_transform({VEC}, lambda x: greatest(x, 0.0))) AS relu_sum,
  list_sum(list_transform(list_zip({VEC}, list_reverse({VEC})), lambda p: p[1] * p[2]))
    / (sqrt(list_sum(list_transform({VEC}, lambda x: x * x))) * sqrt(list_sum(list_transform({VEC}, lambda x: x * x))) + 1e-8)
    AS cos_reverse,
  greatest(-0.1, least(0.1, {VEC}[1])) AS first_clipped
FROM embeddings""", ["norm", "relu_sum", "cos_reverse", "first_clipped"]))
def q_fn10(spark, sf_dir):
    """FN-10: norm, ReLU, cosine (with the reversed vector), clip."""
    e = tb.vectors(spark, sf_dir).select(F.col("item_id").alias("vec_id"),
                                          F.col("vector").cast("array<double>").alias("v"))
    return e.select("vec_id", vectors.norm("v").alias("norm"),
                    F.aggregate(vectors.relu("v"), F.lit(0.0), lambda a, x: a + x).alias("relu_sum"),
                    vectors.cosine("v", F.reverse("v")).alias("cos_reverse"),
                    vectors.clip(F.element_at("v", 1), -0.1, 0.1).alias("first_clipped"))


GENRES_SQL = "[" + ", ".join("'" + g.replace("'", "''") + "'" for g in scalars.GENRE_VOCAB) + "]"


@register("fn11_query_rules", f"""
WITH q AS (SELECT conv_id, turn, lower(text) AS t FROM conversations WHERE role = 'user'),
e AS (SELECT conv_id, turn, t,
  regexp_extract(t, 'user(?:_id)?\\s*[=:]?\\s*(\\d+)', 1) AS uid, regexp_extract(t, '\\btop\\s+(\\d+)', 1) AS ntop,
  regexp_extract(t, '\\bgive\\s+me\\s+(\\d+)', 1) AS ngive, regexp_extract(t, '\\b(\\d0)''?s\\b', 1) AS dec,
  regexp_extract(t, '\\b(1[89]\\d0|20\\d0)''?s\\b', 1) AS dec4, regexp_extract(t, '\\bbefore\\s+(\\d{{4}})\\b', 1) AS bef,
  regexp_matches(t, '\\brecent\\b') AS recent FROM q),
d AS (SELECT *, CASE WHEN dec4 <> '' THEN CAST(dec4 AS INTEGER) WHEN dec <> '' THEN 1900 + CAST(dec AS INTEGER) END AS ds FROM e)
SELECT conv_id, turn, CASE WHEN uid <> '' THEN CAST(uid AS BIGINT) END AS user_id,
  coalesce(CASE WHEN ntop <> '' THEN CAST(ntop AS INTEGER) END, CASE WHEN ngive <> '' THEN CAST(ngive AS INTEGER) END, 10) AS n,
  coalesce(ds, CASE WHEN recent THEN 1995 END) AS year_min,
  coalesce(ds + 9, CASE WHEN bef <> '' THEN CAST(bef AS INTEGER) - 1 END) AS year_max,
  array_to_string(list_filter({GENRES_SQL}, lambda g: regexp_matches(t, '(^|[^a-z])' || lower(g) || '($|[^a-z])')), '|') AS genres
FROM d""")
def q_fn11(spark, sf_dir):
    """FN-11: rule part of query parsing over every user turn of the conversations."""
    c = tb.table(spark, sf_dir, "conversations").where(F.col("role") == "user")
    r = c.select("conv_id", "turn", scalars.query_rules("text").alias("q"))
    return r.select("conv_id", "turn", "q.user_id", "q.n", "q.year_min", "q.year_max",
                    F.array_join("q.genres", "|").alias("genres"))


@register("fn12_hyde_gate", """
SELECT u.conv_id, u.turn,
  length(trim(coalesce(a.text, ''))) >= 30 AND lower(trim(coalesce(a.text, ''))) <> lower(trim(u.text)) AS accepted,
  CAST(length(CASE WHEN length(trim(coalesce(a.text, ''))) >= 30 AND lower(trim(coalesce(a.text, ''))) <> lower(trim(u.text))
                   THEN trim(coalesce(a.text, '')) ELSE u.text END) AS INTEGER) AS text_len,
  CAST(length(concat_ws(' ', u.text, CASE WHEN length(trim(coalesce(a.text, ''))) >= 30
       AND lower(trim(coalesce(a.text, ''))) <> lower(trim(u.text)) THEN trim(coalesce(a.text, '')) ELSE u.text END)) AS INTEGER)
    AS combined_len
FROM conversations u LEFT JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
WHERE u.role = 'user'""")
def q_fn12(spark, sf_dir):
    """FN-12: the following assistant turn as the hypothetical text, gated (>= 30 chars, not the query)."""
    c = tb.table(spark, sf_dir, "conversations")
    u = c.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("q"))
    a = c.where(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("h"))
    j = u.join(a, ["conv_id", "turn"], "left")
    g = scalars.hyde_gate("q", "h", "q")
    h = F.trim(F.coalesce("h", F.lit("")))
    acc = (F.length(h) >= 30) & (F.lower(h) != F.lower(F.trim("q")))
    return j.select("conv_id", "turn", acc.alias("accepted"), F.length(g).alias("text_len"),
                    F.length(scalars.combined_query("q", g)).alias("combined_len"))


@register("fn13_subquery_params", wrap("""
WITH s AS (SELECT conv_id, list(text ORDER BY turn) FILTER (WHERE role = 'user') AS subs,
                  list(turn * 0.4 - 0.2 ORDER BY turn) FILTER (WHERE role = 'assistant') AS al,
                  first(text ORDER BY turn) AS semantic FROM conversations GROUP BY conv_id),
p AS (SELECT conv_id, subs, semantic,
        list_concat(list_transform(coalesce(al, [0.5, 0.5]), lambda a: greatest(0.0, least(1.0, CAST(a AS DOUBLE)))),
                    list_transform(range(greatest(0, len(coalesce(subs, [])) - len(coalesce(al, [0.5, 0.5])))), lambda i: 0.5)) AS padded
      FROM s)
SELECT conv_id,
  CAST(CASE WHEN subs IS NULL OR len(subs) < 1 THEN 1 ELSE len(subs[1:2]) END AS INTEGER) AS n_sub,
  CASE WHEN subs IS NULL OR len(subs) < 1 THEN semantic ELSE subs[1] END AS sub1,
  CASE WHEN subs IS NULL OR len(subs) < 1 THEN 0.6 ELSE padded[1] END AS alpha1,
  CASE WHEN subs IS NULL OR len(subs) < 1 THEN NULL ELSE padded[2] END AS alpha2
FROM p""", ["alpha1", "alpha2"]))
def q_fn13(spark, sf_dir):
    """FN-13: user turns as sub-queries (keep 2), alphas from assistant turns clamped and padded."""
    c = tb.table(spark, sf_dir, "conversations")
    subs = c.where(F.col("role") == "user").groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("_s"))
    al = c.where(F.col("role") == "assistant").groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", (F.col("turn") * 0.4 - 0.2).alias("a")))).alias("_a"))
    sem = c.groupBy("conv_id").agg(F.min_by("text", "turn").alias("semantic"))
    j = sem.join(subs, "conv_id", "left").join(al, "conv_id", "left")
    p = scalars.subquery_params(F.transform("_s", lambda x: x["text"]), F.transform("_a", lambda x: x["a"]), "semantic")
    j = j.select("conv_id", p.alias("p"))
    return j.select("conv_id", F.size("p.sub_queries").alias("n_sub"), F.element_at("p.sub_queries", 1).alias("sub1"),
                    F.element_at("p.alphas", 1).alias("alpha1"),
                    F.when(F.size("p.alphas") >= 2, F.element_at("p.alphas", 2)).alias("alpha2"))


# Query table used by the routing / pipeline queries: one query per benchmark passage,
# issued by the latest buyer of the passage's part (none -> no user).
QUERIES_SQL = """
SELECT b.item_id AS query_id, b.text AS text,
       (SELECT arg_max(user_id, (ts, user_id)) FROM r WHERE r.item_id = b.item_id) AS user_id
FROM benchmark b"""


def query_table(spark, sf_dir):
    q = tb.benchmark_queries(spark, sf_dir)
    r = tb.interactions(spark, sf_dir)
    w = Window.partitionBy("item_id").orderBy(F.col("ts").desc(), F.col("user_id").desc())
    buyer = r.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(
        F.col("item_id").alias("query_id"), "user_id")
    return q.join(buyer, "query_id", "left")


TRIG_SQL = " OR ".join(f"contains(lower(text), '{t}')" for t in scalars.HYDE_TRIGGERS)


@register("fn14_route_query", with_(r=INTERACTIONS, q=QUERIES_SQL) + f"""
SELECT query_id, CASE WHEN text IS NULL OR trim(text) = '' THEN 'none' WHEN user_id IS NULL THEN 'P3'
  WHEN length(text) > 60 OR {TRIG_SQL} THEN 'P4' ELSE 'P2' END AS route,
  (length(text) > 60 OR {TRIG_SQL}) AS complex
FROM q""")
def q_fn14(spark, sf_dir):
    """FN-14: route every benchmark query (user = latest buyer of its part)."""
    q = query_table(spark, sf_dir)
    return q.select("query_id", scalars.route_query("text", "user_id").alias("route"),
                    scalars.is_complex_query("text").alias("complex"))


@register("fn18_safe_parse", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS n, event_type AS intent,
       true AS db_satisfiable, 'recommendation' <> event_type AS custom_intent
FROM events""")
def q_fn18(spark, sf_dir):
    """FN-18 / PF-10: a one-key wrapper JSON per event, unwrapped, parsed and defaulted."""
    ev = tb.table(spark, sf_dir, "events")
    js = F.concat(F.lit('{"query": {"n": '), F.get_json_object("props", "$.k"), F.lit(', "intent": "'),
                  F.col("event_type"), F.lit('"}}'))
    p = scalars.fill_query_defaults(scalars.safe_parse(js), F.lit(""))
    return ev.select("event_id", p["n"].alias("n"), p["intent"].alias("intent"),
                     p["db_satisfiable"].alias("db_satisfiable"),
                     (F.lit("recommendation") != p["intent"]).alias("custom_intent"))


ITEM_GENRES = "SELECT p_partkey AS item_id, p_name AS title, p_brand AS director, unnest(string_split(p_name, ' ')) AS genre FROM part"


TOPG_SQL = """
SELECT user_id, genre, n, rank FROM (
  SELECT user_id, genre, CAST(count(*) AS BIGINT) AS n,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, genre) AS INTEGER) AS rank
  FROM r JOIN g USING (item_id) WHERE rating >= 4 GROUP BY user_id, genre) t WHERE rank <= 3"""


@register("ag10_user_top_genres", with_(r=INTERACTIONS, g=ITEM_GENRES) + TOPG_SQL)
def q_ag10(spark, sf_dir):
    """AG-10: each user's three most frequent genres among liked items (ties by genre)."""
    return user_top_genres(tb.interactions(spark, sf_dir), tb.items(spark, sf_dir))


@register("fn17_genre_query", with_(r=INTERACTIONS, g=ITEM_GENRES, t=TOPG_SQL) + """
SELECT u.user_id, CASE WHEN t2.genres IS NULL THEN 'a popular well-rated movie'
  ELSE 'a ' || lower(t2.genres) || ' film, highly rated and engaging' END AS text
FROM (SELECT DISTINCT user_id FROM r) u
LEFT JOIN (SELECT user_id, string_agg(genre, ' ' ORDER BY rank) AS genres FROM t GROUP BY user_id) t2 USING (user_id)""")
def q_fn17(spark, sf_dir):
    """FN-17: genre query text from each user's top-3 genres; a default sentence when none."""
    r = tb.interactions(spark, sf_dir)
    t = user_top_genres(r, tb.items(spark, sf_dir))
    tg = t.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("rank", "genre"))).alias("_g")) \
        .select("user_id", F.transform("_g", lambda x: x["genre"]).alias("genres"))
    u = r.select("user_id").distinct().join(tg, "user_id", "left")
    return u.select("user_id", scalars.genre_query("genres").alias("text"))


@register("ag07_value_counts", with_(g=ITEM_GENRES) + """
SELECT genre AS value, CAST(count(DISTINCT item_id) AS BIGINT) AS n_items FROM g GROUP BY genre""")
def q_ag07(spark, sf_dir):
    """AG-7: value counts of a list field (genre words of part names)."""
    from rankforge.operators.features import value_counts

    return value_counts(tb.items(spark, sf_dir), "genres")
