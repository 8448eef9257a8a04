"""Scalar column functions: tags, buckets, query rules, gates, routing, display.

All are Column -> Column expressions evaluated inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------- fixed values
# Null fills for item metadata.
FILL_YEAR = 1990
FILL_VOTE_AVERAGE = 6.34
FILL_POPULARITY = 6.32
FILL_RUNTIME = 106.46
ERA_FILL_YEAR = 2000
# Quality tag edges on vote average, popularity tag edges on log1p(popularity).
QUALITY_EDGES = (5.5, 6.5, 7.5)
QUALITY_TAGS = ("low", "mid", "high", "excellent")
POPULARITY_EDGES = (1.2, 1.8, 2.5)
POPULARITY_TAGS = ("low", "mid", "high", "viral")
# Era bins (left-closed): [0,1970) [1970,1980) [1980,1990) [1990,2000) [2000,2010) [2010,2030)
ERA_EDGES = (0, 1970, 1980, 1990, 2000, 2010, 2030)
ERA_LABELS = ("pre_1970", "1970s", "1980s", "1990s", "2000s", "2010s")
# Genre vocabulary the query rules recognise.
GENRE_VOCAB = ("Action", "Adventure", "Animation", "Children's", "Comedy", "Crime", "Documentary", "Drama",
               "Fantasy", "Film-Noir", "Horror", "Musical", "Mystery", "Romance", "Sci-Fi", "Thriller", "War",
               "Western")
# Phrases that mark a descriptive query (routed to the hypothetical-text pipeline).
HYDE_TRIGGERS = ("like", "similar to", "but more", "but less", "meets", "reminiscent", "à la", "ala", "vibe",
                 "feel of", "style of", "tone of", "atmosphere of", "inspired by", "in the spirit of")
COMPLEX_QUERY_CHARS = 60
HYDE_MIN_CHARS = 30
SUBQUERY_MAX = 2
SUBQUERY_PAD_ALPHA = 0.5
SUBQUERY_FALLBACK_ALPHA = 0.6
RECENT_MIN_YEAR = 1995
DEFAULT_N = 10
RECENCY_RATE = 0.05
NOVELTY_FLOOR = 1e-9
HASH_BUCKETS = 256


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---------------------------------------------------------------- FN-6
def self_information(p: Column | str) -> Column:
    return -F.log2(F.greatest(_c(p), F.lit(NOVELTY_FLOOR)))


def year_recency(year: Column | str, max_year: Column | str) -> Column:
    return F.exp(-F.lit(RECENCY_RATE) * (_c(max_year) - _c(year)))


def pow_decay(age: Column | str, half_life: float) -> Column:
    return F.pow(F.lit(0.5), _c(age) / F.lit(float(half_life)))


# ---------------------------------------------------------------- FN-7
def _edge_tags(x: Column, edges, tags, prefix: str) -> Column:
    e = F.when(x < F.lit(edges[0]), F.lit(f"{prefix}:{tags[0]}"))
    for edge, tag in zip(edges[1:], tags[1:-1]):
        e = e.when(x < F.lit(edge), F.lit(f"{prefix}:{tag}"))
    return e.otherwise(F.lit(f"{prefix}:{tags[-1]}"))


def decade_tag(year: Column | str) -> Column:
    y = F.coalesce(_c(year).cast("int"), F.lit(FILL_YEAR))
    return F.concat(F.lit("decade:"), (F.floor(y / 10) * 10).cast("string"), F.lit("s"))


def quality_tag(vote_average: Column | str) -> Column:
    v = F.coalesce(_c(vote_average).cast("double"), F.lit(FILL_VOTE_AVERAGE))
    return _edge_tags(v, QUALITY_EDGES, QUALITY_TAGS, "quality")


def popularity_tag(popularity: Column | str) -> Column:
    p = F.log1p(F.coalesce(_c(popularity).cast("double"), F.lit(FILL_POPULARITY)))
    return _edge_tags(p, POPULARITY_EDGES, POPULARITY_TAGS, "popularity")


# ---------------------------------------------------------------- FN-8
def era_bucket(year: Column | str) -> Column:
    """Era label; null year -> 2000; years outside [0, 2030) -> null."""
    y = F.coalesce(_c(year).cast("int"), F.lit(ERA_FILL_YEAR))
    e = None
    for lo, hi, lab in zip(ERA_EDGES[:-1], ERA_EDGES[1:], ERA_LABELS):
        cond = (y >= lo) & (y < hi)
        e = F.when(cond, F.lit(lab)) if e is None else e.when(cond, F.lit(lab))
    return e


# ---------------------------------------------------------------- FN-9
def hash_bucket(col: Column | str, buckets: int = HASH_BUCKETS, seed: int = 42) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), _c(col)), F.lit(buckets)).cast("int")


# ---------------------------------------------------------------- FN-11
def query_rules(text: Column | str) -> Column:
    """Rule part of query parsing, as a struct:
    user_id ("user 42", "user_id=42"), n ("top 5", "give me 3"; default 10),
    year_min / year_max ("90s" -> 1990..1999, "before 2000" -> max 1999,
    "recent" -> min 1995), genres (vocabulary words present, vocabulary order)."""
    t = F.lower(_c(text))
    uid = F.regexp_extract(t, r"user(?:_id)?\s*[=:]?\s*(\d+)", 1)
    n_top = F.regexp_extract(t, r"\btop\s+(\d+)", 1)
    n_give = F.regexp_extract(t, r"\bgive\s+me\s+(\d+)", 1)
    dec = F.regexp_extract(t, r"\b(\d0)'?s\b", 1)
    dec4 = F.regexp_extract(t, r"\b(1[89]\d0|20\d0)'?s\b", 1)
    before = F.regexp_extract(t, r"\bbefore\s+(\d{4})\b", 1)
    recent = t.rlike(r"\brecent\b")
    dec_start = F.when(dec4 != "", dec4.cast("int")).when(dec != "", F.lit(1900) + dec.cast("int"))
    genres = F.filter(F.array(*[F.when(t.rlike(r"(^|[^a-z])" + g.lower() + r"($|[^a-z])"), F.lit(g))
                                for g in GENRE_VOCAB]), lambda g: g.isNotNull())
    return F.struct(
        F.when(uid != "", uid.cast("bigint")).alias("user_id"),
        F.coalesce(F.when(n_top != "", n_top.cast("int")), F.when(n_give != "", n_give.cast("int")),
                   F.lit(DEFAULT_N)).alias("n"),
        F.coalesce(dec_start, F.when(recent, F.lit(RECENT_MIN_YEAR))).alias("year_min"),
        F.coalesce(F.when(dec_start.isNotNull(), dec_start + 9),
                   F.when(before != "", before.cast("int") - 1)).alias("year_max"),
        genres.alias("genres"),
    )


# ---------------------------------------------------------------- FN-12
def hyde_gate(query: Column | str, hypothetical: Column | str, semantic: Column | str) -> Column:
    """Accept the hypothetical text if it has >= 30 chars (after trim) and differs from the
    query ignoring case and outer spaces; otherwise the semantic description."""
    h = F.trim(F.coalesce(_c(hypothetical), F.lit("")))
    ok = (F.length(h) >= HYDE_MIN_CHARS) & (F.lower(h) != F.lower(F.trim(_c(query))))
    return F.when(ok, h).otherwise(_c(semantic))


def combined_query(query: Column | str, hyde_text: Column | str) -> Column:
    return F.concat_ws(" ", _c(query), _c(hyde_text))


# ---------------------------------------------------------------- FN-13
def subquery_params(sub_queries: Column | str, alphas: Column | str, semantic: Column | str) -> Column:
    """(sub_queries <= 2, alphas clamped to [0,1] and padded with 0.5); an empty or
    null list falls back to ([semantic], [0.6])."""
    sq = _c(sub_queries)
    al = F.coalesce(_c(alphas), F.array(F.lit(0.5), F.lit(0.5)).cast("array<double>"))
    clamped = F.transform(al, lambda a: F.greatest(F.lit(0.0), F.least(F.lit(1.0), a.cast("double"))))
    padded = F.concat(clamped, F.array_repeat(F.lit(SUBQUERY_PAD_ALPHA),
                                              F.greatest(F.lit(0), F.size(sq) - F.size(clamped))))
    bad = sq.isNull() | (F.size(sq) < 1)
    return F.struct(
        F.when(bad, F.array(_c(semantic))).otherwise(F.slice(sq, 1, SUBQUERY_MAX)).alias("sub_queries"),
        F.when(bad, F.array(F.lit(SUBQUERY_FALLBACK_ALPHA))).otherwise(F.slice(padded, 1, SUBQUERY_MAX))
         .alias("alphas"),
    )


# ---------------------------------------------------------------- FN-14
def is_complex_query(query: Column | str) -> Column:
    q = _c(query)
    lq = F.lower(q)
    trig = F.exists(F.array(*[F.lit(t) for t in HYDE_TRIGGERS]), lambda t: F.instr(lq, t) > 0)
    return (F.length(q) > COMPLEX_QUERY_CHARS) | trig


def route_query(query: Column | str, user_id: Column | str, forced: Column | str | None = None) -> Column:
    """Pipeline per query row: blank -> 'none'; forced P1..P5 (a user-needing route without a
    user -> P3); unknown forced name -> 'error'; auto: no user -> P3, complex -> P4, else P2."""
    q, u = _c(query), _c(user_id)
    auto = F.when(u.isNull(), F.lit("P3")).when(is_complex_query(q), F.lit("P4")).otherwise(F.lit("P2"))
    blank = q.isNull() | (F.trim(q) == "")
    if forced is None:
        return F.when(blank, F.lit("none")).otherwise(auto)
    f = F.upper(F.coalesce(_c(forced), F.lit("auto")))
    chosen = F.when(f == "AUTO", auto).otherwise(f)
    return (F.when(blank, F.lit("none"))
            .when(~chosen.isin("P1", "P2", "P3", "P4", "P5"), F.lit("error"))
            .when(u.isNull() & chosen.isin("P1", "P2", "P4", "P5"), F.lit("P3"))
            .otherwise(chosen))


# ---------------------------------------------------------------- FN-15
def template_explanation(title: Column | str, overlap: Column | str, first_genre: Column | str,
                         influence_title: Column | str, director: Column | str) -> Column:
    """"We recommend '<title>' because you liked <overlap or first genre> films like
    '<top influence or "similar films">'<, directed by D>."""
    ov = F.when(F.size(_c(overlap)) > 0, F.array_join(_c(overlap), ", ")).otherwise(_c(first_genre))
    inf = F.coalesce(_c(influence_title), F.lit("similar films"))
    d = _c(director)
    dir_str = F.when(d.isNull() | d.isin("", "nan", "Unknown"), F.lit("")).otherwise(
        F.concat(F.lit(", directed by "), d))
    return F.concat(F.lit("We recommend '"), _c(title), F.lit("' because you liked "), ov,
                    F.lit(" films like '"), inf, F.lit("'"), dir_str, F.lit("."))


# ---------------------------------------------------------------- FN-16
def badge(score: Column | str, rank: Column | str) -> Column:
    """1-based rank: rank 1 or score > 1.0 -> Top Pick; > 0.5 -> Trending; else Hidden Gem."""
    s = _c(score)
    return (F.when((_c(rank) == 1) | (s > 1.0), F.lit("Top Pick"))
            .when(s > 0.5, F.lit("Trending")).otherwise(F.lit("Hidden Gem")))


def score_percent(score: Column | str) -> Column:
    """round((clip(score, -2, 2) + 2) / 4 * 100), halves rounded up."""
    s = F.greatest(F.lit(-2.0), F.least(F.lit(2.0), _c(score).cast("double")))
    return F.floor((s + 2) / 4 * 100 + 0.5).cast("int")


# ---------------------------------------------------------------- FN-17
def genre_query(top_genres: Column | str) -> Column:
    g = _c(top_genres)
    return F.when(g.isNull() | (F.size(g) == 0), F.lit("a popular well-rated movie")).otherwise(
        F.concat(F.lit("a "), F.lower(F.array_join(g, " ")), F.lit(" film, highly rated and engaging")))


# ---------------------------------------------------------------- FN-18
PARSED_QUERY_SCHEMA = (
    "user_id BIGINT, item_id BIGINT, director_filter STRING, genre_filter ARRAY<STRING>, "
    "year_range STRUCT<min: INT, max: INT>, mood_keywords ARRAY<STRING>, intent STRING, n INT, "
    "semantic_description STRING, hypothetical_ideal STRING, db_satisfiable BOOLEAN, constraint_notes STRING"
)


def safe_parse(js: Column | str) -> Column:
    """Parse a parsed-query JSON string; a one-key wrapper object is unwrapped; bad JSON -> null."""
    j = F.trim(_c(js))
    m = F.from_json(j, "map<string,string>")
    first = F.try_element_at(F.map_values(m), F.lit(1))
    one = (F.size(m) == 1) & F.ltrim(first).startswith("{")
    inner = F.when(one, first).otherwise(j)
    return F.from_json(inner, PARSED_QUERY_SCHEMA)


# ---------------------------------------------------------------- PF-10
def fill_query_defaults(parsed: Column | str, original_text: Column | str) -> Column:
    p = _c(parsed)
    sem = p.getField("semantic_description")
    return F.struct(
        p.getField("user_id").alias("user_id"),
        p.getField("item_id").alias("item_id"),
        p.getField("director_filter").alias("director_filter"),
        p.getField("genre_filter").alias("genre_filter"),
        F.coalesce(p.getField("year_range"),
                   F.struct(F.lit(None).cast("int").alias("min"), F.lit(None).cast("int").alias("max")))
         .alias("year_range"),
        p.getField("mood_keywords").alias("mood_keywords"),
        F.coalesce(p.getField("intent"), F.lit("recommendation")).alias("intent"),
        F.coalesce(p.getField("n"), F.lit(DEFAULT_N)).alias("n"),
        F.when(sem.isNull() | (F.trim(sem) == ""), _c(original_text)).otherwise(sem).alias("semantic_description"),
        F.coalesce(p.getField("hypothetical_ideal"), F.lit("")).alias("hypothetical_ideal"),
        F.coalesce(p.getField("db_satisfiable"), F.lit(True)).alias("db_satisfiable"),
        F.coalesce(p.getField("constraint_notes"), F.lit("")).alias("constraint_notes"),
    )


def fill_item_defaults(year: str = "year", vote_average: str = "vote_average", popularity: str = "popularity",
                       runtime: str = "runtime") -> list[Column]:
    return [F.coalesce(F.col(year), F.lit(FILL_YEAR)).alias(year),
            F.coalesce(F.col(vote_average), F.lit(FILL_VOTE_AVERAGE)).alias(vote_average),
            F.coalesce(F.col(popularity), F.lit(FILL_POPULARITY)).alias(popularity),
            F.coalesce(F.col(runtime), F.lit(FILL_RUNTIME)).alias(runtime)]


# ---------------------------------------------------------------- PF-11
def display_score(*cols: Column | str) -> Column:
    """First non-zero, non-null of the given scores (fused, mix, dense-norm, score), else 0."""
    return F.coalesce(*[F.nullif(_c(c).cast("double"), F.lit(0.0)) for c in cols], F.lit(0.0))
