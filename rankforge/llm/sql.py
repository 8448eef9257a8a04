"""DuckDB SQL for the queries of this subpackage that SQL can express on whole tables."""

from __future__ import annotations

#: Records with equal payloads of at least 100 bytes: the smallest page_id is the response.
OP4 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest FROM p),
r AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM q)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM r
"""

#: Longest fitting host and path rule; where none fits, any pattern blocks.
OP7 = r"""
WITH u AS (
  SELECT page_id, coalesce(url, '') AS url,
         lower(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1)) AS host,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path FROM pages),
rules(verdict, rhost, rpath) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fit AS (
  SELECT u.*, (SELECT max(struct_pack(n := length(rhost || rpath), rule := rhost || rpath, verdict := verdict))
               FROM rules WHERE (u.host = rhost OR ends_with(u.host, '.' || rhost)) AND starts_with(u.path, rpath)) AS r FROM u)
SELECT page_id, host, path, r.rule AS rule,
       coalesce(r.verdict, CASE WHEN regexp_matches(lower(url),
         '\bads?[-_.]track|\bspam[-_.]farm\b|\bcasino([-_.](win|bet|slots))?\b|\bcheap[-_.]pills?\b|\badult[-_.][a-z0-9]+|[?&]utm_source=spam\b')
         THEN 'block' ELSE 'allow' END) AS verdict
FROM fit
"""


#: Runs of 1 to 3 words, their CRC-32 taken a nibble at a time, gains by bucket, and the draw by Gumbel keys.
OP11 = r"""
WITH d AS (SELECT doc_id AS id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT -row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
a AS (SELECT r, ws FROM d UNION ALL SELECT r, ws FROM b),
g AS (SELECT r, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]),
                                  list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]))) AS f FROM a),
k AS (SELECT r, f, count(*) AS n FROM g GROUP BY r, f),
h AS (SELECT f, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(2 * strlen(f)), lambda j: strpos('0123456789ABCDEF', substr(hex(f), CASE WHEN j % 2 = 0 THEN j + 2 ELSE j END, 1)) - 1)),
        lambda c, x: xor(c >> 4, [0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948,
                               3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108][1 + (xor(c, x) & 15)]))) % 10000 AS bucket
      FROM (SELECT DISTINCT f FROM k)),
kb AS (SELECT r, bucket, sum(n) AS n FROM k JOIN h USING (f) GROUP BY r, bucket),
t AS (SELECT bucket, sum(CASE WHEN r > 0 THEN n ELSE 0 END)::DOUBLE AS s, sum(CASE WHEN r < 0 THEN n ELSE 0 END)::DOUBLE AS t FROM kb GROUP BY bucket),
al AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM t),
gain AS (SELECT bucket, floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000))))::BIGINT AS gain FROM t, al),
w AS (SELECT r, sum(n * gain)::BIGINT AS weight, sum(n)::BIGINT AS n_features FROM kb JOIN gain USING (bucket) WHERE r > 0 GROUP BY r),
x AS (SELECT d.id AS doc_id, len(ws) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
             coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(d.id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
      FROM d LEFT JOIN w USING (r)),
y AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place, count(*) OVER (PARTITION BY n_words >= 20) AS able FROM x)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 5 * able // 100 THEN place END AS rank FROM y
"""

#: Targets by the water level, finish times by running totals, everything cut where the budget is used up.
OP12 = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                  ('0x' || substr(md5('42:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS place FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS number FROM d GROUP BY source),
w AS (SELECT *, [5.0::DOUBLE, 2, 1][(number - 1) % 3 + 1] AS weight, 2 * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS budget FROM s),
l AS (SELECT *, sum(cap) OVER o + cap / weight * (sum(weight) OVER () - sum(weight) OVER o) <= budget AS capped FROM w WINDOW o AS (ORDER BY cap / weight, number)),
v AS (SELECT any_value(budget) AS budget, (any_value(budget) - coalesce(sum(cap) FILTER (capped), 0)) / sum(weight) FILTER (NOT capped) AS level FROM l),
t AS (SELECT source, source_size, number, CASE WHEN capped THEN cap::DOUBLE ELSE weight * level END AS target, floor(v.budget)::BIGINT AS budget FROM l, v),
q AS (SELECT row_number() OVER () AS r, doc_id, size, source_size, target, number, budget, sum(size) OVER (PARTITION BY t.number ORDER BY place, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS size_to
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT r, size, number, budget, (size_to + k * source_size) / target AS finish FROM q, (VALUES (0), (1)) AS x(k) WHERE size > 0),
n AS (SELECT r, size, budget, sum(size) OVER (ORDER BY finish, number ROWS UNBOUNDED PRECEDING) AS sent FROM c),
m AS (SELECT r, sum(greatest(0, least(size, budget - (sent - size))))::BIGINT AS taken FROM n GROUP BY r)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken FROM q LEFT JOIN m USING (r)
"""

#: All phrases of 1 to 5 words by language, the lowest cut of each, those inside an equally frequent longer one dropped.
OP13 = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
o AS (SELECT lang, m, unnest(list_transform(range(1, len(ws) - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))) AS phrase FROM w, (VALUES (1), (2), (3), (4), (5)) AS x(m) WHERE len(ws) >= m),
f AS (SELECT lang, phrase, m, count(*) AS a FROM o GROUP BY lang, phrase, m),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE m > 1 AND a >= 100),
cut AS (SELECT lang, phrase, a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head, array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS rest
        FROM c, (VALUES (1), (2), (3), (4)) AS x(k) WHERE k < m),
s AS (SELECT cut.lang, cut.phrase, cut.a, k, l.a AS l, r.a AS r, n, (1000::HUGEINT * cut.a * n // (l.a::HUGEINT * r.a))::BIGINT AS score
      FROM cut JOIN f l ON l.lang = cut.lang AND l.phrase = cut.head JOIN f r ON r.lang = cut.lang AND r.phrase = cut.rest JOIN n ON n.lang = cut.lang),
e AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS lowest FROM s),
i AS (SELECT lang, phrase, m, a, unnest([array_to_string(string_split(phrase, ' ')[1:m - 1], ' '), array_to_string(string_split(phrase, ' ')[2:], ' ')]) AS part FROM c WHERE m > 2),
x AS (SELECT lang, part, max(a) AS longer FROM i GROUP BY lang, part),
z AS (SELECT e.*, row_number() OVER (PARTITION BY e.lang ORDER BY score DESC, a DESC, phrase) AS rank FROM e LEFT JOIN x ON x.lang = e.lang AND x.part = e.phrase WHERE lowest = 1 AND (longer IS NULL OR longer < a))
SELECT lang, rank, phrase, a, l, r, n, score FROM z WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_zip_warc": OP4, "op7_url_rules": OP7, "op11_importance_resampling": OP11, "op12_fair_queueing": OP12, "op13_suffix_collocations": OP13}
