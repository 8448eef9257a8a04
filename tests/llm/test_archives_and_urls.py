from __future__ import annotations

import hashlib
import io
import os
import sys
import zipfile


import pytest
from pyarrow import fs

sys.path.insert(0, os.path.dirname(__file__))
sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

from oracle_check import compare, duck  # noqa: E402

from rankforge.llm import queries, sql, url_rules, zip_warc  # noqa: E402


@pytest.mark.parametrize("name", sorted(sql.oracle_sql()))
def test_query_matches_its_sql(spark, small_dir, name):
    res = compare(spark, name, queries.queries()[name], sql.oracle_sql()[name], small_dir, duck(small_dir))
    assert res["cols_match"] and res["hash_match"] and res["spark_rows"] == res["duck_rows"] > 0, res


def reader(data, tmp_path):
    (tmp_path / "x.zip").write_bytes(data)
    return zip_warc.PackageReader(fs.LocalFileSystem().open_input_file(str(tmp_path / "x.zip")))


@pytest.mark.parametrize("zip64", [False, True])
def test_packages_are_zip_files(tmp_path, zip64):
    data = zip_warc.package([("a/é", b"12345"), ("b", b""), (zip_warc.INDEX, b"k 0 {}\n")], zip64)
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        assert z.testzip() is None and z.read("a/é") == b"12345" and z.namelist() == ["a/é", "b", zip_warc.INDEX]
    r = reader(data, tmp_path)
    assert [*r.members] == ["a/é", "b", zip_warc.INDEX] and r.read("a/é", 1, 3) == b"234" and r.read("b") == b""
    assert r.index() == [{}]


def test_reader_reads_other_writers_files(tmp_path):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        with z.open("archive/data.warc.gz", "w", force_zip64=True) as f:  # ZIP64 in the local header alone
            f.write(b"abcdef")
        z.writestr(zipfile.ZipInfo("deflated"), b"a" * 100, zipfile.ZIP_DEFLATED)
        z.comment = b"a comment with PK\x05\x06 in it"
    r = reader(out.getvalue(), tmp_path)
    assert r.read("archive/data.warc.gz", 2, 2) == b"cd"
    with pytest.raises(ValueError):
        r.read("deflated")
    with pytest.raises(ValueError):
        reader(b"no package", tmp_path)


PAGES = "page_id long, url string, html string, digest string, first_id long, payload string"
LONG, OTHER = "ä" * 60, "b" * 100
ROWS = [(5, "http://a", LONG), (3, "http://b", LONG), (3, "http://b", LONG), (9, None, OTHER), (None, "u\r\nv", OTHER), (None, None, "c" * 200), (1, "x", "short"), (2, "y", "short"), (4, "z", None), (6, "z", "")]


def test_records_of_odd_rows(spark):
    pages = spark.createDataFrame([(*r, "d", 1, "p") for r in ROWS], PAGES)
    rows = zip_warc.archive_and_read(pages, package_bytes=300, zip64=True).collect()
    found = sorted(((r.page_id or -1, r.url, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, r.payload and bytes(r.payload)) for r in rows), key=repr)
    wanted = []
    for i, url, html in ROWS:
        raw = (html or "").encode()
        first = {LONG: 3, OTHER: 9}.get(html)
        revisit = first is not None and i != first
        wanted.append((i or -1, (url or "").replace("\r", "%0D").replace("\n", "%0A"), "revisit" if revisit else "response", first if revisit else None, len(raw), hashlib.sha256(raw).hexdigest(), None if revisit else raw))
    assert found == sorted(wanted, key=repr)
    assert zip_warc.archive_and_read(spark.createDataFrame([], PAGES)).count() == 0


def test_pattern_is_filed_under_its_rarest_token():
    a, b = url_rules.Pattern("x-y", ("x", "y")), url_rules.Pattern("y", ("y",))
    assert url_rules.file_patterns([a, b], {"x": 9, "y": 2}) == {"y": [a, b]}
    assert url_rules.file_patterns([a, b], {"x": 1, "y": 2}) == {"x": [a], "y": [b]}
    with pytest.raises(ValueError):
        url_rules.file_patterns([url_rules.Pattern("x", ())], {})


URLS = [
    (1, "http://A.Example.ORG/es/x?y", "a.example.org", "/es/x", "example.org/es/", "block"),
    (2, "https://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
    (3, "https://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    (4, "https://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    (5, "https://example.org?x=/es/", "example.org", "", None, "allow"),
    (6, "http://x.com/de/#/fr/", "x.com", "/de/", "com/de/", "block"),
    (7, "http://casino-win.x.com/en", "casino-win.x.com", "/en", None, "block"),
    (8, "http://casino-win.x.com/fr/1", "casino-win.x.com", "/fr/1", "com/fr/", "allow"),
    (9, "http://casinos.x.net", "casinos.x.net", "", None, "allow"),
    (10, None, "", "", None, "allow"), (11, "", "", "", None, "allow"), (12, "/casino/page", "", "", None, "block"),
    (None, "x://://y/z", ":", "//y/z", None, "allow"), (1, "http://A.Example.ORG/es/x?y", "a.example.org", "/es/x", "example.org/es/", "block"),
    (13, "http://é.org/\nx", "é.org", "/\nx", "org/", "allow"),
]


def test_odd_urls(spark):
    pages = spark.createDataFrame([(i, u, "h", "r", "v") for i, u, *_ in URLS], "page_id long, url string, host string, rule string, verdict string")
    rows = url_rules.judge_urls(pages, queries.URL_RULES, queries.URL_PATTERNS).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(((i, *x) for i, _, *x in URLS), key=repr)
    assert url_rules.judge_urls(pages.limit(0), queries.URL_RULES, queries.URL_PATTERNS).count() == 0
    assert {r.verdict for r in url_rules.judge_urls(pages, [], []).collect()} == {"allow"}


def test_only_candidates_run_and_every_match_is_found(spark):
    """Against all patterns on all URLs."""
    import re

    urls = [f"http://{h}.example.{t}/{p}" for h in ("casino-win", "spam-farm", "a.ads-track", "news", "farm.spam") for t in ("com", "net") for p in ("", "cheap-pills", "x?utm_source=spam", "adult_x")]
    pages = spark.createDataFrame([*enumerate(urls)], "page_id long, url string")
    found = {r.page_id: r.verdict for r in url_rules.judge_urls(pages, [], queries.URL_PATTERNS).collect()}
    assert found == {k: "block" if any(re.search(p.regex, u) for p in queries.URL_PATTERNS) else "allow" for k, u in enumerate(urls)}


def test_forms_of_a_word_are_found_whichever_token_is_rarest(spark):
    """Against the SQL's one expression; each host alone and all together, so that every token is the rarest at times."""
    import re

    pattern = re.search(r"regexp_matches\(lower\(url\),\s*'([^']+)'", sql.OP7)[1]
    hosts = ["ad-track", "ads-track", "ad.tracker", "ads-tracker", "ads_tracking", "x-ad-track", "cheap-pill", "cheap_pills", "cheap.pill", "cheap-pillsx", "bad-track", "ad-x.track", "track.ads", "pills.cheap", "ads", "pills"]
    urls = [f"http://{h}.x.com/" for h in hosts]
    wanted = ["block" if re.search(pattern, u) else "allow" for u in urls]
    assert set(wanted) == {"block", "allow"}
    for own in ([*range(len(urls))], [0, 0, 2, 14], [3, 4, 12], [6, 6, 8, 15], [6, 7], [8]):
        pages = spark.createDataFrame([(k, urls[k]) for k in own], "page_id long, url string")
        assert {r.page_id: r.verdict for r in url_rules.judge_urls(pages, [], queries.URL_PATTERNS).collect()} == {k: wanted[k] for k in own}


def test_url_plan_is_native(spark, small_dir):
    plan = queries.op7_url_rules(spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
