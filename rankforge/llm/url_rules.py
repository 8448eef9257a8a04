"""URL filter in DataFrame functions alone: host and path rules, then patterns found through their rarest literal token.

Host and path rules: a rule fits its host and all subdomains where the URL's path starts with the rule's; the longest
wins. The suffixes of a URL's host look rules up in a map, so that only rules of its own domains are compared.

Patterns: a pattern names literal tokens that every URL it matches must hold. It is filed under the one that occurs in
the fewest URLs; the tokens of a URL look candidates up, and only those run their regular expressions.

Both maps are made of the rules that the caller lists (at most ``MOST_RULES``); nothing is shuffled, so hot hosts do
not matter.

Defined results: null URLs and those without ``://`` have empty host and path and fit no rule; verdict allow unless a
pattern matches; every row is judged for itself, repeated ones alike; an id may be null; other columns are not
looked at; an empty table gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_RULES = 20_000
TOKEN = "[^a-z0-9]+"


@dataclass(frozen=True)
class HostRule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Pattern:
    """``regex`` is searched in the lower-cased URL; ``tokens``: runs of a-z and 0-9 that every match's URL has."""

    regex: str
    tokens: tuple[str, ...]
    verdict: str = "block"


def parse_rule(text: str) -> HostRule:
    """``block example.org/es/`` -> verdict, host, path (from the first slash on)."""
    verdict, _, rest = text.partition(" ")
    host, slash, path = rest.partition("/")
    return HostRule(verdict, host.lower(), slash + path)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """Behind the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def _map(entries: dict[str, list], element: T.DataType) -> Column:
    """A literal map; the rules are the caller's list, so its size is checked before."""
    if not entries:
        return F.create_map().cast(T.MapType(T.StringType(), T.ArrayType(element)))
    pairs = []
    for key, values in entries.items():
        pairs += [F.lit(key), F.array(*values)]
    return F.create_map(*pairs).cast(T.MapType(T.StringType(), T.ArrayType(element)))


def host_rule(host: Column, path: Column, rules: list[HostRule]) -> Column:
    """The longest rule that fits: struct(length, rule, verdict), or null."""
    kind = T.StructType([T.StructField(x, T.StringType()) for x in ("path", "rule", "verdict")])
    filed: dict[str, list] = {}
    for r in rules:
        filed.setdefault(r.host, []).append(F.struct(F.lit(r.path).alias("path"), F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict")))
    index = _map(filed, kind)
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    own = F.flatten(F.transform(domains, lambda d: F.coalesce(F.try_element_at(index, d), F.array().cast(T.ArrayType(kind)))))
    fit = F.filter(own, lambda r: path.startswith(r["path"]))
    return F.array_max(F.transform(fit, lambda r: F.struct(F.length(r["rule"]).alias("length"), r["rule"].alias("rule"), r["verdict"].alias("verdict"))))


def token_counts(urls: DataFrame, url_col: str, tokens: list[str]) -> dict[str, int]:
    """In how many URLs each of the rules' tokens occurs, over all rows (one row a token comes back)."""
    if not tokens:
        return {}
    own = F.array_intersect(F.split(F.lower(F.col(url_col)), TOKEN), F.array(*[F.lit(t) for t in tokens]))
    return {r["token"]: r["n"] for r in urls.select(F.explode(own).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()}


def file_patterns(patterns: list[Pattern], counts: dict[str, int]) -> dict[str, list[Pattern]]:
    """token -> patterns filed under it: each under its rarest token, ties by the alphabet."""
    filed: dict[str, list[Pattern]] = {}
    for p in patterns:
        if not p.tokens or any(re.fullmatch("[a-z0-9]+", t) is None for t in p.tokens):
            raise ValueError(f"{p.regex!r} needs literal tokens of a-z and 0-9")
        filed.setdefault(min(p.tokens, key=lambda t: (counts.get(t, 0), t)), []).append(p)
    return filed


def pattern_verdict(url: Column, filed: dict[str, list[Pattern]]) -> Column:
    """Verdict of the first listed pattern that matches among the candidates, or null."""
    kind = T.StructType([T.StructField("order", T.IntegerType()), T.StructField("regex", T.StringType()), T.StructField("verdict", T.StringType())])
    order = {p: k for k, p in enumerate(p for ps in filed.values() for p in ps)}
    index = _map({t: [F.struct(F.lit(order[p]).alias("order"), F.lit(p.regex).alias("regex"), F.lit(p.verdict).alias("verdict")) for p in ps] for t, ps in filed.items()}, kind)
    text = F.lower(F.coalesce(url, F.lit("")))
    found = F.flatten(F.transform(F.array_distinct(F.split(text, TOKEN)), lambda t: F.coalesce(F.try_element_at(index, t), F.array().cast(T.ArrayType(kind)))))
    return F.array_min(F.filter(found, lambda p: F.regexp_like(text, p["regex"])))["verdict"]


def judge_urls(pages: DataFrame, rules: list[HostRule], patterns: list[Pattern], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict of every row."""
    if len(rules) + len(patterns) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules go into a plan")
    urls = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    filed = file_patterns(patterns, token_counts(urls, "url", sorted({t for p in patterns for t in p.tokens})))
    parts = urls.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = parts.withColumn("fit", host_rule(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce(F.col("fit.verdict"), pattern_verdict(F.col("url"), filed), F.lit("allow"))
    return judged.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"))
