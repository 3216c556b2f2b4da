"""URL rules behind an index of their rarest literal token (native).

Every rule is a regular expression over the canonical form of a URL (host in
lower case, then path) plus the literal tokens (runs of a-z, 0-9) that each
matching URL must hold as whole tokens.  A rule is indexed by the one of its
tokens that the fewest URLs hold.  The tokens of a URL fetch its candidate
rules, and only those run their expression.  Rules without such a token run
inline on every URL.

Defined results: a null URL, or one without ``://``, has empty host and path and
gets the default verdict; repeated rows are each judged; of several fitting
rules of a tier the longest wins, then the smaller text; an empty table gives an
empty result; other columns than those named are not read.

URLs are judged once each (a hot URL is one row before the shuffle), verdicts go
back to the rows by URL.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postline.llm.common import cut, read_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DEFAULT_VERDICT = "allow"
BROADCAST_RULES = 20_000  # an index of at most so many rules is broadcast, a larger one is joined by shuffle


class Rule(NamedTuple):
    """``tier`` 0 rules win over tier 1 rules whatever their length."""

    name: str
    pattern: str
    tokens: tuple[str, ...]
    verdict: str
    tier: int


def _whole_tokens(literal: str, open_left: bool, open_right: bool) -> list[str]:
    """Tokens of a literal; one at an open end may be part of a longer token and is left out."""
    found = [(m.start(), m.end(), m[0]) for m in re.finditer("[a-z0-9]+", literal.translate(str.maketrans(UPPER, LOWER)))]
    return [t for a, b, t in found if not (open_left and a == 0) and not (open_right and b == len(literal))]


def site_rule(host: str, path: str, verdict: str) -> Rule:
    """Fits the host and all its subdomains where the path starts with ``path``."""
    tokens = _whole_tokens(host + path, False, True)
    return Rule(host + path, rf"^(?:[^/]*\.)?{re.escape(host + path)}", tuple(tokens), verdict, 0)


def glob_rule(glob: str, verdict: str) -> Rule:
    """``*`` is any run, ``^`` a separator or an end of the URL, all else is literal."""
    parts = re.split(r"([*^])", glob)
    pattern, tokens = "", []
    for i, part in enumerate(parts):
        if part == "*":
            pattern += ".*"
        elif part == "^":
            pattern += "(?:^|$|[^A-Za-z0-9])"
        else:
            left = parts[i - 1] if i else "*"
            right = parts[i + 1] if i + 1 < len(parts) else "*"
            pattern += re.escape(part)
            tokens += _whole_tokens(part, left == "*", right == "*")
    return Rule(glob, f"(?s){pattern}", tuple(tokens), verdict, 1)


SITE_RULES = [
    site_rule("net", "/", "block"),
    site_rule("example.net", "/en/", "allow"),
    site_rule("example.com", "/de/", "block"),
    site_rule("org", "/fr/", "allow"),
]
# Name patterns of unwanted sites and paths.
GLOB_RULES = [glob_rule(g, "block") for g in (
    "^casino-", "^free-bets^", "^ads-track^", "^spam-farm^", "^adult-", "^xxx^", "^porn^", "^viagra^",
    "^cheap-pills^", "/adserver/", "/affiliate/click",
)]
RULES = SITE_RULES + GLOB_RULES


def with_host_and_path(pages: DataFrame, url_col: str = "url") -> DataFrame:
    url = F.coalesce(F.col(url_col), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(raw) + 1), "^[^?#]*", 0)
    return pages.withColumns({"host": F.translate(raw, UPPER, LOWER), "path": path})


def _tokens(canon: Column) -> Column:
    return F.array_distinct(F.filter(
        F.split(F.translate(canon, UPPER, LOWER), "[^a-z0-9]+"), lambda t: t != ""))


def _rule_value(name, verdict, tier) -> Column:
    """Ordered so that the greatest is the winner."""
    return F.struct((-tier).alias("tier"), F.length(name).alias("length"), name.alias("name"), verdict.alias("verdict"))


def _small(side: DataFrame, rules: list[Rule]) -> DataFrame:
    """The side made from the rules, broadcast while their number allows it."""
    return F.broadcast(side) if len(rules) <= BROADCAST_RULES else side


def rule_index(urls: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows (token, name, pattern, verdict, tier): each rule under its rarest token.

    ``urls`` has the array ``tokens``.  A token counts the URLs that hold it,
    over all of them; of equally rare tokens the smaller one is taken.
    """
    listed = urls.sparkSession.createDataFrame(
        [(r.name, r.pattern, r.verdict, r.tier, list(r.tokens)) for r in rules if r.tokens],
        "name string, pattern string, verdict string, tier int, tokens array<string>")
    by_token = listed.withColumn("token", F.explode("tokens")).drop("tokens")
    counts = (urls.select(F.explode("tokens").alias("token"))
              .join(_small(by_token.select("token").distinct(), rules), "token", "left_semi")
              .groupBy("token").agg(F.count("*").alias("n")))
    rarest = (by_token.join(counts, "token", "left")
              .groupBy("name", "pattern", "verdict", "tier")
              .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("rarest")))
    return rarest.select("name", "pattern", "verdict", "tier", F.col("rarest.token").alias("token"))


def judge_urls(pages: DataFrame, rules: list[Rule] = RULES, url_col: str = "url",
               default: str = DEFAULT_VERDICT) -> DataFrame:
    """One row (url, host, path, rule, verdict, tier) for each distinct URL that is not null."""
    urls = with_host_and_path(pages.select(F.col(url_col).alias("url")).where("url is not null").distinct())
    urls = cut(urls.withColumn("canon", F.concat("host", "path"))
               .withColumn("tokens", _tokens(F.col("canon"))), "urls")
    index = rule_index(urls, rules)
    hits = (urls.select("url", "canon", F.explode("tokens").alias("token"))
            .join(_small(index, rules), "token")
            .where(F.rlike("canon", F.col("pattern")))
            .groupBy("url").agg(F.max(_rule_value(F.col("name"), F.col("verdict"), F.col("tier"))).alias("best")))
    bare = [r for r in rules if not r.tokens]
    judged = urls.join(hits, "url", "left")
    for r in bare:
        value = _rule_value(F.lit(r.name), F.lit(r.verdict), F.lit(r.tier))
        judged = judged.withColumn("best", F.greatest("best", F.when(F.rlike("canon", F.lit(r.pattern)), value)))
    return judged.select("url", "host", "path", F.col("best.name").alias("rule"),
                         F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
                         (-F.col("best.tier")).alias("tier"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on the URL of every row of ``pages``."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    judged = judge_urls(pages)
    return (pages.join(judged, "url", "left").select(
        "page_id",
        F.coalesce("host", F.lit("")).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"),
        F.when(F.col("tier") == 0, F.col("rule")).alias("rule"),
        F.coalesce("verdict", F.lit(DEFAULT_VERDICT)).alias("verdict"),
        F.when(F.col("tier") == 1, F.col("rule")).alias("pattern")))


def _sql_rules() -> str:
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    return ", ".join(f"({quote(r.name)}, {quote(r.pattern)}, {quote(r.verdict)}, {r.tier})" for r in RULES)


ORACLE = f"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
hosts AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*', 0) AS raw FROM parts),
canon AS (
  SELECT row_number() OVER () AS id, page_id, translate(raw, '{UPPER}', '{LOWER}') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*', 0) AS path FROM hosts),
rules(name, pattern, verdict, tier) AS (VALUES {_sql_rules()}),
hits AS (
  SELECT id, name, verdict, tier, row_number() OVER (PARTITION BY id ORDER BY tier, length(name) DESC, name DESC) AS n
  FROM canon JOIN rules ON regexp_matches(host || path, pattern))
SELECT page_id, host, path, CASE WHEN tier = 0 THEN name END AS rule,
       coalesce(verdict, '{DEFAULT_VERDICT}') AS verdict, CASE WHEN tier = 1 THEN name END AS pattern
FROM canon LEFT JOIN hits ON hits.id = canon.id AND n = 1
"""
