"""URL rules by host-suffix / path-prefix expressions and hash prefixes (native).

Each rule ``host/path`` is stored as the SHA-256 of its expression. A URL is
expanded into all expressions a rule could have: every suffix of its host at a
dot and every prefix of its path that ends in a slash. The expressions are
equi-joined with the rules on the first ``PREFIX_HEX`` digits of their digest;
a hit counts only if the whole digest agrees. Of the confirmed rules the
longest wins.

Depths that no rule has cannot match, so the expansion stops at the most labels
and slashes found in the rule table; a URL with thousands of slashes is cheap
and no match is lost. The rule table is a parameter given as a Python list, so
its size is known before it is broadcast (``MAX_BROADCAST_RULES``; a longer
list joins by shuffle).
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load

PREFIX_HEX = 8
MAX_BROADCAST_RULES = 100_000


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    expression: str  # host/path, the path ends in a slash
    base: bool = False  # base rules win over the method's own


# The rules every verdict follows first.
BASE_RULES = (
    Rule("allow", "com/", True),
    Rule("block", "example.com/en/", True),
    Rule("allow", "www.example.com/en/", True),
    Rule("block", "net/es/", True),
    Rule("block", "net/fr/", True),
)
# The method's own block list, hosts of junk pages under each top-level domain.
JUNK_HOSTS = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
OWN_RULES = tuple(Rule("block", f"{h}.example.{tld}/") for h in JUNK_HOSTS for tld in ("com", "net", "org"))


def rule_rows(rules: Sequence[Rule]) -> list[tuple]:
    out = []
    for r in rules:
        if r.verdict not in ("allow", "block"):
            raise ValueError(f"unknown verdict {r.verdict!r}")
        host, slash, _ = r.expression.partition("/")
        if not slash or not host or not r.expression.endswith("/") or host != host.lower():
            raise ValueError(f"not a host/path/ expression: {r.expression!r}")
        digest = hashlib.sha256(r.expression.encode()).hexdigest()
        out.append((digest[:PREFIX_HEX], digest, r.expression, r.verdict, r.base, len(r.expression)))
    return out


def split_url(docs: DataFrame, url: str = "url") -> DataFrame:
    """Adds host and path. No ``://`` or null: both empty. Only A-Z of the host
    are lower-cased."""
    u = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper, low = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return docs.withColumns({"host": F.translate(host, upper, low), "path": path})


def judge(pages: DataFrame, rules: Sequence[Rule] = BASE_RULES + OWN_RULES, default: str = "allow") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, matched.

    ``rule`` is the winning base rule or null, ``matched`` the winning rule of
    either kind. Without a rule the verdict is ``default``. Rows repeat as they
    do in ``pages`` (each is told apart by a row id of the scan); null urls and
    urls without a host match nothing; other columns are ignored."""
    spark = pages.sparkSession
    rows = rule_rows(rules)
    table = spark.createDataFrame(
        rows, "prefix string, digest string, expression string, rule_verdict string, base boolean, length int")
    labels = max((e[2].split("/", 1)[0].count(".") + 1 for e in rows), default=0)
    slashes = max((e[2].count("/") for e in rows), default=0)

    pages = split_url(pages.select("page_id", "url")).select(
        F.monotonically_increasing_id().alias("rid"), "page_id", "host", "path")
    # host suffixes by number of labels (a negative count keeps the right end), path prefixes by number of slashes
    suffixes = F.array_distinct(F.array(*[F.substring_index("host", ".", -i) for i in range(1, labels + 1)])) \
        if labels else F.array().cast("array<string>")
    prefixes = F.filter(
        F.array_distinct(F.array(*[
            F.regexp_extract("path", "^(?:/[^/]*){%d}/" % (j - 1) if j > 1 else "^/", 0)
            for j in range(1, slashes + 1)])),
        lambda p: p != "") if slashes else F.array().cast("array<string>")
    expressions = F.when(F.col("host") != "", F.flatten(F.transform(
        suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p)))))
    keyed = pages.withColumn("expr", F.explode_outer(expressions)) \
        .withColumn("digest", F.sha2("expr", 256)) \
        .withColumn("prefix", F.substring("digest", 1, PREFIX_HEX))
    table = table.withColumnRenamed("digest", "rule_digest")
    if len(rows) <= MAX_BROADCAST_RULES:
        table = F.broadcast(table)
    hit = F.when(F.col("digest") == F.col("rule_digest"), F.struct(
        "base", "length", "expression", "rule_verdict"))
    best = keyed.join(table, "prefix", "left").groupBy("rid").agg(
        F.first("page_id").alias("page_id"), F.first("host").alias("host"), F.first("path").alias("path"),
        F.max(hit).alias("best"))
    return best.select(
        "page_id", "host", "path",
        F.when(F.col("best.base"), F.col("best.expression")).alias("rule"),
        F.coalesce(F.col("best.rule_verdict"), F.lit(default)).alias("verdict"),
        F.col("best.expression").alias("matched"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(load(spark, sf_dir, "pages"))


def _rules_sql(rules: Sequence[Rule]) -> str:
    rows = ", ".join(f"('{r.verdict}', '{r.expression}', {str(r.base).lower()})" for r in rules)
    return f"(VALUES {rows}) AS r(verdict, expression, base)"


# The oracle tests every rule against every page by its definition, without expressions or digests.
SQL = rf"""
WITH cut AS (
  SELECT page_id, row_number() OVER () AS rid,
         CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT rid, page_id, translate(regexp_extract(rest, '^[^/?#]*'),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules AS (SELECT *, split_part(expression, '/', 1) AS rule_host,
                 substr(expression, instr(expression, '/')) AS rule_path FROM {_rules_sql(BASE_RULES + OWN_RULES)}),
hits AS (
  SELECT p.rid, r.*, row_number() OVER (PARTITION BY p.rid ORDER BY base DESC, length(expression) DESC) AS place
  FROM parts p JOIN rules r
    ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path))
SELECT p.page_id, p.host, p.path, CASE WHEN h.base THEN h.expression END AS rule,
       coalesce(h.verdict, 'allow') AS verdict, h.expression AS matched
FROM parts p LEFT JOIN hits h ON h.rid = p.rid AND h.place = 1
"""
