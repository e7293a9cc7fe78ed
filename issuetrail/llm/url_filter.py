"""Operator 5, URL filters: rules by host and path, and a blocked Bloom filter before an exact join with a list of URLs.

Everything here is column expressions, aggregations and joins.
"""

from __future__ import annotations

import math
import string
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from issuetrail.llm.common import table, written

RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: Sites whose pages the query lists one by one, as a feed of reported URLs would.
REPORTED = r"(^|\.)(adult-x|ads-track|casino-win|cheap-pills|free-bets|spam-farm)\."


def parts(url: Column) -> tuple[Column, Column]:
    """Host, with A-Z in lower case, and path; both empty without `://`."""
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    found = lambda i: F.coalesce(F.regexp_extract(url, shape, i), F.lit(""))
    return F.translate(found(1), string.ascii_uppercase, string.ascii_lowercase), found(2)


def canonical(host: Column, path: Column) -> Column:
    """What is listed and looked up: host without www., path without a trailing slash or .html; scheme, query and fragment don't count."""
    return F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, r"(/|\.html)$", ""))


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits: its host is the url's or a parent domain, and the path starts with the rule's. A declared list."""
    text = verdict = F.lit(None).cast("string")
    for kind, domain, prefix in sorted(rules, key=lambda rule: len(rule[1] + rule[2])):
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit(prefix))
        text = F.when(fits, F.lit(domain + prefix)).otherwise(text)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return text, verdict


def _marks(key: Column) -> list[Column]:
    """The bits of a key in its block of four longs: two in each, of six bits of a second hash."""
    second = F.xxhash64(key, F.lit(2))

    def bit(i: int) -> Column:
        at = F.shiftrightunsigned(second, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("long"), at)

    return [bit(2 * w).bitwiseOR(bit(2 * w + 1)) for w in range(4)]


def blocks_for(keys: int, false_positives: float) -> int:
    """How many blocks of 256 bits a filter of so many different keys needs; half as many again as for evenly filled blocks, which these aren't."""
    bits = -8 / math.log(1 - false_positives ** (1 / 8))
    return max(1, math.ceil(1.5 * bits * keys / 256))


def bloom_blocks(listed: DataFrame, blocks: int) -> DataFrame:
    """(block, w0, w1, w2, w3): a blocked Bloom filter of the column `key`, a row for each block of 256 bits in use.

    At most `blocks` rows, whatever is listed; each key sets eight bits of the block that its hash names.
    """
    marked = listed.select(F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(_marks(F.col("key")))])
    return marked.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(4)])


def maybe_listed(rows: DataFrame, filter_blocks: DataFrame, blocks: int) -> DataFrame:
    """Rows with `maybe`: false if the filter excludes that their key is listed. An empty key isn't looked up; its rows are dealt by all their columns."""
    no_key = -1 - F.pmod(F.xxhash64(*rows.columns), F.lit(1 << 16))
    probe = rows.withColumn("block", F.when(F.col("key") == "", no_key).otherwise(F.pmod(F.xxhash64("key"), F.lit(blocks))))
    met = probe.join(filter_blocks, "block", "left")
    all_set = reduce(Column.__and__, [F.col(f"w{i}").bitwiseAND(m) == m for i, m in enumerate(_marks(F.col("key")))])
    return met.withColumn("maybe", F.coalesce(all_set, F.lit(False))).drop("block", *[f"w{i}" for i in range(4)])


def judge(
    pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]], false_positives: float = 0.01, most_blocks: int = 1 << 18
) -> DataFrame:
    """(page_id, host, path, rule, verdict, maybe_listed, listed) of pages (page_id, url), one row for each of theirs.

    listed: canonical URLs as `key`. The longest fitting rule decides; without one, a listed URL is blocked and any other allowed. The filter is
    sized by the list's count of different URLs and the share of false positives. One of at most `most_blocks` blocks (of 40 bytes) is sent to the pages, which
    then don't move; a larger one meets them in a join by shuffle. Only pages that it passes go on to the exact join with the list. A null url, or one
    without `://`, has an empty host and path, fits no rule and is allowed. Repeated rows stay; nulls and repeats in the list are harmless; other columns
    are ignored; empty tables give no rows, or an empty list.
    """
    host, path = parts(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("key", canonical(F.col("host"), F.col("path")))
    known = written(listed.select("key").where("key is not null and key <> ''").distinct())
    blocks = blocks_for(known.count(), false_positives)
    marks = written(bloom_blocks(known, blocks))
    probed = maybe_listed(rows, F.broadcast(marks) if blocks <= most_blocks else marks.hint("merge"), blocks)
    # by shuffle at every size: the list may grow with the pages, and a much repeated URL is split as both sides come straight from it
    hits = probed.where("maybe").join(known.withColumn("listed", F.lit(True)).hint("merge"), "key", "left")
    others = probed.where("not maybe").withColumn("listed", F.lit(False))
    text, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    found = F.coalesce("listed", F.lit(False))
    return hits.unionByName(others).select(
        "page_id",
        "host",
        "path",
        text.alias("rule"),
        F.coalesce(verdict, F.when(found, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        F.col("maybe").alias("maybe_listed"),
        found.alias("listed"),
    )


def reported(pages: DataFrame) -> DataFrame:
    """The list of the query: canonical URLs of pages on reported sites. There is no table of such URLs, so it is made from the pages, here and in the SQL."""
    host, path = parts(F.col("url"))
    rows = pages.select(host.alias("host"), path.alias("path")).where(F.col("host").rlike(REPORTED))
    return rows.select(canonical(F.col("host"), F.col("path")).alias("key"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    # whether the filter alone would have let a page pass is no part of the result
    return judge(pages, reported(pages), RULES).drop("maybe_listed")


SQL = r"""
WITH parsed AS (
    SELECT page_id,
        translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
    FROM pages
), keyed AS (
    SELECT *, regexp_replace(host, '^www\.', '') || regexp_replace(path, '(/|\.html)$', '') AS key,
        regexp_matches(host, '(^|\.)(adult-x|ads-track|casino-win|cheap-pills|free-bets|spam-farm)\.') AS reported
    FROM parsed
), listed AS (
    SELECT DISTINCT key FROM keyed WHERE reported AND key <> ''
), rules(kind, domain, prefix) AS (
    VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), fitting AS (
    SELECT page_id, domain || prefix AS rule, kind, row_number() OVER (PARTITION BY page_id ORDER BY length(domain || prefix) DESC) AS nth
    FROM keyed JOIN rules ON (host = domain OR ends_with(host, '.' || domain)) AND starts_with(path, prefix)
)
SELECT k.page_id, k.host, k.path, f.rule, coalesce(f.kind, CASE WHEN l.key IS NULL THEN 'allow' ELSE 'block' END) AS verdict, l.key IS NOT NULL AS listed
FROM keyed k LEFT JOIN fitting f ON f.page_id = k.page_id AND f.nth = 1 LEFT JOIN listed l ON l.key = k.key
"""
