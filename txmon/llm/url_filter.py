"""URL rules by host-suffix and path-prefix expressions, joined on short hash prefixes.

A url is expanded into every expression ``host suffix + path prefix`` a rule could have (suffixes by
label; prefix lengths taken from the rules), the expressions meet the rules on the first
``PREFIX_HEX`` digits of their SHA-256, the full digests confirm, and the longest confirmed rule
decides.  Work per url is labels x distinct rule path lengths, whatever the number of rules; only one row a
url is shuffled while the rules are small enough to be broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txmon.llm.common import read

PREFIX_HEX = 8
DEFAULT_VERDICT = "allow"
#: Rules up to this size are broadcast, so that the expressions of the urls are not shuffled; a rule takes
#: its texts and at most RULE_BYTES for digest, prefix and lengths.
BROADCAST_BYTES = 32 << 20
RULE_BYTES = 256

#: Fixed values of the query: (verdict, host, path).
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path); both empty for null or without ``://``."""
    url = F.coalesce(url, F.lit(""))
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def rules_frame(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules with their digests; of rules with one expression, block goes before allow."""
    df = spark.createDataFrame([(v, h + p, len(h), len(p)) for v, h, p in rules],
                               "verdict string, rule string, host_len int, path_len int")
    df = df.groupBy("rule", "host_len", "path_len").agg(F.max("verdict").alias("verdict"))
    digest = F.sha2(F.col("rule").cast("binary"), 256)
    df = df.withColumn("rule_digest", digest).withColumn("rule_prefix", F.substring(digest, 1, PREFIX_HEX))
    size = sum(RULE_BYTES + 4 * (len(h) + len(p)) for _, h, p in rules)
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def judge_urls(urls: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """One row per input row: id, host, path, rule (null if none fits), verdict.

    A rule fits its host and all subdomains when the url's path starts with the rule's path; the
    longest rule wins, of equal lengths the one with the longer host, then block.  Without a rule the
    verdict is ``allow``.  A null url or one without ``://`` has an empty host and path, which no
    rule with a path fits.  Repeated rows and ids each keep their own row; an empty table gives an
    empty result; other columns are ignored.
    """
    spark = urls.sparkSession
    host, path = split_url(F.col(url_col))
    rows = urls.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path")).withColumn(
        "row", F.monotonically_increasing_id())
    labels = F.split(F.col("host"), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(
        F.slice(labels, i, F.size(labels)), "."))
    lengths = F.array(*[F.lit(n) for n in sorted({len(p) for _, _, p in rules})] or [F.lit(0)])
    prefixes = F.transform(F.filter(lengths, lambda n: n <= F.char_length("path")),
                           lambda n: F.substring(F.col("path"), F.lit(1), n))
    expressions = F.flatten(F.transform(suffixes, lambda s: F.transform(
        prefixes, lambda p: F.struct(F.concat(s, p).alias("text"), F.char_length(s).alias("host_len")))))
    expanded = rows.withColumn("e", F.explode_outer(expressions)).select(
        "row", "page_id", "host", "path", F.col("e.host_len").alias("cut"),
        F.sha2(F.col("e.text").cast("binary"), 256).alias("digest"))
    hits = expanded.join(rules_frame(spark, rules),
                         F.substring("digest", 1, PREFIX_HEX) == F.col("rule_prefix"), "left")
    sure = (F.col("digest") == F.col("rule_digest")) & (F.col("cut") == F.col("host_len"))
    rank = F.when(sure, F.struct(F.char_length("rule").alias("length"), F.col("host_len"),
                                 F.col("verdict"), F.col("rule")))
    best = expanded_best(hits, rank)
    return best.select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                       F.coalesce("best.verdict", F.lit(DEFAULT_VERDICT)).alias("verdict"))


def expanded_best(hits: DataFrame, rank: Column) -> DataFrame:
    """The winning rule of each row; expressions of a row share a task, so they are combined before
    the shuffle, whose key (the row) cannot be hot."""
    return hits.groupBy("row").agg(F.first("page_id").alias("page_id"), F.first("host").alias("host"),
                                   F.first("path").alias("path"), F.max(rank).alias("best"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read(spark, sf_dir, "pages"))


ORACLE = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
u AS (
  SELECT page_id, row_number() OVER () AS n,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts),
r(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/'))
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path,
       arg_max(h || p, length(h || p)) AS rule, coalesce(arg_max(verdict, length(h || p)), 'allow') AS verdict
FROM u LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
GROUP BY n, page_id, host, path
"""
