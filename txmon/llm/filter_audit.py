"""Filter interaction audit by recursive CTE enumeration.

Every document becomes one bit mask of the filters it fails; masks are counted by part, so a part is at
most ``2 ** filters`` cells however many documents it has.  A recursive query then extends filter
prefixes by every unused letter: a row carries its prefix and the bits applied so far, meets the cells
of its part, and each level of the recursion emits that step's metrics.  A prefix is worked out once
for all orders that begin with it (325 prefixes instead of 600 steps for five filters).

Only digests, masks and counts move; texts are read once, where they are stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txmon.llm.common import SPACES, read, staged

LETTERS = "ABCDE"
METRICS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _text_bits(text: Column) -> Column:
    """The bits of the filters that look at one text only (A to D)."""
    words = F.filter(F.split(F.translate(text, SPACES, " " * len(SPACES)), " "), lambda w: w != "")
    n = F.size(words)
    upper = F.length(text) - F.length(F.translate(text, _UPPER, ""))
    fails = [n < 200,
             F.size(F.array_distinct(words)) * 100 < n * 50,
             upper * 100 > F.length(text) * 2,
             text.rlike(r"[#$%&*|]")]
    bits = F.lit(0)
    for i, fail in enumerate(fails):
        bits = bits + F.when(fail, 1 << i).otherwise(0)
    return bits


def masks(documents: DataFrame) -> DataFrame:
    """part, doc_id, mask (bit i: filter i fails) of every row.

    Null text counts as empty, a null source is the part ''.  E fails where a smaller doc_id of the
    table has the same text; a null doc_id is smaller than none and has none that is smaller.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = staged(documents.select(F.coalesce("source", F.lit("")).alias("part"), "doc_id", text.alias("text")).select(
        "part", "doc_id", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
        _text_bits(F.col("text")).alias("bits")), "audit_rows")
    # written, so that the join below has two plain exchanges and a hot text's rows can be split
    first = staged(rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
                   .where("copies > 1").drop("copies"), "audit_first")
    later = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return rows.join(first, "digest", "left").select(
        "part", "doc_id", (F.col("bits") + F.when(later, 16).otherwise(0)).alias("mask"))


def cells(masked: DataFrame, labels: DataFrame) -> DataFrame:
    """part, cells: for every mask of the part the rows, and those labelled good and toxic.

    A document is good (toxic) if any row of ``labels`` with its id says 1.
    """
    said = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("bigint"))
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(
        said("quality").alias("good"), said("toxic").alias("toxic"))
    counted = (masked.join(marks, F.col("doc_id") == F.col("_id"), "left").groupBy("part", "mask")
               .agg(F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
                    F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")))
    return counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))


def _walk(letters: str) -> str:
    """The recursive query over {cells}."""
    filters = ", ".join(f"named_struct('letter', '{c}', 'bit', {1 << i})" for i, c in enumerate(letters))
    total = lambda what, where: f"aggregate(filter(c.cells, x -> {where}), 0L, (a, x) -> a + x.{what})"
    here = "x.mask & w.applied = 0 AND x.mask & w.bit <> 0"  # passes all before, fails this one
    return f"""
WITH RECURSIVE walk(part, prefix, applied, step, letter, {', '.join(METRICS)}) AS (
  SELECT part, '', 0, 0, '', 0L, 0L, 0L, 0L, 0L, 0L FROM {{cells}}
  UNION ALL
  SELECT w.part, concat(w.prefix, w.letter), w.applied | w.bit, w.step + 1, w.letter,
         {total('n', 'x.mask & (w.applied | w.bit) = 0')},
         {total('n', here)},
         {total('n', 'x.mask & w.applied <> 0 AND x.mask & w.bit <> 0')},
         {total('n', 'x.mask = w.bit')},
         {total('good', here)},
         {total('toxic', here)}
  FROM (SELECT part, prefix, applied, step, f.letter, f.bit
        FROM walk LATERAL VIEW explode(filter(array({filters}), f -> applied & f.bit = 0)) t AS f
        WHERE step < {len(letters)}) w
  JOIN {{cells}} c ON w.part = c.part)
SELECT * FROM walk WHERE step > 0"""


def audit(counted: DataFrame, letters: str = LETTERS) -> DataFrame:
    """part, filter_order, step, METRICS and shapley for every order of ``letters`` (eight at most).

    ``counted``: part and cells as ``cells`` returns them, bit i of a mask standing for letter i.  A
    part without rows has no cells and no result; an empty table gives an empty result.
    """
    if len(set(letters)) != len(letters) or not 1 <= len(letters) <= 8:
        raise ValueError("one to eight different letters")
    spark = counted.sparkSession
    counted = staged(counted, "audit_cells")
    limit = "spark.sql.cteRecursionRowLimit"  # Spark's own limit would stop at some 3,000 parts
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        walk = staged(spark.sql(_walk(letters), cells=counted), "audit_walk")
    finally:
        spark.conf.set(limit, before)
    # the whole orders, step by step: at most 8! x 8 rows
    orders = walk.where(F.col("step") == len(letters)).select(F.col("prefix").alias("filter_order")).distinct().select(
        "filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("_at")).select(
        "filter_order", F.substring("filter_order", F.lit(1), F.col("_at")).alias("prefix"))
    steps = walk.join(F.broadcast(orders), "prefix")
    every = F.sum("removed").over(Window.partitionBy("part", "letter"))  # one row an order
    return steps.select("part", "filter_order", "step", *METRICS, every.alias("shapley"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters over all documents: every order, every step, every source.

    Repeated rows count each; null and empty texts fail A and, after the smallest id, E; other columns
    are ignored; an empty table gives an empty result.
    """
    return audit(cells(masks(read(spark, sf_dir, "documents")), read(spark, sf_dir, "labels")))


ORACLE = r"""
WITH RECURSIVE orders(filter_order) AS (
  SELECT ''
  UNION ALL
  SELECT filter_order || letter FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v(letter)
  WHERE NOT contains(filter_order, letter)),
d AS (
  SELECT coalesce(source, '') AS part, doc_id, coalesce(text, '') AS body FROM documents),
w AS (
  SELECT part, doc_id, body, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS words,
         min(doc_id) OVER (PARTITION BY body) AS first_id FROM d),
m AS (
  SELECT part, doc_id,
         CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 2 * length(body) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > first_id THEN 'E' ELSE '' END AS failed
  FROM w),
l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
         max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
c AS (
  SELECT part, failed, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM m LEFT JOIN l USING (doc_id) GROUP BY part, failed),
s AS (
  SELECT filter_order, step, filter_order[step] AS letter, left(filter_order, step) AS upto,
         left(filter_order, step - 1) AS before
  FROM orders, (VALUES (1), (2), (3), (4), (5)) v(step) WHERE length(filter_order) = 5),
x AS (
  SELECT part, filter_order, step, letter, failed, n, good, toxic,
         contains(failed, letter) AS fails,
         before <> '' AND regexp_matches(failed, '[' || CASE before WHEN '' THEN '-' ELSE before END || ']') AS gone,
         NOT regexp_matches(failed, '[' || upto || ']') AS stays
  FROM c, s),
r AS (
  SELECT part, filter_order, step, letter,
         sum(CASE WHEN stays THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN fails AND gone THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN failed = letter THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN fails AND NOT gone THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN fails AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
  FROM x GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM r
"""
