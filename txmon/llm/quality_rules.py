"""Quality rules as a ledger of bit masks.

Every text is measured and every rule evaluated once: a ledger row holds the measurements and one bit
for each rule that failed.  What a corpus keeps is decided afterwards, from the ledger alone: a policy
is a version and the mask of the rules it enforces, and ablations (what each rule removes, removes
alone, or would give back if it were left out) are bitwise aggregates over the counted masks.  Texts
are not read again for a new policy.

Bits are never given to another rule, so that old ledgers keep their meaning.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txmon.llm.common import SPACES, WORD, read

WINDOW = 3
SYMBOLS = "#*$%&|<>"
_WORD = re.compile(WORD)
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_bangs"]

#: Rules by bit: a name and the condition, over the measurements, under which a document fails.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 10 * n_words",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "short_words": "word_chars < 3 * n_words",
    "long_words": "word_chars > 10 * n_words",
    "upper_case": "100 * n_upper > 30 * word_chars",
    "bangs": "100 * n_bangs > 30 * n_words",
}
BIT = {name: 1 << i for i, name in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A version and the rules that it enforces."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in set(self.rules))


BASE = Policy("base", ("few_words", "repeated_words"))
POLICIES = [BASE, Policy("v1", (*BASE.rules, "symbols", "repeated_lines")), Policy("v2", tuple(RULES))]


def repeated(words: list[str], size: int = WINDOW) -> int:
    """Words that stand in a window of ``size`` words found twice or more, each place counted once."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    names: dict[str, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words))
    key = ids[:n]
    for i in range(1, size):  # exact: each pair of numbers gets a number of its own
        if (int(key.max()) + 1) * len(names) >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1]
        key = key * len(names) + ids[i:n + i]
    _, place, count = np.unique(key, return_inverse=True, return_counts=True)
    again = count[place] > 1
    inside = np.zeros(len(words), bool)
    for i in range(size):
        inside[i:n + i] |= again
    return int(inside.sum())


def measure(text: str | None) -> tuple[int, ...]:
    """MEASURES of one text, null as empty; linear in the text but for a sort of its windows."""
    text = text or ""
    words = _WORD.findall(text)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    count = lambda chars: sum(map(text.count, chars))
    return (len(words), len(text) - count(SPACES), count(SYMBOLS), len(lines), len(lines) - len(set(lines)),
            repeated(words), count(_UPPER), text.count("!"))


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, MEASURES, fail_bits (bit i: rule i of RULES failed) of every row of ``docs``.

    Null text counts as empty: it has no words and fails few_words.  Repeated rows and rows with a null
    id stand for themselves; an empty table gives an empty ledger; other columns are ignored.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = pd.DataFrame([measure(t) for t in batch["text"]], columns=MEASURES, dtype="int64")
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
            yield out

    measured = docs.select("doc_id", "text").mapInPandas(rows, ", ".join(["doc_id bigint"] + [f"{m} bigint" for m in MEASURES]))
    bits = F.lit(0).cast("bigint")
    for name, failed in RULES.items():
        bits = bits + F.when(F.expr(failed), F.lit(BIT[name]).cast("bigint")).otherwise(0)
    return measured.withColumn("fail_bits", bits)


def apply_policy(book: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with ``kept`` and ``against`` (the bits of the policy's rules that failed)."""
    against = F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("bigint"))
    return book.withColumn("against", against).withColumn("kept", F.col("against") == 0)


def ablation(book: DataFrame, policies: Sequence[Policy] = tuple(POLICIES)) -> DataFrame:
    """version, rule, docs, kept, failed, alone, kept_without, words_without; a row for each policy and rule.

    ``failed``: documents that fail the rule; ``alone``: those that fail no other rule of the policy;
    ``kept_without``: documents kept if the rule were left out, ``words_without`` their words.  The
    ledger is reduced to counted masks first (at most 2 ** rules rows), so nothing larger moves.  An
    empty ledger gives an empty result.
    """
    masks = book.groupBy("fail_bits").agg(F.count("*").alias("n"), F.sum("n_words").alias("words"))
    plans = F.array(*[F.struct(F.lit(p.version).alias("version"), F.lit(p.mask).cast("bigint").alias("mask"),
                               F.lit(r).alias("rule"), F.lit(BIT[r]).cast("bigint").alias("bit"))
                      for p in policies for r in dict.fromkeys(p.rules)])
    each = masks.select("fail_bits", "n", "words", F.explode(plans).alias("p")).select("fail_bits", "n", "words", "p.*")
    hit = F.col("fail_bits").bitwiseAND(F.col("mask"))
    rest = F.col("fail_bits").bitwiseAND(F.col("mask").bitwiseXOR(F.col("bit")))
    total = lambda what, where: F.coalesce(F.sum(F.when(where, F.col(what))), F.lit(0))
    return each.groupBy("version", "rule").agg(
        F.sum("n").alias("docs"), total("n", hit == 0).alias("kept"),
        total("n", F.col("fail_bits").bitwiseAND(F.col("bit")) != 0).alias("failed"),
        total("n", hit == F.col("bit")).alias("alone"), total("n", rest == 0).alias("kept_without"),
        total("words", rest == 0).alias("words_without"))


def reach(book: DataFrame, *by: str) -> DataFrame:
    """For each group: ``ever`` and ``always``, the bits of rules that any and that every document fails;
    rules outside ``ever`` can go from a policy without effect on the group."""
    return book.groupBy(*by).agg(F.count("*").alias("docs"), F.bit_or("fail_bits").alias("ever"),
                                 F.bit_and("fail_bits").alias("always"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of all documents under the latest policy; edge rows as in ``ledger``."""
    book = apply_policy(ledger(read(spark, sf_dir, "documents")), POLICIES[-1])
    base = F.col("fail_bits").bitwiseAND(F.lit(BASE.mask).cast("bigint")) != 0
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       base.alias("base_failed"), "kept", "fail_bits")


ORACLE = r"""
WITH t AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body FROM documents),
w AS (
  SELECT rid, doc_id, body, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
g AS (
  SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS three
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
again AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, three) AS times FROM g),
places AS (
  SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM again, (VALUES (0), (1), (2)) v(k) WHERE times > 1 GROUP BY rid),
m AS (
  SELECT doc_id, len(words) AS n_words, length(regexp_replace(body, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         length(regexp_replace(body, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(body, '[^!]', '', 'g')) AS n_bangs
  FROM w LEFT JOIN places USING (rid)),
b AS (
  SELECT *, CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN n_repeat_words > 0.5 * n_words THEN 2 ELSE 0 END
         + CASE WHEN n_symbols > 0.1 * n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
         + CASE WHEN word_chars < 3 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 10 * n_words THEN 32 ELSE 0 END
         + CASE WHEN 10 * n_upper > 3 * word_chars THEN 64 ELSE 0 END + CASE WHEN 10 * n_bangs > 3 * n_words THEN 128 ELSE 0 END
         AS fail_bits FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, fail_bits = 0 AS kept,
       CAST(fail_bits AS BIGINT) AS fail_bits
FROM b
"""
