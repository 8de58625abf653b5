"""Exact deduplication by two passes over a Bloom filter, in DataFrame functions only.

Pass 1 marks, for every normalised-text hash, ``PROBES`` bits of one 32,768-bit block and keeps the
bits marked by two rows or more.  Pass 2 tests every hash against those blocks: a hash with a bit
that only its own row marked is unique and passes straight through; only the rest are grouped.  A
false positive costs a shuffle of one narrow row, never a result.

Only digests move: the texts are read once, and (id, hash, length) is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txmon.llm.common import BLOCK_BITS, DOC_COLUMNS, MAX_BLOCKS, SPACES, read, staged, without_ids

PROBES = 3


def normalised_digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of the text without white space; null counts as empty."""
    return F.sha2(F.translate(F.coalesce(text, F.lit("")), SPACES, "").cast("binary"), 256)


def _probes(sha: Column) -> list[Column]:
    return [F.conv(F.substring(sha, 17 + 4 * i, 4), 16, 10).cast("bigint") % BLOCK_BITS
            for i in range(PROBES)]


def _block(sha: Column, blocks: int) -> Column:
    return F.conv(F.substring(sha, 1, 15), 16, 10).cast("bigint") % blocks


def repeated_bits(digests: DataFrame, blocks: int) -> DataFrame:
    """Pass 1: (block, bits) of the filter bits that at least two rows mark."""
    marked = digests.select(_block(F.col("text_sha256"), blocks).alias("block"),
                            F.explode(F.array_distinct(F.array(*_probes(F.col("text_sha256"))))).alias("bit"))
    return (marked.groupBy("block", "bit").count().where("count > 1")
            .groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits")))


def _bit_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (position % 8).cast("int")) == 1


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without white space; the row with the most code points, then the
    smallest id, stays.  Null text counts as empty (all empty and blank texts are one group); a null
    id sorts after every other id; repeated rows of one id and text form a group in which every
    repeat carries kept=true for that id (``deduplicated`` keeps one of them).  An empty table gives
    an empty result; other columns are ignored.
    """
    text = F.col(text_col)
    digests = staged(docs.select(F.col(id_col).alias("doc_id"), normalised_digest(text).alias("text_sha256"),
                                 F.coalesce(F.char_length(text), F.lit(0)).alias("chars")), "digests")
    rows = digests.count()
    blocks = max(1, min(MAX_BLOCKS, rows * PROBES * 8 // BLOCK_BITS + 1))
    bits = repeated_bits(digests, blocks)
    sha = F.col("text_sha256")
    tested = (digests.withColumn("block", _block(sha, blocks))
              .join(F.broadcast(bits), "block", "left")  # at most MAX_BLOCKS rows of 4 KB
              .withColumn("maybe", F.coalesce(
                  F.forall(F.array(*_probes(sha)), lambda p: _bit_set(F.col("bits"), p)), F.lit(False)))
              .select("doc_id", "text_sha256", "chars", "maybe"))
    unique = tested.where(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")
    maybe = tested.where("maybe").select("doc_id", "text_sha256", "chars")
    groups = staged(
        maybe.groupBy("text_sha256").agg(
            F.count("*").alias("group_size"),
            F.max(F.struct("chars", (-F.col("doc_id")).alias("order"), "doc_id"))["doc_id"].alias("keep_id")),
        "groups")  # written, so that the join below has two plain exchanges and hot groups can be split
    grouped = maybe.join(groups, "text_sha256").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256")
    return unique.unionByName(grouped)


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one per group, with the columns of ``docs``.

    Only ids travel for almost all rows: an id that stands on one row goes or stays as a whole.  Ids on
    several rows of which one at least has an equal elsewhere are told apart by text; among repeated
    rows of one id and equal texts the first by all its columns stays, and rows with a null id likewise.
    """
    flags = staged(exact_dedup(docs).where("group_size > 1").select("doc_id", "text_sha256", "kept"), "flags")
    # ids that stand on several rows, among those that have an equal text somewhere
    several = staged(docs.select("doc_id").join(flags.select("doc_id").distinct(), "doc_id", "left_semi").groupBy("doc_id")
                     .count().where("count > 1").select("doc_id"), "several")
    gone = flags.where("NOT kept").select("doc_id").distinct()
    plain = without_ids(docs.where("doc_id IS NOT NULL"), gone.unionByName(several))

    mixed = docs.where("doc_id IS NULL").unionByName(docs.join(several, "doc_id", "left_semi").select(*docs.columns))
    marked = mixed.withColumn("_own", normalised_digest(F.col("text")))
    told = flags.select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"), F.col("kept").alias("_kept")).distinct()
    marked = marked.join(told, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_sha")), "left")
    alone = marked.where(F.col("_kept").isNull()).select(*docs.columns)
    keepers = (marked.where("_kept").withColumn("_chars", -F.char_length("text"))
               .withColumn("_all", F.to_json(F.struct(*docs.columns))))
    first = keepers.groupBy("_own").agg(
        F.min_by(F.struct(*docs.columns), F.struct("_chars", "_all")).alias("row")).select("row.*")
    return plain.unionByName(alone).unionByName(first)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts, the longest, then of the smallest id; null text counts
    as empty; see ``deduplicated`` for repeated and null ids; an empty table gives an empty one."""
    return deduplicated(docs.select(*DOC_COLUMNS))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id)
"""
