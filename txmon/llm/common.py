"""Shared pieces: table schemas, written intermediate tables, word and row rules."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txmon.session import checkpoint_dir

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
DOC_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: The white space of every contract: blank and the controls 9 to 13.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


#: Rows in one Arrow batch to Python.  Texts are long: Spark's default of 10,000 rows takes hundreds of
#: MB in a worker, several times over where texts go both ways.  Rows may be long: a batch also ends at
#: BATCH_BYTES, so it holds that much and one row at most.
BATCH_ROWS = 1000
BATCH_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    modest_batches(spark)
    return spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def modest_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch to ``BATCH_ROWS`` rows and ``BATCH_BYTES``; lower settings of the
    caller's stay.  Spark reads them when a plan runs, so they hold for the session from here on."""
    conf = spark._jsparkSession.sessionState().conf()
    for key, now, most in (("maxRecordsPerBatch", conf.arrowMaxRecordsPerBatch(), BATCH_ROWS),
                           ("maxBytesPerBatch", conf.arrowMaxBytesPerBatch(), BATCH_BYTES)):
        if now <= 0 or now > most:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", str(most))


def tasks_for(rows: int, each: int) -> int:
    """Tasks that take ``each`` rows at most, of evenly dealt rows."""
    return max(1, math.ceil(rows / each))


def staged(df: DataFrame, name: str, tasks: int | None = None) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    ``tasks``: no more than these write, for small tables of a known size; a file for each shuffle
    partition takes longer than their rows.

    Cuts the lineage: a lost executor costs the tasks it ran, not the stages before this table.
    Every call takes a folder of its own, so no live frame is ever overwritten.
    """
    spark = df.sparkSession
    modest_batches(spark)
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    (df if tasks is None else df.coalesce(tasks)).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: str = "doc_id") -> Column:
    """The fold no model learns from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def word_count(text: Column) -> Column:
    """Words of the shared white-space rule; null and blank texts have none."""
    blank = F.trim(F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES)))
    return F.when(blank == "", F.lit(0).cast("bigint")).otherwise(
        F.size(F.split(blank, " +")).cast("bigint"))


BLOCK_BITS = 32768
#: 65,536 blocks of 4 KB: a broadcast filter never exceeds 256 MB; a fuller one lets more rows through.
MAX_BLOCKS = 65536
_ID_PROBES = 4


def without_ids(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose doc_id is in ``gone`` (doc_id); null ids stay.

    A Bloom filter over the ids that go is broadcast: a row it doesn't know passes straight through, with
    its text, and only the others are shuffled to be held against the ids themselves.
    """
    ids = staged(gone.select("doc_id").where("doc_id IS NOT NULL").distinct(), "gone")
    blocks = max(1, min(MAX_BLOCKS, ids.count() * 16 // BLOCK_BITS + 1))
    block = F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int")
    probes = [F.pmod(F.xxhash64("doc_id", F.lit(i)), F.lit(BLOCK_BITS)) for i in range(_ID_PROBES)]
    bits = ids.select(block.alias("_block"), F.explode(F.array(*probes)).alias("_bit")).groupBy("_block").agg(
        F.bitmap_construct_agg("_bit").alias("_bits"))
    byte = lambda p: F.conv(F.hex(F.substring("_bits", (p / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    known = F.col("doc_id").isNotNull()
    for p in probes:
        known = known & F.coalesce(F.getbit(byte(p), (p % 8).cast("int")) == 1, F.lit(False))
    tested = docs.withColumn("_block", block).join(F.broadcast(bits), "_block", "left").withColumn("_maybe", known)
    sure = tested.where("NOT _maybe").select(*docs.columns)
    return sure.unionByName(tested.where("_maybe").select(*docs.columns).join(ids, "doc_id", "left_anti").select(*docs.columns))
