"""Real-time velocity enrichment with Structured Streaming.

Velocities depend on an account and a time only, so the stream answers for (account, time) and rows take
their answer by joining on both.  State is kept by (block of accounts, week): the distinct times of each
account in that week and in the one before, with counts and sums.  A row therefore enters two states, its own
week and the next.  A block is a share of the accounts by hash, so the number of states a
week does not grow with the accounts, and a state answers all its rows in a few vector operations.

Rows may arrive in any order.  A late row changes the answers of later times; these are given again with
a higher version, and ``latest_velocity`` keeps the last.  The watermark trails the newest time seen by
``late_by``; rows older than it are left to the next batch run, and a week's state goes by an event-time
timer when the watermark has passed its end, for no row that may still come can reach it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from txmon.functions.money import MONEY, to_usd
from txmon.functions.timefn import US_PER_DAY, US_PER_HOUR, micros
from txmon.session import checkpoint_dir
from txmon.sources.monitor import load_monitor_sources
from txmon.sources.store import latest

WINDOWS = {"velocity_1h": US_PER_HOUR, "velocity_24h": 24 * US_PER_HOUR, "velocity_7d": 7 * US_PER_DAY}
AMOUNT_WINDOW = ("amount_velocity_24h", 24 * US_PER_HOUR)
BUCKET_US = 7 * US_PER_DAY  # the widest window
LATE_BY = "10 days"

ANSWERS = ("account_id long, us long, velocity_1h long, velocity_24h long, velocity_7d long, "
           "cents_24h long, version long")
STATE = "accounts binary, us binary, n binary, cents binary, version long"  # longs, by account and time

#: Blocks of accounts in a week, at least.  Fixed for the life of a checkpoint; a state holds the rows that a block's
#: accounts have in two weeks, 32 bytes for each account and time, and costs some 10 ms whatever it holds.
BLOCKS = 16
#: Rows of the whole stream for which there is a block.
ROWS_A_BLOCK = 1_000_000
#: Two weeks: what an account takes on the line on which the times of a block's accounts lie one after another.
SPAN_US = 2 * BUCKET_US


def _answers(t: np.ndarray, at: np.ndarray, n: np.ndarray, cents: np.ndarray) -> np.ndarray:
    """The counts and the sum over ``[t - w, t)`` for each place of ``t``, a column a window."""
    count, total = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(cents)])
    upto = np.searchsorted(at, t, side="left")
    since = lambda w: np.searchsorted(at, t - w, side="left")
    out = [count[upto] - count[since(w)] for w in WINDOWS.values()]
    return np.stack([*out, total[upto] - total[since(AMOUNT_WINDOW[1])]], axis=1)


def _week(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    _, week = key
    if state.hasTimedOut:
        state.remove()
        return
    old = [np.frombuffer(x, np.int64) for x in state.get[:4]] if state.exists else [np.empty(0, np.int64)] * 4
    version = state.get[4] + 1 if state.exists else 0
    new = [(f["account_id"], f["us"], f["n"], f["cents"]) for f in frames]
    account, us, n, cents = (np.concatenate([o, *(f[i].to_numpy(np.int64) for f in new)]) for i, o in enumerate(old))
    accounts, rank = np.unique(account, return_inverse=True)
    start = (int(week) - 1) * BUCKET_US
    # the line: a window of the own week never reaches into the account before
    at = rank * SPAN_US + (us - start)
    at, first, place = np.unique(at, return_index=True, return_inverse=True)
    account, us = account[first], us[first]
    sums = [np.zeros(len(at), np.int64) for _ in range(2)]
    for total, x in zip(sums, (n, cents), strict=True):
        np.add.at(total, place, x)
    n, cents = sums
    state.update((account.tobytes(), us.tobytes(), n.tobytes(), cents.tobytes(), version))
    # no row can reach this week once the watermark is past its end
    end_ms = (int(week) + 1) * BUCKET_US // 1000
    state.setTimeoutTimestamp(max(end_ms, state.getCurrentWatermarkMs() + 1))
    own = us >= int(week) * BUCKET_US
    mine = at[own]
    now = _answers(mine, at, n, cents)
    before = np.searchsorted(accounts, old[0]) * SPAN_US + (old[1] - start)
    # answered before: again only where the answer has changed
    changed = ~np.isin(mine, before) | (now != _answers(mine, before, old[2], old[3])).any(axis=1)
    if changed.any():
        out = pd.DataFrame(now[changed], columns=[*WINDOWS, "cents_24h"])
        out.insert(0, "us", us[own][changed])
        out.insert(0, "account_id", account[own][changed])
        out["version"] = version
        yield out


def velocity_stream(transactions_stream: DataFrame, late_by: str = LATE_BY, blocks: int = BLOCKS) -> DataFrame:
    """A stream of transactions -> ANSWERS for each (account, time), corrections included (append mode).

    Rows without an account or a time have no velocity and are left out; rows older than the watermark
    too, and answers do not count them.
    """
    t = F.col("us")
    own = F.floor(t / BUCKET_US).cast("bigint")
    rows = transactions_stream.where("account_id IS NOT NULL AND timestamp IS NOT NULL").select(
        "account_id", micros("timestamp").alias("us"), (to_usd("amount", "currency") * 100).cast("bigint").alias("cents"))
    timed = rows.withColumn("at", F.timestamp_micros("us")).withWatermark("at", late_by)
    dealt = timed.select("account_id", "at", "us", F.lit(1).cast("bigint").alias("n"), F.coalesce("cents", F.lit(0)).cast("bigint").alias("cents"),
                         F.pmod(F.xxhash64("account_id"), F.lit(blocks)).alias("block"),
                         F.explode(F.array(own, own + 1)).alias("week"))
    return dealt.groupBy("block", "week").applyInPandasWithState(
        _week, ANSWERS, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def latest_velocity(answers: DataFrame) -> DataFrame:
    """account_id, us and the velocities: the last answer for each account and time."""
    last = latest(answers, ["account_id", "us"], "version")
    name = AMOUNT_WINDOW[0]
    return last.select("account_id", "us", *WINDOWS, (F.col("cents_24h").cast("decimal(20,0)") / 100).cast(MONEY).alias(name))


def run_to_table(stream_df: DataFrame, out_path: str, checkpoint: str, late_by: str = LATE_BY, blocks: int = BLOCKS):
    """Write the answers of all rows there are to Parquet, exactly once; returns the ended query."""
    q = (velocity_stream(stream_df, late_by, blocks).writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def stream_transactions(spark: SparkSession, path: str, schema, files_per_trigger: int | None = 1) -> DataFrame:
    """A folder of Parquet files as a stream, oldest file first; None: all that are there in one micro-batch."""
    stream = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        stream = stream.option("maxFilesPerTrigger", files_per_trigger)
    return stream.parquet(path)


def arrivals(transactions: DataFrame, chunks: int, late: str, delay_us: int) -> Iterator[DataFrame]:
    """The transactions in chunks in the order of their arrival: rows for which ``late`` (SQL) holds arrive
    ``delay_us`` after their time, the others at once."""
    us = micros("timestamp")
    rows = transactions.withColumn("_at", us + F.when(F.expr(late), F.lit(delay_us)).otherwise(0))
    cuts = rows.select(F.percentile_approx("_at", [i / chunks for i in range(1, chunks)]).alias("c")).first()["c"]
    bounds = [None, *(cuts or []), None]
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        part = rows if low is None else rows.where(F.col("_at") >= low)
        part = part if high is None else part.where(F.col("_at") < high)
        yield part.drop("_at")


def n1_streaming_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Velocities of every transaction from a stream in which a seventh of the rows comes two days late."""
    src = load_monitor_sources(spark, sf_dir)
    base = f"{checkpoint_dir(spark).rstrip('/')}/stream/{uuid.uuid4().hex}"
    tx = src.transactions.select("id", "account_id", "amount", "currency", "timestamp")
    blocks = max(BLOCKS, tx.count() // ROWS_A_BLOCK)
    for part in arrivals(tx, 4, "id % 7 = 0", 2 * US_PER_DAY):
        part.write.mode("append").parquet(f"{base}/in")  # as many files as there are tasks
        # the stream is taken up from its checkpoint with what has arrived since
        run_to_table(stream_transactions(spark, f"{base}/in", tx.schema, None), f"{base}/out", f"{base}/state", blocks=blocks)
    last = latest_velocity(spark.read.schema(ANSWERS).parquet(f"{base}/out"))
    rows = tx.select("id", "account_id", micros("timestamp").alias("us"))
    return rows.join(last, ["account_id", "us"]).select(
        "id", "account_id", *WINDOWS, F.col(AMOUNT_WINDOW[0]).cast("double").alias(AMOUNT_WINDOW[0]))
