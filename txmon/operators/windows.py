"""Trailing time-window aggregates that stay balanced on hot keys.

A plain ``Window.partitionBy(key)`` puts every row of a key into one task, and AQE cannot split window
partitions.  Two plans share the keys between them:

* **Buckets with a halo**, for almost all keys.  The key's timeline is cut into buckets of ``bucket_us``
  (``BUCKET_WIDTHS`` of the widest window) and each bucket also receives the rows of the preceding ``max_width``
  microseconds: a quarter of the rows goes twice.  Halo rows feed the
  frames but are dropped from the output.  A sliding frame is added up anew for every row, the square of
  a busy key's rows; frames here only grow: ``[t - w, t)`` is what came before ``t`` less what came before
  ``t - w``, two running totals that each row enters once.
* **Two-level prefix sums**, for keys with more than ``hot_rows`` rows in a bucket.  Rows of one time are
  counted together first, where they are read.  Each time then asks for the total before itself and, by
  an expiry marker, before ``t - w``; both are the total of the sub-buckets before theirs, carried over a
  table of sub-buckets, plus a running total inside their own.  A task holds one sub-bucket (an hour, for
  windows of a week) of one key, whatever share of the rows the key has.

Both give the same numbers.  Which keys are hot is part of the plan: a table of at most
rows / ``hot_rows`` keys, which is what may be broadcast.  The split reads its input three times, so it
is for inputs that are cheap to read, stored tables and projections of a scan; without ``hot_rows`` all
keys go by buckets.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _difference(df: DataFrame, fn: str, value: str | None, before, expired) -> Column:
    """The total over ``before`` less the total over ``expired``, a frame inside it."""
    if fn == "count":
        return (F.count(F.lit(1)).over(before) - F.count(F.lit(1)).over(expired)).cast("bigint")
    if fn != "sum":
        raise ValueError(f"unsupported trailing aggregate {fn}")
    exact = _exact(df, value)
    total = [F.coalesce(F.sum(value).over(f), F.lit(0)) for f in (before, expired)]
    return (total[0] - total[1]).cast(exact)


#: Rows of one key in one bucket from which the key's rows go by prefix sums.
HOT_ROWS = 500_000
#: Widest windows in a bucket.  One would send every row twice.
BUCKET_WIDTHS = 4
#: Sub-buckets in the widest window.
SUB_BUCKETS = 168


def trailing_aggregates(
    df: DataFrame,
    key: str,
    us: str,
    aggregates: dict[str, tuple[str, str | None, int]],
    bucket_us: int | None = None,
    payload: list[str] | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Add trailing-window columns over the half-open frame ``[t - width, t)``.

    aggregates: ``{out_name: (fn, value_col, width_us)}`` with fn ``count`` or ``sum``
      (``sum`` is 0, not NULL, on an empty frame; integers and decimals only).
    payload: columns only needed on output rows; they are nulled on halo rows
      before the shuffle so the halo costs only key, time and values.
    hot_rows: keys with more rows in a bucket go by prefix sums, rows with a null time by neither; None
      sends all keys by buckets.
    """
    if hot_rows is None:
        return bucketed_aggregates(df, key, us, aggregates, bucket_us, payload)
    max_w = max(w for _, _, w in aggregates.values())
    df = df.where(F.col(us).isNotNull())
    busy = (df.groupBy(key, F.floor(F.col(us) / F.lit(bucket_us or BUCKET_WIDTHS * max_w)).alias("_b")).count()
            .where(F.col("count") > hot_rows).select(F.col(key).alias("_hot")).distinct())
    hot = F.broadcast(busy)  # at most rows / hot_rows keys
    cold = df.join(hot, F.col(key) == F.col("_hot"), "left_anti")
    warm = df.join(hot, F.col(key) == F.col("_hot"), "left_semi")
    return bucketed_aggregates(cold, key, us, aggregates, bucket_us, payload).unionByName(
        prefix_aggregates(warm, key, us, aggregates))


def _exact(df: DataFrame, value: str):
    """The type that holds sums of ``value`` exactly."""
    kind = df.schema[value].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        raise ValueError(f"{value} is {kind.simpleString()}: differences of running totals need an exact type")
    return T.DecimalType(min(38, kind.precision + 10), kind.scale) if isinstance(kind, T.DecimalType) else T.LongType()


def prefix_aggregates(df: DataFrame, key: str, us: str, aggregates: dict[str, tuple[str, str | None, int]],
                      sub_us: int | None = None) -> DataFrame:
    """The same by two-level prefix sums; no task holds more than a sub-bucket of a key."""
    widths = sorted({w for _, _, w in aggregates.values()})
    sub_us = sub_us or max(widths[-1] // SUB_BUCKETS, 1)
    values = sorted({v for _, v, _ in aggregates.values() if v})
    totals = {"_n": F.count(F.lit(1)), **{f"_s_{v}": F.coalesce(F.sum(v), F.lit(0)).cast(_exact(df, v)) for v in values}}
    kinds = {c: "bigint" if c == "_n" else _exact(df, c[3:]).simpleString() for c in totals}
    points = df.groupBy(F.col(key).alias("_k"), F.col(us).alias("_t")).agg(*[v.alias(c) for c, v in totals.items()])
    # the point itself, and a marker without weight where each of its windows begins
    mark = lambda w: F.struct((F.col("_t") - w).alias("_x"), F.lit(w).cast("bigint").alias("_w"), *[
        (F.col(c) if w == 0 else F.lit(0).cast(kinds[c])).alias(c) for c in totals])
    marks = points.select("_k", "_t", F.explode(F.array(*[mark(w) for w in (0, *widths)])).alias("m")).select(
        "_k", "_t", "m.*").withColumn("_b", F.floor(F.col("_x") / F.lit(sub_us)).cast("bigint"))
    inside = Window.partitionBy("_k", "_b").orderBy("_x").rangeBetween(Window.unboundedPreceding, -1)
    over = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0)).cast(kinds[c])
    ranked = marks.select("_k", "_t", "_w", "_b", *[over(c, inside).alias(c) for c in totals])
    before = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    subs = marks.groupBy("_k", "_b").agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in totals])
    carried = subs.select(F.col("_k").alias("_ck"), F.col("_b").alias("_cb"), *[over(c, before).alias(f"_c{c}") for c in totals])
    placed = ranked.join(carried, F.col("_k").eqNullSafe(F.col("_ck")) & (F.col("_b") == F.col("_cb"))).select("_k", "_t", "_w", *[
        (F.col(c) + F.col(f"_c{c}")).cast(kinds[c]).alias(c) for c in totals])
    at = lambda c, w: F.max(F.when(F.col("_w") == w, F.col(c)))
    outs = []
    for name, (fn, value, width) in aggregates.items():
        if fn not in ("count", "sum"):
            raise ValueError(f"unsupported trailing aggregate {fn}")
        c = "_n" if fn == "count" else f"_s_{value}"
        outs.append((at(c, 0) - at(c, width)).cast(kinds[c]).alias(name))
    answers = placed.groupBy("_k", "_t").agg(*outs)
    return df.join(answers, F.col(key).eqNullSafe(F.col("_k")) & (F.col(us) == F.col("_t"))).drop("_k", "_t")


def bucketed_aggregates(df: DataFrame, key: str, us: str, aggregates: dict[str, tuple[str, str | None, int]],
                        bucket_us: int | None = None, payload: list[str] | None = None) -> DataFrame:
    """Trailing aggregates by buckets with a halo; a task holds a bucket of a key and its halo."""
    max_w = max(w for _, _, w in aggregates.values())
    b_us = bucket_us or BUCKET_WIDTHS * max_w
    halo_copies = math.ceil(max_w / b_us)
    t = F.col(us)
    own_b = F.floor(t / F.lit(b_us)).cast("bigint")
    # a row of bucket b also belongs to bucket b + j when it lies in the last max_w before that bucket
    buckets = [own_b] + [
        F.when(t >= (own_b + j) * F.lit(b_us) - F.lit(max_w), own_b + j) for j in range(1, halo_copies + 1)
    ]
    exploded = df.withColumn("_own_b", own_b).withColumn(
        "_b", F.explode(F.filter(F.array(*buckets), lambda x: x.isNotNull())))
    own = F.col("_b") == F.col("_own_b")
    value_cols = {v for _, v, _ in aggregates.values() if v}
    keep = {key, us, "_b", "_own_b"} | value_cols
    nulled = [
        (F.when(own, F.col(c)).alias(c) if (payload is None or c in payload) and c not in keep else F.col(c))
        for c in exploded.columns
    ]
    exploded = exploded.select(*nulled)

    w = Window.partitionBy(key, "_b").orderBy(t)
    before = w.rangeBetween(Window.unboundedPreceding, -1)
    outs: list[Column] = []
    for name, (fn, value, width) in aggregates.items():
        expired = w.rangeBetween(Window.unboundedPreceding, -width - 1)
        outs.append(_difference(df, fn, value, before, expired).alias(name))
    return (exploded.select("*", *outs).filter(own).drop("_b", "_own_b"))


def with_previous(df: DataFrame, key: str, us: str, tie: str, cols: list[str], out_prefix: str = "prev_",
                  bucket_us: int = 30 * 86_400_000_000, hot_rows: int | None = HOT_ROWS,
                  sub_us: int = 3_600_000_000) -> DataFrame:
    """``LAG`` of ``cols`` per ``key`` in ``(us, tie)`` order, without one task per key.

    Inside each ``(key, time bucket)`` a window gives the previous row; the first row of a bucket takes the
    last row of the previous non-empty bucket, found on the small per-bucket table.  Buckets of more than
    ``hot_rows`` rows are cut into sub-buckets of ``sub_us``, which divides ``bucket_us``: a task holds an
    hour of a hot key, and the table grows only by the hours of such buckets.  Rows with a null key are
    one key, rows with a null time come first.
    """
    if bucket_us % sub_us and hot_rows is not None:
        raise ValueError(f"sub-buckets of {sub_us} do not divide buckets of {bucket_us}")
    start = lambda width: (F.floor(F.col(us) / F.lit(width)) * F.lit(width)).cast("bigint")
    rec = F.struct(F.col(us).alias("_u"), F.col(tie).alias("_t"), *[F.col(c).alias(c) for c in cols])
    d = df.withColumn("_b", start(bucket_us)).withColumn("_rec", rec)
    if hot_rows is not None:
        busy = (df.groupBy(F.col(key).alias("_hk"), start(bucket_us).alias("_hb")).count()
                .where(F.col("count") > hot_rows).select("_hk", "_hb"))
        hot = F.broadcast(busy.withColumn("_hot", F.lit(True)))  # at most rows / hot_rows buckets
        d = d.join(hot, F.col(key).eqNullSafe(F.col("_hk")) & F.col("_b").eqNullSafe(F.col("_hb")), "left").withColumn(
            "_b", F.when(F.col("_hot"), start(sub_us)).otherwise(F.col("_b"))).drop("_hk", "_hb", "_hot")
    inner = Window.partitionBy(key, "_b").orderBy(us, tie)
    d = d.withColumn("_prev_in", F.lag("_rec").over(inner))
    last = d.groupBy(F.col(key).alias("_lk"), F.col("_b").alias("_lb")).agg(F.max("_rec").alias("_last"))
    last = last.withColumn("_prev_b", F.lag("_last").over(Window.partitionBy("_lk").orderBy("_lb"))).drop("_last")
    d = d.join(last, F.col(key).eqNullSafe(F.col("_lk")) & F.col("_b").eqNullSafe(F.col("_lb")), "left")
    prev = F.coalesce(F.col("_prev_in"), F.col("_prev_b"))
    return d.select(*df.columns, *[prev[c].alias(out_prefix + c) for c in cols])
