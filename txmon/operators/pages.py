"""Pages and ordered files from one total order, without sorting everything for each page.

``page_directory`` range-partitions the rows once and returns the first key of every page; ``seek`` reads
a page from its first key on, a filter that reaches the scan and a top-k of one page.  ``write_ordered``
writes the same order as files whose names sort as their rows do.  ``top_per_group`` keeps the first rows
of every group; each task keeps no more than that before the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txmon.operators.ranking import _ranged, _starts

#: (column, descending) in order of weight; the last column must make the order total.
Order = list[tuple[str, bool]]


def columns(order: Order) -> list[Column]:
    """Nulls stand last, ascending or descending."""
    return [F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, down in order]


def positions(df: DataFrame, order: Order) -> DataFrame:
    """``df`` with ``position``, from 0, in a total order, and ``total``; no task holds more than a range."""
    ranged = _ranged(df, *columns(order))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    starts = F.broadcast(_starts(ranged, F.count("*")))  # one row a partition
    return ranged.join(starts, "_pid").withColumn("position", F.col("_start") + local).withColumn(
        "total", F.col("_n")).drop("_pid", "_mid", "_start", "_n")


def page_directory(df: DataFrame, order: Order, per_page: int) -> DataFrame:
    """page (from 1), the order columns of its first row, rows on it, total, pages; a row a page."""
    if per_page < 1:
        raise ValueError("a page holds one row at least")
    names = [c for c, _ in order]
    placed = positions(df.select(*names), order)
    first = placed.where(F.col("position") % per_page == 0)
    left = F.col("total") - F.col("position")
    return first.select((F.col("position") / per_page + 1).cast("bigint").alias("page"), *names,
                        F.least(left, F.lit(per_page)).cast("bigint").alias("rows"), "total",
                        F.ceil(F.col("total") / per_page).cast("bigint").alias("pages"))


def _not_before(key: dict, order: Order, inclusive: bool) -> Column:
    """The row stands at the key (if inclusive) or behind it, nulls last."""
    terms, same = [], []
    for c, down in order:
        v = key[c]
        if v is None:
            equal, behind = F.col(c).isNull(), F.lit(False)
        else:
            equal = F.col(c) == F.lit(v)
            behind = (F.col(c) < F.lit(v) if down else F.col(c) > F.lit(v)) | F.col(c).isNull()
        terms.append(reduce(lambda a, b: a & b, [*same, behind]))
        same.append(equal)
    if inclusive:
        terms.append(reduce(lambda a, b: a & b, same))
    return F.coalesce(reduce(lambda a, b: a | b, terms), F.lit(False))


def seek(df: DataFrame, order: Order, per_page: int, key: dict | None = None, inclusive: bool = False) -> DataFrame:
    """The next ``per_page`` rows behind ``key`` (the order columns of the last row read), or from it on
    if ``inclusive``; the first page without a key."""
    rows = df if key is None else df.where(_not_before(key, order, inclusive))
    if key is not None and (lead := key[order[0][0]]) is not None:  # the bound that a scan can use
        c = F.col(order[0][0])
        rows = rows.where((c <= F.lit(lead)) | c.isNull() if order[0][1] else (c >= F.lit(lead)) | c.isNull())
    return rows.orderBy(*columns(order)).limit(per_page)


def write_ordered(df: DataFrame, order: Order, path: str, limit: int | None = None, partitions: int | None = None) -> str:
    """CSV, UTF-8, a header in every file; read in the order of their names the files give the rows in order.

    With ``limit`` only the first rows, one file.  Ranges become part numbers, so nothing is sorted in one
    task but a limited export, which is a top-k.
    """
    by = columns(order)
    if limit is not None:
        out = df.orderBy(*by).limit(limit).coalesce(1)
    else:
        n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        out = df.repartitionByRange(n, *by).sortWithinPartitions(*by)
    out.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)
    return path


def top_per_group(df: DataFrame, key: str, order: Order, n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group with their rank from 1.  Spark limits the rank before the shuffle
    too (WindowGroupLimit), so a task sends at most n rows of a group, however hot it is."""
    w = Window.partitionBy(key).orderBy(*columns(order))
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)
