"""Stored tables: partitioned Parquet that is written, audited and then published.

A batch is written to a folder of its own, read back and checked, and becomes visible by one small
commit file that lists its partitions.  Readers see what is committed and nothing else, so a run that
dies between two steps leaves no half-written partition: the next run of the same batch writes its
folder anew, and a batch that is committed already is skipped.

A commit adds rows to its partitions or replaces them.  Keyed writes read only the partitions that the
new rows fall into, hold keys against keys and move whole rows once, to their files; a partition is
written anew only where a row of it is replaced.  One writer a table at a time; readers may run meanwhile.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txmon.session import materialize

COMMITS = "batch string, seq bigint, part string, mode string, rows bigint, folder string"


class AuditError(ValueError):
    """A written batch that must not be published."""


def latest(df: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Of rows of one key the one of the highest version; ties go to the greatest row."""
    rest = [c for c in df.columns if c not in (*keys, version)]
    row = F.max(F.struct(version, *rest)).alias("_r")
    return df.groupBy(*keys).agg(row).select(*[
        F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns])


@dataclass
class StoredTable:
    """``part``: the partition column, a date, number or short text that is never null."""

    spark: SparkSession
    path: str
    schema: str  # DDL of the rows, the partition column included
    part: str

    def _folder(self, name: str) -> str:
        return f"{self.path.rstrip('/')}/{name}"

    def commits(self) -> list:
        """Committed partitions in the order of their commits: a row a partition and batch."""
        try:
            frame = self.spark.read.schema(COMMITS).parquet(self._folder("commits"))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted(frame.collect(), key=lambda r: (r["seq"], r["part"]))

    def batches(self) -> list[str]:
        return list(dict.fromkeys(r["batch"] for r in self.commits()))

    def read(self, parts: list[str] | None = None) -> DataFrame:
        """The published rows, of some partitions only if ``parts`` names them (as text)."""
        live: dict[str, list[str]] = {}
        for r in self.commits():
            if parts is None or r["part"] in parts:
                folder = f"{self._folder('data')}/{r['folder']}/{self.part}={r['part']}"
                live[r["part"]] = ([] if r["mode"] == "replace" else live.get(r["part"], [])) + [folder] * (r["rows"] > 0)
        paths = [p for ps in live.values() for p in ps]
        shape = self.spark.createDataFrame([], self.schema)
        if not paths:
            return shape
        # batch folders carry random names: only the partition column is read off the path
        rows = self.spark.read.schema(self.schema + ", batch string").option("basePath", self._folder("data")).parquet(*paths)
        return rows.select(*shape.columns)

    def _rows(self, df: DataFrame) -> DataFrame:
        """``df`` in the columns and types of the table."""
        shape = self.spark.createDataFrame([], self.schema)
        return df.select(*[F.col(f.name).cast(f.dataType) for f in shape.schema.fields])

    def _write(self, df: DataFrame, target: str) -> DataFrame:
        """Adds to a folder that is not published yet; what stands there now."""
        # split and joined to even files by partition; a partition with a third of the rows takes many tasks
        self._rows(df).hint("rebalance", F.col(self.part)).write.mode("append").partitionBy(self.part).parquet(target)
        return self.spark.read.schema(self.schema).option("basePath", target).parquet(target)

    def _audit(self, back: DataFrame, batch: str, unique: list[str] | None) -> dict[str, int]:
        """Rows of each partition, where the written rows may be published."""
        counts = {str(r["p"]): r["n"] for r in back.groupBy(F.col(self.part).cast("string").alias("p")).agg(
            F.count("*").alias("n")).collect()}  # a row a partition
        if "None" in counts:
            raise AuditError(f"{batch}: {counts['None']} rows have no {self.part}")
        if unique and counts:
            twice = back.groupBy(*unique).count().where("count > 1").limit(1).collect()
            if twice:
                raise AuditError(f"{batch}: a key occurs {twice[0]['count']} times")
        return counts

    def _new_folder(self) -> tuple[str, str]:
        folder = f"batch={uuid.uuid4().hex}"
        return folder, f"{self._folder('data')}/{folder}"

    def _publish(self, df: DataFrame, batch: str, mode: str, unique: list[str] | None, touched: list[str] = ()) -> int:
        """Write, audit, publish.  ``touched``: partitions that a replacing batch leaves empty count too."""
        folder, target = self._new_folder()
        counts = self._audit(self._write(df, target), batch, unique)
        for p in touched:
            counts.setdefault(p, 0)
        self._commit(batch, folder, dict.fromkeys(counts, mode), counts)
        return sum(counts.values())

    def _commit(self, batch: str, folder: str, modes: dict[str, str], counts: dict[str, int]) -> None:
        seq = max((r["seq"] for r in self.commits()), default=0) + 1
        lines = [(batch, seq, p, modes[p], n, folder) for p, n in sorted(counts.items())] or [(batch, seq, "", "append", 0, folder)]
        self.spark.createDataFrame(lines, COMMITS).coalesce(1).write.mode("append").parquet(self._folder("commits"))

    def _touched(self, df: DataFrame) -> list[str]:
        rows = df.select(F.col(self.part).cast("string").alias("p")).distinct().collect()  # a row a partition
        return sorted(str(r["p"]) for r in rows)

    def append(self, df: DataFrame, batch: str) -> int:
        """Add all rows; a batch that is committed already adds none."""
        return 0 if batch in self.batches() else self._publish(df, batch, "append", None)

    def append_absent(self, df: DataFrame, keys: list[str], batch: str) -> int:
        """Add the rows whose ``keys`` are not stored yet, one a key; equal keys share a partition.

        Reads ``df`` three times or more.  Keys are counted first: where none repeats, rows go straight to
        their files; where none is new, no row moves; else the rows are held against the keys that repeat.
        """
        if batch in self.batches():
            return 0
        df = self._rows(df)
        stored = self.read(self._touched(df)).select(*keys)
        both = df.select(*keys, F.lit(0).alias("_old")).unionByName(stored.withColumn("_old", F.lit(1)))
        whole = F.lit(True)  # a key with a null in it equals no stored one
        for k in keys:
            whole = whole & F.col(k).isNotNull()
        seen = both.groupBy(*keys).agg(F.count_if(F.col("_old") == 0).alias("_n"), F.max("_old").alias("_old")).where(
            "_n > 0").select(*keys, (F.col("_n") > 1).alias("_twice"), ((F.col("_old") == 1) & whole).alias("_known"))
        n = seen.agg(F.count_if(F.col("_twice") & ~F.col("_known")).alias("twice"), F.count_if("_known").alias("known"),
                     F.count("*").alias("all")).first()
        if n["known"] == n["all"]:
            df = df.limit(0)
        elif n["known"] or n["twice"]:
            odd = materialize(seen.where("_known OR _twice").select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_known"), "keys")
            same = F.lit(True)
            for k in keys:
                same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
            one = df.join(odd.where("NOT _known"), same, "left_semi").dropDuplicates(keys)
            df = df.join(odd, same, "left_anti").unionByName(one)
        return self._publish(df, batch, "append", keys)

    def merge(self, df: DataFrame, keys: list[str], batch: str, version: str | None = None) -> int:
        """Replace the stored rows of ``df``'s keys and add the others; equal keys share a partition.

        Only the partitions that ``df`` touches are read, and those of which a row is replaced are written
        anew; ``df`` is computed once.  With ``version`` the highest of a key wins, in ``df`` and against
        what is stored; without it rows of ``df`` win and a key may occur in ``df`` once.
        """
        if batch in self.batches():
            return 0
        if version:
            df = materialize(self._rows(df), "merge")
            touched = self._touched(df)
            return self._publish(latest(self.read(touched).unionByName(df), keys, version), batch, "replace", keys, touched)
        folder, target = self._new_folder()
        back = self._write(df, target)
        counts = self._audit(back, batch, keys)
        hit: list[str] = []
        if not {r["part"] for r in self.commits() if r["rows"]}.isdisjoint(counts):
            old, mine = self.read(sorted(counts)), back.select(*keys)
            part = F.col(self.part).cast("string")
            hit = [r["p"] for r in old.join(mine, keys, "left_semi").select(part.alias("p")).distinct().collect()]  # a row a partition
        if hit:  # the rows that stay of these partitions go with the new ones
            counts = self._audit(self._write(old.where(part.isin(hit)).join(mine, keys, "left_anti"), target), batch, keys)
        self._commit(batch, folder, {p: "replace" if p in hit else "append" for p in counts}, counts)
        return sum(counts.values())
