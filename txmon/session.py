"""Spark session and lineage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(cpus: str | int | None = None, app: str = "txmon",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Local session for tests and the bench; on a cluster the caller's session is used as is."""
    master = f"local[{cpus or os.environ.get('BENCH_CPUS', '*')}]"
    parts = shuffle_partitions or int(os.environ.get("TXMON_SHUFFLE_PARTITIONS", "8"))
    spark = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TXMON_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session (a cluster names a shared
    folder there).  Only when it is unset — local tests — a fresh scratch
    folder is created and registered.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="txmon-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    jsc = spark.sparkContext._jsc
    if jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    Cuts the lineage (a lost executor recomputes from the written table, not
    from the sources) and gives later stages real file statistics.
    """
    spark = df.sparkSession
    base = checkpoint_dir(spark).rstrip("/")
    # a folder of its own for every run: nothing a live frame points to is replaced
    path = f"{base}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)
