"""What the dedup and mixing operators write and shuffle."""

import glob
import math
from collections import Counter

from pyspark.sql import functions as F

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_small_tables_take_few_files(spark, tmp_path, monkeypatch):
    from txmon.llm import common
    from txmon.llm.components import components

    monkeypatch.setattr(common, "checkpoint_dir", lambda spark: str(tmp_path))

    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = components(spark.range(100).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))).collect()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert sorted(tuple(r) for r in got) == [(i, 0) for i in range(101)]
    folders = glob.glob(f"{tmp_path}/llm/*")
    assert folders and max(len(glob.glob(f"{f}/part-*")) for f in folders) == 1  # a file a partition before


def test_equal_groups_are_read_once(spark):
    from txmon.llm.near_dedup import company

    rows = [(c, t, bytes(32), t) for t in range(16) for c in (1, 2, 3)] + [(4, 0, bytes(32), 99)]
    groups, large = company(spark.createDataFrame(rows, "cls bigint, tree int, path binary, at bigint"), len(rows))
    assert large is None and sorted(r["cls"] for r in groups.collect()) == [1, 2, 3]


def test_mixing_moves_no_texts(spark):
    from txmon.llm.mixing import mixed_documents, stage

    rows = [(i, "w " * (i % 9 + 1), "en", "abc"[i % 3], 1) for i in range(300)]
    rows += [(None, "one two", "en", "a", 1)] * 7 + [(5, "x y z", "en", None, 1)] * 3 + [(900, None, "en", "b", 1), (901, " ", "en", "c", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    taken = [(r["doc_id"], r["source"], r["size"], r["taken"] // r["size"] if r["size"] else 0) for r in mixed_documents(docs).collect()]
    total, n = Counter(), Counter()
    for *key, times in taken:
        total[tuple(key)] += times
        n[tuple(key)] += 1
    want = {k: n[k] * math.ceil(v / n[k]) for k, v in total.items() if v}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        mix = stage(spark, docs, "")
        plan = mix._jdf.queryExecution().executedPlan().toString()
        got = Counter((r["doc_id"], r["source"], len((r["text"] or "").split())) for r in mix.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert got == want
