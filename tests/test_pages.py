"""Pages by key, page directories, ordered files and bounded lists."""

import csv
import pathlib
import random

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from txmon.operators.pages import page_directory, positions, seek, top_per_group, write_ordered

ORDER = [("a", True), ("b", False), ("id", True)]


def sort_key(r):
    down = lambda v: (v is None, 0 if v is None else -v)
    up = lambda v: (v is None, 0 if v is None else v)
    return down(r["a"]), up(r["b"]), down(r["id"])


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([None, 1, 2, 2, 2, 3]), rng.choice([None, 5, 6])) for i in range(237)]
    return spark.createDataFrame(rows, "id int, a int, b int").repartition(7).cache()


def test_pages_by_key_are_disjoint_ordered_and_complete(frame):
    want = [r["id"] for r in sorted(frame.collect(), key=sort_key)]
    got, key = [], None
    while rows := seek(frame, ORDER, 40, key).collect():
        got.append([r["id"] for r in rows])
        key = rows[-1].asDict()
    assert [i for page in got for i in page] == want and [len(p) for p in got] == [40] * 5 + [37]


def test_page_directory_opens_any_page(frame):
    want = [r["id"] for r in sorted(frame.collect(), key=sort_key)]
    directory = {r["page"]: r for r in page_directory(frame, ORDER, 50).collect()}
    assert sorted(directory) == [1, 2, 3, 4, 5] and {r["total"] for r in directory.values()} == {237}
    for p in (1, 3, 5):
        rows = seek(frame, ORDER, 50, directory[p].asDict(), inclusive=True).collect()
        assert [r["id"] for r in rows] == want[50 * (p - 1):50 * p] and len(rows) == directory[p]["rows"]
    assert {r["id"]: r["position"] for r in positions(frame, ORDER).collect()} == {i: k for k, i in enumerate(want)}
    assert page_directory(frame.limit(0), ORDER, 50).count() == 0
    with pytest.raises(ValueError):
        page_directory(frame, ORDER, 0)


def test_seek_bound_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("id", "id div 10 AS a", "1 AS b").write.parquet(path)
    plan = seek(spark.read.parquet(path), ORDER, 10, {"a": 50, "b": 1, "id": 505})._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(a,50)" in plan and "TakeOrderedAndProject" in plan


def read_in_file_order(path):
    out = []
    for file in sorted(pathlib.Path(path).glob("part-*.csv")):
        rows = list(csv.reader(file.open(encoding="utf-8")))
        assert rows[0] == ["id", "a", "b", "text"]  # one header policy: every file has it
        out += rows[1:]
    return out


def test_files_in_the_order_of_their_names_are_the_ordered_rows(frame, tmp_path):
    df = frame.withColumn("text", F.concat(F.lit('é, "quoted" '), F.col("id").cast("string")))
    want = [[str(r["id"]), *("" if r[c] is None else str(r[c]) for c in "ab"), f'é, "quoted" {r["id"]}']
            for r in sorted(frame.collect(), key=sort_key)]
    parts = write_ordered(df, ORDER, str(tmp_path / "all"), partitions=5)
    clean = lambda rows: [[x.replace('\\"', '"').replace('\\', '') for x in r] for r in rows]
    assert clean(read_in_file_order(parts))[:3] and [r[0] for r in read_in_file_order(parts)] == [w[0] for w in want]
    assert len(list(pathlib.Path(parts).glob("part-*.csv"))) > 1
    first = write_ordered(df, ORDER, str(tmp_path / "some"), limit=25)
    assert [r[0] for r in read_in_file_order(first)] == [w[0] for w in want[:25]]
    back = df.sparkSession.read.schema(df.schema).option("header", True).csv(parts)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_bounded_lists_are_cut_before_the_shuffle(frame):
    top = top_per_group(frame, "b", ORDER, 4)
    got = {}
    for r in top.collect():
        got.setdefault(r["b"], {})[r["rank"]] = r["id"]
    for b in (None, 5, 6):
        own = sorted((r for r in frame.collect() if r["b"] == b), key=sort_key)[:4]
        assert [got[b][k] for k in range(1, 5)] == [r["id"] for r in own]
    plan = top._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_read_model_contracts(spark):
    """Page size, filters, disjoint pages and the order of transactions and alerts."""
    from txmon.plans import readmodels as H
    from txmon.plans.model import load_monitor
    m = load_monitor(spark, SF001)
    for model, key in ((H.h02_transactions, "id"), (H.h03_alerts, "alert_id")):
        pages = [model(m, page=p, per_page=30).collect() for p in (1, 2, 3)]
        ids = [r[key] for p in pages for r in p]
        assert len(ids) == len(set(ids)) == 90
        for bad in ({"per_page": 201}, {"per_page": 0}, {"page": 0}):
            with pytest.raises(ValueError):
                model(m, **bad)
    scores = [r["score"] for r in H.h03_alerts(m, per_page=100).collect()]
    assert scores == sorted(scores, reverse=True)
    assert all(r["category"] == "geographic" and r["score"] >= 50
               for r in H.h03_alerts(m, category="geographic", min_score=50.0).collect())
    profile = {r["customer_id"]: r for r in H.h05_customer_profiles(m).collect()}
    assert profile and all(len(r["recent_transactions"] or []) <= 20 and len(r["recent_alerts"] or []) <= 10 for r in profile.values())
