"""Stored tables: publish, audit, resume, replace on key, add if absent; the monitor in batches."""

import datetime as dt

import pytest
from conftest import TXN_SCHEMA, txn
from pyspark.sql import functions as F

from txmon.sources.store import AuditError, StoredTable, latest

ROWS = "k bigint, day date, v string, at bigint"
D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)


@pytest.fixture()
def table(spark, tmp_path):
    return StoredTable(spark, str(tmp_path / "t"), ROWS, "day")


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), ROWS)


def stored(t, parts=None):
    return sorted((r.k, r.day, r.v, r["at"]) for r in t.read(parts).collect())


def test_append_is_published_once(spark, table):
    assert stored(table) == [] and table.batches() == []
    rows = frame(spark, (1, D1, "a", 1), (2, D2, "b", 1))
    assert table.append(rows, "one") == 2 and table.append(rows, "one") == 0
    assert stored(table) == [(1, D1, "a", 1), (2, D2, "b", 1)] and stored(table, ["2024-01-02"]) == [(2, D2, "b", 1)]
    assert table.append(frame(spark), "none") == 0 and table.batches() == ["one", "none"]


def test_append_absent(spark, table):
    table.append(frame(spark, (1, D1, "a", 1)), "one")
    more = frame(spark, (1, D1, "other", 2), (1, D2, "other day", 2), (3, D3, "c", 2), (3, D3, "c", 2))
    assert table.append_absent(more, ["k", "day"], "two") == 2
    assert table.append_absent(more, ["k", "day"], "three") == 0
    assert stored(table) == [(1, D1, "a", 1), (1, D2, "other day", 2), (3, D3, "c", 2)]


def test_merge_replaces_on_key_and_reads_its_partitions_only(spark, table, monkeypatch):
    table.append(frame(spark, (1, D1, "a", 1), (2, D1, "b", 1), (3, D2, "c", 1)), "one")
    asked = []
    plain = StoredTable.read
    monkeypatch.setattr(StoredTable, "read", lambda self, parts=None: asked.append(parts) or plain(self, parts))
    table.merge(frame(spark, (2, D1, "new", 2), (9, D1, "more", 2)), ["k", "day"], "two")
    assert asked == [["2024-01-01"]]
    assert stored(table) == [(1, D1, "a", 1), (2, D1, "new", 2), (3, D2, "c", 1), (9, D1, "more", 2)]
    assert table.merge(frame(spark, (2, D1, "again", 3)), ["k", "day"], "two") == 0  # committed already


def test_merge_by_version_keeps_the_latest(spark, table):
    table.append(frame(spark, (1, D1, "v5", 5), (2, D1, "v1", 1)), "one")
    table.merge(frame(spark, (1, D1, "v3", 3), (2, D1, "v2", 2), (2, D1, "v4", 4)), ["k", "day"], "two", "at")
    assert stored(table) == [(1, D1, "v5", 5), (2, D1, "v4", 4)]
    assert [r.v for r in latest(frame(spark, (1, D1, "x", 1), (1, D1, "y", 1)), ["k"], "at").collect()] == ["y"]


def test_audit_stops_a_bad_batch(spark, table):
    table.append(frame(spark, (1, D1, "a", 1)), "one")
    with pytest.raises(AuditError, match="key"):
        table.merge(frame(spark, (2, D1, "x", 1), (2, D1, "y", 1)), ["k", "day"], "two")
    with pytest.raises(AuditError, match="no day"):
        table.append(frame(spark, (2, None, "x", 1)), "three")
    assert stored(table) == [(1, D1, "a", 1)] and table.batches() == ["one"]


def test_a_run_killed_before_its_commit_leaves_nothing(spark, table, monkeypatch):
    table.append(frame(spark, (1, D1, "a", 1)), "one")
    commit = StoredTable._commit
    monkeypatch.setattr(StoredTable, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        table.merge(frame(spark, (1, D1, "b", 2)), ["k", "day"], "two")
    assert stored(table) == [(1, D1, "a", 1)]
    monkeypatch.setattr(StoredTable, "_commit", commit)
    assert table.merge(frame(spark, (1, D1, "b", 2)), ["k", "day"], "two") == 1
    assert stored(table) == [(1, D1, "b", 2)]


def transactions(spark, days):
    rows, n = [], 0
    for d in days:
        for h in (1, 9, 9, 23):
            for a in (1, 2):
                n += 1
                rows.append(txn(d * 100 + n, a, f"2024-03-{d:02d} {h:02d}:00:{n % 3:02d}", amount=f"{100 + 37 * n}.00",
                                ty="wire_out", cp=f"CP-{(d + h + a) % 5}", country="N04"))
    return spark.createDataFrame(rows, TXN_SCHEMA)


@pytest.fixture()
def monitor(spark, dims, tmp_path):
    from txmon.operators.rules import rules_frame
    from txmon.plans.incremental import MonitorStore
    from txmon.sources.monitor import MonitorSources
    accounts, customers, country = dims
    src = MonitorSources(country, customers, accounts, transactions(spark, range(1, 21)))
    truth = spark.createDataFrame([("layering", 10), ("geo_risk", 10), ("layering", 30)], "pattern string, customer_id bigint")
    return MonitorStore(spark, str(tmp_path / "m")), src, rules_frame(spark), truth


def state(store):
    out = {}
    for name in ("rules", "transactions", "first_seen", "enrichment", "alerts", "performance"):
        out[name] = sorted(map(str, getattr(store, name).read().collect()))
    return out


def at_once(spark, src):
    from txmon.operators.enrich import ENRICHMENT_COLUMNS, enrich
    return sorted(map(str, enrich(src.transactions, src.accounts, src.country_risk).select(*ENRICHMENT_COLUMNS).collect()))


def test_batches_equal_one_run_and_a_rerun_changes_nothing(spark, monitor, monkeypatch):
    from txmon.operators.enrich import ENRICHMENT_COLUMNS
    store, src, rules, truth = monitor
    day = F.dayofmonth("timestamp")
    run = lambda name, rows: store.run(name, src, rows, rules, truth, "2024-03-31")
    run("old", src.transactions.where(day < 20))
    asked = []
    plain = StoredTable.read
    monkeypatch.setattr(StoredTable, "read", lambda self, parts=None: asked.append((self.path, parts)) or plain(self, parts))
    run("new", src.transactions.where(day == 20))
    read = {p for path, parts in asked if path.endswith("/transactions") for p in parts}
    assert read == {f"2024-03-{d}" for d in range(13, 21)}  # one new day reads eight
    got = sorted(map(str, store.enrichment.read().select(*ENRICHMENT_COLUMNS).collect()))
    assert got == at_once(spark, src) and len(got) == 160
    before = state(store)
    assert before["alerts"] and before["performance"]
    assert set(run("new", src.transactions.where(day == 20)).values()) == {0}
    run("again", src.transactions)  # another name, the same rows: nothing is new but the figures of the date
    assert state(store) == before


def test_late_rows_are_enriched_with_the_history_they_have(spark, monitor):
    store, src, rules, truth = monitor
    late = (F.dayofmonth("timestamp") == 12) & (F.col("account_id") == 1)
    store.run("most", src, src.transactions.where(~late), rules, truth, "2024-03-31")
    kept = {r.transaction_id: r for r in store.enrichment.read().collect()}
    store.run("late", src, src.transactions.where(late), rules, truth, "2024-03-31")
    rows = {r.transaction_id: r for r in store.enrichment.read().collect()}
    assert len(rows) == 160 and all(rows[i] == r for i, r in kept.items())
    full = {s.split(",")[0]: s for s in at_once(spark, src)}
    from txmon.operators.enrich import ENRICHMENT_COLUMNS
    for r in store.enrichment.read().select(*ENRICHMENT_COLUMNS).collect():
        if r.transaction_id not in kept:
            assert str(r) == full[str(r).split(",")[0]]


@pytest.mark.parametrize("step", ["first_seen", "enrichment", "alerts"])
def test_a_killed_run_continues_at_the_step_that_failed(spark, monitor, monkeypatch, step):
    store, src, rules, truth = monitor
    commit = StoredTable._commit

    def killed(self, *a):
        if self.path.endswith(f"/{step}"):
            raise RuntimeError("killed")
        return commit(self, *a)

    monkeypatch.setattr(StoredTable, "_commit", killed)
    with pytest.raises(RuntimeError):
        store.run("b", src, src.transactions, rules, truth, "2024-03-31")
    name = {"rule_performance": "performance", "audit_log": "audit"}.get(step, step)
    assert not store.progress("b")[name] and getattr(store, name).read().count() == 0
    monkeypatch.setattr(StoredTable, "_commit", commit)
    out = store.run("b", src, src.transactions, rules, truth, "2024-03-31")
    assert all(store.progress("b").values())
    done = {"transactions": ["rules"], "alerts": ["transactions", "enrichment"]}.get(step, [])
    assert all(out[s] == 0 for s in done)
    from txmon.operators.enrich import ENRICHMENT_COLUMNS
    assert sorted(map(str, store.enrichment.read().select(*ENRICHMENT_COLUMNS).collect())) == at_once(spark, src)


def test_audit_log_round_trip(spark, monitor, monkeypatch):
    """Encode, append, decode: the ground truth comes back, also in several events."""
    import json

    from txmon.operators.precision import ground_truth_from_audit
    from txmon.plans import incremental
    monkeypatch.setattr(incremental, "IDS_AN_EVENT", 7)
    store, src, _, _ = monitor
    want = {("layering" if i % 3 else "geo_risk", i) for i in range(60)}
    truth = spark.createDataFrame(sorted(want), "pattern string, customer_id bigint")
    assert store.log_loaded("x", src, truth) > 8 and store.log_loaded("x", src, truth) == 0
    store.log("x", "etl_run", {"rows": 160})
    log = store.audit.read().collect()
    loaded = [json.loads(r.metadata) for r in log if r.event_type == "data_loaded"]
    assert all((m["n_customers"], m["n_accounts"], m["n_transactions"]) == (2, 2, 160) for m in loaded)
    assert [json.loads(r.metadata) for r in log if r.event_type == "etl_run"] == [{"rows": 160}]
    assert {(r.pattern, r.customer_id) for r in ground_truth_from_audit(store.audit.read()).collect()} == want


def test_a_keyed_write_computes_its_rows_once_and_leaves_other_partitions(spark, table):
    table.append(frame(spark, (1, D1, "a", 1), (2, D1, "b", 1), (3, D2, "c", 1)), "one")
    ran = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            ran.add(len(b))
            yield b

    new = frame(spark, (2, D1, "new", 2), (9, D2, "more", 2)).coalesce(1).mapInPandas(counted, ROWS)
    assert table.merge(new, ["k", "day"], "two") == 3 and ran.value == 2  # each row three times before
    assert stored(table) == [(1, D1, "a", 1), (2, D1, "new", 2), (3, D2, "c", 1), (9, D2, "more", 2)]
    assert {r["part"]: r["mode"] for r in table.commits() if r["batch"] == "two"} == {
        "2024-01-01": "replace", "2024-01-02": "append"}  # no row of the second is replaced


def test_append_absent_with_nulls_and_repeats(spark, table):
    rows = frame(spark, (None, D1, "n", 1), (None, D1, "n", 1), (1, D1, "a", 1), (1, D1, "a", 1), (2, D1, "b", 1))
    assert table.append_absent(rows, ["k", "day"], "one") == 3
    assert table.append_absent(frame(spark, (1, D1, "z", 1), (2, D1, "z", 1)), ["k", "day"], "two") == 0
    assert table.append_absent(frame(spark, (None, D1, "m", 1), (1, D1, "z", 1)), ["k", "day"], "three") == 1  # null equals none
    assert sorted((r.k is None, r.k or 0, r.v) for r in table.read().collect()) == [
        (False, 1, "a"), (False, 2, "b"), (True, 0, "m"), (True, 0, "n")]


def test_a_batch_that_is_all_new_or_all_stored_moves_no_rows_for_its_keys(spark, table, monkeypatch):
    seen = []
    plain = StoredTable._publish
    monkeypatch.setattr(StoredTable, "_publish", lambda self, df, *a: seen.append(
        df._jdf.queryExecution().optimizedPlan().toString()) or plain(self, df, *a))
    rows = frame(spark, (1, D1, "a", 1), (2, D2, "b", 1))
    assert table.append_absent(rows, ["k", "day"], "one") == 2 and table.append_absent(rows, ["k", "day"], "two") == 0
    assert not any(x in plan for plan in seen for x in ("Aggregate", "Join"))
