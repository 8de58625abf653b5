"""The monitor as stored tables that grow batch by batch.

A batch of transactions is landed, enriched, put to the rules and measured.  Each step is one commit of
its own table under the batch's name, so a run that stops is continued by running the same batch again:
steps that are committed are skipped, the others start from stored rows.

* Enrichment reads the batch's partitions and those of the seven days before them, for that is as far as
  a trailing window looks back.  The first row of every (account, counterparty) is kept as a table of its
  own that only gains rows, so no batch walks through all history.
* Rows that arrive late are enriched with the history they have; rows already enriched stay.
* Alerts are added where (transaction, rule) is absent, rule figures replace those of their (rule,
  evaluation date), rules are added where their name is absent.
* Events of the audit log carry their data as JSON; the ground truth for rule precision is read back
  from there.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txmon.functions.timefn import micros
from txmon.operators.enrich import ENRICHMENT_COLUMNS, enrich, first_seen_counterparty
from txmon.operators.precision import ground_truth_from_audit, rule_performance
from txmon.operators.rules import ALERT_COLUMNS, SCORE_COLUMNS, alert_rows, fire, rules_frame
from txmon.operators.windows import HOT_ROWS
from txmon.session import checkpoint_dir, materialize
from txmon.sources.monitor import MonitorSources, build_fraud_customers, load_monitor_sources
from txmon.sources.store import StoredTable

LOOK_BACK_DAYS = 7
#: Customer ids in one audit event; a load with more writes more events.
IDS_AN_EVENT = 1000

TRANSACTIONS = ("id bigint, account_id bigint, transaction_type string, amount decimal(18,2), currency string, "
                "timestamp timestamp_ntz, counterparty_account string, counterparty_name string, "
                "counterparty_country string, channel string, status string, created_at timestamp_ntz")
ENRICHMENT = ("transaction_id bigint, amount_usd decimal(18,2), is_round_amount int, is_large_cash int, velocity_1h bigint, "
              "velocity_24h bigint, velocity_7d bigint, amount_velocity_24h decimal(18,2), country_risk_score int, "
              "is_new_counterparty int, account_age_days int, customer_id bigint")
ALERTS = ("alert_id bigint, transaction_id bigint, rule_id bigint, score double, status string, created_date timestamp_ntz, "
          "resolved_date timestamp_ntz, notes string, rule_score double, customer_risk_score double, "
          "geographic_risk_score double, behavioral_score double, composite_score double, customer_id bigint")
PERFORMANCE = ("rule_id bigint, evaluation_date date, total_alerts bigint, true_positives bigint, false_positives bigint, "
               "precision_rate double, avg_score double, median_score double, p95_score double, notes string")
RULES = ("id bigint, name string, description string, category string, sql_condition string, severity double, "
         "is_active int")
AUDIT = ("event_type string, entity_type string, entity_id bigint, description string, metadata string, "
         "created_at timestamp_ntz, day date")


class MonitorStore:
    """``grain``: 'DAY' or 'MONTH', the size of a partition."""

    def __init__(self, spark: SparkSession, path: str, grain: str = "DAY"):
        self.spark, self.grain = spark, grain
        table = lambda name, schema, part: StoredTable(spark, f"{path.rstrip('/')}/{name}", schema, part)
        self.rules = table("rules", RULES, "category")
        self.transactions = table("transactions", f"{TRANSACTIONS}, day date", "day")
        self.first_seen = table("first_seen", "account_id bigint, counterparty_account string, us bigint, id bigint, day date", "day")
        self.enrichment = table("enrichment", f"{ENRICHMENT}, day date", "day")
        self.alerts = table("alerts", f"{ALERTS}, day date", "day")
        self.performance = table("rule_performance", PERFORMANCE, "evaluation_date")
        self.audit = table("audit_log", AUDIT, "day")

    def day(self, timestamp: str = "timestamp"):
        return F.to_date(F.date_trunc(self.grain, F.col(timestamp)))

    def days_of(self, batch: str) -> list[str]:
        """The partitions that a batch's transactions fell into."""
        return [r["part"] for r in self.transactions.commits() if r["batch"] == batch and r["rows"]]

    def _back(self, days: list[str]) -> list[str]:
        """``days`` and the stored partitions that a trailing window of theirs reaches into."""
        stored = {r["part"] for r in self.transactions.commits() if r["part"]}
        reach = set()
        for d in map(dt.date.fromisoformat, days):
            for k in range(LOOK_BACK_DAYS + 1):
                at = d - dt.timedelta(days=k)
                reach.add((at if self.grain == "DAY" else at.replace(day=1)).isoformat())
        return sorted(stored & reach)

    # the steps of a batch

    def seed_rules(self, batch: str, rules: DataFrame) -> int:
        """Rules whose name is not stored yet."""
        return self.rules.append_absent(rules, ["category", "name"], batch)

    def log_loaded(self, batch: str, src: MonitorSources, truth: DataFrame, at: str = "2025-01-01 00:00:00") -> int:
        """``data_loaded`` events with the table sizes and, in pieces, the ground truth."""
        sizes = [src.customers.agg(F.count("*").alias("n_customers")), src.accounts.agg(F.count("*").alias("n_accounts")),
                 src.transactions.agg(F.count("*").alias("n_transactions"))]
        counted = sizes[0].crossJoin(sizes[1]).crossJoin(sizes[2])  # three single rows
        pieces = truth.agg(F.ceil(F.count("*") / IDS_AN_EVENT).cast("int").alias("_pieces")).crossJoin(counted)
        dealt = truth.crossJoin(F.broadcast(pieces))  # a single row
        held = dealt.groupBy("pattern", F.pmod(F.xxhash64("customer_id"), F.greatest("_pieces", F.lit(1))).alias("_k"),
                             "n_customers", "n_accounts", "n_transactions").agg(F.sort_array(F.collect_list("customer_id")).alias("ids"))
        body = F.to_json(F.struct("n_customers", "n_accounts", "n_transactions",
                                  F.create_map(F.col("pattern"), F.col("ids")).alias("fraud_customers")))
        return self._log(batch, held.select(body.alias("metadata")), "data_loaded", "customers", "Input tables loaded", at)

    def log(self, batch: str, event: str, numbers: dict[str, int], at: str = "2025-01-01 00:00:00") -> int:
        one = self.spark.range(1).select(F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in numbers.items()])).alias("metadata"))
        return self._log(batch, one, event, None, event.replace("_", " "), at)

    def _log(self, batch: str, rows: DataFrame, event: str, entity: str | None, text: str, at: str) -> int:
        when = F.lit(at).cast("timestamp_ntz")
        return self.audit.append(rows.select(
            F.lit(event).alias("event_type"), F.lit(entity).cast("string").alias("entity_type"),
            F.lit(None).cast("bigint").alias("entity_id"), F.lit(text).alias("description"), "metadata",
            when.alias("created_at"), F.to_date(when).alias("day")), f"{batch}/{event}")

    def land(self, batch: str, transactions: DataFrame) -> int:
        """Transactions whose id is not stored in their partition yet."""
        return self.transactions.append_absent(transactions.withColumn("day", self.day()), ["id", "day"], batch)

    def _untouched(self, days: list[str]) -> bool:
        """No row of these partitions is enriched yet, so all of them are new."""
        return {r["part"] for r in self.enrichment.commits() if r["rows"]}.isdisjoint(days)

    def _new(self, days: list[str]) -> DataFrame:
        if self._untouched(days):
            return self.transactions.read(days)
        done = self.enrichment.read(days).select(F.col("transaction_id").alias("id"), "day")
        return self.transactions.read(days).join(done, ["day", "id"], "left_anti")

    def remember(self, batch: str) -> int:
        """First rows of counterparties that are new, or earlier than the one kept."""
        if batch in self.first_seen.batches():
            return 0
        new = self._new(self.days_of(batch)).withColumn("us", micros("timestamp"))
        key = ["account_id", "counterparty_account"]
        mine = new.filter("counterparty_account <> ''").groupBy(*key).agg(F.min(F.struct("us", "id", "day")).alias("f"))
        kept = self.first_seen.read().groupBy(*key).agg(F.min(F.struct("us", "id")).alias("k"))
        fresh = mine.join(kept, key, "left").where(F.col("k").isNull() | (F.struct("f.us", "f.id") < F.col("k")))
        return self.first_seen.append(fresh.select(*key, "f.us", "f.id", "f.day"), batch)

    def enrich(self, batch: str, accounts: DataFrame, country_risk: DataFrame) -> int:
        """The batch's new transactions, enriched from their look-back and the kept first rows."""
        if batch in self.enrichment.batches():
            return 0
        days = self.days_of(batch)
        history = self.transactions.read(self._back(days)).drop("day")
        key = ["account_id", "counterparty_account"]
        asked = first_seen_counterparty(history.withColumn("us", micros("timestamp"))).select(*key)
        first = self.first_seen.read().join(asked, key, "left_semi").groupBy(*key).agg(
            F.min(F.struct("us", "id"))["id"].alias("_first_id"))
        wide = enrich(history, accounts, country_risk, first=first, hot_rows=HOT_ROWS).withColumn("day", self.day())
        if self._untouched(days):
            wide = wide.where(F.col("day").cast("string").isin(days))
        else:
            wide = wide.join(self._new(days).select("id", "day"), ["day", "id"], "left_semi")
        rows = wide.select(*ENRICHMENT_COLUMNS, "customer_id", "day")
        return self.enrichment.merge(rows, ["day", "transaction_id"], batch)

    def wide(self, days: list[str] | None = None) -> DataFrame:
        """Transactions with their enrichment."""
        e = self.enrichment.read(days).withColumn("id", F.col("transaction_id"))
        return self.transactions.read(days).join(e, ["day", "id"])

    def alert(self, batch: str, accounts: DataFrame, customers: DataFrame) -> int:
        """Alerts of the batch's partitions whose (transaction, rule) has none yet."""
        if batch in self.alerts.batches():
            return 0
        fired, _ = fire(self.wide(self.days_of(batch)), accounts, customers, self.rules.read())
        rows = alert_rows(fired, "customer_id", "day")
        columns = list(dict.fromkeys([*ALERT_COLUMNS, *SCORE_COLUMNS, "customer_id", "day"]))
        rows = materialize(rows.select(*columns), "fired")  # read for its partitions, its keys and its rows
        return self.alerts.append_absent(rows, ["day", "transaction_id", "rule_id"], batch)

    def measure(self, batch: str, evaluation_date: str) -> int:
        """Rule figures of the date, by the ground truth that the audit log keeps."""
        truth = ground_truth_from_audit(self.audit.read())
        rows = rule_performance(self.alerts.read(), self.rules.read(), truth, evaluation_date)
        return self.performance.merge(rows, ["rule_id", "evaluation_date"], f"{batch}/{evaluation_date}")

    def run(self, batch: str, src: MonitorSources, transactions: DataFrame, rules: DataFrame, truth: DataFrame,
            evaluation_date: str) -> dict[str, int]:
        """Every step of a batch; rows written by step (0 where it was committed before)."""
        out = {"rules": self.seed_rules(batch, rules), "loaded": self.log_loaded(batch, src, truth)}
        out["transactions"] = self.land(batch, transactions)
        out["first_seen"] = self.remember(batch)
        out["enrichment"] = self.enrich(batch, src.accounts, src.country_risk)
        out["alerts"] = self.alert(batch, src.accounts, src.customers)
        out["rule_performance"] = self.measure(batch, evaluation_date)
        self.log(batch, "rule_engine_run", {k: v for k, v in out.items()})
        return out

    def progress(self, batch: str) -> dict[str, bool]:
        """Which steps of a batch are committed."""
        done = lambda t: any(b == batch or b.startswith(f"{batch}/") for b in t.batches())
        return {t: done(getattr(self, t)) for t in
                ("rules", "transactions", "first_seen", "enrichment", "alerts", "performance", "audit")}


# registered queries: the tables after a run over the older transactions, one over the newer ones and a rerun

CUT = "2000-01-01 00:00:00"


@lru_cache(maxsize=8)
def _loaded(app: str, sf_dir: str, base: str) -> str:
    """Runs the batches once a session and input; the queries below read the stored tables."""
    spark = SparkSession.getActiveSession()
    path = f"{base}/store/{uuid.uuid4().hex}"
    store = MonitorStore(spark, path, "MONTH")
    src = load_monitor_sources(spark, sf_dir)
    rules, truth = rules_frame(spark), build_fraud_customers(src.customers)
    older, newer = src.transactions.where(F.col("timestamp") < CUT), src.transactions.where(F.col("timestamp") >= CUT)
    store.run("older", src, older, rules, truth, "2024-06-30")
    store.run("newer", src, newer, rules, truth, "2024-12-31")
    store.run("newer", src, newer, rules, truth, "2024-12-31")  # nothing is left to do
    store.measure("again", "2024-06-30")  # the earlier date with all alerts: replaces its rows
    store.land("late", src.transactions)  # all are stored
    return path


def loaded(spark: SparkSession, sf_dir: str) -> MonitorStore:
    base = checkpoint_dir(spark).rstrip("/")
    return MonitorStore(spark, _loaded(spark.sparkContext.applicationId, sf_dir, base), "MONTH")


def s05_stored_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = loaded(spark, sf_dir).enrichment.read().select(*ENRICHMENT_COLUMNS)
    return rows.withColumn("amount_usd", F.col("amount_usd").cast("double")).withColumn(
        "amount_velocity_24h", F.col("amount_velocity_24h").cast("double"))


def s06_stored_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded(spark, sf_dir).alerts.read().select("alert_id", "transaction_id", "rule_id", "score", "status")


def s08_stored_rule_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded(spark, sf_dir).performance.read()


def s09_audit_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ground truth decoded from the audit log, both loads of it."""
    return ground_truth_from_audit(loaded(spark, sf_dir).audit.read()).distinct()


def x05_full_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every stored table."""
    store = loaded(spark, sf_dir)
    names = {"rules": store.rules, "transactions": store.transactions, "first_seen": store.first_seen,
             "transaction_enrichment": store.enrichment, "alerts": store.alerts, "rule_performance": store.performance}
    out = None
    for name, table in names.items():
        one = table.read().agg(F.count("*").alias("stored_rows")).select(F.lit(name).alias("table_name"), "stored_rows")
        out = one if out is None else out.unionByName(one)
    return out


ALL = {f.__name__: f for f in (s05_stored_enrichment, s06_stored_alerts, s08_stored_rule_performance, s09_audit_truth,
                               x05_full_run)}
