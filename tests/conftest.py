import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from txmon.session import get_spark
    s = get_spark(cpus="*", app="txmon-tests", shuffle_partitions=8)
    yield s


TXN_SCHEMA = ("id bigint, account_id bigint, transaction_type string, amount decimal(18,2), currency string, "
              "timestamp timestamp_ntz, counterparty_account string, counterparty_name string, "
              "counterparty_country string, channel string, status string, created_at timestamp_ntz")


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def txn(i, acct, t, amount="100.00", ty="transfer_out", cur="USD", cp=None, country=None, status="completed"):
    from decimal import Decimal
    return (i, acct, ty, Decimal(amount), cur, ts(t), cp, None if cp is None else "Party", country, "online",
            status, ts(t))


@pytest.fixture()
def dims(spark):
    accounts = spark.createDataFrame(
        [(1, 10, "checking", "USD", dt.date(2024, 1, 1), "active", 1000.0, ts("2024-01-01 00:00:00")),
         (2, 20, "checking", "USD", dt.date(2024, 6, 1), "active", 1000.0, ts("2024-06-01 00:00:00"))],
        "id bigint, customer_id bigint, account_type string, currency string, opened_date date, status string, "
        "daily_limit double, created_at timestamp_ntz")
    customers = spark.createDataFrame(
        [(10, "Ann", "individual", 3, "N01", dt.date(2000, 1, 1), "verified", 0, ts("2000-01-01 00:00:00")),
         (20, "Bob", "business", 1, "N02", dt.date(2000, 1, 1), "verified", 1, ts("2000-01-01 00:00:00"))],
        "id bigint, name string, customer_type string, risk_rating int, country string, registration_date date, "
        "kyc_status string, pep_status int, created_at timestamp_ntz")
    country = spark.createDataFrame(
        [("N01", "One", 1, 0, None), ("N04", "Four", 4, 1, None), ("N05", "Five", 5, 1, None)],
        "country_code string, country_name string, risk_level int, fatf_listed int, notes string")
    return accounts, customers, country
