"""Chains of three legs against all triples, and the work of one hot counterparty."""

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from txmon.operators.chains import Amounts, before, latest_accounts, latest_without, third_legs

SCHEMA = "party string, id bigint, account string, us bigint, amount decimal(18,2)"


def _frame(spark, rows):
    df = spark.createDataFrame([(p, i, a, u, None if c is None else str(c)) for p, i, a, u, c in rows],
                               "party string, id bigint, account string, us bigint, cents string")
    return df.select("party", "id", "account", "us", (F.col("cents").cast("decimal(18,0)") / 100).cast(
        "decimal(18,2)").alias("amount"))


def _all_triples(rows, window, tolerance):
    share = Fraction(str(tolerance))
    rows = [r for r in rows if None not in (r[0], *r[2:]) and r[4] >= 0]

    def follows(a, b):
        return (a[0] == b[0] and 0 < b[3] - a[3] <= window and a[2] != b[2]
                and abs(b[4] - a[4]) <= a[4] * share)
    seconds = [(a, b) for a in rows for b in rows if follows(a, b)]
    return {c[1] for a, b in seconds for c in rows if follows(b, c) and c[2] != a[2]}


@pytest.mark.parametrize("seed,accounts,spread,tolerance", [
    (1, 3, 40, 0.05), (2, 4, 400, 0.05), (3, 2, 10, 0.05), (4, 6, 3000, 0.3), (5, 3, 3, 0.0), (6, 5, 60, 0.99)])
def test_third_legs_equal_all_triples(spark, seed, accounts, spread, tolerance):
    rng = random.Random(seed)
    rows = [(rng.choice("PQ"), i, rng.choice("ABCDEFGH"[:accounts]), rng.randrange(600),
             1000 + rng.randrange(-spread, spread)) for i in range(160)]
    rows += [("P", 900 + i, a, u, c) for i, (a, u, c) in enumerate(
        [("A", 5, 0), ("B", 6, 0), ("C", 7, 0), ("A", 5, -100), ("B", 6, -100), ("C", 7, -100), ("A", -3, 0)])]
    rows += [(None, 950, "A", 1, 1000), ("P", 951, None, 2, 1000), ("P", 952, "B", None, 1000), ("P", 953, "C", 3, None)]
    got = [r["id"] for r in third_legs(_frame(spark, rows), 50, tolerance).collect()]
    want = _all_triples(rows, 50, tolerance)
    assert want and set(got) == want and len(got) == len(want)


def test_third_legs_of_an_empty_table_and_a_bad_tolerance(spark):
    assert third_legs(spark.createDataFrame([], SCHEMA), 50, 0.05).collect() == []
    with pytest.raises(ValueError):
        third_legs(spark.createDataFrame([], SCHEMA), 50, 1.0)


@pytest.mark.parametrize("keep", [latest_accounts, latest_without])
def test_a_hot_counterparty_keeps_a_few_legs_a_range(keep):
    """Nodes hold three legs at most and their number follows the amounts, not the rows."""
    rng, sizes = random.Random(3), []
    for n in (2_000, 20_000):
        amounts = Amounts(keep, Fraction(1, 20))
        for us in range(n):
            cents = 100_000 + rng.randrange(500)
            if keep is latest_accounts:
                assert len(before(amounts, cents, us - 100, us % 50)) == (2 if us > 2 else us)
            amounts.add(cents, (us, (us % 50,)))
        assert max(map(len, amounts.nodes.values())) <= 3
        sizes.append(len(amounts.nodes))
    assert sizes[1] <= 1.1 * sizes[0]


@pytest.mark.parametrize("batch", [1, 7, 10_000])
def test_few_legs_reach_the_tree_and_all_that_must(spark, monkeypatch, batch):
    """A busy counterparty is settled by its latest legs; behind a row of legs of one account the tree answers."""
    import pyarrow as pa

    from txmon.operators import chains
    rng, added = random.Random(9), []
    plain = Amounts.add
    monkeypatch.setattr(Amounts, "add", lambda self, *a: added.append(a) or plain(self, *a))

    def answers(accounts):
        legs = sorted(((us, found, us, account) for us, account in enumerate(accounts) for found in (False, True)),
                      key=lambda x: x[:2])
        rows = [{"party": "P", "band": 1, "bucket": 1, "us": us, "found": f, "cents": 1000 + rng.randrange(5),
                 "accounts": [a]} for us, f, _, a in legs]
        batches = [pa.RecordBatch.from_pylist(rows[i:i + batch]) for i in range(0, len(rows), batch)]
        return [x for _, found in chains._asked(batches, latest_accounts, Fraction(1, 20), 10_000, before) for x in found]
    busy = answers([rng.choice("ABCDEF") for _ in range(600)])
    assert not added and all(len(x) == 2 for x in busy[50:])
    hidden = answers([*"ABC", *"D" * 100, "E", "D"])
    assert added and [sorted(x) for x in hidden[:4]] == [[], ["A"], ["A", "B"], sorted(hidden[3])]
    assert all(len(x) == 2 and set(x) <= set("ABC") for x in hidden[3:103])
    assert "D" in hidden[103] and len(hidden[103]) == 2 and len(hidden[104]) == 2 and "D" not in hidden[104]
