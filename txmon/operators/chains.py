"""Chains of three legs to one counterparty, linear in the legs.

A leg follows another when it goes to the same counterparty from another account, later but within a
window, and their amounts are close.  Instead of building the pairs, legs are swept in order of time
inside (counterparty, amount band, time bucket).  A binary tree over the amounts keeps for each range
only the few latest legs that can matter: three of different accounts, or, for legs that are
second in a chain, the latest and the latest without each of its accounts.  A leg costs the depth of that tree,
whatever the number of legs near it, and a task holds times, amounts and accounts of one group.  Before the tree is
asked, the latest legs of the group are looked at, all rows of a batch at once: they settle almost every leg, and
a tree is built only for the groups with a leg that they don't.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A leg in the sweep: its time and the accounts a leg that follows must differ from.
Leg = tuple[int, tuple]


def latest_accounts(legs: list[Leg]) -> list[Leg]:
    """The latest legs of three accounts: whoever asks, two accounts other than its own are left."""
    out: list[Leg] = []
    for leg in legs:
        if all(leg[1] != o[1] for o in out):
            out.append(leg)
    return out[:3]


def latest_without(legs: list[Leg]) -> list[Leg]:
    """The latest leg, and for each of its accounts the latest leg without it: the best for every asker."""
    out = legs[:1]
    for account in legs[0][1]:
        out += [leg for leg in legs if account not in leg[1]][:1]
    return sorted(dict.fromkeys(out), key=lambda leg: -leg[0])


class Amounts:
    """Legs by amount in cents: each node of a sparse binary tree holds what ``keep`` leaves of its legs,
    newest first.  Legs are added in order of time."""

    def __init__(self, keep: Callable[[list[Leg]], list[Leg]], tolerance: Fraction):
        self.keep, self.p, self.q = keep, tolerance.numerator, tolerance.denominator
        self.nodes: dict[tuple[int, int], list[Leg]] = {}

    def close(self, cents: int) -> tuple[int, int]:
        """First and last amount a with |cents - a| <= a * tolerance."""
        return -(-cents * self.q // (self.q + self.p)), cents * self.q // (self.q - self.p)

    def add(self, cents: int, leg: Leg) -> None:
        first, last = self.close(cents * (self.q + self.p) // self.q)  # the widest range that holds it
        for level in range((last - first + 2).bit_length()):
            at = level, cents >> level
            self.nodes[at] = self.keep([leg, *self.nodes.get(at, ())])

    def near(self, cents: int, since: int) -> Iterator[Leg]:
        """Kept legs of close amounts, not older than ``since``."""
        first, last = self.close(cents)
        end, level = last + 1, 0
        while first < end:
            if first & 1:
                yield from (leg for leg in self.nodes.get((level, first), ()) if leg[0] >= since)
                first += 1
            if end & 1:
                end -= 1
                yield from (leg for leg in self.nodes.get((level, end), ()) if leg[0] >= since)
            first, end, level = first >> 1, end >> 1, level + 1


def before(amounts: Amounts, cents: int, since: int, account) -> list:
    """Accounts of the legs that this one follows: none, the only one, or two of them."""
    found: list = []
    for _, (other,) in amounts.near(cents, since):
        if other != account and other not in found:
            found.append(other)
            if len(found) == 2:
                break
    return found


#: Latest legs at which an ask looks before the tree.
BACK = 32


def _quick(legs: pa.Table, tolerance: Fraction, window_us: int, follows: bool) -> tuple[np.ndarray, list]:
    """For each ask of sorted ``legs`` whether the ``BACK`` latest legs found before it settle the answer, and
    that answer: they do if it is complete, or if no older leg is left in the window."""
    ints = lambda c: legs.column(c).to_numpy()
    found, us, cents = ints("found"), ints("us"), ints("cents")
    asks, at = np.flatnonzero(~found), np.flatnonzero(found)
    if len(cents) and cents.max() > (1 << 62) // (tolerance.numerator + tolerance.denominator):
        return np.zeros(len(asks), bool), [None] * len(asks)  # too large for products of longs
    lists = legs.column("accounts").combine_chunks()
    values = lists.flatten().dictionary_encode()
    code, sizes = values.indices.to_numpy(), lists.value_lengths().to_numpy()
    first = np.cumsum(sizes) - sizes
    one = code[first]
    two = np.where(sizes > 1, code[np.minimum(first + 1, len(code) - 1)], -1) if len(code) else one
    n_found = np.cumsum(found) - found  # legs found before each row
    new = _new_groups(legs)
    start = n_found[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))][asks]
    f_us, f_cents, f_one, f_two = us[at], cents[at], one[at], two[at]
    a_us, a_cents, own, last = us[asks] - window_us, cents[asks], one[asks], n_found[asks]
    got = np.full((len(asks), 2), -1, np.int64)
    left = np.arange(len(asks))  # asks that still look
    for j in range(1, BACK + 2):
        to = last[left] - j
        inside = to >= start[left]
        left, to = left[inside], to[inside]
        inside = f_us[to] >= a_us[left]
        left, to = left[inside], to[inside]
        if j > BACK or not len(left):
            break
        hit = np.abs(a_cents[left] - f_cents[to]) * tolerance.denominator <= f_cents[to] * tolerance.numerator
        hit &= (f_one[to] != own[left]) & (f_two[to] != own[left])
        if follows:
            got[left[hit], 0] = 1
            left = left[~hit]
        else:
            hit &= f_one[to] != got[left, 0]
            row, account = left[hit], f_one[to[hit]]
            second = got[row, 0] >= 0
            got[row[second], 1] = account[second]
            got[row[~second], 0] = account[~second]
            left = left[got[left, 1] < 0]
    settled = np.ones(len(asks), bool)
    settled[left] = False
    if follows:
        return settled, (got[:, 0] > 0).tolist()
    names = values.dictionary.to_pylist()
    return settled, [[names[x] for x in pair if x >= 0] for pair in got.tolist()]


def _new_groups(legs: pa.Table) -> np.ndarray:
    """Rows with which a (party, band, bucket) begins."""
    new = np.ones(len(legs), bool)
    if len(legs) > 1:
        party = legs.column("party").combine_chunks().dictionary_encode()
        party = (party.combine_chunks() if isinstance(party, pa.ChunkedArray) else party).indices.to_numpy()
        band, bucket = legs.column("band").to_numpy(), legs.column("bucket").to_numpy()
        new[1:] = (party[1:] != party[:-1]) | (band[1:] != band[:-1]) | (bucket[1:] != bucket[:-1])
    return new


def _asked(batches, keep, tolerance: Fraction, window_us: int, answer):
    """Sweep sorted batches: legs to be found are added, the others asked; (asking rows, answers) a batch.

    Most asks are settled by the latest legs before them.  Legs enter a tree only where an ask of their
    group is not, from the first leg of the group on.
    """
    tail: pa.Table | None = None      # the last legs found
    at, waiting, amounts = None, [], None  # the group at the end of the last batch, its legs, their tree
    for batch in batches:
        legs = pa.Table.from_batches([batch])
        if not len(legs):
            continue
        both = legs if tail is None else pa.concat_tables([tail, legs])
        settled, answers = _quick(both, tolerance, window_us, keep is latest_without)
        found = legs.column("found").combine_chunks().to_numpy(zero_copy_only=False)
        starts = [int(i) for i in np.flatnonzero(_new_groups(legs))]
        key = lambda i: tuple(legs.column(c)[i].as_py() for c in ("party", "band", "bucket"))  # noqa: E731, B023
        if key(0) != at:
            waiting, amounts = [], None
        ask_rows = np.flatnonzero(~found)
        open_rows = {int(i): k for k, i in enumerate(ask_rows) if not settled[k]}
        ends = [*starts[1:], len(legs)]
        hard = np.searchsorted(starts, list(open_rows), side="right") - 1 if open_rows else []
        for g in sorted(set(map(int, hard))):
            if g:
                waiting, amounts = [], None
            amounts = amounts or Amounts(keep, tolerance)
            for us, cents, accounts in (leg for w in waiting for leg in zip(*(c.to_pylist() for c in w.columns), strict=True)):
                amounts.add(cents, (us, tuple(accounts)))
            waiting = []
            part = legs.slice(starts[g], ends[g] - starts[g])
            columns = [part.column(c).to_pylist() for c in ("us", "found", "cents", "accounts")]
            for i, us, is_found, cents, accounts in zip(range(starts[g], ends[g]), *columns, strict=True):
                if is_found:
                    amounts.add(cents, (us, tuple(accounts)))
                elif i in open_rows:
                    answers[open_rows[i]] = answer(amounts, cents, us - window_us, accounts[0])
        g = len(starts) - 1
        if g not in set(map(int, hard)):
            if g:
                waiting, amounts = [], None
            part = legs.slice(starts[g])
            waiting.append(part.filter(part.column("found")).select(["us", "cents", "accounts"]))
        at = key(len(legs) - 1)
        known = both.filter(both.column("found"))
        tail = known.slice(max(0, len(known) - BACK - 1)).combine_chunks()
        yield batch.filter(pc.invert(batch.column("found"))), answers


def _sides(legs: DataFrame, band: Column, bucket: Column, starts: Column) -> DataFrame:
    """Each leg once as it asks and, where ``starts``, as it may be found from the neighbouring bands and
    the next bucket; sorted by time, those that ask before those found at the same time."""
    place = lambda b, t, found: F.struct(b.alias("band"), t.alias("bucket"), F.lit(found).alias("found"))
    asks = F.array(place(band, bucket, False))
    near = F.array(*[place(band + d, bucket + e, True) for d in (-1, 0, 1) for e in (0, 1)])
    both = legs.withColumn("_at", F.explode(F.when(starts, F.concat(asks, near)).otherwise(asks)))
    key = ["party", "band", "bucket"]
    return both.select("party", F.when(~F.col("_at.found"), F.col("id")).alias("id"), "us", "cents", "accounts", "_at.*").repartition(*key).sortWithinPartitions(
        *key, "us", "found")


def third_legs(legs: DataFrame, window_us: int, tolerance: float) -> DataFrame:
    """Ids of the legs that are third in a chain, one row for each such leg.

    ``legs``: party, id, account, us, amount.  In a chain of three, each leg comes after the one before it by
    more than 0 and at most ``window_us``, its amount b is close to the amount a before it,
    |b - a| <= a * tolerance, and the three accounts differ.  Amounts are compared in whole cents; rows
    with a null party, account, time or amount are in no chain, nor are amounts below zero.
    """
    if not 0 <= tolerance < 1:
        raise ValueError(f"a tolerance of {tolerance} is not in [0, 1)")
    share = Fraction(str(tolerance))
    cents = (F.col("amount").cast("decimal(18,2)") * 100).cast("bigint")
    legs = legs.select("party", "id", F.array("account").alias("accounts"), F.col("us").cast("bigint").alias("us"),
                       cents.alias("cents")).where(
        "party IS NOT NULL AND accounts[0] IS NOT NULL AND us IS NOT NULL AND cents >= 0")
    # close amounts lie in neighbouring bands of a logarithmic scale, a little wider than the tolerance
    width = max(math.log1p(tolerance), -math.log1p(-tolerance), 1e-6) * (1 + 1e-9)
    band = F.when(F.col("cents") > 0, F.floor(F.ln("cents") / width)).otherwise(-10).cast("bigint")  # zero is close to zero only
    bucket = F.floor(F.col("us") / F.lit(window_us)).cast("bigint")
    accounts_type = legs.schema["accounts"].dataType
    leg_type = T.StructType([legs.schema[c] for c in ("party", "id", "us", "cents")]
                            + [T.StructField("accounts", accounts_type), T.StructField("before", accounts_type)])

    def second(batches):
        for asks, found in _asked(batches, latest_accounts, share, window_us, before):
            kind = asks.schema.field("accounts").type
            yield pa.RecordBatch.from_arrays(
                [*(asks.column(c) for c in ("party", "id", "us", "cents", "accounts")), pa.array(found, kind)],
                ["party", "id", "us", "cents", "accounts", "before"])

    def third(batches):
        follows = lambda amounts, cents, since, account: any(
            account not in leg[1] for leg in amounts.near(cents, since))
        for asks, found in _asked(batches, latest_without, share, window_us, follows):
            yield pa.RecordBatch.from_arrays([asks.column("id").filter(pa.array(found, pa.bool_()))], ["id"])

    followed = _sides(legs, band, bucket, F.lit(True)).mapInArrow(second, leg_type)
    # a second leg bars its own account and, where it is the only one, that of the first leg
    barred = F.when(F.size("before") == 1, F.concat("accounts", "before")).otherwise(F.col("accounts"))
    chained = followed.select("party", "id", "us", "cents", barred.alias("accounts"), F.size("before").alias("n"))
    return _sides(chained, band, bucket, F.col("n") > 0).mapInArrow(third, T.StructType([legs.schema["id"]]))
