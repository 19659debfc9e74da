"""Split joins, ranks and reports give the same rows as their literal forms, also when every key counts as crowded."""

from __future__ import annotations

import datetime as dt
import itertools
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bankflow.operators import fraud, joins, ledger, ranking, reconciliation, risk
from bankflow.operators.accounts import low_credit_accounts, suspicious_transactions, very_high_payments
from bankflow.plans import fan_out_left, left_join, split_layout
from bankflow.plans.skew import BASE
from tests.helpers import assert_same, bank

AS_OF = dt.date(2001, 8, 1)
CHUNKS = [1, 1_000_000]


def keyed(spark, seed, column, n):
    rng = random.Random(seed)
    data = [(None if rng.random() < 0.1 else ("hot" if rng.random() < 0.4 else rng.choice("abcd")), rng.randint(0, 5))
            for _ in range(n)]
    return spark.createDataFrame(data, f"k string, {column} int")


@pytest.mark.parametrize("chunk", CHUNKS)
@pytest.mark.parametrize("seed", [1, 2])
def test_left_join_with_copies(spark, chunk, seed):
    base, side = keyed(spark, seed, "x", 12), keyed(spark, seed + 10, "y", 15)
    found = left_join(base, side, "k", chunk, F.monotonically_increasing_id())
    assert_same(found, base.join(side, "k", "left"))


@pytest.mark.parametrize("seed", [3, 4])
def test_fan_out_over_several_axes(spark, seed):
    base = keyed(spark, seed, "x", 9).distinct()
    sides = {"one": keyed(spark, seed + 1, "y", 14).distinct(), "two": keyed(spark, seed + 2, "z", 8).distinct()}
    inputs = {BASE: base, **sides}
    factors = split_layout(inputs, "k", 1)
    assert factors.agg(F.max("_k_one")).first()[0] > 1
    expected = base.join(sides["one"], "k", "left").join(sides["two"], "k", "left")
    assert_same(fan_out_left(base, sides, "k", factors), expected)


def test_side_outside_the_grid_is_repeated(spark):
    base, one = keyed(spark, 6, "x", 9).distinct(), keyed(spark, 7, "y", 14).distinct()
    plain = keyed(spark, 8, "z", 6).distinct()
    factors = split_layout({"one": one}, "k", 1)
    expected = base.join(one, "k", "left").join(plain, "k", "left")
    assert_same(fan_out_left(base, {"one": one, "plain": plain}, "k", factors), expected)


def test_rows_of_a_hot_key_are_spread_over_tasks(spark, sixteen_tasks):
    base = spark.range(1, 200).select(F.col("id").alias("k"))
    side = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 200).alias("k"), "id")
    whole = left_join(base, side, "k", 1_000_000)
    split = left_join(base, side, "k", 500)
    assert largest_task(whole) > 10_000
    assert largest_task(split) < 6_000
    assert split.count() == whole.count()


def test_layout_of_a_large_input(spark):
    """One key in a third of the rows, the others well below the limit."""
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    assert [tuple(r) for r in split_layout({"only": df}, "k", 10_000).collect()] == [(-1, 2)]
    assert split_layout({"only": df.filter("k >= 0")}, "k", 10_000) is None


def test_layout_looks_at_the_product(spark):
    """No input is large, but what comes out of a key is; small inputs are not cut."""
    one = spark.range(3_000).select(F.when(F.col("id") < 900, 1).otherwise(F.col("id")).alias("k"))
    other = spark.range(2_000).select(F.when(F.col("id") < 800, 1).otherwise(F.col("id")).alias("k"))
    few = spark.createDataFrame([(1,), (1,), (2,)], "k long")
    [row] = split_layout({"one": one, "other": other, "few": few}, "k", 20_000).collect()
    assert row.k == 1 and row["_k_few"] == 1 and (row["_k_one"], row["_k_other"]) == (9, 8)
    cells = row["_k_one"] * row["_k_other"]
    assert 900 * 800 * 2 / cells <= 20_000
    whole = one.join(other, "k", "left").join(few, "k", "left").count()
    assert fan_out_left(one, {"other": other, "few": few}, "k", split_layout(
        {BASE: one, "other": other, "few": few}, "k", 20_000), F.monotonically_increasing_id()).count() == whole


def largest_task(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


@pytest.fixture
def sixteen_tasks(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_pairs_of_one_payment_are_spread_over_tasks(spark, sixteen_tasks):
    """30,000 rows of one payment, nearly all in one clearing system: 3.6 million pairs, none of them in one task."""
    payments = spark.range(30_000).select(
        F.lit(7).cast("long").alias("PaymentID"), (F.col("id") % 5 * 100.0).alias("Amount"),
        F.lit(AS_OF).alias("PaymentDate"),
        F.when(F.col("id") % 500 == 0, "SEPA").otherwise("SWIFT").alias("ClearingSystem"))
    pairs = reconciliation.payment_reconciliation(payments)
    expected = 2 * 60 * 29_940
    assert pairs.count() == expected and largest_task(pairs) < expected / 3


def test_copies_of_one_row_are_spread_over_tasks(spark, sixteen_tasks):
    df = spark.createDataFrame([("a", 100_000), ("b", 3)], "x string, n long")
    repeated = joins.repeat_rows(df, "n", 1_000)
    assert repeated.count() == 100_003 and largest_task(repeated) < 30_000
    assert {r.x: r["count"] for r in repeated.groupBy("x").count().collect()} == {"a": 100_000, "b": 3}


def test_lookups_are_broadcast_by_their_known_size(spark):
    """No shuffle by currency or segment, each of which has a handful of values."""
    tables = bank(spark, 61)

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    rates = plan(joins.accounts_with_rates(tables["accounts"], risk.exchange_rates(spark)))
    assert "BroadcastHashJoin" in rates and "hashpartitioning(Currency" not in rates
    chain = plan(joins.payments_with_derived(tables["payments"]))
    assert "hashpartitioning(CustomerSegment" not in chain


@pytest.mark.parametrize("chunk", CHUNKS)
def test_either_end_join(spark, chunk):
    tables = bank(spark, 11)
    expected = spark.sql(
        "select a.AccountID, a.Balance, p.PaymentID, p.FromAccountID, p.ToAccountID, p.Amount as PaymentAmount "
        "from accounts a left join payments p "
        "on cast(a.AccountID as string) = p.FromAccountID or cast(a.AccountID as string) = p.ToAccountID"
    )
    assert_same(joins.accounts_with_payments(tables["accounts"], tables["payments"], chunk), expected)


def test_payment_to_oneself_matches_once(spark):
    accounts = bank(spark, 1)["accounts"].filter("AccountID = 5").limit(1)
    payments = spark.createDataFrame(
        [(1, "5", "5", 10.0)], "PaymentID long, FromAccountID string, ToAccountID string, Amount double"
    )
    assert joins.accounts_with_payments(accounts, payments).count() == 1


def dicts(df):
    return [r.asDict() for r in df.collect()]


def found_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def signs(tables):
    """Per account: its suspicious transactions, very high payments and low scores, with repeats."""
    flagged, large, weak = {}, {}, {}
    for t in dicts(tables["transactions"]):
        if t["Suspecious"]:
            flagged.setdefault(t["AccountID"], []).append(t["TransactionID"])
    for p in dicts(tables["payments"]):
        if p["Amount"] * p["ExchangeRate"] > 100000:
            large.setdefault(p["FromAccountID"], []).append(p["PaymentID"])
    for a in dicts(tables["accounts"]):
        if a["CreditScore"] < 400:
            weak.setdefault(None if a["AccountID"] is None else str(a["AccountID"]), []).append(a["CreditScore"])
    return flagged, large, weak


def side_by_side(*sets, accounts):
    """Combinations of one row of each set of an account; an empty set counts as one None. None meets nothing."""
    for account in accounts:
        if account is None:
            for n, held in enumerate(sets):
                for value in held.get(None, []):
                    yield account, *(value if k == n else None for k in range(len(sets)))
        else:
            yield from ((account, *values) for values in itertools.product(*(held.get(account, [None]) for held in sets)))


@pytest.mark.parametrize("chunk", CHUNKS)
@pytest.mark.parametrize("seed", [21])
def test_full_outer_chain(spark, chunk, seed):
    tables = bank(spark, seed)
    flagged, large, weak = signs(tables)
    expected = [
        (account, transaction, True, account if payment else None, payment, account if score else None, score)
        for account, transaction, payment, score in side_by_side(
            {k: [(v,) for v in held] for k, held in flagged.items()}, {k: [(v,) for v in held] for k, held in large.items()},
            {k: [(v,) for v in held] for k, held in weak.items()}, accounts=[k for k in flagged if k is not None])
    ]
    expected = [(a, t[0], s, pa, p and p[0], sa, c and c[0]) for a, t, s, pa, p, sa, c in expected]
    expected += [(None, t, True, None, None, None, None) for t in flagged.get(None, [])]
    expected += [(None, None, None, k, p, None, None) for k, held in large.items() for p in held if k is None or k not in flagged]
    expected += [(None, None, None, None, None, k, c) for k, held in weak.items() for c in held if k is None or k not in flagged]
    found = joins.full_outer_chain(
        suspicious_transactions(tables["transactions"]), very_high_payments(tables["payments"]),
        low_credit_accounts(tables["accounts"]), chunk,
    )
    assert found_rows(found) == sorted(expected, key=repr)


@pytest.mark.parametrize("chunk", CHUNKS)
@pytest.mark.parametrize("seed", [31, 32])
def test_potential_fraud(spark, chunk, seed):
    t = bank(spark, seed)
    args = t["accounts"], t["transactions"], t["payments"], chunk
    flagged, large, weak = ({k: [(v,) for v in held] for k, held in sign.items()} for sign in signs(t))

    def counted(combinations):
        groups = Counter(
            (account, a and a[0], b and str(b[0]) if b and b[0] is not None else None, True if a else None, c and c[0])
            for account, a, b, c in combinations)
        return sorted(((*key, n) for key, n in groups.items()), key=repr)

    everyone = {*flagged, *large, *weak}
    assert found_rows(fraud.potential_fraud_accounts_coalesced(*args)) == counted(
        side_by_side(flagged, large, weak, accounts=everyone))
    literal = list(side_by_side(flagged, large, weak, accounts=[k for k in flagged if k is not None]))
    literal += [(None, v, None, None) for v in flagged.get(None, [])]
    literal += [(None, None, v, None) for k, held in large.items() if k is None or k not in flagged for v in held]
    literal += [(None, None, None, v) for k, held in weak.items() if k is None or k not in flagged for v in held]
    assert found_rows(fraud.potential_fraud_accounts(*args)) == counted(literal)


def reconciled(payments):
    out = []
    for one, other in itertools.permutations(payments, 2):
        systems = one["ClearingSystem"], other["ClearingSystem"]
        if one["PaymentID"] != other["PaymentID"] or None in systems or systems[0] == systems[1]:
            continue
        gap = abs(one["Amount"] - other["Amount"]) / one["Amount"] * 100 if one["Amount"] else None
        days = abs((one["PaymentDate"] - other["PaymentDate"]).days)
        status = "Mismatched" if (gap is not None and gap > 1) or days > 2 else "Matched"
        out.append((str(one["PaymentID"]), *systems, gap, days, status))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk", CHUNKS)
@pytest.mark.parametrize("seed", [41, 42])
def test_reconciliation(spark, chunk, seed):
    payments = bank(spark, seed)["payments"]
    assert found_rows(reconciliation.payment_reconciliation(payments, chunk)) == reconciled(dicts(payments))


def exact(values):
    return float(sum(Decimal(str(v)) for v in values))


def expected_ledger(tables):
    """Account by account, from the meaning of the columns."""
    accounts, payments, transactions = (dicts(tables[n]) for n in ("accounts", "payments", "transactions"))

    def figures(column):
        """Count, sum, average, largest and least amount per value; a NULL has no figures in a join."""
        amounts = {}
        for p in payments:
            amounts.setdefault(p[column], []).append(p["Amount"])
        return {k: (len(v), exact(v), exact(v) / len(v), max(v), min(v)) for k, v in amounts.items() if k is not None}

    merchants, segments = figures("MerchantName"), figures("CustomerSegment")
    fees = {}
    for p in payments:
        if p["PaymentID"] is not None and p["Amount"] and p["Fee"] / p["Amount"] > 0.05:
            fees.setdefault(p["PaymentID"], set()).add(p["Fee"] / p["Amount"] * 100)
    out = set()
    for a in accounts:
        if a["AccountID"] is None:
            continue
        me = str(a["AccountID"])
        paid = [p for p in payments if me in (p["FromAccountID"], p["ToAccountID"])]
        traded = [t for t in transactions if t["AccountID"] == me]
        failed = [t for t in traded if t["Status"] == "Failed"]
        shares = {(b["ODLimit"] - b["Balance"]) / b["ODLimit"] * 100 for b in accounts
                  if b["AccountID"] == a["AccountID"] and b["ODLimit"] > b["Balance"] and b["ODLimit"] != 0}
        low = {(b["Balance"],) for b in accounts if b["AccountID"] == a["AccountID"] and b["Balance"] < 1000
               and b["DateOpened"] is not None and b["DateOpened"] >= dt.date(2000, 8, 1)}
        high = {(p["Amount"] * p["ExchangeRate"], p["PaymentDate"], p["MerchantName"], p["Description"]) for p in paid
                if p["Amount"] * p["ExchangeRate"] > 10000 and p["Currency"] not in (None, "USD")}
        failures = {tuple(t[c] for c in ("TransactionID", "Amount", "Currency", "Status", "EventTs", "Description"))
                    for t in failed}
        months = {(n,) for n in Counter(t["TransactionDate"][3:] for t in failed).values()}
        payments_shown = set()
        for p in paid:
            count, total, average, most, least = merchants.get(p["MerchantName"], (None,) * 5)
            for share in fees.get(p["PaymentID"], {None}):
                payments_shown.add((
                    share, total, average, most, least, count, *segments.get(p["CustomerSegment"], (None,) * 3)[:3],
                    *(p[c] for c in ("PaymentID", "FromAccountID", "ToAccountID", "Amount", "Currency", "PaymentDate",
                                     "MerchantName", "Description", "PaymentType", "Fee"))))
        trades = {tuple(t[c] for c in ("TransactionID", "TransactionType", "Amount", "Currency", "Status", "EventTs",
                                       "Description", "TransactionFee", "TransactionDate", "Suspecious")) for t in traded}
        own = tuple(a[c] for c in ("AccountID", "AccountType", "Balance", "Currency", "CreditScore", "DateOpened",
                                   "ManagerID", "ODLimit"))
        widths = ((low, 1), (high, 4), (failures, 6), (months, 1), (payments_shown, 19), (trades, 10))
        for share in shares:
            for l, h, f, m, p, t in itertools.product(*(rows or {(None,) * width} for rows, width in widths)):
                out.add((*own, share, *h, *l, *f, p[0], *p[1:6], *p[6:9], *m, *p[9:], *t))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed, chunk", [(51, 2), (52, 2), (51, 1_000_000), (52, 1_000_000)])
def test_ledger(spark, seed, chunk):
    """Repeated accounts, copies and equal segments included; no final DISTINCT on our side."""
    t = bank(spark, seed)
    found = ledger.ledger_flattened(t["accounts"], t["payments"], t["transactions"], AS_OF, chunk)
    left = found_rows(found)
    assert len(left) == len(set(left))
    assert left == expected_ledger(t)


@pytest.mark.parametrize("ranges", [None, 1, 5])
def test_rank_in_group(spark, ranges):
    rng = random.Random(5)
    data = [(rng.choice(["A", "A", "B", None]), i, rng.choice([None, 1, 2, 3, 5, 8, 13, 21])) for i in range(60)]
    data.append(("C", 99, None))
    df = spark.createDataFrame(data, "region string, id int, population long")
    df.createOrReplaceTempView("ranked")
    expected = spark.sql("select *, rank() over (partition by region order by population desc) as rank from ranked")
    assert_same(ranking.rank_in_group(df, "region", "population", ranges), expected)
    assert_same(ranking.top_in_group(df, "region", "population"), expected.filter("rank = 1").drop("rank"))
