"""Bucketed tables: what a merge touches, that it gives what the plain merges give, chains of versions."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from bankflow.operators import scd
from bankflow.plans import merges
from bankflow.plans.ordered import in_ranges, with_next, with_previous
from bankflow.schemas import CUSTOMER, CUSTOMER_STAGING, LOANS, LOANS_STAGING_TIMED
from bankflow.sources import BucketedTable, SnapshotTable
from bankflow.streaming import stream_scd1, stream_scd2
from tests.helpers import assert_same, rows
from tests.test_scd import D0, D1, D2, customers, loans, pairs, staged


def pieces(table):
    return {(p["bucket"], p["area"], p["data_version"]) for p in table.manifest()}


def test_a_merge_touches_only_the_buckets_of_its_keys(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), CUSTOMER, "CustomerID", 8)
    merges.seed(table, customers(spark, *[(i, "old") for i in range(60)]))
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "t" / "data").rglob("*.parquet")}
    before = pieces(table)
    counts = merges.merge_type1(table, staged(spark, (7, "new")), D1, "day 1")
    touched = table.touched(staged(spark, (7, "new")))
    assert len(touched) == 1 and len(before) == 8
    assert before - pieces(table) == {(touched[0], "open", 0)} and pieces(table) - before == {(touched[0], "open", 1)}
    assert all(f.stat().st_mtime_ns == at for f, at in files.items())
    written = list((tmp_path / "t" / "data" / "v=1").rglob("*.parquet"))
    assert {f.parent.name for f in written} == {f"_bucket={touched[0]}"}
    assert pairs(table.read()) == sorted([(i, "new" if i == 7 else "old", D1 if i == 7 else D0) for i in range(60)], key=repr)
    assert pairs(table.read(0)) == sorted([(i, "old", D0) for i in range(60)], key=repr)
    assert (counts.kept, counts.updated, counts.inserted, counts.closed) == (59, 1, 0, 0)


def test_lookup_reads_one_bucket(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), CUSTOMER, "CustomerID", 8)
    merges.seed(table, customers(spark, *[(i, "a") for i in range(60)]))
    found = table.lookup(staged(spark, (9, "x"), (9, "y"), (1000, "z")))
    assert pairs(found) == [(9, "a", D0)]
    read = {f.split("_bucket=")[1].split("/")[0] for f in found.inputFiles() if "_bucket=" in f}
    assert read <= {str(b) for b in table.touched(staged(spark, (9, "x"), (1000, "z")))}


@pytest.mark.parametrize("buckets", [1, 5])
def test_merges_give_what_whole_merges_give(spark, tmp_path, buckets):
    rng = random.Random(buckets)
    one = BucketedTable(spark, str(tmp_path / "one"), CUSTOMER, "CustomerID", buckets)
    two = merges.history_table(spark, str(tmp_path / "two"), LOANS, "LoanID", buckets)
    plain_one, plain_two = customers(spark, (1, "a"), (2, "b"), (None, "n")), spark.createDataFrame([], LOANS)
    merges.seed(one, plain_one)
    for day in range(4):
        moment = D1 + dt.timedelta(days=day)
        ids = rng.sample(range(12), 5) if day != 2 else []
        staging = staged(spark, *[(i, rng.choice("ab")) for i in ids], (None, f"day {day}"))
        merges.merge_type1(one, staging, moment, f"day {day}")
        plain_one = scd.scd1_customer(plain_one, staging, moment)
        borrowed = loans(spark, *[(i, rng.choice([1.0, 2.0]), rng.choice([None, "x"])) for i in ids])
        merges.merge_type2(two, borrowed, moment, f"day {day}")
        plain_two = scd.scd2_merge(plain_two, borrowed, moment)
    assert_same(one.read(), plain_one)
    assert_same(two.read(), plain_two)
    assert_same(two.read_open(), scd.current_rows(plain_two))
    total = one.read().count()
    last = one.log().orderBy(F.desc("version")).first()
    assert last["kept"] + last["updated"] + last["inserted"] == total


def test_closed_versions_are_added_and_compacted(spark, tmp_path):
    table = merges.history_table(spark, str(tmp_path / "t"), LOANS, "LoanID", 1)
    for day in range(5):
        counts = merges.merge_type2(table, loans(spark, (1, float(day), "x"), (2, 0.0, "x")), D1 + dt.timedelta(days=day), f"{day}")
        assert (counts.kept, counts.inserted, counts.closed) == ((0, 2, 0) if day == 0 else (day, 1, 1))
    settled = [p for p in table.manifest() if p["area"] == "settled"]
    assert [p["row_count"] for p in settled] == [1] * 4
    before = rows(table.read())
    assert table.compact("tidy", most_pieces=4) == 4
    assert table.compact("tidy more", most_pieces=3) == 5 and table.compact("tidy more", most_pieces=3) == 5
    assert [p["row_count"] for p in table.manifest() if p["area"] == "settled"] == [4]
    assert rows(table.read()) == before and rows(table.read(4)) == before
    merges.merge_type2(table, loans(spark, (1, 9.0, "x")), D1 + dt.timedelta(days=9), "9")
    assert table.read().count() == len(before) + 1 and table.read_open().count() == 2


def test_batches_are_merged_once_and_leftovers_replaced(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), CUSTOMER, "CustomerID", 4)
    assert table.version() is None and table.read().isEmpty() and table.compact("none") is None
    assert merges.merge_type1(table, staged(spark), D1, "empty").inserted == 0
    assert table.read().isEmpty()
    merges.merge_type1(table, staged(spark, (1, "a")), D1, "day 1")
    assert merges.merge_type1(table, staged(spark, (2, "never")), D1, "day 1") is None
    # A writer that died before its commit.
    customers(spark, (8, "lost")).write.parquet(str(tmp_path / "t/data/v=2/_area=open/_bucket=1"))
    merges.merge_type1(table, staged(spark, (2, "b")), D2, "day 2")
    assert pairs(BucketedTable(spark, str(tmp_path / "t"), CUSTOMER, "CustomerID", 4).read()) == [(1, "a", D1), (2, "b", D2)]
    with pytest.raises(ValueError, match="CustomerID = 3"):
        merges.merge_type1(table, staged(spark, (3, "a"), (3, "b")), D2, "day 3")
    assert table.version() == 2


def timed(spark, *versions):
    """(id, amount, moment) as staging."""
    return spark.createDataFrame(
        [(dt.date(2000, 1, 1), "Home", "Weekly", 1.5, 9, "Active", i, amount, dt.date(2010, 1, 1), None, at)
         for i, amount, at in versions], LOANS_STAGING_TIMED)


@pytest.mark.parametrize("ranges", [None, 6])
def test_chain_equals_a_merge_for_each_moment(spark, ranges):
    """One loan with most of the versions, over several ranges; values come back and repeat."""
    rng = random.Random(3)
    moments = [D1 + dt.timedelta(hours=h) for h in range(40)]
    versions = [(1, float(rng.choice([1, 2, 2])), at) for at in moments]
    versions += [(i, float(rng.choice([1, 2])), at) for i in (2, 3) for at in rng.sample(moments, 4)]
    history = scd.as_current(loans(spark, (1, 1.0, None), (3, 5.0, None), (4, 4.0, None)), D0)
    chained = scd.scd2_chain(history, timed(spark, *versions).repartition(5), "arrived", ranges=ranges)
    state = {1: [(1.0, D0)], 3: [(5.0, D0)], 4: [(4.0, D0)]}
    for i, amount, at in sorted(versions, key=lambda v: v[2]):
        held = state.setdefault(i, [])
        if not held or held[-1][0] != amount:
            held.append((amount, at))
    expected = [
        (i, amount, k == len(held) - 1, at, None if k == len(held) - 1 else held[k + 1][1])
        for i, held in state.items() for k, (amount, at) in enumerate(held)]
    found = [(r.LoanID, r.Amount, r.is_current, r.valid_from, r.valid_to) for r in chained.collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr) and len(found) > 20


def test_chain_refuses_rows_without_a_place(spark):
    history = scd.as_current(loans(spark, (1, 1.0, None)), D1)
    for bad in ([(1, 2.0, D0)], [(1, 2.0, D1)], [(2, 1.0, D2), (2, 3.0, D2)]):
        with pytest.raises(ValueError, match="no later than"):
            scd.scd2_chain(history, timed(spark, *bad), "arrived")
    kept = scd.scd2_chain(history, timed(spark, (None, 1.0, D0), (None, 1.0, D0)), "arrived", kind="kind")
    assert sorted((r.LoanID or 0, r.kind) for r in kept.collect()) == [(0, "inserted"), (0, "inserted"), (1, "kept")]


@pytest.mark.parametrize("bucketed", [True, False])
def test_stream_keeps_every_version(spark, tmp_path, bucketed):
    path = str(tmp_path / "loans")
    table = merges.history_table(spark, path, LOANS, "LoanID", 3) if bucketed else SnapshotTable(spark, path, LOANS)
    staging, checkpoint = str(tmp_path / "staging"), str(tmp_path / "checkpoint")
    timed(spark, (1, 10.0, D0), (2, 5.0, D0)).write.parquet(staging)
    timed(spark, (1, 11.0, D1), (2, 5.0, D1)).write.mode("append").parquet(staging)
    stream_scd2(spark, staging, LOANS_STAGING_TIMED, checkpoint, table, "LoanID", moment="arrived")
    timed(spark, (1, 10.0, D2)).write.mode("append").parquet(staging)
    result = stream_scd2(spark, staging, LOANS_STAGING_TIMED, checkpoint, table, "LoanID", moment="arrived")
    assert sorted(((r.LoanID, r.Amount, r.valid_from, r.valid_to) for r in result.collect()), key=repr) == [
        (1, 10.0, D0, D1), (1, 10.0, D2, None), (1, 11.0, D1, D2), (2, 5.0, D0, None)]
    with pytest.raises(ValueError, match="either"):
        stream_scd2(spark, staging, LOANS_STAGING_TIMED, checkpoint, table, "LoanID")


def test_stream_into_a_bucketed_table(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "customers"), CUSTOMER, "CustomerID", 4)
    staging = str(tmp_path / "staging")
    staged(spark, (1, "a"), (2, "b")).write.parquet(staging)
    for _ in range(2):
        result = stream_scd1(spark, staging, CUSTOMER_STAGING, str(tmp_path / "c"), table, "CustomerID", D1)
    assert pairs(result) == [(1, "a", D1), (2, "b", D1)] and table.version() == 0


def test_neighbours_across_ranges(spark):
    df = spark.createDataFrame([(k, i, i * 10) for k in (1, 2) for i in range(50 if k == 1 else 3)], "k int, i int, v int")
    placed = in_ranges(df.repartition(4), "k", "i", 5)
    assert placed.select("_range").distinct().count() > 2
    both = with_next(with_previous(placed, "k", "i", ["v"], "before"), "k", "i", ["v"], "after")
    for r in both.collect():
        last = 49 if r.k == 1 else 2
        assert (r.before.v if r.before else None) == (None if r.i == 0 else r.v - 10)
        assert (r.after.v if r.after else None) == (None if r.i == last else r.v + 10)
