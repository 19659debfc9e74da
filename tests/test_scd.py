from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from bankflow.operators import scd
from bankflow.plans import materialize
from bankflow.schemas import CUSTOMER, CUSTOMER_STAGING, LOANS, LOANS_STAGING
from bankflow.sources import SnapshotTable
from bankflow.streaming import stream_scd1, stream_scd2
from tests.helpers import assert_same

D0, D1, D2 = (dt.datetime(2001, 1, n, 6) for n in (1, 2, 3))


def customers(spark, *rows):
    """(id, address) pairs as a target table."""
    return spark.createDataFrame(
        [(i, "F", "L", dt.date(1980, 1, 1), None, "555", address, 1, D0) for i, address in rows], CUSTOMER
    )


def staged(spark, *rows):
    return spark.createDataFrame(
        [(i, "F", "L", "1980-01-01", None, "555", address, 1) for i, address in rows], CUSTOMER_STAGING
    )


def loans(spark, *rows):
    """(id, amount, collateral) triples as staging."""
    return spark.createDataFrame(
        [(dt.date(2000, 1, 1), "Home", "Weekly", 1.5, 9, "Active", i, amount, dt.date(2010, 1, 1), collateral)
         for i, amount, collateral in rows], LOANS_STAGING
    )


def pairs(df):
    return sorted(((r.CustomerID, r.Address, r.last_update) for r in df.collect()), key=repr)


def test_scd1_updates_inserts_and_keeps(spark):
    merged = scd.scd1_customer(customers(spark, (1, "a"), (2, "b")), staged(spark, (2, "B"), (3, "c")), D1)
    assert pairs(merged) == [(1, "a", D0), (2, "B", D1), (3, "c", D1)]
    assert merged.schema["DateOfBirth"].dataType.typeName() == "date"


def test_scd1_null_key_is_inserted_and_kept(spark):
    merged = scd.scd1_customer(customers(spark, (None, "a")), staged(spark, (None, "b")), D1)
    assert pairs(merged) == [(None, "a", D0), (None, "b", D1)]


def test_scd1_null_in_staging_replaces_a_value(spark):
    merged = scd.scd1_customer(customers(spark, (1, "a")), staged(spark, (1, None)), D1)
    assert pairs(merged) == [(1, None, D1)]


def test_scd1_twice_is_once(spark):
    target, staging = customers(spark, (1, "a"), (2, "b")), staged(spark, (2, "B"), (3, "c"))
    once = scd.scd1_customer(target, staging, D1)
    assert_same(scd.scd1_customer(once, staging, D1), once)


def test_scd1_only_changed_keeps_the_stamp(spark):
    merged = scd.scd1_customer(customers(spark, (1, "a"), (2, "b")), staged(spark, (1, "a"), (2, "B")), D1, True)
    assert pairs(merged) == [(1, "a", D0), (2, "B", D1)]


def test_scd1_joins_a_small_staging_without_shuffling_the_target(spark):
    target = spark.range(10).select(
        F.col("id").alias("CustomerID"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in CUSTOMER.fields[1:]]
    )
    staging = materialize(staged(spark, (1, "x")), "small_staging")
    plan = scd.scd1_customer(target, staging, D1)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_newest_per_key(spark):
    df = spark.createDataFrame(
        [(1, 5, "old"), (1, 7, "new"), (1, 7, "newer"), (None, 1, "x"), (None, 1, "x"), (2, None, "only")],
        "k int, at int, note string",
    )
    kept = sorted((tuple(r) for r in scd.newest_per_key(df, "k", ["at"]).collect()), key=repr)
    assert kept == [(1, 7, "newer"), (2, None, "only"), (None, 1, "x"), (None, 1, "x")]


def test_require_unique(spark):
    assert scd.require_unique(staged(spark, (1, "a"), (2, "b"), (None, "c"), (None, "d")), "CustomerID").count() == 4
    with pytest.raises(ValueError, match="CustomerID = 1"):
        scd.require_unique(staged(spark, (1, "a"), (1, "b")), "CustomerID")


def test_scd2_new_changed_and_unchanged(spark):
    day1 = scd.scd2_merge(spark.createDataFrame([], LOANS), loans(spark, (1, 10.0, "x"), (2, 20.0, "x")), D1)
    day2 = scd.scd2_merge(day1, loans(spark, (1, 10.0, "x"), (2, 25.0, "x"), (3, 30.0, None)), D2)
    versions = sorted((r.LoanID, r.Amount, r.is_current, r.valid_from, r.valid_to) for r in day2.collect())
    assert versions == [
        (1, 10.0, True, D1, None), (2, 20.0, False, D1, D2), (2, 25.0, True, D2, None), (3, 30.0, True, D2, None)
    ]
    assert {r.LoanID: r.Amount for r in scd.current_rows(day2).collect()} == {1: 10.0, 2: 25.0, 3: 30.0}
    assert {r.LoanID: r.Amount for r in scd.rows_as_of(day2, D1).collect()} == {1: 10.0, 2: 20.0}
    assert_same(scd.rows_as_of(day2, D2), scd.current_rows(day2))


@pytest.mark.parametrize("column", scd.LOAN_TRACKED)
@pytest.mark.parametrize("to_null", [True, False])
def test_scd2_sees_null_in_every_tracked_column(spark, column, to_null):
    full = loans(spark, (1, 10.0, "x"))
    bare = full.withColumn(column, F.lit(None).cast(full.schema[column].dataType))
    before, after = (full, bare) if to_null else (bare, full)
    history = scd.as_current(before, D1)
    merged = scd.scd2_merge(history, after, D2)
    assert sorted(r.is_current for r in merged.collect()) == [False, True]
    # The literal comparison is blind here and only appends.
    assert scd.scd2_close(history, after, D2).first().is_current


def test_scd2_literal_appends_unchanged_rows(spark):
    history = scd.as_current(loans(spark, (1, 10.0, "x")), D1)
    assert scd.scd2_append_all(history, loans(spark, (1, 10.0, "x")), D2).filter("is_current").count() == 2


def test_scd2_history_stays_consistent(spark):
    """At most one current row per key, no overlap, and a repeated day changes nothing."""
    history = spark.createDataFrame([], LOANS)
    for day, amounts in enumerate([(1, 2), (1, 3), (1, 3), (4, 3)]):
        batch = loans(spark, *[(i, float(a), None) for i, a in enumerate(amounts)])
        grown = scd.scd2_merge(history, batch, D0 + dt.timedelta(days=day))
        if day == 2:
            assert_same(grown, history)
        history = grown
    rows = history.collect()
    for loan in (0, 1):
        spans = sorted((r.valid_from, r.valid_to or dt.datetime.max) for r in rows if r.LoanID == loan)
        assert all(end <= start for (_, end), (start, _) in zip(spans, spans[1:]))
        assert sum(r.is_current for r in rows if r.LoanID == loan) == 1


def test_snapshots_keep_versions_and_skip_a_committed_batch(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), CUSTOMER)
    assert table.version() is None and table.read().isEmpty()
    table.commit(customers(spark, (1, "a")), "day 1")
    table.commit(scd.scd1_customer(table.read(), staged(spark, (1, "b")), D1), "day 2")
    assert table.commit(customers(spark, (9, "never")), "day 2") == 1
    assert [pairs(table.read(v)) for v in (0, 1)] == [[(1, "a", D0)], [(1, "b", D1)]]
    # A writer that died before its commit leaves a folder behind, which the next commit replaces.
    customers(spark, (8, "lost")).write.parquet(str(tmp_path / "t" / "v=2"))
    assert pairs(table.read()) == [(1, "b", D1)]
    table.commit(customers(spark, (2, "c")), "day 3")
    assert pairs(SnapshotTable(spark, str(tmp_path / "t"), CUSTOMER).read()) == [(2, "c", D0)]


def test_streams_apply_new_files_once(spark, tmp_path):
    staging, checkpoint = str(tmp_path / "staging"), str(tmp_path / "checkpoint")
    table = SnapshotTable(spark, str(tmp_path / "customers"), CUSTOMER)
    staged(spark, (1, "a"), (2, "b")).write.parquet(staging)
    stream_scd1(spark, staging, CUSTOMER_STAGING, checkpoint, table, "CustomerID", D1)
    staged(spark, (2, "B"), (3, "c")).write.mode("append").parquet(staging)
    stream_scd1(spark, staging, CUSTOMER_STAGING, checkpoint, table, "CustomerID", D2)
    result = stream_scd1(spark, staging, CUSTOMER_STAGING, checkpoint, table, "CustomerID", D2)
    assert pairs(result) == [(1, "a", D1), (2, "B", D2), (3, "c", D2)]
    assert table.version() == 1


def test_stream_scd2(spark, tmp_path):
    staging, checkpoint = str(tmp_path / "staging"), str(tmp_path / "checkpoint")
    table = SnapshotTable(spark, str(tmp_path / "loans"), LOANS)
    loans(spark, (1, 10.0, "x")).write.parquet(staging)
    stream_scd2(spark, staging, LOANS_STAGING, checkpoint, table, "LoanID", D1)
    loans(spark, (1, 11.0, "x")).write.mode("append").parquet(staging)
    result = stream_scd2(spark, staging, LOANS_STAGING, checkpoint, table, "LoanID", D2)
    assert sorted((r.Amount, r.is_current) for r in result.collect()) == [(10.0, False), (11.0, True)]


def test_streams_lose_no_version_unasked(spark, tmp_path):
    staging = str(tmp_path / "staging")
    loans(spark, (1, 10.0, "x")).write.parquet(staging)
    loans(spark, (1, 11.0, "x")).write.mode("append").parquet(staging)
    table = SnapshotTable(spark, str(tmp_path / "refused"), LOANS)
    with pytest.raises(Exception, match="more than one row for LoanID"):
        stream_scd2(spark, staging, LOANS_STAGING, str(tmp_path / "c1"), table, "LoanID", D1)
    assert table.read().isEmpty()
    table = SnapshotTable(spark, str(tmp_path / "newest"), LOANS)
    result = stream_scd2(spark, staging, LOANS_STAGING, str(tmp_path / "c2"), table, "LoanID", D1, ["Amount"])
    assert [(r.Amount, r.is_current) for r in result.collect()] == [(11.0, True)]
