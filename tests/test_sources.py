from __future__ import annotations

import datetime as dt
import json
import threading

import pytest
from pyspark.sql import functions as F

from bankflow.checks.queries import QUERIES
from bankflow.operators import countries as cty
from bankflow.plans import incremental as inc
from bankflow.plans import publish
from bankflow.plans.workspace import shared_dir
from bankflow.schemas import COUNTRIES, CUSTOMER_STAGING, EXCHANGE_RATES, PORTFOLIO_RISK
from bankflow.sources import (
    bounds_query,
    create_if_absent,
    increment_condition,
    load_payloads,
    partition_options,
    read_checked_json,
    read_csv_staging,
    read_nested_json,
    save_table,
    scan_query,
)
from tests.helpers import bank, rows

T1, T2, T3 = (dt.datetime(2001, 8, n, 6) for n in (1, 2, 3))


def accounts(spark, *days):
    return spark.createDataFrame(
        [(i, dt.date(2001, 7, d)) for i, d in days], "AccountID bigint, DateOpened date"
    )


def keys(raw, name="accounts"):
    return sorted(r[0] for r in raw.read(name).select("AccountID").collect())


def test_first_load_is_full_then_only_newer_rows(spark, tmp_path):
    raw = inc.RawLayer(spark, str(tmp_path))
    assert raw.read("accounts") is None
    first = inc.load(accounts(spark, (1, 1), (2, 5)), inc.ACCOUNTS, raw, T1)
    assert (first.row_count, first.mark) == (2, dt.date(2001, 7, 5))
    second = inc.load(accounts(spark, (1, 1), (2, 5), (3, 5), (4, 9)), inc.ACCOUNTS, raw, T2)
    assert (second.row_count, second.mark) == (1, dt.date(2001, 7, 9))
    assert keys(raw) == [1, 2, 4]
    assert {r.load_dt for r in raw.read("accounts").collect()} == {T1.date(), T2.date()}


def test_empty_increment_leaves_the_mark(spark, tmp_path):
    raw = inc.RawLayer(spark, str(tmp_path))
    source = accounts(spark, (1, 1), (2, 5))
    inc.load(source, inc.ACCOUNTS, raw, T1)
    again = inc.load(source, inc.ACCOUNTS, raw, T2)
    assert (again.row_count, again.mark, raw.last("accounts")) == (0, dt.date(2001, 7, 5), (0, dt.date(2001, 7, 5)))


def test_load_of_an_empty_source(spark, tmp_path):
    raw = inc.RawLayer(spark, str(tmp_path))
    result = inc.load(accounts(spark), inc.ACCOUNTS, raw, T1)
    assert (result.row_count, result.mark) == (0, None)
    assert raw.read("accounts") is None


def test_crash_before_the_log_repeats_no_row(spark, tmp_path, monkeypatch):
    raw = inc.RawLayer(spark, str(tmp_path))
    source = accounts(spark, (1, 1), (2, 5))
    with monkeypatch.context() as broken:
        broken.setattr(inc.RawLayer, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            inc.load(source, inc.ACCOUNTS, raw, T1)
    assert raw.read("accounts") is None
    inc.load(source, inc.ACCOUNTS, raw, T2)
    assert keys(raw) == [1, 2]


def test_overlap_picks_up_late_rows_once(spark, tmp_path):
    raw = inc.RawLayer(spark, str(tmp_path))
    inc.load(accounts(spark, (1, 1), (2, 5)), inc.ACCOUNTS, raw, T1)
    late = inc.load(accounts(spark, (1, 1), (2, 5), (3, 5), (4, 4)), inc.ACCOUNTS, raw, T2, overlap_days=2)
    assert late.row_count == 2
    assert keys(raw) == [1, 2, 3, 4]
    assert late.mark == dt.date(2001, 7, 5)


def test_slices_equal_one_full_load(spark, tmp_path):
    source = accounts(spark, *[(i, 1 + i % 28) for i in range(60)])
    whole, sliced = inc.RawLayer(spark, str(tmp_path / "a")), inc.RawLayer(spark, str(tmp_path / "b"))
    inc.load(source, inc.ACCOUNTS, whole, T1)
    for upto in (7, 15, 28):
        inc.load(source.filter(F.dayofmonth("DateOpened") <= upto), inc.ACCOUNTS, sliced, T1)
    assert rows(sliced.read("accounts")) == rows(whole.read("accounts"))


def test_text_dates_are_compared_as_dates(spark, tmp_path):
    def transactions(*days):
        return spark.createDataFrame(list(enumerate(days)), "TransactionID bigint, TransactionDate string")

    raw = inc.RawLayer(spark, str(tmp_path))
    first = inc.load(transactions("31-01-2023", "05-06-2024"), inc.TRANSACTIONS, raw, T1)
    assert first.mark == dt.date(2024, 6, 5)
    second = inc.load(transactions("31-01-2023", "05-06-2024", "01-07-2024"), inc.TRANSACTIONS, raw, T2)
    assert second.row_count == 1


def test_increment_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "p")
    accounts(spark, (1, 1), (2, 5)).write.parquet(path)
    plan = inc.increment(spark.read.parquet(path), inc.ACCOUNTS, dt.date(2001, 7, 2))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(DateOpened,2001-07-02)" in text


def test_jdbc_queries_and_options():
    assert bounds_query("bank.accounts", "AccountID") == (
        "(select min(AccountID) as lower_bound, max(AccountID) as upper_bound from bank.accounts) bounds"
    )
    assert bounds_query("t", "k", "d", dt.date(2001, 8, 1)) == (
        "(select min(k) as lower_bound, max(k) as upper_bound from t where d > date '2001-08-01') bounds"
    )
    with pytest.raises(TypeError):
        bounds_query("t", "k", "d", "x' or 1=1 --")
    assert scan_query("bank.accounts") == "(select * from bank.accounts) src"
    assert partition_options("AccountID", (0, 90), 4) == {
        "partitionColumn": "AccountID", "lowerBound": "0", "upperBound": "90", "numPartitions": "4"
    }
    assert partition_options("AccountID", None, 4) == {}
    assert partition_options("AccountID", (1, 2), 1) == {}


def test_jdbc_source_of_a_load(spark, tmp_path, monkeypatch):
    calls = []
    monkeypatch.setattr(inc, "read_partitioned", lambda _, connection, *args: calls.append((connection, args)))
    raw = inc.RawLayer(spark, str(tmp_path))
    inc.load(accounts(spark, (1, 1), (2, 5)), inc.ACCOUNTS, raw, T1)
    for spec in inc.BANK_TABLES:
        inc.jdbc_source(spark, {"url": "jdbc:x"}, spec, raw)
    assert calls == [
        ({"url": "jdbc:x"}, ("accounts", "AccountID", 4, "DateOpened", dt.date(2001, 7, 5))),
        ({"url": "jdbc:x"}, ("transactions", "TransactionID", 6, "TransactionDate", None)),
        ({"url": "jdbc:x"}, ("payments", "PaymentID", 6, "PaymentDate", None)),
    ]


def test_jdbc_source_of_an_increment(spark, tmp_path, monkeypatch):
    """Text dates are compared as dates at the source, in the scan and in the bounds; the overlap reads late rows."""
    calls = []
    monkeypatch.setattr(inc, "read_partitioned", lambda *args, **options: calls.append((args[2:], options)))
    raw = inc.RawLayer(spark, str(tmp_path))
    dated = spark.createDataFrame([(1, "05-06-2024")], "TransactionID bigint, TransactionDate string")
    inc.load(dated, inc.TRANSACTIONS, raw, T1)
    inc.jdbc_source(spark, {}, inc.TRANSACTIONS, raw)
    inc.jdbc_source(spark, {}, inc.TRANSACTIONS, raw, overlap_days=3)
    day = "str_to_date(TransactionDate, '%d-%m-%Y')"
    assert calls == [
        (("transactions", "TransactionID", 6, day, dt.date(2024, 6, 5)), {}),
        (("transactions", "TransactionID", 6, day, dt.date(2024, 6, 2)), {"with_nulls": True}),
    ]
    assert scan_query("t", where=increment_condition(day, dt.date(2024, 6, 5))) == (
        f"(select * from t where {day} > date '2024-06-05') src")
    assert bounds_query("t", "k", day, dt.date(2024, 6, 2), with_nulls=True) == (
        "(select min(k) as lower_bound, max(k) as upper_bound from t "
        f"where ({day} > date '2024-06-02' or {day} is null)) bounds")
    assert increment_condition(day, None, True) == ""


def test_rows_without_a_date_are_loaded_once(spark, tmp_path):
    raw = inc.RawLayer(spark, str(tmp_path))

    def undated(*ids):
        return spark.createDataFrame([(i, None) for i in ids], "AccountID bigint, DateOpened date")

    assert inc.load(undated(1, 2), inc.ACCOUNTS, raw, T1).row_count == 2
    assert inc.load(undated(1, 2), inc.ACCOUNTS, raw, T2).row_count == 0
    assert inc.load(undated(1, 2, 3), inc.ACCOUNTS, raw, T2).row_count == 1
    inc.load(accounts(spark, (9, 5)), inc.ACCOUNTS, raw, T2)
    assert inc.load(undated(3, 4), inc.ACCOUNTS, raw, T3).row_count == 0
    assert inc.load(undated(3, 4), inc.ACCOUNTS, raw, T3, overlap_days=1).row_count == 1
    assert keys(raw) == [1, 2, 3, 4, 9]


def test_day_ranges_read_the_batches_that_have_them(spark, tmp_path):
    raw = inc.RawLayer(spark, str(tmp_path))
    assert raw.read_days(inc.ACCOUNTS, dt.date(2001, 7, 1), dt.date(2001, 7, 2)) is None
    source = spark.createDataFrame(
        [(i, dt.date(2001, 1 + i // 10, 1 + i % 10)) for i in range(60)], "AccountID bigint, DateOpened date")
    for month in range(1, 7):
        inc.load(source.filter(F.month("DateOpened") <= month), inc.ACCOUNTS, raw, T1 if month < 4 else T2)

    def read(first, last):
        df = raw.read_days(inc.ACCOUNTS, first, last)
        folders = {f.split("/accounts/")[1].rsplit("/", 1)[0] for f in df.inputFiles() if "/accounts/" in f}
        return sorted(r.AccountID for r in df.collect()), folders

    first, last = dt.date(2001, 2, 5), dt.date(2001, 3, 2)
    wanted = list(range(14, 22))
    assert read(first, last) == (wanted, {"batch=1/load_dt=2001-08-01", "batch=2/load_dt=2001-08-01"})
    assert read(dt.date(1999, 1, 1), dt.date(1999, 2, 1))[0] == []
    before = rows(raw.read("accounts"))
    assert raw.compact(inc.ACCOUNTS, T2.date()) == 6
    assert rows(raw.read("accounts")) == before and len(raw.batches("accounts")) == 1
    assert read(first, last)[0] == wanted
    plan = raw.read_days(inc.ACCOUNTS, first, last)._jdf.queryExecution().executedPlan().toString()
    assert "(_month" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0] and "2001-03" in plan
    # A later load goes on after the compaction, from the same mark.
    extra = source.unionByName(accounts(spark, (77, 9)))
    assert inc.load(extra, inc.ACCOUNTS, raw, T3).row_count == 1
    found, folders = read(dt.date(2001, 6, 9), dt.date(2001, 7, 9))
    assert found == [58, 59, 77] and "batch=7/load_dt=2001-08-03" in folders
    assert read(dt.date(2001, 7, 1), dt.date(2001, 7, 9)) == ([77], {"batch=7/load_dt=2001-08-03"})
    assert raw.compact(inc.ACCOUNTS, T3.date()) == 8 and raw.compact(inc.ACCOUNTS, T3.date()) is None
    assert raw.read("accounts").count() == 61


def test_csv_with_a_bad_row_fails(spark, tmp_path):
    (tmp_path / "c.csv").write_text("CustomerID,FirstName,LastName,DateOfBirth,Email,PhoneNumber,Address,BranchID\n"
                                    "x,A,B,1980-01-01,,5,s,1\n")
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        read_csv_staging(spark, str(tmp_path / "c.csv"), CUSTOMER_STAGING).collect()


def country(name, region, population, currencies):
    return {
        "name": {"common": name, "official": name, "nativeName": {"x": {"official": name, "common": name}}},
        "region": region, "population": population, "currencies": currencies, "area": 12, "latlng": [1, 2.5],
        "unknownField": 1,
    }


@pytest.fixture()
def payloads(tmp_path):
    euro, dollar = {"name": "Euro", "symbol": "E"}, {"name": "Dollar", "symbol": "$"}
    files = {
        "eur.json": [country("A", "Europe", 60_000_000, {"EUR": euro, "USD": dollar}),
                     country("B", "Europe", 60_000_000, {"EUR": euro}), country("C", "Africa", 5_000_000, {})],
        "usd.json": [country("A", "Europe", 60_000_000, {"EUR": euro, "USD": dollar}),
                     country("D", None, None, None), country("E", "Asia", 999_999, {"USD": dollar})],
    }
    for name, content in files.items():
        (tmp_path / name).write_text(json.dumps(content, indent=1))
    return [str(tmp_path / name) for name in files]


def test_multi_line_payloads_are_one_scan(spark, payloads):
    df = read_nested_json(spark, payloads, COUNTRIES)
    assert sorted(r[0] for r in df.select("name.common").collect()) == ["A", "A", "B", "C", "D", "E"]
    assert df.filter("name.common = 'A'").select("area", "latlng").first() == (12.0, [1.0, 2.5])
    one_by_one = cty.union_payloads([read_nested_json(spark, p, COUNTRIES) for p in payloads])
    assert one_by_one.count() == 6
    assert sorted(r[0] for r in cty.distinct_countries(df).select("name.common").collect()) == list("ABCDE")


def test_payloads_are_held_against_a_contract(spark, payloads, tmp_path):
    """Error bodies, wrong types and cut files go to quarantine with the name of their file; good rows beside them stay."""
    folder = tmp_path / "bad"
    folder.mkdir()
    (folder / "error.json").write_text('{"status": 404, "message": "not found"}')
    (folder / "text.json").write_text(json.dumps([dict(country("T", "Asia", 5, {}), population="many")]))
    (folder / "cut.json").write_text(json.dumps([country("X", "Asia", 1, {})])[:-9])
    quarantine = str(tmp_path / "quarantine")
    paths = [*payloads, str(folder)]
    taken = load_payloads(spark, paths, COUNTRIES, ["name.common"], quarantine)
    assert sorted(r[0] for r in taken.select("name.common").collect()) == ["A", "A", "B", "C", "D", "E"]
    assert taken.columns == COUNTRIES.fieldNames()
    refused = spark.read.parquet(quarantine)
    assert sorted((r.file.rsplit("/", 1)[1], r.reason) for r in refused.collect()) == [
        ("cut.json", "unreadable"), ("error.json", "missing name.common"), ("text.json", "unreadable")]
    assert all(r.payload for r in refused.collect())
    load_payloads(spark, str(folder), COUNTRIES, ["name.common", "region"], quarantine)
    assert refused.count() == 3 and spark.read.parquet(quarantine).count() == 6
    with pytest.raises(ValueError, match="name.short"):
        read_checked_json(spark, paths, COUNTRIES, ["name.short"])


def test_union_of_payloads_does_not_depend_on_partitions(spark, tmp_path):
    def one(name, code, population):
        return {"name": {"common": name}, "cca3": code, "population": population}

    found = [one("A", "AAA", 5), one("A", "AAA", 7), one("Another A", "AAA", 6), one("B", None, 1), one("B", None, 1),
             one(None, None, 3), one(None, None, 3), one(None, "CCC", None), one("C", "CCC", 2)]
    results = set()
    for k in range(4):
        path = tmp_path / f"{k}.json"
        path.write_text("\n".join(map(json.dumps, found[k:] + found[:k])))
        df = read_nested_json(spark, str(path), COUNTRIES, multi_line=False).repartition(k + 1)
        kept = cty.distinct_countries(df).select("name.common", "cca3", "population").collect()
        results.add(tuple(sorted((tuple(r) for r in kept), key=repr)))
    assert len(results) == 1
    assert sorted((r[1] or r[0] or "") for r in results.pop()) == ["", "", "AAA", "B", "CCC"]


def test_reports_are_published_whole_and_once(spark, tmp_path):
    tables = bank(spark, 71)
    root = str(tmp_path / "reports")
    inputs = {n: tables[n] for n in ("accounts", "transactions", "payments")}
    names = ["fee_leakage", "portfolio_risk"]
    with pytest.raises(ValueError, match="not been published"):
        publish.ReportTables(spark, root).read("fee_leakage")
    first = publish.publish_reports(spark, root, inputs, T1.date(), "day 1", names)
    reports = publish.ReportTables(spark, root)
    assert first["fee_leakage"] == tables["transactions"].count() == reports.read("fee_leakage").count()
    assert reports.read("portfolio_risk").schema.fieldNames() == PORTFOLIO_RISK.fieldNames()
    # A rerun of the batch leaves the tables as they are; a new batch replaces them.
    fewer = inputs | {"transactions": tables["transactions"].limit(3)}
    assert publish.publish_reports(spark, root, fewer, T1.date(), "day 1", names) == first
    assert publish.publish_reports(spark, root, fewer, T1.date(), "day 2", names)["fee_leakage"] == 3
    # A run that died before its commit.
    spark.range(9).write.parquet(f"{root}/fee_leakage/v=2")
    reports.register("fee_leakage")
    assert spark.table("fee_leakage").count() == 3
    assert {r.report: r.row_count for r in publish.published_counts(spark, root, names).collect()}["fee_leakage"] == 3
    spark.catalog.dropTempView("fee_leakage")


def test_country_reports(spark, payloads):
    df = cty.distinct_countries(read_nested_json(spark, payloads, COUNTRIES))
    levels = {r[0]: r[1] for r in cty.country_risk_category(df).select("name.common", "risk_level").collect()}
    assert levels == {"A": "Low", "B": "Low", "C": "High", "D": "Medium", "E": "High"}
    details = sorted(tuple(r) for r in cty.currency_details(df).collect())
    assert [(d[0], d[1]) for d in details] == [("A", "EUR"), ("A", "USD"), ("B", "EUR"), ("E", "USD")]
    largest = {tuple(r) for r in cty.largest_country_per_region(df).collect()}
    assert largest == {("Europe", "A", 60_000_000), ("Europe", "B", 60_000_000), ("Africa", "C", 5_000_000),
                       (None, "D", None), ("Asia", "E", 999_999)}


def test_catalog_tables(spark, tmp_path):
    rates = spark.createDataFrame([("EUR", 98.1)], EXCHANGE_RATES)
    create_if_absent(spark, "rates", EXCHANGE_RATES, str(tmp_path / "rates"))
    assert spark.table("rates").isEmpty()
    save_table(rates, "rates", mode="append")
    create_if_absent(spark, "rates", EXCHANGE_RATES, str(tmp_path / "rates"))
    assert spark.table("rates").count() == 1
    save_table(rates.union(rates), "rates", path=str(tmp_path / "rates2"))
    assert spark.table("rates").count() == 2
    spark.sql("drop table rates")


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_a_currency_without_countries_is_an_empty_payload(spark, tmp_path):
    """Payloads are written one by one, without sorting the rows by payload, so one may be empty."""
    customer = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    customer.filter("c_custkey in (1, 4)").write.parquet(str(tmp_path / "customer.parquet"))
    for name in ("nation", "region"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    for query in ("union_payloads", "union_payloads_dedup"):
        found = QUERIES[query](spark, str(tmp_path)).collect()
        assert [r["common"] for r in found] == ["Country#000000001"]


def test_reports_are_published_side_by_side(spark, tmp_path, monkeypatch):
    """Two reports that wait for each other are both published; a failing one leaves the other in place and is raised."""
    both = threading.Barrier(2, timeout=60)

    def waiting(spark, tables, as_of):
        both.wait()
        return tables["accounts"]

    def failing(spark, tables, as_of):
        raise ValueError("no report")

    monkeypatch.setattr(publish, "REPORTS", {"one": (None, waiting), "two": (None, waiting), "bad": (None, failing)})
    inputs = {"accounts": spark.range(3).toDF("id")}
    assert publish.publish_reports(spark, str(tmp_path / "a"), inputs, T1.date(), "day 1", ["one", "two"]) == {
        "one": 3, "two": 3}
    with pytest.raises(ValueError, match="no report"):
        publish.publish_reports(spark, str(tmp_path / "b"), inputs, T1.date(), "day 1")
    assert publish.ReportTables(spark, str(tmp_path / "b")).read("two").count() == 3
