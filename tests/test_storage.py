"""Files: raw layer, day partitions, reruns, catalog, runs and the stream."""

from datetime import date, datetime, timedelta
from decimal import Decimal
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillhouse import queries
from tillhouse.layout import (
    DAY_KEYS, Layout, days_between, lookback_days, parse_day, partition_text, projected_partitions, resolve_days,
    storage_section,
)
from tillhouse.plans import changes, gold, runs
from tillhouse.operators import keysets
from tillhouse.schemas import FACT, MALFORMED_ROWS, MENU_MASTER, ORDER_ITEMS, ORDERS, OUTLET_MASTER, SILVER_ORDERS
from tillhouse.session import shuffle_partitions, work_root
from tillhouse.sources import bronze, catalog, commits, source, tables
from tillhouse.streaming import intake

D1, D2, D3 = days_between(date(2026, 3, 1), date(2026, 3, 3))


def keyed(spark, *rows):
    return spark.createDataFrame(list(rows), "k int, year string, month string, day string")


def keys_by_day(df):
    return sorted((row.day, row.k) for row in df.collect())


K = "k int"


@pytest.fixture
def schema(spark):
    return spark.createDataFrame([], K).schema


def test_layout():
    assert partition_text(date(2026, 3, 2)) == "year=2026/month=03/day=02"
    span = days_between(parse_day("2026-02-25"), parse_day("2026-03-02"))
    assert len(span) == 6 and span[3] == date(2026, 2, 28) and span[4] == date(2026, 3, 1)
    assert lookback_days(date(2026, 3, 1)) == [date(2026, 2, 27), date(2026, 2, 28), date(2026, 3, 1)]
    projected = projected_partitions(2026, 2027)
    assert len(projected) == 744 and projected[0] == ("2026", "01", "01") and projected[-1] == ("2027", "12", "31")


def test_run_days():
    today = date(2026, 7, 1)
    assert resolve_days(day="2026-03-02", start="2026-01-01", end="2026-01-05") == [date(2026, 3, 2)]
    assert len(resolve_days(start="2026-01-01", end="2026-01-05")) == 5
    assert resolve_days(start="2026-01-01") == [date(2026, 1, 1)]
    assert resolve_days(end="2026-01-05", today=today) == [today]
    assert resolve_days(today=today) == [today]
    assert resolve_days(start="2026-01-05", end="2026-01-01") == []
    for bad in ("2026-3-2", "02-03-2026", "2026-02-30", "x"):
        with pytest.raises(ValueError):
            resolve_days(day=bad)


def test_locations():
    layout = Layout.from_settings(
        {"bronze": "from-args"}, {"BRONZE_BUCKET": "from-env", "SILVER_BUCKET": "/data/silver/"},
        {"silver": "from-file", "quarantine": "s3a://bad", "gold": "star"},
    )
    assert layout == Layout("s3a://from-args", "/data/silver", "s3a://bad", "s3a://star")
    with pytest.raises(ValueError):
        Layout.from_settings({"bronze": "x"})


def test_config_file(tmp_path):
    path = tmp_path / "config.json"
    path.write_text('{"storage": {"bronze": "b", "silver": "s", "quarantine": "q", "gold": "/data/g"}}')
    layout = Layout.from_settings(storage=storage_section(str(path)))
    assert layout == Layout("s3a://b", "s3a://s", "s3a://q", "/data/g")


def test_shuffle_width():
    assert shuffle_partitions(10, 200) == 200
    assert shuffle_partitions(100 * 1024**4, 200) == 409_600
    assert shuffle_partitions(1024**4, 200) == 4096


def test_work_folder_is_the_named_one(spark):
    assert work_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_csv_text(spark, tmp_path):
    path = tmp_path / "orders"
    path.mkdir()
    (path / "a.csv").write_text(
        "order_id,outlet_id,cashier_id,total_amount,payment_method,created_at\n"
        "2,<nil>,101,150.50,<nil>,2026-05-01 10:00:00\n"
        '3,x,101,oops,"say ""hi"", ok",notatime\n'
    )
    first, second = bronze.read_master(spark, str(path), ORDERS).orderBy("order_id").collect()
    assert tuple(first) == (2, None, 101, Decimal("150.50"), None, datetime(2026, 5, 1, 10))
    assert tuple(second) == (3, None, 101, None, 'say "hi", ok', None)


def test_csv_round_trip_of_odd_text(spark, tmp_path):
    rows = [(1, 1, 1, Decimal("1.00"), text, datetime(2026, 3, 1)) for text in ('a "b", c', "", "x\\y", None, "ü")]
    path = str(tmp_path / "csv")
    bronze.write_master(spark.createDataFrame(rows, ORDERS), path)
    found = bronze.read_master(spark, path, ORDERS)
    assert sorted(row.payment_method or str(row.payment_method) for row in found.collect()) == sorted(
        ['a "b", c', "", "x\\y", "None", "ü"], key=lambda t: t or str(t)
    )


def test_keys_stay_text(spark, tmp_path, schema):
    path = str(tmp_path / "t")
    tables.write_days(keyed(spark, (1, "2026", "03", "01")), path, [D1])
    assert [tuple(row) for row in tables.read_partitioned(spark, path, schema).collect()] == [(1, "2026", "03", "01")]
    assert [tuple(row) for row in tables.read_day_files(spark, path, schema, [D1]).collect()] == [(1, "2026", "03", "01")]


def test_rerun_of_one_day(spark, tmp_path, schema):
    path = str(tmp_path / "t")
    three = [(1, "2026", "03", "01"), (2, "2026", "03", "02"), (3, "2026", "03", "03")]
    tables.write_days(keyed(spark, *three), path, [D1, D2, D3])
    tables.write_days(keyed(spark, (9, "2026", "03", "02")), path, [D2])
    assert keys_by_day(tables.read_partitioned(spark, path, schema)) == [("01", 1), ("02", 9), ("03", 3)]


@pytest.mark.parametrize("aligned", [True, False])
def test_clean_rerun_leaves_no_old_rows(spark, tmp_path, schema, aligned):
    path = str(tmp_path / "t")
    tables.write_days(keyed(spark, (1, "2026", "03", "01"), (2, "2026", "03", "02")), path, [D1, D2])
    tables.write_days(keyed(spark, (5, "2026", "03", "01")), path, [D1, D2], aligned=aligned)
    assert keys_by_day(tables.read_partitioned(spark, path, schema)) == [("01", 5)]
    nothing = tables.read_partitioned(spark, path, schema).filter("k > 100")
    assert tables.stored_days(spark, path, [D1, D2]) == [D1]
    tables.write_days(nothing, path, [D1, D2], aligned=aligned)
    assert tables.stored_days(spark, path, [D1, D2]) == []
    assert tables.read_partitioned(spark, path, schema).count() == 0


def test_missing_days_are_empty(spark, tmp_path, schema):
    path = str(tmp_path / "t")
    assert tables.read_day_files(spark, path, schema, [D1, D2]).count() == 0
    tables.write_days(keyed(spark, (1, "2026", "03", "01")), path, [D1])
    assert tables.read_day_files(spark, path, schema, [D1, D2, D3]).count() == 1
    assert tables.read_day_files(spark, path, schema, [D3]).count() == 0


def test_partitions_are_pruned(spark, tmp_path, schema):
    path = str(tmp_path / "t")
    tables.write_days(keyed(spark, (1, "2026", "03", "01"), (2, "2026", "03", "02")), path, [D1, D2])
    assert "PartitionFilters: [(concat_ws" in plan_of(tables.read_partitioned(spark, path, schema, [D2]))
    assert keys_by_day(tables.read_partitioned(spark, path, schema, [D2])) == [("02", 2)]
    assert all("day=02" in name for name in tables.read_day_files(spark, path, schema, [D2]).inputFiles())


def test_days_with_a_gap_leave_the_gap_alone(spark, tmp_path, schema):
    path = str(tmp_path / "t")
    three = [(1, "2026", "03", "01"), (2, "2026", "03", "02"), (3, "2026", "03", "03")]
    tables.write_days(keyed(spark, *three), path, [D1, D2, D3])
    tables.write_days(keyed(spark, *[(k + 10, *rest) for k, *rest in three]), path, [D1, D3])
    assert keys_by_day(tables.read_partitioned(spark, path, schema)) == [("01", 11), ("02", 2), ("03", 13)]
    assert keys_by_day(tables.read_partitioned(spark, path, schema, [D1, D3])) == [("01", 11), ("03", 13)]


def test_one_large_day_is_split_and_one_small_day_is_one_file(spark, tmp_path):
    rows = spark.range(0, 1000, 1, 8).selectExpr("id", "'2026' AS year", "'03' AS month", "'01' AS day")
    tables.write_days(rows, str(tmp_path / "t"), [D1])
    assert len(list(tmp_path.glob("t/run=*/year=2026/month=03/day=01/part-*"))) == 1


def test_line_breaks_survive_the_raw_layer(spark, tmp_path):
    odd = ["a\nb", "c\r\nd", 'e "f"\n,g', "back\\slash\\n", "\\", None]
    rows = spark.createDataFrame([(n, 1, 1, Decimal("1.00"), text, datetime(2026, 3, 1)) for n, text in enumerate(odd)], ORDERS)
    bronze.write_transactions(rows, ORDERS.fieldNames(), str(tmp_path / "days"), [D1])
    found = bronze.read_transactions(spark, str(tmp_path / "days"), ORDERS, [D1])
    assert [row.payment_method for row in found.orderBy("order_id").collect()] == odd
    bronze.write_master(rows, str(tmp_path / "flat"))
    flat = bronze.read_master(spark, str(tmp_path / "flat"), ORDERS)
    assert [row.payment_method for row in flat.orderBy("order_id").collect()] == odd


def test_insert_if_absent(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.createDataFrame([(1, "old")], "k int, v string"), path)
    arriving = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a")], "k int, v string")
    for _ in range(2):
        tables.insert_if_absent(arriving, path, "k")
        assert sorted(tuple(row) for row in spark.read.parquet(path).collect()) == [(1, "old"), (2, "a")]


def test_keyed_insert_reads_the_buckets_of_its_keys(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = spark.range(1000).selectExpr("id AS k", "'old' AS v")
    tables.write_keyed(rows, path, "k", buckets=16)
    assert len(list((tmp_path / "t").glob("bucket=*-of-16"))) == 16
    arriving = spark.createDataFrame([(5, "new"), (5000, "b"), (5000, "a"), (5001, "c")], "k long, v string")
    wanted = {row[0] for row in tables._bucketed(arriving, "k", 16).select("bucket").distinct().collect()}
    read = []
    real = tables.read_keyed
    with monkeypatch.context() as patched:
        patched.setattr(tables, "read_keyed", lambda *args: read.extend(real(*args).inputFiles()) or real(*args))
        tables.insert_if_absent(arriving, path, "k")
    assert {name.rsplit("bucket=", 1)[1].split("/")[0] for name in read} == wanted and len(wanted) < 4
    tables.insert_if_absent(arriving, path, "k")
    found = tables.read_keyed(spark, path, rows.schema)
    assert found.count() == 1002
    assert sorted(tuple(row) for row in found.filter("k IN (5, 5000, 5001)").collect()) == [(5, "old"), (5000, "a"), (5001, "c")]


def test_slices_hold_the_same_number_of_orders():
    """Nine of ten orders fall into the hour after noon."""
    minutes = [datetime(2026, 3, 1) + timedelta(minutes=m) for m in range(24 * 60)]
    counts = [(at, 150 if at.hour == 12 else 1) for at in minutes]
    bounds = source.slice_bounds(counts, 8)
    assert len(bounds) == 7 and sum(at.hour == 12 for at in bounds) >= 6
    edges = [datetime(2026, 3, 1), *bounds, datetime(2026, 3, 2)]
    sizes = [sum(n for at, n in counts if low <= at < high) for low, high in zip(edges, edges[1:], strict=False)]
    assert sum(sizes) == sum(n for _, n in counts) and max(sizes) - min(sizes) <= 300
    predicates = source.slice_predicates("created_at", D1, D1, bounds)
    assert len(predicates) == 8
    assert predicates[0].startswith("created_at >= '2026-03-01 00:00:00' AND") and predicates[-1].endswith("< '2026-03-02 00:00:00'")
    assert source.slice_bounds([], 8) == [] and source.slice_bounds([(minutes[5], 99)], 8) == []
    assert source.slice_predicates("created_at", D1, D2, []) == ["created_at >= '2026-03-01 00:00:00' AND created_at < '2026-03-03 00:00:00'"]
    assert "GROUP BY 1" in source.counts_query(D1, D2) and "created_at < '2026-03-03'" in source.counts_query(D1, D2)


def test_max_id_of_nothing(spark):
    assert tables.max_id(spark.createDataFrame([], ORDERS), "order_id").first().max_id == 0


def test_catalog_tables(spark, tmp_path):
    layout = Layout.under(str(tmp_path))
    rows = spark.createDataFrame([(1, 1, 1, Decimal(1), "Cash", datetime(2026, 3, 1), "valid", "2026", "03", "01")],
                                 "order_id long, outlet_id int, cashier_id int, total_amount decimal(14,2), payment_method string, created_at timestamp, data_quality_status string, year string, month string, day string")
    tables.write_days(rows, f"{layout.silver}/orders", [D1])
    tables.write_days(spark.createDataFrame([], ORDER_ITEMS).selectExpr("*", "'' year", "'' month", "'' day"), f"{layout.silver}/order_items", [D1])
    tables.write_table(spark.createDataFrame([], OUTLET_MASTER), f"{layout.silver}/outlet_master")
    tables.write_table(spark.createDataFrame([], MENU_MASTER), f"{layout.silver}/menu_master")
    catalog.create_database(spark, layout, "shop")
    catalog.create_silver_tables(spark, layout, "shop")
    assert spark.table("shop.orders").filter("day = '01'").count() == 1
    assert spark.table("shop.menu_master").schema == MENU_MASTER
    later = rows.withColumn("day", F.lit("02"))
    tables.write_days(later, f"{layout.silver}/orders", [D2])
    assert spark.table("shop.orders").count() == 1
    catalog.register_days(spark, "shop.orders", f"{layout.silver}/orders", [D1, D2])
    assert spark.table("shop.orders").count() == 2
    tables.write_days(rows.unionAll(rows), f"{layout.silver}/orders", [D1, D2])
    catalog.register_days(spark, "shop.orders", f"{layout.silver}/orders", [D1, D2])
    assert [tuple(row) for row in spark.sql("SHOW PARTITIONS shop.orders").collect()] == [("year=2026/month=03/day=01",)]
    assert spark.table("shop.orders").count() == 2


def test_source_queries():
    options = source.jdbc_options("jdbc:x", source.orders_query(D1, D2), "created_at", "a", "b", 8)
    assert "created_at >= '2026-03-01' AND created_at < '2026-03-03'" in options["dbtable"]
    assert options["numPartitions"] == "8" and options["partitionColumn"] == "created_at"
    assert "JOIN orders o ON o.order_id = i.order_id" in source.items_query(D1, D1)
    assert "partitionColumn" not in source.jdbc_options("jdbc:x", "SELECT 1")


def shop(spark, orders, items, price="10.00"):
    at = datetime(2026, 1, 1)
    menu = [(1, "tea", "Coffee", *[Decimal(price)] * 4, "true", at), (2, "bun", "Pastry", *[Decimal("5.00")] * 4, "false", at)]
    return source.FrameSource(
        {
            "outlet_master": spark.createDataFrame([(1, "x", "y", "1", at, at)], OUTLET_MASTER),
            "menu_master": spark.createDataFrame(menu, MENU_MASTER),
            "orders": spark.createDataFrame(
                [(o, 1, 101, Decimal(t), p, datetime.fromisoformat(d)) for o, t, p, d in orders], ORDERS
            ),
            "order_items": spark.createDataFrame(
                [(n, o, m, 1, Decimal(p), Decimal(p)) for n, (o, m, p) in enumerate(items)], ORDER_ITEMS
            ),
        }
    )


ORDER_ROWS = [
    (1, "10.00", "Cash", "2026-03-01 09:00:00"),
    (2, "15.00", "cash", "2026-03-02 09:00:00"),
    (3, "99.00", "OVO", "2026-03-02 23:59:59"),
    (4, "5.00", "QRIS", "2026-03-03 00:00:00"),
]
ITEM_ROWS = [(1, 1, "10.00"), (2, 1, "10.00"), (2, 2, "5.00"), (3, 2, "5.00"), (3, 8, "5.00"), (4, 2, "6.00")]


def state(spark, layout):
    """Everything a run stores, as comparable rows."""
    found = {}
    for name, schema in (("orders", SILVER_ORDERS), ("order_items", ORDER_ITEMS)):
        found[name] = sorted(map(str, tables.read_partitioned(spark, f"{layout.silver}/{name}", schema).collect()))
    rules = "orphan_items invalid_payments invalid_prices orders_discrepancies duplicate_orders anomaly_cashiers"
    for rule in rules.split():
        path = f"{layout.quarantine}/{rule}"
        folders = commits.state(spark, path).folders(path)
        rows = spark.read.option("basePath", path).parquet(*folders).drop("run").collect() if folders else []
        found[rule] = sorted(map(str, rows))
    found["fact"] = sorted(map(str, runs.read_fact(spark, layout).collect()))
    for name in ("dim_menu", "dim_outlet", "dim_date"):
        found[name] = sorted(map(str, spark.read.parquet(f"{layout.gold}/{name}").collect()))
    return found


def test_daily_chain(spark, tmp_path):
    layout = Layout.under(str(tmp_path / "by-day"))
    first = shop(spark, ORDER_ROWS, ITEM_ROWS)
    for day in (D1, D2, D3):
        summary = runs.run_days(spark, first, layout, [day])
        assert {row.test_name: row.violations for row in summary.collect() if row.violations} == {}
    by_day = state(spark, layout)
    assert len(by_day["orders"]) == 4 and len(by_day["order_items"]) == 6
    assert len(by_day["fact"]) == 3
    assert len(by_day["orphan_items"]) == 1 and len(by_day["invalid_prices"]) == 1
    assert len(by_day["invalid_payments"]) == 1 and len(by_day["orders_discrepancies"]) == 2

    catalog.create_database(spark, layout, "star")
    catalog.create_gold_tables(spark, layout, "star")
    assert spark.table("star.fact_order_items").groupBy("day").count().count() == 2
    assert spark.table("star.dim_date").count() == 730
    assert runs.source_freshness(spark, layout, "2026-03-03 12:00:00").first().status == "pass"

    # running a day again changes nothing; all days in one run give the same
    runs.run_days(spark, first, layout, [D2])
    assert state(spark, layout) == by_day
    together = Layout.under(str(tmp_path / "together"))
    runs.run_days(spark, first, together, [D1, D2, D3])
    assert state(spark, together) == by_day

    # the source was put right: the old bad rows go, other days stay
    fixed_orders = [(2, "15.00", "Cash", "2026-03-02 09:00:00"), (3, "5.00", "OVO", "2026-03-02 23:59:59")]
    fixed = shop(spark, [ORDER_ROWS[0], *fixed_orders, ORDER_ROWS[3]], ITEM_ROWS[:4] + ITEM_ROWS[5:])
    runs.run_days(spark, fixed, layout, [D2])
    after = state(spark, layout)
    assert after["orphan_items"] == [] and after["invalid_payments"] == []
    assert len(after["orders_discrepancies"]) == 1 and len(after["invalid_prices"]) == 1
    assert len(after["fact"]) == 4


def test_run_of_days_with_a_gap(spark, tmp_path):
    layout = Layout.under(str(tmp_path / "gap"))
    runs.run_days(spark, shop(spark, ORDER_ROWS, ITEM_ROWS), layout, [D1, D2, D3])
    before = state(spark, layout)
    doubled = [(o, str(2 * Decimal(t)), p, d) for o, t, p, d in ORDER_ROWS]
    runs.run_days(spark, shop(spark, doubled, ITEM_ROWS), layout, [D1, D3])
    after = state(spark, layout)
    middle = [row for row in before["orders"] if "day='02'" in row]
    assert len(middle) == 2 and [row for row in after["orders"] if "day='02'" in row] == middle
    assert before["orders"] != after["orders"]


def test_clean_days_list_every_rule(spark, tmp_path):
    layout = Layout.under(str(tmp_path / "clean"))
    runs.extract(spark, shop(spark, ORDER_ROWS[:1], ITEM_ROWS[:1]), layout, [D1, D2])
    counts = runs.load_silver(spark, layout, [D1, D2]).collect()
    assert len(counts) == 20 and {row.violations for row in counts} == {0}


def test_run_after_the_default_calendar(spark, tmp_path):
    layout = Layout.under(str(tmp_path / "later"))
    data = shop(spark, [(1, "10.00", "Cash", "2027-01-05 09:00:00")], ITEM_ROWS[:1])
    summary = runs.run_days(spark, data, layout, [date(2027, 1, 5)], calendar_end="2027-12-31")
    assert all(row.status != "fail" for row in summary.collect())
    assert runs.read_fact(spark, layout).count() == 1


def test_shuffles_are_sized_before_the_extract(spark, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(runs, "size_shuffles", lambda _, size: seen.append(("size", size)))
    monkeypatch.setattr(runs, "extract", lambda *_: seen.append("extract") or (_ for _ in ()).throw(KeyboardInterrupt))
    data = shop(spark, ORDER_ROWS, ITEM_ROWS)
    data.size_bytes = lambda: 7
    with pytest.raises(KeyboardInterrupt):
        runs.run_days(spark, data, Layout.under(str(tmp_path)), [D1])
    assert seen == [("size", 7), "extract"]


def test_day_without_orders(spark, tmp_path):
    layout = Layout.under(str(tmp_path / "empty"))
    nothing = shop(spark, ORDER_ROWS, ITEM_ROWS)
    runs.run_days(spark, nothing, layout, [date(2026, 4, 1)])
    assert runs.read_fact(spark, layout).count() == 0


def test_history_over_runs(spark, tmp_path):
    layout = Layout.under(str(tmp_path / "history"))
    for price, at in (("10.00", "2026-01-01"), ("12.00", "2026-02-01"), ("12.00", "2026-02-01")):
        rows = [(1, "tea", "Coffee", *[Decimal(price)] * 4, "true", datetime.fromisoformat(at))]
        runs.refresh_history(spark, layout, "menu_master", spark.createDataFrame(rows, MENU_MASTER))
    stored = runs.read_history(spark, layout, "menu_master")
    assert sorted((str(row.base_price), row.valid_to is None) for row in stored.collect()) == [("10.00", False), ("12.00", True)]
    # closed versions are written once: later loads leave their files as they are
    root = tmp_path / "history" / "gold" / "snp_menu_master"
    closed = {name: name.read_bytes() for name in root.glob("closed=000002/part-*")}
    assert closed
    for price, at in (("13.00", "2026-03-01"), ("14.00", "2026-04-01")):
        rows = [(1, "tea", "Coffee", *[Decimal(price)] * 4, "true", datetime.fromisoformat(at))]
        runs.refresh_history(spark, layout, "menu_master", spark.createDataFrame(rows, MENU_MASTER))
    assert all(name.read_bytes() == content for name, content in closed.items())
    assert runs.read_open(spark, layout, "menu_master").count() == 1
    rows = sorted(runs.read_history(spark, layout, "menu_master").collect(), key=lambda row: row.valid_from)
    assert [str(row.base_price) for row in rows] == ["10.00", "12.00", "13.00", "14.00"]
    assert [row.valid_to for row in rows[:-1]] == [row.valid_from for row in rows[1:]]
    # a load that closed versions and died before its open ones counted is done again
    spark.read.parquet(f"{root}/closed=000005").write.parquet(f"{root}/closed=000006")
    assert runs.read_history(spark, layout, "menu_master").count() == 4
    # a version folder without its success marker was never finished
    spark.range(1).write.parquet(f"{layout.gold}/snp_menu_master/version=000009")
    (tmp_path / "history" / "gold" / "snp_menu_master" / "version=000009" / "_SUCCESS").unlink()
    assert runs.read_history(spark, layout, "menu_master").count() == 4


def test_stream_takes_each_file_once(spark, tmp_path):
    raw, landed, checkpoint = (str(tmp_path / name) for name in ("raw", "landed", "checkpoint"))
    data = shop(spark, ORDER_ROWS, ITEM_ROWS)
    names = ORDERS.fieldNames()

    def arrive(day):
        bronze.write_transactions(data.orders(day, day), names, raw, [day])

    arrive(D1)
    arrive(D2)
    intake.ingest_arrivals(spark, raw, ORDERS, landed, checkpoint, days_per_batch=1)
    assert intake.read_landed(spark, landed, ORDERS).count() == 3
    arrive(D3)
    for _ in range(2):
        intake.ingest_arrivals(spark, raw, ORDERS, landed, checkpoint)
        assert sorted(row.order_id for row in intake.read_landed(spark, landed, ORDERS).collect()) == [1, 2, 3, 4]


def test_stream_replaces_a_day_that_is_run_again(spark, tmp_path):
    raw, landed, checkpoint = (str(tmp_path / name) for name in ("raw", "landed", "checkpoint"))
    data, names = shop(spark, ORDER_ROWS, ITEM_ROWS), ORDERS.fieldNames()
    bronze.write_transactions(data.orders(D1, D3), names, raw, [D1, D2, D3])
    intake.ingest_arrivals(spark, raw, ORDERS, landed, checkpoint)
    bronze.write_transactions(data.orders(D2, D2), names, raw, [D2])
    bronze.write_transactions(data.orders(D1, D1).limit(0), names, raw, [D1])
    intake.ingest_arrivals(spark, raw, ORDERS, landed, checkpoint)
    assert sorted(row.order_id for row in intake.read_landed(spark, landed, ORDERS).collect()) == [2, 3, 4]


def test_reader_keeps_the_state_it_started_with(spark, tmp_path, schema):
    """A commit while somebody reads: the reader ends on its files, and they go with the commit after the next."""
    path = str(tmp_path / "t")
    tables.write_days(keyed(spark, (1, "2026", "03", "01"), (2, "2026", "03", "02")), path, [D1, D2])
    before = tables.read_partitioned(spark, path, schema)
    files = before.inputFiles()
    tables.write_days(keyed(spark, (9, "2026", "03", "01")), path, [D1, D2])
    assert keys_by_day(before) == [("01", 1), ("02", 2)]
    assert keys_by_day(tables.read_partitioned(spark, path, schema)) == [("01", 9)]
    assert all(Path(name.removeprefix("file://")).exists() for name in files)
    tables.write_days(keyed(spark, (7, "2026", "03", "02")), path, [D2])
    assert not any(Path(name.removeprefix("file://")).exists() for name in files)
    assert keys_by_day(tables.read_partitioned(spark, path, schema)) == [("01", 9), ("02", 7)]


def test_nothing_counts_before_its_commit(spark, tmp_path, schema, monkeypatch):
    path = str(tmp_path / "t")
    tables.write_days(keyed(spark, (1, "2026", "03", "01")), path, [D1])
    with monkeypatch.context() as patched:
        patched.setattr(commits, "commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            tables.write_days(keyed(spark, (5, "2026", "03", "01"), (6, "2026", "03", "02")), path, [D1, D2])
    assert keys_by_day(tables.read_partitioned(spark, path, schema)) == [("01", 1)]
    assert commits.remove_unfinished(spark, path) == 1
    assert commits.remove_unfinished(spark, path) == 0
    assert keys_by_day(tables.read_partitioned(spark, path, schema)) == [("01", 1)]


def test_writers_that_meet_lose_nothing(spark, tmp_path, schema, monkeypatch):
    """Another writer commits between a writer's look at the state and its own commit."""
    path = str(tmp_path / "t")
    tables.write_days(keyed(spark, (1, "2026", "03", "01")), path, [D1])
    publish, meeting = commits._publish, []

    def overtaken(*args):
        if not meeting:
            meeting.append(1)
            tables.write_days(keyed(spark, (2, "2026", "03", "02")), path, [D2])
        return publish(*args)

    monkeypatch.setattr(commits, "_publish", overtaken)
    tables.write_days(keyed(spark, (3, "2026", "03", "03")), path, [D3])
    assert keys_by_day(tables.read_partitioned(spark, path, schema)) == [("01", 1), ("02", 2), ("03", 3)]
    assert commits.state(spark, path).version == 3


def test_blanks_and_null_text_survive_the_raw_layer(spark, tmp_path):
    odd = [" a ", "\tb\t", "  ", "<nil>", "x <nil> y", "\\0", "", None]
    rows = spark.createDataFrame([(n, 1, 1, Decimal("1.00"), text, datetime(2026, 3, 1)) for n, text in enumerate(odd)], ORDERS)
    bronze.write_transactions(rows, ORDERS.fieldNames(), str(tmp_path / "days"), [D1])
    found = bronze.read_transactions(spark, str(tmp_path / "days"), ORDERS, [D1])
    assert [row.payment_method for row in found.orderBy("order_id").collect()] == odd


def test_malformed_lines_are_counted_and_kept(spark, tmp_path):
    layout = Layout.under(str(tmp_path / "malformed"))
    days = [D1, D2, D3]
    runs.extract(spark, shop(spark, ORDER_ROWS, ITEM_ROWS), layout, days)
    lines = {"orders": "7,1,101,oops,Cash,2026-03-02 09:00:00", "order_items": "90,2,1,one,10.00"}
    for name, line in lines.items():
        (file,) = (tmp_path / "malformed" / "bronze" / name).glob("run=*/year=2026/month=03/day=02/part-*")
        file.write_text(file.read_text() + line + "\n")
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    counts = runs.load_silver(spark, layout, days).collect()
    assert {row.day: row.violations for row in counts if row.rule == "malformed_rows"} == {"01": 0, "02": 2, "03": 0}
    kept = tables.read_partitioned(spark, f"{layout.quarantine}/malformed_rows", MALFORMED_ROWS).collect()
    assert {(row.table_name, row.malformed_line, row.day) for row in kept} == {(name, line, "02") for name, line in lines.items()}
    silver = tables.read_partitioned(spark, f"{layout.silver}/orders", SILVER_ORDERS)
    assert silver.filter("order_id = 7 AND total_amount IS NULL").count() == 1
    # put right and loaded again, they are gone
    runs.extract(spark, shop(spark, ORDER_ROWS, ITEM_ROWS), layout, days)
    runs.load_silver(spark, layout, days)
    assert tables.every_stored_day(spark, f"{layout.quarantine}/malformed_rows") == []


def test_emptied_raw_layer_takes_nothing_away(spark, tmp_path):
    """Only a commit that says so empties a day; a missing raw layer, or one begun anew, says nothing about other days."""
    raw, landed, checkpoint = (str(tmp_path / name) for name in ("raw", "landed", "checkpoint"))
    data, names = shop(spark, ORDER_ROWS, ITEM_ROWS), ORDERS.fieldNames()
    bronze.write_transactions(data.orders(D1, D2), names, raw, [D1, D2])
    intake.ingest_arrivals(spark, raw, ORDERS, landed, checkpoint)
    moved = tmp_path / "raw"
    moved.rename(tmp_path / "away")
    intake.ingest_arrivals(spark, raw, ORDERS, landed, checkpoint)
    assert intake.read_landed(spark, landed, ORDERS).count() == 3
    bronze.write_transactions(data.orders(D3, D3), names, raw, [D3])
    intake.ingest_arrivals(spark, raw, ORDERS, landed, str(tmp_path / "checkpoint-2"))
    assert sorted(row.order_id for row in intake.read_landed(spark, landed, ORDERS).collect()) == [1, 2, 3, 4]


def test_stream_batches_can_be_repeated(spark, tmp_path):
    """Without its checkpoint a stream sees all commits again, and lands nothing."""
    raw, landed = str(tmp_path / "raw"), str(tmp_path / "landed")
    data, names = shop(spark, ORDER_ROWS, ITEM_ROWS), ORDERS.fieldNames()
    bronze.write_transactions(data.orders(D1, D3), names, raw, [D1, D2, D3])
    intake.ingest_arrivals(spark, raw, ORDERS, landed, str(tmp_path / "c1"))
    held = commits.state(spark, landed)
    assert [(row.day, row.row_count) for row in intake.ledger(spark, landed).collect()] == [(D1, 1), (D2, 2), (D3, 1)]
    intake.ingest_arrivals(spark, raw, ORDERS, landed, str(tmp_path / "c2"))
    assert commits.state(spark, landed) == held
    kept = {name for name in (tmp_path / "c1" / "sources" / "0").rglob("*") if name.is_file()}
    assert not any("part-" in name.read_text(errors="replace") for name in kept)
    assert intake.damaged_days(spark, landed, ORDERS) == []
    (file,) = (tmp_path / "landed").glob("run=*/year=2026/month=03/day=01/part-*")
    file.unlink()
    assert intake.damaged_days(spark, landed, ORDERS) == [D1]


def test_late_rows_are_found_however_late(spark, tmp_path):
    layout = Layout.under(str(tmp_path / "late"))
    early = shop(spark, [ORDER_ROWS[0], *ORDER_ROWS[2:]], ITEM_ROWS)
    later = days_between(D1, date(2026, 3, 11))
    runs.run_days(spark, early, layout, later[:3])
    assert changes.late_days(spark, early, layout, later[2]) == []
    complete = shop(spark, ORDER_ROWS, ITEM_ROWS)
    found = changes.changed_days(spark, complete, layout, D1, later[-1]).collect()
    assert [tuple(row) for row in found] == [(D2, 1, 2, 2, 4)]
    # no look-back is given: the run of a day nine days later picks the row up
    runs.run_days(spark, complete, layout, [later[10]], catch_up=True)
    assert tables.read_partitioned(spark, f"{layout.silver}/orders", SILVER_ORDERS).count() == 4
    assert changes.late_days(spark, complete, layout, later[10]) == []
    # a changed value is a change, too, and so is a day that has lost its rows
    changed = shop(spark, [(1, "10.00", "QRIS", "2026-03-01 09:00:00"), *ORDER_ROWS[1:3]], ITEM_ROWS)
    found = changes.changed_days(spark, changed, layout, D1, D3).collect()
    assert [tuple(row) for row in found] == [(D1, 1, 1, 1, 1), (D3, 1, 1, 0, 0)]


def test_keys_are_compared_with_days_that_may_hold_them(spark, tmp_path, monkeypatch):
    """Days with other ranges of keys, and those whose filter knows none of the new ones, are not opened."""
    layout = Layout.under(str(tmp_path / "keys"))
    days = days_between(D1, date(2026, 3, 8))

    def fact(day, keys):
        columns = {"item_id": F.col("id"), "order_id": F.col("id"), "menu_id": F.col("id"), "quantity": F.lit(1)}
        rows = spark.createDataFrame([(k,) for k in keys], "id long").withColumns(columns)
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in FACT if f.name not in columns]
        return rows.select(*columns, *missing).withColumns({"year": F.lit("2026"), "month": F.lit("03"), "day": F.lit(f"{day.day:02d}")})

    for i, day in enumerate(days[:6]):  # even and odd days have keys of one range, of which none is common
        first = 1000 * (i // 2)
        runs.store_fact(spark, layout, fact(day, range(first + i % 2, first + 1000, 2)), [day])
    opened, filters = [], []
    real = tables.read_folders

    def watched(s, path, schema, folders, *rest):
        (filters if path.endswith("_keys") else opened).extend(folders)
        return real(s, path, schema, folders, *rest)

    def repeated(day, keys):
        runs.store_fact(spark, layout, fact(day, keys), [day])
        opened.clear(), filters.clear()
        with monkeypatch.context() as patched:
            patched.setattr(tables, "read_folders", watched)
            found = {row.item_id: row.n_records for row in runs.repeated_fact_keys(spark, layout, [day]).collect()}
        return found, sorted(name[-2:] for name in opened), sorted(name[-2:] for name in filters)

    assert repeated(days[6], [5000, 5001]) == ({}, ["07"], [])
    assert repeated(days[6], [5000, 5001, 5001]) == ({5001: 2}, ["07"], [])
    assert repeated(days[6], [1003, 1003, 1004]) == ({1003: 3, 1004: 2}, ["03", "04", "07"], ["03", "04"])
    assert repeated(days[6], [2, 4, 7000]) == ({2: 2, 4: 2}, ["01", "07"], ["01", "02", "03", "04", "05", "06"])
    assert repeated(days[7], []) == ({}, [], [])
    for n in (1, 50, 300_000):
        size = keysets.size_of(n)
        filled = keysets._filled(np.arange(0, 3 * n, 3), size)
        known = np.stack([filled[places] for places in keysets._places(np.arange(3 * n), size)]).all(axis=0)
        assert known[::3].all() and (n < 100 or known[1::3].mean() < 0.03)


def test_filters_are_made_without_python_objects_and_looked_up_in_few_passes(spark, monkeypatch):
    """Keys stay in Arrow's memory, and small filters of many days are looked up in one pass over the keys, not in one per 16 days."""
    days = days_between(D1, date(2026, 4, 9))
    text = F.split(F.date_add(F.lit(D1), (F.col("id") % len(days)).cast("int")).cast("string"), "-")
    rows = spark.range(4000).withColumns({name: text[i] for i, name in enumerate(DAY_KEYS)}).withColumnRenamed("id", "key")
    rows = rows.unionByName(rows.limit(3).withColumn("key", F.lit(None).cast("long")))  # a NULL key is in no filter
    filters = keysets.day_filters(rows, "key", {day: 100 for day in days}).localCheckpoint()
    assert filters.count() == len(days)

    passes = []
    real = type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: passes.append(len(value)) or real(self, value))
    first = spark.range(0, 4000, len(days)).toDF("key")  # the keys of the first day
    assert days[0] in keysets.known_days(first, "key", filters) and passes == [len(days)]
    passes.clear()
    monkeypatch.setattr(keysets, "HELD_BYTES", 1024)
    assert keysets.known_days(spark.range(4000).toDF("key"), "key", filters) == days and len(passes) > 1
    assert len(keysets.known_days(spark.range(10**9, 10**9 + 2).toDF("key"), "key", filters)) < 10
    assert keysets.portions([("a", 3), ("b", 9), ("c", 2), ("d", 2)], 4) == [["a"], ["b"], ["c", "d"]]

    batch = pa.RecordBatch.from_pydict({"key": [5, None, 7], "year": ["2026"] * 3, "month": ["03"] * 3, "day": ["01", "01", "02"]})
    found = {day: keys for day, keys in keysets._by_day(batch, "key")}
    assert all(isinstance(keys, np.ndarray) for keys in found.values())
    assert {day[2]: keys.tolist() for day, keys in found.items()} == {"01": [5], "02": [7]}


def test_raw_rows_are_shuffled_by_one_date_and_days_hashed_in_whole_numbers(spark, tmp_path, monkeypatch):
    moments = ["2026-03-01 09:00:00", "2026-03-02 23:59:59", "2026-03-03 00:00:00", None, "2026-03-01 23:59:59.9"]
    rows = spark.createDataFrame(list(enumerate(moments)), "k int, at string").select("k", F.to_timestamp("at").alias("created_at"))
    written = []
    real = tables.write_days
    monkeypatch.setattr(bronze, "write_days", lambda df, *rest, **named: written.append(df) or real(df, *rest, **named))
    path = str(tmp_path / "raw")
    bronze.write_transactions(rows, ["k", "created_at"], path, [D1, D3])
    plan = written[0]._jdf.queryExecution().optimizedPlan().toString().splitlines()
    shuffles = [line for line in plan if "RebalancePartitions" in line]
    assert len(shuffles) == 1 and "_day" in shuffles[0] and "month" not in shuffles[0]
    stored = bronze.read_transactions(spark, path, rows.schema, [D1, D2, D3])
    assert keys_by_day(stored) == [("01", 0), ("01", 4), ("03", 2)]

    hashes = tables.day_hashes(stored)
    whole = stored.groupBy("day").agg(F.sum(F.xxhash64("k", "created_at").cast("decimal(20,0)")).cast("string").alias("hash"))
    assert {f"{day.day:02d}": note["hash"] for day, note in hashes.items()} == {row.day: row.hash for row in whole.collect()}


def test_the_fact_is_built_once_for_all_days(spark, monkeypatch):
    """What unique_over_days writes again is read from the stored fact, not joined anew."""
    built = []
    real = runs.store_fact
    monkeypatch.setattr(runs, "store_fact", lambda s, layout, rows, days: built.append(rows.inputFiles()) or real(s, layout, rows, days))
    queries.REGISTRY["unique_over_days"](spark, "/root/testdata/sf0.001")
    source_files, again = built
    assert any("lineitem" in name for name in source_files) and again
    assert not any("lineitem" in name for name in again)


def test_tests_of_a_run_stay_in_its_days(spark, tmp_path, monkeypatch):
    layout = Layout.under(str(tmp_path / "scoped"))
    far = date(2026, 5, 20)
    data = shop(spark, [*ORDER_ROWS, (9, "10.00", "Cash", "2026-05-20 10:00:00")], [*ITEM_ROWS, (9, 1, "10.00")])
    runs.run_days(spark, data, layout, [D1, D2, D3])
    opened = []
    real = tables.read_folders
    monkeypatch.setattr(tables, "read_folders", lambda s, p, c, folders, *rest: opened.extend(folders) or real(s, p, c, folders, *rest))
    summary = runs.run_days(spark, data, layout, [far], now="2026-05-21 09:00:00").collect()
    assert opened and all("month=05/day=20" in name for name in opened)
    assert {row.test_name: row.status for row in summary}["freshness_orders"] == "pass"
    late = runs.freshness_test(spark, layout, "2026-06-21 09:00:00").first()
    assert (late.violations, late.status) == (1, "fail")
    everything = runs.run_tests(spark, layout, far).collect()
    assert len(everything) == 11 and {row.status for row in everything} == {"pass"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_source_day_reaches_the_scan(spark, tmp_path):
    data = shop(spark, ORDER_ROWS, ITEM_ROWS)
    for name, df in data.frames.items():
        df.write.parquet(str(tmp_path / name))
    till = source.ParquetSource(spark, str(tmp_path))
    plan = plan_of(till.orders(D2, D2).select("order_id"))
    assert "GreaterThanOrEqual(created_at,2026-03-02 00:00:00.0), LessThan(created_at" in plan
    assert "ReadSchema: struct<order_id:bigint,created_at:timestamp>" in plan
    assert sorted(row.order_id for row in till.items(D2, D2).collect()) == [2, 2, 3, 3]


def test_fact_of_a_day_prunes_both_sides(spark, tmp_path):
    orders = spark.sql(
        "SELECT 1L order_id, 1 outlet_id, 1 cashier_id, CAST(1 AS DECIMAL(14,2)) total_amount, 'Cash' payment_method, "
        "TIMESTAMP '2026-03-02 08:00:00' created_at, 'valid' data_quality_status, '2026' year, '03' month, '02' day"
    )
    items = spark.sql(
        "SELECT 1L item_id, 1L order_id, 1L menu_id, 1 quantity, CAST(1 AS DECIMAL(12,2)) price_per_item, "
        "CAST(1 AS DECIMAL(14,2)) subtotal, '2026' year, '03' month, '02' day"
    )
    for name, df in (("orders", orders), ("order_items", items)):
        tables.write_days(df, str(tmp_path / name), [D2])
    fact = gold.fact_for_day(
        tables.read_partitioned(spark, str(tmp_path / "orders"), SILVER_ORDERS),
        tables.read_partitioned(spark, str(tmp_path / "order_items"), ORDER_ITEMS),
        D2,
    )
    assert plan_of(fact).count("PartitionFilters: [isnotnull(year") == 2
    assert fact.count() == 1
    assert gold.fact_for_days(orders, items, [D1, D2]).count() == 1
    assert gold.fact_for_days(orders, items, [D3]).count() == 0


def test_large_day_is_split_and_small_days_are_one_file(spark, tmp_path, schema):
    """A small day may share the fate of a large one that hashes to the same partition; most do not."""
    path = tmp_path / "t"
    rows = spark.range(0, 60_000, 1, 8).selectExpr(
        "CAST(id AS INT) AS k", "'2026' AS year", "'03' AS month",
        "IF(id % 20 < 9, CONCAT('1', CAST(id % 20 AS STRING)), '03') AS day",
    )
    days = days_between(D1, date(2026, 3, 20))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        tables.write_days(rows, str(path), days)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {folder.name: len(list(folder.glob("part-*"))) for folder in path.glob("run=*/year=2026/month=03/day=*")}
    assert len(files) == 10
    assert files.pop("day=03") > 2
    assert sorted(files.values())[4] == 1
    assert tables.read_partitioned(spark, str(path), schema).count() == 60_000


def test_command_line(spark, tmp_path, capsys):
    from tillhouse.__main__ import main

    data = shop(spark, ORDER_ROWS, ITEM_ROWS)
    for name, df in data.frames.items():
        df.write.parquet(str(tmp_path / "till" / name))
    lake = str(tmp_path / "lake")
    main(["--source", str(tmp_path / "till"), "--root", lake, "--start-date", "2026-03-01", "--end-date", "2026-03-03"])
    assert "unique_fact_item_id" in capsys.readouterr().out
    assert runs.read_fact(spark, Layout.under(lake)).count() == 3
    # a day, its catalog tables and a late row in one go
    more = [*ORDER_ROWS, (5, "10.00", "Cash", "2026-03-04 09:00:00"), (6, "5.00", "Cash", "2026-03-01 10:00:00")]
    data = shop(spark, more, [*ITEM_ROWS, (5, 1, "10.00"), (6, 2, "5.00")])
    for name in ("orders", "order_items"):
        data.frames[name].write.mode("overwrite").parquet(str(tmp_path / "till" / name))
    main(["--source", str(tmp_path / "till"), "--root", lake, "--date", "2026-03-04", "--catch-up", "--database", "till_cli"])
    rows = spark.sql("SELECT day, COUNT(*) AS n FROM till_cli.orders GROUP BY day ORDER BY day").collect()
    assert [tuple(row) for row in rows] == [("01", 2), ("04", 1)]
    assert spark.sql("SELECT SUM(quantity) FROM till_cli.fact_order_items WHERE day = '04'").first()[0] == 1
    with pytest.raises(SystemExit):
        main(["--source", "x", "--root", lake, "--start-date", "2026-03-03", "--end-date", "2026-03-01"])
