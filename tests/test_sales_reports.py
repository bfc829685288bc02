"""Sales fact, incremental runs and reports."""

import datetime as dt

from weblake.plans import reports, sales
from weblake.sources.fixtures import Fixture

from .conftest import SF_SMALL


def _orders(spark, rows):
    return spark.createDataFrame(rows, "OrderId bigint, CustomerId bigint, OrderDate timestamp_ntz")


def test_incremental_empty_month_is_empty(spark):
    orders = _orders(spark, [(1, 1, dt.datetime(2020, 1, 5))])
    items = spark.createDataFrame([(10, 1, 5)], "OrderItemId bigint, OrderId bigint, CatalogId bigint")
    catalog = spark.createDataFrame([(5, 9.5)], "CatalogId bigint, Price double")
    for mode in ("orders", "min_id"):
        assert sales.sales_fact_incremental(items, orders, catalog, "2020-03-01", mode).count() == 0
    bounds = sales.order_id_bounds(orders, "2020-03-01").first()
    assert bounds.minOrderId is None and bounds.maxOrderId is None


def test_min_id_mode_keeps_old_items_with_null_date(spark):
    orders = _orders(spark, [(1, 1, dt.datetime(2020, 1, 5)), (2, 1, dt.datetime(2020, 3, 2))])
    items = spark.createDataFrame([(10, 1, 5), (20, 2, 5), (30, 3, 5)],
                                  "OrderItemId bigint, OrderId bigint, CatalogId bigint")
    catalog = spark.createDataFrame([(5, 9.5)], "CatalogId bigint, Price double")
    exact = sales.sales_fact_incremental(items, orders, catalog, "2020-03-15")
    legacy = sales.sales_fact_incremental(items, orders, catalog, "2020-03-15", "min_id")
    assert sorted(r.orderItemId for r in exact.collect()) == [20]
    rows = {r.orderItemId: r for r in legacy.collect()}
    assert sorted(rows) == [20, 30] and rows[30].orderDate is None
    assert (rows[20].year_partition, rows[20].month_partition) == ("2020", "03")


def test_full_equals_snapshot_plus_incremental(spark):
    fx = Fixture(spark, SF_SMALL)
    items, orders, catalog = fx.orderitems(), fx.orders(), fx.catalog()
    full = sales.sales_fact(items, orders, catalog)
    snap = sales.sales_fact_for_orders(items, sales.orders_snapshot(orders, "1998-01-01"), catalog)
    merged = snap
    for month in ("1997-12-01", "1999-06-01"):  # overlapping batches: updates and inserts
        batch = sales.sales_fact_incremental(items, orders, catalog, month)
        merged = sales.sales_upsert(merged, batch)
    assert merged.exceptAll(full).count() == 0 and full.exceptAll(merged).count() == 0


def test_report_tie_break_by_country_name(spark):
    visits = spark.createDataFrame(
        [("1.1.1.1", "ZZ", None, 1, "p1"), ("1.1.1.2", "ZZ", None, 1, "p1"),
         ("2.2.2.1", "AA", None, 1, "p1"), ("2.2.2.2", "AA", None, 2, "p2")],
        "HostIp string, Country string, VisitedAt timestamp_ntz, ProductId bigint, ProductName string")
    got = [tuple(r) for r in reports.report_popular_products(visits).collect()]
    assert got == [("AA", "p1", 1), ("AA", "p2", 1)]


def test_last_year_orders_report(spark):
    sales_rows = spark.createDataFrame(
        [(1, 1, 1.0, dt.datetime(2000, 1, 3), "2000", "01"), (2, 1, 1.0, dt.datetime(2000, 1, 3), "2000", "01"),
         (3, 2, 1.0, dt.datetime(2000, 2, 3), "2000", "02"), (4, 3, 1.0, dt.datetime(2001, 2, 3), "2001", "02")],
        "orderItemId bigint, orderId bigint, price double, orderDate timestamp_ntz, "
        "year_partition string, month_partition string")
    ly = reports.last_year_orders(sales_rows, dt.date(2001, 6, 1))
    got = [tuple(r) for r in reports.report_last_year_orders(ly).collect()]
    assert got == [("2000", "01", 1), ("2000", "02", 1)]


def test_order_devices_top5_ties(spark):
    dev = spark.createDataFrame([(None, None, i, f"d{i % 7}") for i in range(70)],
                                "Username string, VisitedAt timestamp_ntz, OrderId bigint, Device string")
    got = [tuple(r) for r in reports.report_order_devices(dev).collect()]
    assert got == [("d0", 10), ("d1", 10), ("d2", 10), ("d3", 10), ("d4", 10)]
