"""Sources and sinks: log text round trip, gold tables, JDBC on embedded Derby, views."""

import datetime as dt
import glob
import json
import os
import re

import pytest
from pyspark.sql import functions as F

from weblake import schemas
from weblake.plans import weblogs as W
from weblake.session import shared_dir
from weblake.sinks import jdbc as JS
from weblake.sinks import tables as T
from weblake.sinks import views as V
from weblake.sources import jdbc as JR
from weblake.sources.files import read_domain_csv
from weblake.sources.fixtures import Fixture
from weblake.sources.logs import read_weblogs

from .conftest import SF_SMALL


def test_log_text_round_trip(spark, scratch):
    fx = Fixture(spark, SF_SMALL)
    logs = fx.weblogs().drop("event_id")
    root = os.path.join(scratch, "landing")
    T.append_text_lines(W.render_weblog_lines(logs), root, ["year", "month"])
    back = read_weblogs(spark, root, year=2024, month=1).drop("year", "month")
    assert back.exceptAll(logs).count() == 0 and logs.exceptAll(back).count() == 0
    assert read_weblogs(spark, root, year=2024, month=2).count() == 0


def test_log_scan_quoting_and_short_lines(spark, scratch):
    p = os.path.join(scratch, "logs", "year=2022", "month=10")
    os.makedirs(p)
    with open(os.path.join(p, "file.log"), "w") as fh:
        fh.write('10.0.3.7 - "customer.a" 2022-10-03 10:00:01 - "200" - "http://s/products/12" "Mozilla/5.0 (X; Y) G"\n')
        fh.write('10.0.3.7 - customer.a 2022-10-03 10:20:01 - "200" - "http://s/orders/77" "curl/7.81"\n')
        fh.write('bad line\n')
    rows = read_weblogs(spark, os.path.join(scratch, "logs")).orderBy(F.col("time").asc_nulls_last()).collect()
    assert len(rows) == 3
    assert rows[0].username == rows[1].username == "customer.a"
    assert rows[0].useragent == "Mozilla/5.0 (X; Y) G"
    short = rows[2]
    assert short.ident == "line" and short.username is None and short.year == 2022 and short.month == 10


def test_schema_document(spark):
    doc = json.dumps(schemas.WEBLOGS.jsonValue())
    assert schemas.schema_from_json(doc) == schemas.WEBLOGS


def _sales_rows(spark, rows):
    return spark.createDataFrame(rows, schemas.SALES)


PARTS = schemas.SALES_PARTITIONS
KEYS = ["orderItemId"]


def _folders(root, name="sales"):
    return {os.path.relpath(f, os.path.join(root, name)) for f in glob.glob(os.path.join(root, name, "run=*", "year*", "month*"))}


def test_merge_into_partitioned_with_partition_move(spark, scratch):
    T.define_table(spark, scratch, "sales", schemas.SALES, schemas.SALES_PARTITIONS)
    first = _sales_rows(spark, [(1, 1, 1.0, dt.datetime(2020, 1, 5), "2020", "01"),
                                (2, 2, 2.0, dt.datetime(2020, 2, 5), "2020", "02")])
    T.merge_into(spark, scratch, "sales", first, KEYS, schemas.SALES, PARTS)
    # item 2 moves from February to March; item 3 is new
    batch = _sales_rows(spark, [(2, 2, 2.5, dt.datetime(2020, 3, 1), "2020", "03"),
                                (3, 3, 3.0, dt.datetime(2020, 3, 2), "2020", "03")])
    stats = T.merge_into(spark, scratch, "sales", batch, KEYS, schemas.SALES, PARTS)

    def got():
        return sorted((r.orderItemId, r.price, r.month_partition) for r in T.read_table(spark, scratch, "sales").collect())
    assert got() == [(1, 1.0, "01"), (2, 2.5, "03"), (3, 3.0, "03")]
    assert stats == {"run": 3, "applied": True}
    state = T.current(spark, scratch)
    live = {f for _, f in state["tables"]["sales"]["live"]}
    assert sorted(f.rsplit("=", 1)[-1] for f in live) == ["01", "03"]   # February is gone
    assert _folders(scratch) > live   # what run 2 named can still be read
    # the next run forgets what only run 2 named; January's files were never rewritten
    T.merge_into(spark, scratch, "sales", batch.limit(0), KEYS, schemas.SALES, PARTS)
    assert _folders(scratch) == live and got() == [(1, 1.0, "01"), (2, 2.5, "03"), (3, 3.0, "03")]
    assert len(glob.glob(os.path.join(scratch, "_runs", "*.json"))) == 2


def _fails_once(monkeypatch, owner, name, at=1):
    real, calls = getattr(owner, name), []

    def broken(*args, **kwargs):
        calls.append(1)
        if len(calls) == at:
            monkeypatch.setattr(owner, name, real)
            raise RuntimeError("lost")
        return real(*args, **kwargs)

    monkeypatch.setattr(owner, name, broken)


@pytest.mark.parametrize("owner,step", [(T, "upsert"), (T.Run, "_write"), (T.Run, "publish"), (T._Pointers, "publish")])
def test_merge_that_fails_half_way_is_invisible_and_can_be_repeated(spark, scratch, monkeypatch, owner, step):
    first = _sales_rows(spark, [(1, 1, 1.0, dt.datetime(2020, 1, 5), "2020", "01"), (2, 2, 2.0, dt.datetime(2020, 2, 5), "2020", "02")])
    move = _sales_rows(spark, [(2, 2, 2.5, dt.datetime(2020, 3, 1), "2020", "03"), (None, 9, 9.0, None, None, None)])
    rows = lambda: sorted((r.orderItemId or 0, r.price, r.month_partition) for r in T.read_table(spark, scratch, "sales").collect())
    T.merge_into(spark, scratch, "sales", first, KEYS, schemas.SALES, PARTS, epoch=("s", 0))
    _fails_once(monkeypatch, owner, step)
    with pytest.raises(RuntimeError, match="lost"):
        T.merge_into(spark, scratch, "sales", move, KEYS, schemas.SALES, PARTS, epoch=("s", 1))
    assert rows() == [(1, 1.0, "01"), (2, 2.0, "02")]
    for _ in range(3):   # the replay, and the replay of what was published
        T.merge_into(spark, scratch, "sales", move, KEYS, schemas.SALES, PARTS, epoch=("s", 1))
        assert rows() == [(0, 9.0, None), (1, 1.0, "01"), (2, 2.5, "03")]
    assert not glob.glob(os.path.join(shared_dir(spark), spark.sparkContext.applicationId, "merge-batch-*"))


def test_the_second_writer_of_a_run_is_refused(spark, scratch):
    parts = {"year_partition": F.lit("2024")}
    row = lambda k, v: spark.createDataFrame([("u", None, k, v)], schemas.DEVICES)
    T.merge_into(spark, scratch, "d", row(1, "old"), ["OrderId"], schemas.DEVICES, parts)
    with pytest.raises(RuntimeError, match="another writer"):
        with T.gold_run(spark, scratch) as slow:
            slow.merge("d", row(1, "slow"), ["OrderId"], schemas.DEVICES, parts)
            T.merge_into(spark, scratch, "d", row(1, "fast"), ["OrderId"], schemas.DEVICES, parts)   # publishes first
    assert [r.Device for r in T.read_table(spark, scratch, "d").collect()] == ["fast"]


def test_a_pointer_that_is_still_being_written_is_not_read(spark, scratch):
    row = spark.createDataFrame([("u", None, 1, "x")], schemas.DEVICES)
    T.merge_into(spark, scratch, "d", row, ["OrderId"], schemas.DEVICES)
    with open(os.path.join(scratch, "_runs", "00000002.json"), "w") as fh:
        fh.write('{"run": 2, "tab')
    assert T.current(spark, scratch)["run"] == 1 and T.read_table(spark, scratch, "d").count() == 1
    assert T.current(spark, os.path.join(scratch, "nothing")) == T.EMPTY


@pytest.mark.parametrize("value", ["a/b=c:d", "100% [x] {y}", "ü ß", None, "2024"])
def test_partition_values_that_need_escapes(spark, scratch, value):
    parts = {"kind": F.lit(value), "year_partition": F.lit("1")}
    rows = spark.createDataFrame([("u", None, 1, "x"), ("v", None, 1, "y"), ("w", None, None, "z")], schemas.DEVICES)
    for _ in range(2):
        T.merge_into(spark, scratch, "d", rows, ["OrderId"], schemas.DEVICES, parts, epoch=("s", 5))
        got = T.read_table(spark, scratch, "d", keep_partitions=True).collect()
        assert len(got) == 3 and {r.kind for r in got} == {value}
    with pytest.raises(Exception, match="more than one source row"):
        T.merge_into(spark, scratch, "d", rows, ["OrderId"], schemas.DEVICES, parts, epoch=("s", 6))
    one = spark.createDataFrame([("n", None, 2, "x"), ("n", None, 2, "x")], schemas.DEVICES)
    T.merge_into(spark, scratch, "d", one, ["OrderId"], schemas.DEVICES, parts, epoch=("s", 6))
    assert T.read_table(spark, scratch, "d").count() == 5


def test_merge_on_a_condition_moves_rows_between_partitions(spark, scratch):
    parts = {"month": F.date_format("VisitedAt", "yyyy-MM")}
    on = "source.VisitedAt > target.VisitedAt and target.OrderId = source.OrderId"
    day = lambda m, d: dt.datetime(2024, m, d)
    rows = [("u", day(1, 5), 1, "a"), ("u", day(1, 6), 2, "b"), ("u", day(2, 7), 3, "c")]
    T.merge_into(spark, scratch, "d", spark.createDataFrame(rows, schemas.DEVICES), ["OrderId"], schemas.DEVICES, parts)
    batch = [("u", day(2, 1), 1, "A"), ("u", day(1, 1), 1, "early"), ("u", day(1, 6), 2, "same time"), ("u", day(3, 1), 4, "D"), ("u", day(3, 2), None, "E")]
    T.merge_into(spark, scratch, "d", spark.createDataFrame(batch, schemas.DEVICES), on, schemas.DEVICES, parts)
    got = sorted((r.OrderId or 0, r.Device, r.month) for r in T.read_table(spark, scratch, "d", keep_partitions=True).collect())
    assert got == [(0, "E", "2024-03"), (1, "A", "2024-02"), (1, "early", "2024-01"), (2, "b", "2024-01"), (2, "same time", "2024-01"),
                   (3, "c", "2024-02"), (4, "D", "2024-03")]
    twice = [("u", day(4, 1), 3, "x"), ("u", day(4, 2), 3, "y")]
    with pytest.raises(Exception, match="more than one source row"):
        T.merge_into(spark, scratch, "d", spark.createDataFrame(twice, schemas.DEVICES), on, schemas.DEVICES, parts)


def test_touched_partitions_follow_from_the_batch_where_keys_decide_them(spark, scratch, monkeypatch):
    """Product visits are partitioned by a function of a key: no scan of the table is needed to find them."""
    from weblake.plans.runs import visit_partitions
    rows = [("1.1.1.1", "A", dt.datetime(2024, m, 5), 1, "p") for m in (1, 2)]
    merge = lambda r: T.merge_into(spark, scratch, "v", spark.createDataFrame(r, schemas.PRODUCT_VISITS), schemas.PRODUCT_VISITS_KEYS,
                                   schemas.PRODUCT_VISITS, visit_partitions())
    merge(rows)
    monkeypatch.setattr(T, "merge_condition", lambda *a: pytest.fail("the table's keys were read"))
    merge([("1.1.1.1", "B", dt.datetime(2024, 2, 5), 1, "p"), ("1.1.1.1", "C", dt.datetime(2024, 3, 5), 1, "p")])
    assert sorted(r.Country for r in T.read_table(spark, scratch, "v").collect()) == ["A", "B", "C"]


def test_replacing_a_partitioned_table_leaves_nothing(spark, scratch):
    rows = _sales_rows(spark, [(1, 1, 1.0, None, "2020", "01"), (2, 1, 1.0, None, "2020", "02")])
    T.merge_into(spark, scratch, "t", rows, KEYS, schemas.SALES, PARTS)
    with T.gold_run(spark, scratch) as run:
        run.replace("t", rows.limit(1), schemas.SALES, PARTS)
        assert run.rows("t").count() == 1 and T.read_table(spark, scratch, "t").count() == 2   # not yet visible to others
    assert T.read_table(spark, scratch, "t").count() == 1
    plain = os.path.join(scratch, "plain")
    T.write_table(rows, plain, schemas.SALES_PARTITIONS)
    T.write_table(rows.limit(1), plain, schemas.SALES_PARTITIONS)
    assert spark.read.parquet(plain).count() == 1


def test_no_machine_local_folder_on_a_cluster(spark):
    from types import SimpleNamespace as NS

    class Conf:
        def get(self, key, default=None):
            return default

    far = NS(sparkContext=NS(getCheckpointDir=lambda: None, master="spark://host:7077"), conf=Conf())
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(far)


def test_last_year_partition_filter_is_pruned(spark, scratch):
    rows = _sales_rows(spark, [(1, 1, 1.0, dt.datetime(2000, 1, 5), "2000", "01"),
                               (2, 2, 1.0, dt.datetime(2001, 1, 5), "2001", "01")])
    T.merge_into(spark, scratch, "sales", rows, KEYS, schemas.SALES, PARTS)
    from weblake.plans.reports import last_year_orders
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    df = last_year_orders(T.read_table(spark, scratch, "sales"), "2001-06-01")
    assert [r.orderItemId for r in df.collect()] == [1]
    plan = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert re.search(r"PartitionFilters: \[[^\]]*year_partition#\d+ = 2000", plan)
    assert df.first().month_partition == "01"  # text partition values keep their zero


DERBY = "org.apache.derby.jdbc.EmbeddedDriver"


@pytest.fixture
def derby(scratch):
    url = f"jdbc:derby:{os.path.join(scratch, 'db')};create=true"
    return url, {"driver": DERBY}


def test_jdbc_round_trip_on_derby(spark, derby):
    url, props = derby
    fx = Fixture(spark, SF_SMALL)
    orders = fx.orders().withColumn("OrderDate", F.col("OrderDate").cast("timestamp"))
    JS.write_jdbc(orders, url, "orders", props, mode="overwrite")
    full = JR.read_table(spark, url, "orders", props)
    assert full.count() == fx.orders().count()
    preds = JR.month_predicates("OrderDate", dt.date(1995, 1, 1), dt.date(2001, 8, 1), quote='"')
    monthly = JR.read_with_predicates(spark, url, "orders", preds, props)
    assert monthly.rdd.getNumPartitions() == len(preds)
    assert monthly.count() == full.count()
    inc = JR.read_with_predicates(spark, url, "orders", JR.since_month_predicate("OrderDate", dt.date(2001, 6, 1), quote='"'),
                                  props)
    assert inc.count() == fx.orders().filter("OrderDate >= '2001-06-01'").count()
    ranged = JR.read_range_partitioned(spark, url, "orders", '"OrderId"', 1, 6000, 4, props)
    assert ranged.rdd.getNumPartitions() == 4 and ranged.count() == full.count()
    with pytest.raises(Exception):
        JS.write_jdbc(orders, url, "orders", props, mode="errorifexists")


def test_domain_csv_import(spark, scratch):
    p = os.path.join(scratch, "companies.csv")
    with open(p, "w") as fh:
        fh.write("Supplier A, TRUE\nSupplier B, TRUE\nCompany A, FALSE\n")
    df = read_domain_csv(spark, p, "CompanyName string, IsSupplier boolean", key="CompanyId")
    got = [tuple(r) for r in df.orderBy("CompanyId").collect()]
    assert got == [(1, "Supplier A", True), (2, "Supplier B", True), (3, "Company A", False)]


def _mart(spark):
    import weblake.registry as R
    return {"last_year_orders": R.q_last_year_orders(spark, SF_SMALL), "order_devices": R.q_order_devices(spark, SF_SMALL),
            "popular_products": R.q_product_visits(spark, SF_SMALL)}


def test_report_views_outlive_their_frames(spark, scratch):
    import weblake.registry as R
    views = V.load_mart(spark, _mart(spark), "mart_a", scratch)
    try:
        for name, query in (("popular_products_report", R.q_report_popular_products), ("order_devices_report", R.q_report_order_devices),
                            ("last_year_orders_report", R.q_report_last_year_orders)):
            expect, got = query(spark, SF_SMALL), spark.sql(f"select * from mart_a.{name}")
            assert got.exceptAll(expect).count() == 0 and expect.exceptAll(got).count() == 0
            assert views[name].columns == expect.columns
        # a later load: the views, not frames, show the new rows
        fewer = _mart(spark) | {"popular_products": R.q_product_visits(spark, SF_SMALL).filter("ProductId < 50")}
        V.load_mart(spark, fewer, "mart_a", scratch)
        got = {r.ProductName for r in spark.table("mart_a.popular_products_report").collect()}
        assert got and got <= {r.ProductName for r in fewer["popular_products"].collect()}
        V.drop_report_views(spark, "mart_a")
        assert not spark.catalog.tableExists("mart_a.popular_products_report") and spark.catalog.tableExists("mart_a.popular_products")
    finally:
        V.drop_mart(spark, "mart_a")
    assert not spark.catalog.databaseExists("mart_a")
    assert not [t for t in spark.catalog.listTables() if t.isTemporary]   # no query leaves views in the session


def test_a_table_overwritten_under_its_view_leaves_the_view_stale(spark, scratch):
    """Why a load drops the views first: over a table whose column is gone the old view cannot be read."""
    V.load_mart(spark, _mart(spark), "mart_b", scratch)
    try:
        wider = _mart(spark)["order_devices"].withColumnRenamed("Device", "Agent")
        wider.write.mode("overwrite").format("parquet").option("path", f"{scratch}/order_devices").saveAsTable("mart_b.order_devices")
        with pytest.raises(Exception, match="Device|INCOMPATIBLE"):
            spark.table("mart_b.order_devices_report").collect()
        V.load_mart(spark, _mart(spark), "mart_b", scratch)   # drop, overwrite, create: readable again
        assert spark.table("mart_b.order_devices_report").count() == 5
    finally:
        V.drop_mart(spark, "mart_b")


def test_merge_key_bounds_on_ntz_keys_in_other_zone(spark, scratch):
    """Key-range pruning on a timestamp_ntz key must not shift with the session zone."""
    parts = {"year_partition": F.lit("2024"), "month_partition": F.lit("01")}
    rows = [("1.1.1.1", "A", dt.datetime(2024, 1, 5, 23, 30), 1, "p")]
    T.merge_into(spark, scratch, "visits", spark.createDataFrame(rows, schemas.PRODUCT_VISITS), schemas.PRODUCT_VISITS_KEYS,
                 schemas.PRODUCT_VISITS, parts)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        upd = [("1.1.1.1", "B", dt.datetime(2024, 1, 5, 23, 30), 1, "p")]
        T.merge_into(spark, scratch, "visits", spark.createDataFrame(upd, schemas.PRODUCT_VISITS), schemas.PRODUCT_VISITS_KEYS,
                     schemas.PRODUCT_VISITS, parts)
        got = [(r.Country, r.VisitedAt) for r in T.read_table(spark, scratch, "visits").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [("B", dt.datetime(2024, 1, 5, 23, 30))]


def test_month_predicates_cover_every_row_once():
    import duckdb
    assert JR.month_predicates("ts", dt.date(2020, 11, 15), dt.date(2020, 10, 15)) == ["1 = 0"]
    preds = JR.month_predicates("ts", dt.date(2020, 11, 15), dt.date(2021, 2, 3))
    assert len(preds) == 4
    values = ["2019-01-01 00:00:00", "2020-11-30 23:59:59", "2020-12-01 00:00:00", "2021-01-31 23:59:59",
              "2021-02-01 00:00:00", "2030-05-05 12:00:00", None]
    con = duckdb.connect()
    con.execute("create table t (ts timestamp)")
    con.executemany("insert into t values (?)", [(v,) for v in values])
    hits = [sum(con.execute(f"select count(*) from t where ts is not distinct from ? and ({p})", [v])
                .fetchall()[0][0] for p in preds) for v in values]
    assert hits == [1] * len(values)
    assert JR.month_predicates("ts", dt.date(2020, 1, 1), dt.date(2020, 1, 31)) == ["1 = 1"]


def test_incremental_items_by_order_id_range(spark, derby):
    """SRC-2 -> AGG-1 -> SRC-3 -> FLT-2: month's orders, their id bounds, a
    range-partitioned item read, then the sales rows of exactly those orders."""
    from weblake.plans import sales
    url, props = derby
    fx = Fixture(spark, SF_SMALL)
    JS.write_jdbc(fx.orders().withColumn("OrderDate", F.col("OrderDate").cast("timestamp")), url, "orders", props)
    JS.write_jdbc(fx.orderitems(), url, "orderitems", props)
    month = JR.read_with_predicates(spark, url, "orders", JR.since_month_predicate("OrderDate", dt.date(2001, 6, 1),
                                                                                   quote='"'), props)
    month = month.withColumn("OrderDate", F.col("OrderDate").cast("timestamp_ntz"))
    items = JR.read_range_for(spark, url, "orderitems", "OrderId", sales.order_id_bounds(month), 4, props, quote='"')
    got = sales.sales_fact_for_orders(items, month, fx.catalog())
    expect = sales.sales_fact_incremental(fx.orderitems(), fx.orders(), fx.catalog(), "2001-06-01")
    assert got.exceptAll(expect).count() == 0 and expect.exceptAll(got).count() == 0
    empty = JR.read_with_predicates(spark, url, "orders", JR.since_month_predicate("OrderDate", dt.date(2030, 1, 1),
                                                                                   quote='"'), props)
    assert JR.read_range_for(spark, url, "orderitems", "OrderId", sales.order_id_bounds(empty), 4, props,
                             quote='"').count() == 0


def test_define_table_if_absent_and_replace(spark, scratch):
    with open(os.path.join(scratch, "devices.json"), "w") as fh:
        fh.write(schemas.DEVICES.json())
    T.define_table(spark, scratch, "devices", os.path.join(scratch, "devices.json"))   # from a schema document
    assert T.read_table(spark, scratch, "devices").count() == 0 and T.table_exists(spark, scratch, "devices")
    rows = spark.createDataFrame([("u", dt.datetime(2024, 1, 1), 1, "[x]")], schemas.DEVICES)
    T.merge_into(spark, scratch, "devices", rows, ["OrderId"], schemas.DEVICES)   # a table without partitions
    T.define_table(spark, scratch, "devices", schemas.DEVICES)                 # exists: left alone
    assert T.read_table(spark, scratch, "devices").count() == 1
    T.merge_into(spark, scratch, "devices", rows.withColumn("Device", F.lit("new")), "target.OrderId = source.OrderId", schemas.DEVICES)
    assert [r.Device for r in T.read_table(spark, scratch, "devices").collect()] == ["new"]
    T.define_table(spark, scratch, "devices", schemas.DEVICES, replace=True)   # drop and recreate
    assert T.read_table(spark, scratch, "devices").count() == 0
    assert T.read_table(spark, scratch, "devices").schema == schemas.DEVICES
    with pytest.raises(ValueError, match="no table"):
        T.read_table(spark, scratch, "other")
