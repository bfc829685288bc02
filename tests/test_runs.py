"""End-to-end runs: historical + incremental = full; streaming ingest; mart over JDBC."""

import os

import pytest
from pyspark.sql import functions as F

from weblake import registry as R
from weblake.plans import reports, runs
from weblake.plans import weblogs as W
from weblake.sinks.tables import append_text_lines
from weblake.sources.fixtures import Fixture
from weblake.sources.logs import read_weblogs
from weblake.streaming.weblog_ingest import start_weblog_ingest

from .conftest import SF_SMALL


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _key_rows(df):
    return {tuple(r) for r in df.collect()}


def test_historical_run_and_incremental_run_that_updates(spark, scratch):
    from weblake.plans.sales import incremental_orders
    R.runs.run_transform(spark, R.fixture_sources(spark, SF_SMALL, early=True), scratch, R.RUN_SNAPSHOT, is_historical=True)
    before = {n: _key_rows(df) for n, df in runs.gold_tables(spark, scratch).items()}
    now = R.fixture_sources(spark, SF_SMALL)
    assert runs.run_transform(spark, now, scratch, R.RUN_INCREMENTAL_AS_OF, is_historical=False, logs_month=R.RUN_LOGS_MONTH) == 2
    g = runs.gold_tables(spark, scratch)
    recent = incremental_orders(now.orders, R.RUN_INCREMENTAL_AS_OF).select(F.col("OrderId").alias("orderId"))
    assert _same(g["sales"].join(recent, "orderId", "left_semi").select(g["sales"].columns),
                 R.q_sales_fact(spark, SF_SMALL).join(recent, "orderId", "left_semi").select(g["sales"].columns))
    assert _same(g["devices"], R.q_order_devices(spark, SF_SMALL))
    assert _same(g["products"], R.q_product_visits(spark, SF_SMALL))
    after = {n: _key_rows(df) for n, df in g.items()}
    keys = {"sales": 0, "devices": 2}
    for name, at in keys.items():   # rows of the same key changed values, and some sales their month
        old, new = {r[at]: r for r in before[name]}, {r[at]: r for r in after[name]}
        assert any(k in old and old[k] != new[k] for k in new) and len(new) > len(old)
    old, new = {r[0]: r[-1] for r in before["sales"]}, {r[0]: r[-1] for r in after["sales"]}
    assert any(k in old and old[k] != new[k] for k in new)
    # replaying the incremental run changes nothing
    runs.run_transform(spark, now, scratch, R.RUN_INCREMENTAL_AS_OF, is_historical=False, logs_month=R.RUN_LOGS_MONTH)
    assert {n: _key_rows(df) for n, df in runs.gold_tables(spark, scratch).items()} == after
    mart = runs.run_load(spark, scratch, R.AS_OF)
    rep = runs.run_reports(mart)
    assert _same(rep["popular_products_report"], R.q_report_popular_products(spark, SF_SMALL))
    assert _same(rep["last_year_orders_report"], R.q_report_last_year_orders(spark, SF_SMALL))
    assert _same(rep["order_devices_report"], R.q_report_order_devices(spark, SF_SMALL))


@pytest.mark.parametrize("failing", ["products", "publish"])
def test_a_run_that_fails_after_the_devices_merge_leaves_all_tables_at_the_old_run(spark, scratch, monkeypatch, failing):
    from weblake.sinks import tables as T
    early, now = R.fixture_sources(spark, SF_SMALL, early=True), R.fixture_sources(spark, SF_SMALL)
    runs.run_transform(spark, early, scratch, R.RUN_SNAPSHOT, is_historical=True)
    before = {n: _key_rows(df) for n, df in runs.gold_tables(spark, scratch).items()}
    merge, publish, merged = T.Run.merge, T.Run.publish, []

    def broken_merge(run, name, *args, **kwargs):
        if name == failing:
            raise RuntimeError("lost")
        merged.append(name)
        return merge(run, name, *args, **kwargs)

    def broken_publish(run):
        raise RuntimeError("lost")

    monkeypatch.setattr(T.Run, "merge", broken_merge)
    monkeypatch.setattr(T.Run, "publish", broken_publish if failing == "publish" else publish)
    run = lambda: runs.run_transform(spark, now, scratch, R.RUN_INCREMENTAL_AS_OF, is_historical=False, logs_month=R.RUN_LOGS_MONTH)
    with pytest.raises(RuntimeError, match="lost"):
        run()
    assert merged[:2] == ["sales", "devices"]
    assert {n: _key_rows(df) for n, df in runs.gold_tables(spark, scratch).items()} == before
    monkeypatch.setattr(T.Run, "merge", merge)
    monkeypatch.setattr(T.Run, "publish", publish)
    run()   # the retry
    after = runs.gold_tables(spark, scratch)
    assert _same(after["devices"], R.q_order_devices(spark, SF_SMALL)) and _same(after["products"], R.q_product_visits(spark, SF_SMALL))


def test_mart_load_over_jdbc(spark, scratch):
    root = os.path.join(scratch, "gold")
    R.run_fixture_history(spark, SF_SMALL, root)
    url = f"jdbc:derby:{os.path.join(scratch, 'mart')};create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    mart = runs.run_load(spark, root, R.AS_OF, mart_url=url, mart_properties=props)
    back = spark.read.jdbc(url, "last_year_orders", properties=props)
    assert back.count() == mart["last_year_orders"].count()
    report = reports.report_last_year_orders(back.withColumn("orderDate", F.col("orderDate").cast("timestamp_ntz")))
    assert _same(report, R.q_report_last_year_orders(spark, SF_SMALL))


def test_streaming_ingest_matches_batch(spark, scratch):
    fx = Fixture(spark, SF_SMALL)
    landing = os.path.join(scratch, "landing")
    gold = os.path.join(scratch, "gold")
    ckpt = os.path.join(scratch, "stream-ckpt")
    logs = fx.landing_weblogs()
    ranges, products = fx.ipsrangelist(), fx.products()
    first = logs.filter(F.col("date") < "2024-01-15").drop("year", "month")
    second = logs.filter(F.col("date") >= "2024-01-15").drop("year", "month")
    append_text_lines(W.render_weblog_lines(first), landing, ["year", "month"])
    q = start_weblog_ingest(spark, landing, gold, ranges, products, ckpt)
    q.awaitTermination(300)
    append_text_lines(W.render_weblog_lines(second), landing, ["year", "month"])
    q = start_weblog_ingest(spark, landing, gold, ranges, products, ckpt)
    q.awaitTermination(300)
    assert q.exception() is None
    from weblake.sinks.tables import current, read_table
    g = {"devices": read_table(spark, gold, "devices"), "products": read_table(spark, gold, "products")}
    assert current(spark, gold)["run"] == 2   # one visible step per micro-batch, for both tables
    batch_logs = read_weblogs(spark, landing)
    assert _same(g["devices"], W.order_devices(W.enrich_weblogs(batch_logs, ranges)))
    assert _same(g["products"], R.q_product_visits(spark, SF_SMALL))


def test_auto_mode_picks_historical_then_incremental(spark, scratch):
    from weblake.plans.sales import orders_snapshot
    fx = Fixture(spark, SF_SMALL)
    root = os.path.join(scratch, "gold")
    snap = orders_snapshot(fx.orders(), "2001-01-01")
    early = runs.Sources(orders=snap, orderitems=fx.orderitems().join(snap.select("OrderId"), "OrderId", "left_semi"),
                             catalog=fx.catalog(), products=fx.products(), ipsrangelist=fx.ipsrangelist(),
                             weblogs=fx.landing_weblogs().filter(F.col("date") < "2024-01-20"))
    runs.run_transform(spark, early, root, "2001-01-01")          # no table yet: historical
    now = runs.Sources(orders=fx.orders(), orderitems=fx.orderitems(), catalog=fx.catalog(),
                           products=fx.products(), ipsrangelist=fx.ipsrangelist(), weblogs=fx.landing_weblogs())
    runs.run_transform(spark, now, root, "2001-01-15", logs_month="2024-01-01")  # table exists: incremental
    g = runs.gold_tables(spark, root)
    assert _same(g["sales"], R.q_sales_fact(spark, SF_SMALL))
    assert _same(g["products"], R.q_product_visits(spark, SF_SMALL))


def test_year_month_of(spark):
    from weblake.functions.dates import year_month_of
    y, m = year_month_of(F.lit("2022-10-03"))
    r = spark.range(1).select(y.alias("y"), m.alias("m")).first()
    assert (r.y, r.m) == ("2022", "10")
