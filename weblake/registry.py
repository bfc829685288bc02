"""Registered queries (Spark) and their DuckDB oracles, keyed alike.

Each query reads the driver tables of one scale-factor folder, in full.
Parameters that select a time slice are the features themselves (the
incremental month, the last-year report, a run's snapshot date).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle_sql as O
from . import schemas
from .functions.dates import month_text, year_month_of, year_text
from .functions.ip import ip_to_long, long_to_ip, range_end_text, range_start_text
from .functions.text import page_type
from .operators import quality as Q
from .operators.serial import positional_join
from .plans import calendar, catalog, order_logs, reports, runs, sales, weblogs
from .session import stage, work_path
from .sinks.tables import define_table, gold_run, merge_into, read_table
from .sources.fixtures import FIXTURE_SITE, FIXTURE_USER_AGENTS
from .sources.fixtures import Fixture
from .sources.logs import read_weblogs

# Run parameters of the registered queries (orders span 1995-01 .. 2001-08,
# events span January 2024).
AS_OF = "2001-06-01"            # last year = 2000; incremental month = 2001-06
SALES_SNAPSHOT = "2001-01-01"   # the gold sales table as loaded before this date
SALES_BATCH_AS_OF = "2000-12-15"  # next incremental run: orders from 2000-12-01 on
LOGS_OLD_BEFORE = "2024-01-20"  # logs processed by the earlier run
LOGS_NEW_FROM = "2024-01-10"    # logs processed by the later run (overlap = re-sent logs)


def _enriched(fx: Fixture, date_filter=None, mode: str = "exact") -> DataFrame:
    logs = fx.weblogs()
    if date_filter is not None:
        logs = logs.filter(date_filter)
    return weblogs.enrich_weblogs(logs, fx.ipsrangelist(), mode=mode)


def _sales_full(fx: Fixture) -> DataFrame:
    return sales.sales_fact(fx.orderitems(), fx.orders(), fx.catalog())


def _sales_snapshot(fx: Fixture) -> DataFrame:
    snap = sales.orders_snapshot(fx.orders(), SALES_SNAPSHOT)
    return sales.sales_fact_for_orders(fx.orderitems(), snap, fx.catalog())


def q_sales_fact(spark, d):
    return _sales_full(Fixture(spark, d))


def q_sales_fact_incremental(spark, d):
    fx = Fixture(spark, d)
    return sales.sales_fact_incremental(fx.orderitems(), fx.orders(), fx.catalog(), AS_OF)


def q_sales_fact_incremental_min_id(spark, d):
    fx = Fixture(spark, d)
    return sales.sales_fact_incremental(fx.orderitems(), fx.orders(), fx.catalog(), AS_OF,
                                        item_selection="min_id")


def q_order_id_bounds(spark, d):
    return sales.order_id_bounds(Fixture(spark, d).orders(), AS_OF)


# The upsert queries stage their two inputs first, as a transform run has them:
# the current table stored, the batch materialised once. The batches really change
# what they match: new prices, devices and names, moved dates (and so partitions),
# and null keys; some target rows occur twice, and both are updated.

def _twice(current: DataFrame, key: str) -> DataFrame:
    return current.unionByName(current.filter(F.col(key) % 5 == 0))


def _lost(key: str, of: str | None = None):
    """The key column, null in one row of 13."""
    return F.when(F.col(of or key) % 13 != 0, F.col(key)).alias(key)


def q_sales_upsert(spark, d):
    fx = Fixture(spark, d)
    batch = sales.sales_fact_incremental(fx.orderitems(), fx.orders(), fx.catalog(), SALES_BATCH_AS_OF)
    moved = F.when(F.col("orderItemId") % 7 == 0, F.col("orderDate") + F.expr("interval 40 days")).otherwise(F.col("orderDate"))
    batch = batch.select(_lost("orderItemId"), "orderId", (F.col("price") + 1).alias("price"), moved.alias("orderDate"),
                         year_text(moved).alias("year_partition"), month_text(moved).alias("month_partition"))
    return sales.sales_upsert(stage(_twice(_sales_snapshot(fx), "orderItemId"), "current-sales"), stage(batch, "sales-batch"))


def q_weblogs_enriched(spark, d):
    return _enriched(Fixture(spark, d))


def q_weblogs_enriched_by_host(spark, d):
    """Enriched logs the way a range table too large to broadcast is joined: distinct hosts probe, log rows
    join their host's ranges. The ranges here are the nations' and wider ones around them, so several
    block sizes are in use and ranges overlap."""
    fx = Fixture(spark, d)
    return weblogs.enrich_weblogs(fx.weblogs(), fx.nested_ranges(), probe_rows=0)


def q_weblogs_enriched_two_octet(spark, d):
    return _enriched(Fixture(spark, d), mode="two_octet")


def q_order_devices(spark, d):
    return weblogs.order_devices(_enriched(Fixture(spark, d)))


def q_devices_upsert(spark, d):
    fx = Fixture(spark, d)
    old = weblogs.order_devices(_enriched(fx, F.col("date") < LOGS_OLD_BEFORE))
    new = weblogs.order_devices(_enriched(fx, F.col("date") >= LOGS_NEW_FROM))
    new = new.select("Username", "VisitedAt", _lost("OrderId"), F.concat("Device", F.lit(" v2")).alias("Device"))
    return weblogs.devices_upsert(stage(_twice(old, "OrderId"), "current-devices"), stage(new, "devices-batch"))


def q_product_visits(spark, d):
    fx = Fixture(spark, d)
    return weblogs.product_visits(_enriched(fx), fx.products())


def q_products_upsert(spark, d):
    fx = Fixture(spark, d)
    old = weblogs.product_visits(_enriched(fx, F.col("date") < LOGS_OLD_BEFORE), fx.products())
    new = weblogs.product_visits(_enriched(fx, F.col("date") >= LOGS_NEW_FROM), fx.products())
    new = new.select(_lost("HostIp", "ProductId"), "Country", "VisitedAt", "ProductId", F.concat("ProductName", F.lit(" (new)")).alias("ProductName"))
    return weblogs.products_upsert(stage(_twice(old, "ProductId"), "current-products"), stage(new, "products-batch"))


def q_last_year_orders(spark, d):
    """Last year's rows of the stored sales table: one year's folders are scanned."""
    root = work_path(spark, "gold")
    with gold_run(spark, root) as run:
        run.replace("sales", _sales_full(Fixture(spark, d)), schemas.SALES, runs.sales_partitions())
    return reports.last_year_orders(read_table(spark, root, "sales"), AS_OF)


def q_report_last_year_orders(spark, d):
    return reports.report_last_year_orders(q_last_year_orders(spark, d))


def q_report_order_devices(spark, d):
    return reports.report_order_devices(q_order_devices(spark, d))


def q_report_popular_products(spark, d):
    return reports.report_popular_products(q_product_visits(spark, d))


CATALOG_SEED = 42


def _catalog_inputs(fx: Fixture):
    companies = stage(fx.price_list_companies(CATALOG_SEED), "price-list-companies")   # a row a company, read for suppliers and for buyers
    return fx.product_prices(), companies.filter("IsSupplier"), companies


def q_supplier_price_list(spark, d):
    products, suppliers, _ = _catalog_inputs(Fixture(spark, d))
    return catalog.supplier_price_list(products, suppliers, CATALOG_SEED)


def q_company_price_list(spark, d):
    products, suppliers, companies = _catalog_inputs(Fixture(spark, d))
    offers = stage(catalog.supplier_price_list(products, suppliers, CATALOG_SEED), "supplier-price-list")
    return catalog.company_price_list(offers, companies.filter(~F.col("IsSupplier")), CATALOG_SEED)


def q_catalog_build(spark, d):
    fx = Fixture(spark, d)
    products, _, companies = _catalog_inputs(fx)
    return catalog.catalog_build(fx.catalog(), products, companies, CATALOG_SEED)


def q_supplier_offers(spark, d):
    fx = Fixture(spark, d)
    return catalog.supplier_offers(fx.catalog(), fx.companies())


LOG_SEED = 7


def q_order_log_lines(spark, d):
    fx = Fixture(spark, d)
    return order_logs.order_log_lines(fx.order_context(), order_logs.order_products(fx.orderitems(), fx.catalog()),
                                      FIXTURE_SITE, LOG_SEED)


def q_order_products(spark, d):
    fx = Fixture(spark, d)
    return order_logs.order_products(fx.orderitems(), fx.catalog())


def q_weblog_lines(spark, d):
    return weblogs.render_weblog_lines(Fixture(spark, d).weblogs())


def q_ip_codec(spark, d):
    logs = Fixture(spark, d).weblogs()
    ip = ip_to_long("host")
    return logs.select("host", ip.alias("ip"), long_to_ip(ip).alias("host_back"),
                       F.shiftright(ip, 16).alias("block"))


def q_ip_ranges(spark, d):
    r = Fixture(spark, d).ipsrangelist()
    return r.select("country", "iprange", range_start_text("iprange").alias("start_text"),
                    range_end_text("iprange").alias("end_text"),
                    ip_to_long(range_start_text("iprange")).alias("lo"),
                    ip_to_long(range_end_text("iprange")).alias("hi"))


def q_run_calendar(spark, d):
    return calendar.run_calendar(Fixture(spark, d).orders(), "OrderDate")


def q_company_ids_by_role(spark, d):
    c = Fixture(spark, d).companies()
    return c.select("IsSupplier", "CompanyId").distinct().orderBy("IsSupplier", "CompanyId")


def q_quality_report(spark, d):
    fx = Fixture(spark, d)
    cu, pr, co, ca, od, oi, ip = (fx.customers(), fx.products(), fx.companies(), fx.catalog(), fx.orders(),
                                  stage(fx.orderitems(), "orderitems"), fx.ipsrangelist())
    return Q.report([
        Q.unique_check("pk.lineitem", fx.table("lineitem"), ["l_orderkey", "l_linenumber"]),   # finds repeated keys
        Q.table_check("pk.customers", cu, ["CustomerId"], "nn.customers", ["CustomerName"]),
        Q.table_check("pk.products", pr, ["ProductId"], "nn.products", ["ProductName"]),
        Q.table_check("pk.companies", co, ["CompanyId"], "nn.companies", ["CompanyName", "IsSupplier"]),
        Q.table_check("pk.catalog", ca, ["CatalogId"], "nn.catalog", ["ProductId", "CompanyId", "Price"]),
        Q.table_check("pk.orders", od, ["OrderId"], "nn.orders", ["CustomerId", "OrderDate"]),
        Q.table_check("pk.orderitems", oi, ["OrderItemId"], "nn.orderitems", ["OrderId", "CatalogId"]),
        Q.unique_check("uq.catalog.company_product", ca, ["CompanyId", "ProductId"]),
        Q.not_null_check("nn.ipsrangelist", ip, ["country", "iprange"]),
        Q.reference_checks([
            ("fk.catalog.product", ca, "ProductId", pr, "ProductId"),
            ("fk.catalog.company", ca, "CompanyId", co, "CompanyId"),
            ("fk.catalog.supplier", ca, "SupplierId", co, "CompanyId"),
            ("fk.orders.customer", od, "CustomerId", cu, "CustomerId"),
            ("fk.orderitems.order", oi, "OrderId", od, "OrderId"),
            ("fk.orderitems.catalog", oi, "CatalogId", ca, "CatalogId"),
        ]),
    ])


RUN_SNAPSHOT = "2001-03-01"           # what the historical run sees: orders placed before, some dated later than now
RUN_INCREMENTAL_AS_OF = "2001-01-15"  # next monthly run: orders from 2001-01-01 on
RUN_LOGS_MONTH = "2024-01-01"         # and the January landing folder


def fixture_sources(spark, d, early: bool = False) -> runs.Sources:
    """The sources as they are, or as they stood at the earlier run: fewer orders and logs, some orders of
    the incremental months dated 20 days later, other prices, product names and user agents."""
    fx = Fixture(spark, d)
    orders, items, catalog_, products, logs = fx.orders(), fx.orderitems(), fx.catalog(), fx.products(), fx.landing_weblogs()
    if early:
        moved = (F.col("OrderId") % 5 == 0) & (F.col("OrderDate") >= F.lit(f"{RUN_INCREMENTAL_AS_OF[:8]}01").cast("timestamp_ntz"))
        orders = sales.orders_snapshot(orders, RUN_SNAPSHOT).withColumn(
            "OrderDate", F.when(moved, F.col("OrderDate") + F.expr("interval 20 days")).otherwise(F.col("OrderDate")))
        items = items.join(orders.select("OrderId"), "OrderId", "left_semi")
        catalog_ = catalog_.withColumn("Price", F.when(F.col("CatalogId") % 3 == 0, F.col("Price") - 1).otherwise(F.col("Price")))
        products = products.withColumn("ProductName", F.concat("ProductName", F.lit(" (old)")))
        logs = logs.filter(F.col("date") < LOGS_OLD_BEFORE).withColumn("useragent", F.concat(F.lit("Old/1.0 (before) "), "useragent"))
    return runs.Sources(orders=orders, orderitems=items, catalog=catalog_, products=products, ipsrangelist=fx.ipsrangelist(), weblogs=logs)


def run_fixture_history(spark, d, gold_root: str, tables=tuple(runs.GOLD)) -> None:
    """A historical run over the sources as they stood earlier, then an
    incremental run over the current sources, which changes values, moves rows to other months and adds rows."""
    runs.run_transform(spark, fixture_sources(spark, d, early=True), gold_root, RUN_SNAPSHOT, is_historical=True, tables=tables)
    runs.run_transform(spark, fixture_sources(spark, d), gold_root, RUN_INCREMENTAL_AS_OF, is_historical=False,
                       logs_month=RUN_LOGS_MONTH, tables=tables)


def _run(spark, d, tables=tuple(runs.GOLD)) -> str:
    """The gold root after both runs."""
    root = work_path(spark, "runs")
    run_fixture_history(spark, d, root, tables)
    return root


def q_transform_load_run(spark, d):
    """The sales table after a historical and an incremental run of all three tables."""
    return runs.gold_tables(spark, _run(spark, d))["sales"]


def q_run_devices(spark, d):
    """The devices table after both runs (of this table alone)."""
    return runs.gold_tables(spark, _run(spark, d, ("devices",)))["devices"]


def q_run_products(spark, d):
    """The product visits after both runs (of this table alone)."""
    return runs.gold_tables(spark, _run(spark, d, ("products",)))["products"]


def q_run_reports(spark, d):
    """The run's three reports, read from their views over the loaded mart."""
    from .sinks import views
    database = f"mart_{uuid.uuid4().hex}"
    made = views.load_mart(spark, runs.run_load(spark, _run(spark, d), AS_OF), database, work_path(spark, "mart"))
    parts = [made["last_year_orders_report"].select(F.lit("last_year_orders").alias("report"), F.col("lastYear").alias("k1"), F.col("month").alias("k2"), F.col("qttOrders").alias("n")),
             made["order_devices_report"].select(F.lit("order_devices"), "Device", F.lit(None).cast("string"), "qttOrders"),
             made["popular_products_report"].select(F.lit("popular_products"), "Country", "ProductName", "qttLogs")]
    views.drop_mart(spark, database)   # the frames are resolved: they read the mart's files
    return parts[0].union(parts[1]).union(parts[2])


def q_conditional_merge(spark, d):
    """A stored merge on key and condition: an order's device is replaced by a later visit only; earlier visits
    of a known order do not match it and are added. An order may come twice, as long as one visit is later."""
    fx, root = Fixture(spark, d), work_path(spark, "gold")
    old = weblogs.order_devices(_enriched(fx, F.col("date") < LOGS_OLD_BEFORE))
    merge_into(spark, root, "devices", old, schemas.DEVICES_KEYS, schemas.DEVICES, runs.visit_partitions())
    new = weblogs.order_devices(_enriched(fx, F.col("date") >= LOGS_NEW_FROM))
    shift = {"later": F.expr("interval 25 days"), "earlier": F.expr("interval -1 day")}   # 25 days: mostly another month
    batch = [new.select("Username", (F.col("VisitedAt") + by).alias("VisitedAt"), "OrderId", F.concat("Device", F.lit(f" {name}")).alias("Device"))
             for name, by in shift.items()]
    batch = batch[0].filter("OrderId % 3 <> 0").unionByName(batch[1].filter("OrderId % 2 = 0"))
    merge_into(spark, root, "devices", batch, "target.OrderId = source.OrderId and source.VisitedAt > target.VisitedAt",
               schemas.DEVICES, runs.visit_partitions())
    return read_table(spark, root, "devices")


def q_defined_table(spark, d):
    """A table defined from a schema document, filled, left alone by a second definition, dropped and
    recreated, filled again; read by its declared schema."""
    fx, root, document = Fixture(spark, d), work_path(spark, "gold"), schemas.DEVICES.json()
    devices = {name: weblogs.order_devices(_enriched(fx, when)) for name, when in
               (("old", F.col("date") < LOGS_OLD_BEFORE), ("new", F.col("date") >= LOGS_NEW_FROM))}
    define_table(spark, root, "devices", document, list(runs.visit_partitions()))
    merge_into(spark, root, "devices", devices["old"], schemas.DEVICES_KEYS, schemas.DEVICES, runs.visit_partitions())
    define_table(spark, root, "devices", document, list(runs.visit_partitions()))
    if not read_table(spark, root, "devices").head(1):
        raise RuntimeError("a table that exists must be left alone")
    define_table(spark, root, "devices", document, list(runs.visit_partitions()), replace=True)
    merge_into(spark, root, "devices", devices["new"], schemas.DEVICES_KEYS, schemas.DEVICES, runs.visit_partitions())
    return read_table(spark, root, "devices")


def q_reports_from_states(spark, d):
    """The three reports from states of distinct values: built by month of sales and day of visits, those of the
    periods that arrive again replaced, the rest kept."""
    fx, root = Fixture(spark, d), work_path(spark, "gold")
    whole = _sales_full(fx)
    old_orders = F.col("orderDate") < F.lit(SALES_SNAPSHOT).cast("timestamp_ntz")
    again = F.col("orderDate") >= F.lit(f"{SALES_BATCH_AS_OF[:8]}01").cast("timestamp_ntz")
    enriched = stage(_enriched(fx), "enriched-logs")
    devices, visits = weblogs.order_devices(enriched), weblogs.product_visits(enriched, fx.products())
    before, since = F.col("VisitedAt") < LOGS_OLD_BEFORE, F.col("VisitedAt") >= LOGS_NEW_FROM
    with gold_run(spark, root) as run:   # the first load; what arrives again later is only half there
        reports.refresh_states(run, whole.filter(old_orders & (~again | (F.col("orderId") % 2 == 0))), devices.filter(before), visits.filter(before))
    with gold_run(spark, root) as run:
        reports.refresh_states(run, whole.filter(again), devices.filter(since), visits.filter(since))
    made = reports.reports_from_states(*[read_table(spark, root, t, keep_partitions=True) for t in reports.STATE_TABLES], AS_OF)
    parts = [made["last_year_orders_report"].select(F.lit("last_year_orders").alias("report"), F.col("lastYear").alias("k1"), F.col("month").alias("k2"), F.col("qttOrders").alias("n")),
             made["order_devices_report"].select(F.lit("order_devices"), "Device", F.lit(None).cast("string"), "qttOrders"),
             made["popular_products_report"].select(F.lit("popular_products"), "Country", "ProductName", "qttLogs")]
    return parts[0].union(parts[1]).union(parts[2])


def q_quality_after_batch(spark, d):
    """Violations after a batch (new orders, their items, line items taken back), from the report before it and
    the key values that the batch touches."""
    fx = Fixture(spark, d)
    orders, items, lines = fx.orders(), fx.orderitems(), fx.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    early, late = orders.filter(F.col("OrderDate") < SALES_SNAPSHOT), orders.filter(F.col("OrderDate") >= SALES_SNAPSHOT)
    early_items, late_items = items.filter("OrderItemId % 10 < 5"), items.filter("OrderItemId % 10 >= 5")   # children before their parents
    taken = lines.filter("l_quantity = 1")
    keys = ["l_orderkey", "l_linenumber"]
    line_state, item_state, order_state = (stage(Q.key_state(df, k), "keys") for df, k in ((lines, keys), (early_items, ["OrderId"]), (early, ["OrderId"])))
    catalog_state = Q.key_state(fx.catalog(), ["CatalogId"])
    before = Q.report([Q.unique_check("pk.lineitem", lines, keys), Q.unique_check("pk.orders", early, ["OrderId"]),
                       Q.reference_checks([("fk.orderitems.order", early_items, "OrderId", early, "OrderId"),
                                           ("fk.orderitems.catalog", early_items, "CatalogId", fx.catalog(), "CatalogId")])])
    item_change, order_change = Q.signed_keys(late_items, None, ["OrderId"]), stage(Q.signed_keys(late, None, ["OrderId"]), "keys")
    no_catalog = Q.signed_keys(fx.catalog().limit(0), None, ["CatalogId"])
    return Q.report_after(before, [
        Q.unique_change("pk.lineitem", line_state, Q.signed_keys(None, taken, keys)),
        Q.unique_change("pk.orders", order_state, order_change),
        Q.reference_change("fk.orderitems.order", item_state, item_change, order_state, order_change),
        Q.reference_change("fk.orderitems.catalog", Q.key_state(early_items, ["CatalogId"]), Q.signed_keys(late_items, None, ["CatalogId"]), catalog_state, no_catalog)])


LANDING_MONTH = (2000, 6)


def _landing(spark, d) -> str:
    """Order and visit log lines together as landing text under year= and month= folders."""
    from .sinks.tables import append_text_lines
    path = work_path(spark, "landing")
    append_text_lines(q_order_log_lines(spark, d).unionByName(q_weblog_lines(spark, d)), path, ["year", "month"])
    return path


def q_landing_logs(spark, d):
    """Lines, hosts and page types of every landing month, read back from text."""
    logs = read_weblogs(spark, _landing(spark, d)).withColumn("page", page_type("referer"))
    return logs.groupBy("year", "month", "page").agg(F.count(F.lit(1)).alias("lines"), F.count_distinct("host").alias("hosts"))


def q_landing_logs_month(spark, d):
    """One month's log rows: only that folder is read."""
    logs = read_weblogs(spark, _landing(spark, d), *LANDING_MONTH)
    return logs.select("host", "username", "date", "time", "referer", "useragent", "year", "month")


def q_positional_join(spark, d):
    """The i-th customer with the i-th product, as far as both reach."""
    fx = Fixture(spark, d)
    return positional_join(fx.customers(), fx.products(), ["CustomerId"], ["ProductId"])


def q_domain_csv(spark, d):
    """Companies written as CSV files in the order of their ids and imported with serial ids in file order: many
    files, many tasks, the numbers of one file."""
    from .sources.files import read_domain_csv
    path = work_path(spark, "companies")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = Fixture(spark, d).companies().repartitionByRange(parts, "CompanyId").sortWithinPartitions("CompanyId")
    rows.select("CompanyName", "IsSupplier").write.csv(path)
    return read_domain_csv(spark, path, "CompanyName string, IsSupplier boolean", key="Id")


def q_order_months(spark, d):
    """Orders by the year and month texts of their date text."""
    year, month = year_month_of(F.date_format("OrderDate", "yyyy-MM-dd"))
    return (Fixture(spark, d).orders().select(year.alias("year"), month.alias("month"))
            .groupBy("year", "month").agg(F.count(F.lit(1)).alias("orders")))


def q_stream_ingest(spark, d):
    """Landing logs written as text, ingested by the file stream (two arrivals),
    merged into the gold product-visit table; returns that table."""
    from .sinks.tables import append_text_lines
    from .streaming.weblog_ingest import start_weblog_ingest
    fx = Fixture(spark, d)
    base = work_path(spark, "stream")
    logs = fx.landing_weblogs().drop("year", "month")
    for arrival in (F.col("date") < LOGS_OLD_BEFORE, F.col("date") >= LOGS_OLD_BEFORE):
        append_text_lines(weblogs.render_weblog_lines(logs.filter(arrival)), f"{base}/landing", ["year", "month"])
        q = start_weblog_ingest(spark, f"{base}/landing", f"{base}/gold", fx.ipsrangelist(), fx.products(),
                                f"{base}/checkpoint")
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return read_table(spark, f"{base}/gold", "products")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "sales_fact": q_sales_fact,
    "sales_fact_incremental": q_sales_fact_incremental,
    "sales_fact_incremental_min_id": q_sales_fact_incremental_min_id,
    "order_id_bounds": q_order_id_bounds,
    "sales_upsert": q_sales_upsert,
    "weblogs_enriched": q_weblogs_enriched,
    "weblogs_enriched_by_host": q_weblogs_enriched_by_host,
    "weblogs_enriched_two_octet": q_weblogs_enriched_two_octet,
    "order_devices": q_order_devices,
    "devices_upsert": q_devices_upsert,
    "product_visits": q_product_visits,
    "products_upsert": q_products_upsert,
    "last_year_orders": q_last_year_orders,
    "report_last_year_orders": q_report_last_year_orders,
    "report_order_devices": q_report_order_devices,
    "report_popular_products": q_report_popular_products,
    "supplier_price_list": q_supplier_price_list,
    "company_price_list": q_company_price_list,
    "catalog_build": q_catalog_build,
    "supplier_offers": q_supplier_offers,
    "order_products": q_order_products,
    "order_log_lines": q_order_log_lines,
    "weblog_lines": q_weblog_lines,
    "ip_codec": q_ip_codec,
    "ip_ranges": q_ip_ranges,
    "run_calendar": q_run_calendar,
    "company_ids_by_role": q_company_ids_by_role,
    "quality_report": q_quality_report,
    "transform_load_run": q_transform_load_run,
    "run_devices": q_run_devices,
    "run_products": q_run_products,
    "run_reports": q_run_reports,
    "conditional_merge": q_conditional_merge,
    "defined_table": q_defined_table,
    "reports_from_states": q_reports_from_states,
    "quality_after_batch": q_quality_after_batch,
    "landing_logs": q_landing_logs,
    "landing_logs_month": q_landing_logs_month,
    "positional_join": q_positional_join,
    "domain_csv": q_domain_csv,
    "order_months": q_order_months,
    "stream_ingest": q_stream_ingest,
}

# Queries without an exact SQL oracle (checked by row count and by tests).
ROWS_ONLY: dict[str, str] = {}

# ---------------------------------------------------------------- oracles

_INC = f"select * from src_orders where OrderDate >= timestamp '{AS_OF[:8]}01'"
_SNAP = f"select * from src_orders where OrderDate < timestamp '{SALES_SNAPSHOT}'"
_BATCH = f"select * from src_orders where OrderDate >= timestamp '{SALES_BATCH_AS_OF[:8]}01'"
_LAST_YEAR = f"select * from sales where year_partition = '{int(AS_OF[:4]) - 1}'"
_ENRICHED = [("bounds", O.RANGE_BOUNDS)] + O.enriched_ctes()
_OLD_NEW = ([("bounds", O.RANGE_BOUNDS),
             ("logs_old", f"select * from src_weblogs where date < '{LOGS_OLD_BEFORE}'"),
             ("logs_new", f"select * from src_weblogs where date >= '{LOGS_NEW_FROM}'")]
            + O.enriched_ctes("enr_old", "logs_old") + O.enriched_ctes("enr_new", "logs_new"))
_TWO_OCTET = f"""select p.HostIp, r.country as Country, p.Username, p.VisitedAt, p.PageType, p.Id, p.Device,
  p.year_partition, p.month_partition
from (select *, split_part(HostIp, '.', 1) || split_part(HostIp, '.', 2) as k from parsed0) p
join (select country, split_part(iprange, '.', 1) || split_part(iprange, '.', 2) as k,
             {O.ip_sql(O.range_start_sql('iprange'))} as lo, {O.ip_sql(O.range_end_sql('iprange'))} as hi
      from (select distinct country, iprange from src_ipsrangelist)) r
  on p.k = r.k and p.ip between r.lo and r.hi"""



def _twice_sql(cte: str, key: str) -> str:
    return f"select * from {cte} union all select * from {cte} where {key} % 5 = 0"


_REPORT_LAST_YEAR = """select strftime(orderDate, '%Y') as lastYear, strftime(orderDate, '%m') as month,
  count(distinct orderId) as qttOrders from ly group by 1, 2"""
_REPORT_DEVICES = """select Device, qttOrders from (select Device, count(distinct OrderId) as qttOrders,
  row_number() over (order by count(distinct OrderId) desc, Device) as place from dev group by Device) where place <= 5"""
_REPORT_PRODUCTS = """select Country, ProductName, qttLogs from (
  select pv.Country, ProductName, count(distinct pv.HostIp) as qttLogs, any_value(c.place) as place from pv
  join (select Country, row_number() over (order by count(distinct HostIp) desc, Country) as place from pv group by Country) c
    on c.Country = pv.Country group by pv.Country, ProductName) where place = 1"""

_THREE_REPORTS = f"""select 'last_year_orders' as report, lastYear as k1, month as k2, qttOrders as n from ({_REPORT_LAST_YEAR})
union all select 'order_devices', Device, null, qttOrders from ({_REPORT_DEVICES})
union all select 'popular_products', Country, ProductName, qttLogs from ({_REPORT_PRODUCTS})"""

ORACLES: dict[str, str] = {
    "sales_fact": O.with_views([], O.sales_sql()),
    "sales_fact_incremental": O.with_views([("recent", _INC)], O.sales_sql("recent", "inner")),
    "sales_fact_incremental_min_id": O.with_views(
        [("recent", _INC)],
        O.sales_sql("recent", "left", "where i.OrderId >= (select min(OrderId) from recent)")),
    "order_id_bounds": O.with_views(
        [("recent", _INC)], "select min(OrderId) as minOrderId, max(OrderId) as maxOrderId from recent"),
    "sales_upsert": O.with_views(
        [("snap", _SNAP), ("batch_orders", _BATCH),
         ("tgt0", O.sales_sql("snap", "inner")), ("tgt", _twice_sql("tgt0", "orderItemId")),
         ("src0", "select *, case when orderItemId % 7 = 0 then orderDate + interval 40 day else orderDate end as moved from ("
                  + O.sales_sql("batch_orders", "inner") + ")"),
         ("src", """select case when orderItemId % 13 <> 0 then orderItemId end as orderItemId, orderId, price + 1 as price, moved as orderDate,
             strftime(moved, '%Y') as year_partition, strftime(moved, '%m') as month_partition from src0""")],
        O.upsert_sql("tgt", "src", ["orderItemId"])),
    "weblogs_enriched": O.with_views(_ENRICHED, "select * from enriched"),
    "weblogs_enriched_by_host": O.with_views(
        [("all_ranges", """select country, iprange from src_ipsrangelist union all
            select n_name || ' and around', concat(n_nationkey * 9 + 8, '.0.0.0-', n_nationkey * 9 + 12, '.255.255.255') from nation union all
            select n_name || ' narrow', concat(n_nationkey * 9 + 10, '.', n_nationkey % 4, '.7.0-', n_nationkey * 9 + 10, '.', n_nationkey % 4, '.9.99') from nation"""),
         ("bounds", O.RANGE_BOUNDS.replace("src_ipsrangelist", "all_ranges"))] + O.enriched_ctes(), "select * from enriched"),
    "weblogs_enriched_two_octet": O.with_views([("parsed0", O.PARSED_LOGS.replace("LOGS", "src_weblogs"))],
                                               _TWO_OCTET),
    "order_devices": O.with_views(_ENRICHED, O.order_devices_sql("enriched")),
    "devices_upsert": O.with_views(
        _OLD_NEW + [("tgt0", O.order_devices_sql("enr_old")), ("tgt", _twice_sql("tgt0", "OrderId")),
                    ("src0", O.order_devices_sql("enr_new")),
                    ("src", """select Username, VisitedAt, case when OrderId % 13 <> 0 then OrderId end as OrderId,
                         Device || ' v2' as Device from src0""")],
        O.upsert_sql("tgt", "src", ["OrderId"])),
    "product_visits": O.with_views(_ENRICHED, O.product_visits_sql("enriched")),
    "products_upsert": O.with_views(
        _OLD_NEW + [("tgt0", O.product_visits_sql("enr_old")), ("tgt", _twice_sql("tgt0", "ProductId")),
                    ("src0", O.product_visits_sql("enr_new")),
                    ("src", """select case when ProductId % 13 <> 0 then HostIp end as HostIp, Country, VisitedAt, ProductId,
                         ProductName || ' (new)' as ProductName from src0""")],
        O.upsert_sql("tgt", "src", ["HostIp", "VisitedAt", "ProductId"])),
    "last_year_orders": O.with_views([("sales", O.sales_sql())], _LAST_YEAR),
    "report_last_year_orders": O.with_views(
        [("sales", O.sales_sql()), ("ly", _LAST_YEAR)],
        _REPORT_LAST_YEAR + " order by 2"),
    "report_order_devices": O.with_views(
        _ENRICHED + [("dev", O.order_devices_sql("enriched"))],
        _REPORT_DEVICES),
    "report_popular_products": O.with_views(
        _ENRICHED + [("pv", O.product_visits_sql("enriched"))],
        _REPORT_PRODUCTS),
}

_CAT = O.catalog_ctes(CATALOG_SEED)
ORACLES.update({
    "supplier_price_list": O.with_views(_CAT, "select * from sup_rows"),
    "company_price_list": O.with_views(_CAT, "select * from com_rows"),
    "catalog_build": O.with_views(_CAT, "select * from catalog_out"),
    "supplier_offers": O.with_views([], """select c.ProductId, c.CompanyId as SupplierId, c.Price from src_catalog c
where c.CompanyId in (select CompanyId from src_companies where IsSupplier)"""),
})


def _q_unique(name, table, keys):
    k = ", ".join(keys)
    nn = " and ".join(f"{c} is not null" for c in keys)
    return (f"select '{name}' as check_name, count(*) as violations from "
            f"(select {k} from {table} where {nn} group by {k} having count(*) > 1)")


def _q_ref(name, child, fk, parent, pk):
    return (f"select '{name}' as check_name, count(*) as violations from {child} c "
            f"where c.{fk} is not null and not exists (select 1 from {parent} p where p.{pk} = c.{fk})")


def _q_nn(name, table, cols):
    return " union all ".join(f"select '{name}.{c}' as check_name, count(*) filter (where {c} is null) as violations "
                              f"from {table}" for c in cols)


_QUALITY = " union all ".join([
    _q_unique("pk.lineitem", "lineitem", ["l_orderkey", "l_linenumber"]),
    _q_unique("pk.customers", "src_customers", ["CustomerId"]),
    _q_unique("pk.products", "src_products", ["ProductId"]),
    _q_unique("pk.companies", "src_companies", ["CompanyId"]),
    _q_unique("pk.catalog", "src_catalog", ["CatalogId"]),
    _q_unique("pk.orders", "src_orders", ["OrderId"]),
    _q_unique("pk.orderitems", "src_orderitems", ["OrderItemId"]),
    _q_unique("uq.catalog.company_product", "src_catalog", ["CompanyId", "ProductId"]),
    _q_ref("fk.catalog.product", "src_catalog", "ProductId", "src_products", "ProductId"),
    _q_ref("fk.catalog.company", "src_catalog", "CompanyId", "src_companies", "CompanyId"),
    _q_ref("fk.catalog.supplier", "src_catalog", "SupplierId", "src_companies", "CompanyId"),
    _q_ref("fk.orders.customer", "src_orders", "CustomerId", "src_customers", "CustomerId"),
    _q_ref("fk.orderitems.order", "src_orderitems", "OrderId", "src_orders", "OrderId"),
    _q_ref("fk.orderitems.catalog", "src_orderitems", "CatalogId", "src_catalog", "CatalogId"),
    _q_nn("nn.companies", "src_companies", ["CompanyName", "IsSupplier"]),
    _q_nn("nn.products", "src_products", ["ProductName"]),
    _q_nn("nn.customers", "src_customers", ["CustomerName"]),
    _q_nn("nn.catalog", "src_catalog", ["ProductId", "CompanyId", "Price"]),
    _q_nn("nn.orders", "src_orders", ["CustomerId", "OrderDate"]),
    _q_nn("nn.orderitems", "src_orderitems", ["OrderId", "CatalogId"]),
    _q_nn("nn.ipsrangelist", "src_ipsrangelist", ["country", "iprange"]),
])

# the runs: orders of the incremental months as they are now, older ones at the prices of the first run
_RUN_CTES = [("now_orders", f"select * from src_orders where OrderDate >= timestamp '{RUN_INCREMENTAL_AS_OF[:8]}01'"),
             ("old_orders", f"select * from src_orders where OrderDate < timestamp '{RUN_INCREMENTAL_AS_OF[:8]}01'"),
             ("now_sales", O.sales_sql("now_orders", "inner")),
             ("old_sales", "select s.* replace (case when i.CatalogId % 3 = 0 then s.price - 1 else s.price end as price) from ("
              + O.sales_sql("old_orders", "inner") + ") s join src_orderitems i on i.OrderItemId = s.orderItemId")]
_RUN_ROWS = "select * from now_sales union all select * from old_sales"
_RUN_SALES = O.with_views(_RUN_CTES, _RUN_ROWS)

_UAS = "case OrderId % 7 " + " ".join(f"when {i} then '{ua}'" for i, ua in enumerate(FIXTURE_USER_AGENTS)) + " end"
_ORDER_CTX = f"""select o.OrderId, o.OrderDate, c.c_name as CustomerName,
  concat(cast(c.c_nationkey * 9 + 10 as varchar), '.', cast(c.c_nationkey % 4 as varchar), '.',
         cast(o.OrderId % 200 as varchar), '.', cast(o.CustomerId % 256 as varchar)) as HostIp,
  {_UAS.replace('OrderId', 'o.OrderId')} as UserAgent
from src_orders o join customer c on o.CustomerId = c.c_custkey"""
_ORDER_PRODUCTS = """select distinct i.OrderId, c.ProductId from src_orderitems i join src_catalog c on i.CatalogId = c.CatalogId"""


def _log_line_sql(host, user, ts, referer, ua):
    return (f"concat_ws(' ', {host}, '-', {user}, strftime({ts}, '%Y-%m-%d'), strftime({ts}, '%H:%M:%S'), '-', "
            f"'\"200\"', '-', '\"' || {referer} || '\"', '\"' || {ua} || '\"')").replace('\\"', '"')


_VISIT_AT = (f"(o.OrderDate - to_minutes({O.draw_sql(repr(str(LOG_SEED)), "'visit-min'", 'p.OrderId', 'p.ProductId')} % 31)"
             f" - to_seconds({O.draw_sql(repr(str(LOG_SEED)), "'visit-sec'", 'p.OrderId', 'p.ProductId')} % 60))")
_ORDER_LINES = f"""select {_log_line_sql('o.HostIp', "'\"' || lower(replace(o.CustomerName, ' ', '.')) || '\"'", 'v.at',
                                        "'http://shop.example.com/products/' || cast(v.ProductId as varchar)", 'o.UserAgent')} as value,
  cast(year(v.at) as integer) as year, cast(month(v.at) as integer) as month
from (select p.OrderId, p.ProductId, {_VISIT_AT} as at from op p join ctx o on o.OrderId = p.OrderId) v
join ctx o on o.OrderId = v.OrderId
union all
select {_log_line_sql('o.HostIp', "lower(replace(o.CustomerName, ' ', '.'))", 'o.OrderDate',
                      "'http://shop.example.com/orders/' || cast(o.OrderId as varchar)", 'o.UserAgent')} as value,
  cast(year(o.OrderDate) as integer) as year, cast(month(o.OrderDate) as integer) as month
from ctx o"""

ORACLES.update({
    "order_products": O.with_views([], _ORDER_PRODUCTS),
    "order_log_lines": O.with_views([("ctx", _ORDER_CTX), ("op", _ORDER_PRODUCTS)], _ORDER_LINES),
    "weblog_lines": O.with_views([], f"""select {_log_line_sql('host', 'username', "strptime(date || ' ' || time, '%Y-%m-%d %H:%M:%S')",
                                                              'referer', 'useragent')} as value,
  cast(year(cast(date as date)) as integer) as year, cast(month(cast(date as date)) as integer) as month from src_weblogs"""),
    "ip_codec": O.with_views([], f"""select host, {O.ip_sql('host')} as ip,
  case when {O.ip_sql('host')} is not null then concat_ws('.', ({O.ip_sql('host')} >> 24) & 255, ({O.ip_sql('host')} >> 16) & 255,
     ({O.ip_sql('host')} >> 8) & 255, {O.ip_sql('host')} & 255) end as host_back,
  {O.ip_sql('host')} >> 16 as block from src_weblogs"""),
    "ip_ranges": O.with_views([], f"""select country, iprange, {O.range_start_sql('iprange')} as start_text,
  {O.range_end_sql('iprange')} as end_text, {O.ip_sql(O.range_start_sql('iprange'))} as lo,
  {O.ip_sql(O.range_end_sql('iprange'))} as hi from src_ipsrangelist"""),
    "run_calendar": O.with_views([], """select cast(m as date) as run_date,
  'year=' || strftime(m, '%Y') || '/month=' || strftime(m, '%m') as folder,
  cast(date_trunc('month', m - interval 1 day) as date) as events_from, cast(m - interval 1 day as date) as events_to,
  cast(year(m) - 1 as varchar) as last_year, cast(m - interval 1 month as date) as previous_month
from (select unnest(generate_series(date_trunc('month', min(OrderDate)), date_trunc('month', max(OrderDate)),
                                    interval 1 month)) as m from src_orders)"""),
    "company_ids_by_role": O.with_views([], "select distinct IsSupplier, CompanyId from src_companies order by 1, 2"),
    "quality_report": O.with_views([], _QUALITY),
    "transform_load_run": _RUN_SALES,
    "conditional_merge": O.with_views(
        _OLD_NEW + [("tgt", O.order_devices_sql("enr_old")), ("new0", O.order_devices_sql("enr_new")),
                    ("src", """select Username, VisitedAt + interval 25 day as VisitedAt, OrderId, Device || ' later' as Device from new0 where OrderId % 3 <> 0
                       union all select Username, VisitedAt - interval 1 day, OrderId, Device || ' earlier' from new0 where OrderId % 2 = 0""")],
        """select case when s.OrderId is not null then s.Username else t.Username end as Username,
             case when s.OrderId is not null then s.VisitedAt else t.VisitedAt end as VisitedAt,
             coalesce(s.OrderId, t.OrderId) as OrderId, case when s.OrderId is not null then s.Device else t.Device end as Device
           from tgt t full join src s on t.OrderId = s.OrderId and s.VisitedAt > t.VisitedAt"""),
    "defined_table": O.with_views(_OLD_NEW, O.order_devices_sql("enr_new")),
    "stream_ingest": O.with_views(_ENRICHED, O.product_visits_sql("enriched")),
    "run_devices": O.with_views(_ENRICHED, O.order_devices_sql("enriched")),
    "run_products": O.with_views(_ENRICHED, O.product_visits_sql("enriched")),
    "run_reports": O.with_views(
        _ENRICHED + _RUN_CTES + [("sales", _RUN_ROWS), ("ly", _LAST_YEAR), ("dev", O.order_devices_sql("enriched")), ("pv", O.product_visits_sql("enriched"))],
        _THREE_REPORTS),
    "reports_from_states": O.with_views(
        _ENRICHED + [("sales", O.sales_sql()), ("ly", _LAST_YEAR), ("dev", O.order_devices_sql("enriched")), ("pv", O.product_visits_sql("enriched"))],
        _THREE_REPORTS),
    "quality_after_batch": O.with_views([("lines", "select * from lineitem where l_quantity is distinct from 1")], " union all ".join([
        _q_unique("pk.lineitem", "lines", ["l_orderkey", "l_linenumber"]), _q_unique("pk.orders", "src_orders", ["OrderId"]),
        _q_ref("fk.orderitems.order", "src_orderitems", "OrderId", "src_orders", "OrderId"),
        _q_ref("fk.orderitems.catalog", "src_orderitems", "CatalogId", "src_catalog", "CatalogId")])),
    "landing_logs": O.with_views(
        [("ctx", _ORDER_CTX), ("op", _ORDER_PRODUCTS)],
        f"""select year, month, page, count(*) as lines, count(distinct host) as hosts from (
  select year, month, split_part(value, ' ', 1) as host, case when value like '%.com/products/%' then 'product'
    when value like '%.com/orders/%' then 'order' end as page
  from ({_ORDER_LINES} union all select * from ({{WEBLOG_LINES}}))) group by all"""),
    "landing_logs_month": O.with_views([("ctx", _ORDER_CTX), ("op", _ORDER_PRODUCTS)], f"""
select host, username, strftime(ts, '%Y-%m-%d') as date, strftime(ts, '%H:%M:%S') as time, referer, useragent,
  cast(year(ts) as integer) as year, cast(month(ts) as integer) as month from (
  select o.HostIp as host, lower(replace(o.CustomerName, ' ', '.')) as username, {_VISIT_AT} as ts,
    'http://shop.example.com/products/' || cast(p.ProductId as varchar) as referer, o.UserAgent as useragent from op p join ctx o on o.OrderId = p.OrderId
  union all select o.HostIp, lower(replace(o.CustomerName, ' ', '.')), o.OrderDate, 'http://shop.example.com/orders/' || cast(o.OrderId as varchar), o.UserAgent from ctx o)
where year(ts) = {LANDING_MONTH[0]} and month(ts) = {LANDING_MONTH[1]}"""),
    "positional_join": O.with_views([], """select CustomerId, CustomerName, ProductId, ProductName from
  (select *, row_number() over (order by CustomerId) as i from src_customers) join
  (select *, row_number() over (order by ProductId) as i from src_products) using (i)"""),
    "domain_csv": O.with_views([], "select row_number() over (order by CompanyId) as Id, CompanyName, IsSupplier from src_companies"),
    "order_months": O.with_views([], """select strftime(OrderDate, '%Y') as year, strftime(OrderDate, '%m') as month,
  count(*) as orders from src_orders group by all"""),
})
ORACLES["landing_logs"] = ORACLES["landing_logs"].replace("{WEBLOG_LINES}", ORACLES["weblog_lines"])
