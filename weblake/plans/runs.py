"""Transform runs: full or incremental into gold tables, then load
the mart, answer the reports.

Gold layout under ``gold_root``: ``sales``, ``devices`` and ``products``, each
partitioned by ``year_partition``/``month_partition`` (sales by order date, the
two log tables by visit date), so an incremental month rewrites about one
month of each table. A run shows its three merges in one step: readers see all
tables of the last run, or all tables of this one.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.dates import month_text, year_text
from ..session import stage, staging
from ..sinks.jdbc import write_jdbc
from ..sinks.tables import current, gold_run, table_exists, table_rows
from . import reports, sales, weblogs

PARTITION_NAMES = ["year_partition", "month_partition"]


def visit_partitions() -> dict:
    """Partition columns of the log tables: year and month of the visit."""
    return {"year_partition": year_text("VisitedAt"), "month_partition": month_text("VisitedAt")}


GOLD = {"sales": schemas.SALES, "devices": schemas.DEVICES, "products": schemas.PRODUCT_VISITS}


def sales_partitions() -> list[str]:
    return schemas.SALES_PARTITIONS


@dataclass
class Sources:
    """Source relations: the order database and the landing logs (with the
    ``year``/``month`` folder columns)."""
    orders: DataFrame
    orderitems: DataFrame
    catalog: DataFrame
    products: DataFrame
    ipsrangelist: DataFrame
    weblogs: DataFrame


def _date(d) -> _dt.date:
    return _dt.date.fromisoformat(d[:10]) if isinstance(d, str) else d


def run_transform(spark: SparkSession, src: Sources, gold_root: str, as_of=None, is_historical: bool | None = None,
                  logs_month=None, range_mode: str = "exact", tables: tuple[str, ...] = tuple(GOLD)) -> int:
    """One transform run; returns its number. Historical: every order and every landing log.
    Incremental: orders from the first day of ``as_of``'s month, and the
    landing folder of ``logs_month`` (default: ``as_of``'s month).

    ``as_of`` defaults to today; ``is_historical=None`` chooses a historical run exactly when none of
    ``tables`` (the gold tables to refresh) exists yet. All of them change in one step, or none."""
    as_of = _date(as_of) if as_of is not None else _dt.date.today()
    root = gold_root.rstrip("/")
    if is_historical is None:
        is_historical = not any(table_exists(spark, root, t) for t in tables)
    logs = src.weblogs
    if not is_historical:
        lm = _date(logs_month) if logs_month else as_of
        logs = logs.filter((F.col("year") == lm.year) & (F.col("month") == lm.month))
    with gold_run(spark, root) as run:
        if "sales" in tables:
            batch = (sales.sales_fact(src.orderitems, src.orders, src.catalog) if is_historical
                     else sales.sales_fact_incremental(src.orderitems, src.orders, src.catalog, as_of))
            run.merge("sales", batch, schemas.SALES_KEYS, schemas.SALES, sales_partitions())
        merge_visits(run, logs, src.ipsrangelist, src.products, [t for t in tables if t != "sales"], range_mode)
    return run.number


def merge_visits(run, logs: DataFrame, ranges: DataFrame, products: DataFrame, tables=("devices", "products"), range_mode: str = "exact") -> None:
    """Merge what ``logs`` hold for the two log tables into a run. The enriched logs are staged in the
    shared folder when both need them."""
    with staging(run.spark):
        enriched = weblogs.enrich_weblogs(logs, ranges, mode=range_mode)
        if len(tables) > 1:
            enriched = stage(enriched, "enriched-logs")
        if "devices" in tables:
            run.merge("devices", weblogs.order_devices(enriched), schemas.DEVICES_KEYS, schemas.DEVICES, visit_partitions())
        if "products" in tables:
            run.merge("products", weblogs.product_visits(enriched, products), schemas.PRODUCT_VISITS_KEYS, schemas.PRODUCT_VISITS, visit_partitions())


def gold_tables(spark: SparkSession, gold_root: str) -> dict[str, DataFrame]:
    """The three gold tables, all as the same run left them."""
    state = current(spark, gold_root)
    return {name: table_rows(spark, gold_root, state, name, schema) for name, schema in GOLD.items()}


def run_load(spark: SparkSession, gold_root: str, as_of, mart_url: str | None = None,
             mart_properties: dict | None = None, mode: str = "overwrite") -> dict[str, DataFrame]:
    """Mart extracts: last year's sales (partition-pruned), devices, product
    visits; written over JDBC when ``mart_url`` is given."""
    g = gold_tables(spark, gold_root)
    mart = {"last_year_orders": reports.last_year_orders(g["sales"], _date(as_of)),
            "order_devices": g["devices"],
            "popular_products": g["products"]}
    if mart_url:
        for table, df in mart.items():
            write_jdbc(df, mart_url, table, mart_properties, mode=mode)
    return mart


def run_reports(mart: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {"last_year_orders_report": reports.report_last_year_orders(mart["last_year_orders"]),
            "order_devices_report": reports.report_order_devices(mart["order_devices"]),
            "popular_products_report": reports.report_popular_products(mart["popular_products"])}
