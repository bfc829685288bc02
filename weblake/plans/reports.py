"""Mart extracts and the three reports, as DataFrame functions over gold tables.

The reports can also be kept: the rows of a period (a month of sales, a day of visits) are reduced to a
mergeable state of distinct values (:mod:`weblake.operators.distinct`), only the periods that changed are
reduced again, and the reports are read from the states, equal to a recount of all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import last_year_text
from ..operators.distinct import bitmap_state, distinct_counts, value_state
from ..session import stage


def last_year_orders(sales: DataFrame, as_of) -> DataFrame:
    """Sales rows of the year before ``as_of``: an equality on the text partition
    column, so a partitioned gold table is pruned to one year directory."""
    return sales.filter(F.col("year_partition") == F.lit(last_year_text(as_of)))


def report_last_year_orders(last_year: DataFrame) -> DataFrame:
    """Per month: the year, and the number of distinct orders; by month."""
    return (last_year.groupBy(F.date_format("orderDate", "MM").alias("month"))
            .agg(F.max(F.date_format("orderDate", "yyyy")).alias("lastYear"),
                 F.count_distinct("orderId").alias("qttOrders"))
            .select("lastYear", "month", "qttOrders")
            .orderBy("month"))


def report_order_devices(devices: DataFrame, top: int = 5) -> DataFrame:
    """The ``top`` devices by distinct orders (ties by device name)."""
    return (devices.groupBy("Device").agg(F.count_distinct("OrderId").alias("qttOrders"))
            .orderBy(F.desc("qttOrders"), F.asc("Device"))
            .limit(top))


def visitor_counts(visits: DataFrame) -> DataFrame:
    """Distinct visiting hosts per country (``ProductName`` null, ``whole`` 1) and per country
    and product (``whole`` 0), from one pass over the visits."""
    hosts = visits.groupingSets([["Country", "HostIp", "ProductName"], ["Country", "HostIp"]], "Country", "HostIp", "ProductName").agg(
        F.grouping("ProductName").cast("int").alias("whole"))
    return hosts.groupBy("Country", "ProductName", "whole").agg(F.count("HostIp").alias("qttLogs"))


def report_popular_products(visits: DataFrame) -> DataFrame:
    """Products by distinct visiting hosts within the most active country (most distinct
    visiting hosts, ties by name). The counts are staged: the country is chosen from them."""
    counts = stage(visitor_counts(visits), "visitor-counts")
    top = (counts.filter("whole = 1").orderBy(F.desc("qttLogs"), F.asc("Country")).limit(1).select("Country"))
    return (counts.filter("whole = 0").join(top, on="Country", how="left_semi")
            .select("Country", "ProductName", "qttLogs")
            .orderBy(F.desc("qttLogs"), F.asc("ProductName")))


# ---------------------------------------------------------------- reports from states
# table -> its state: period columns (the partitions), further groups, counted value
STATE_TABLES = {"sales_state": (["year_partition", "month_partition"], [], "orderId"),
                "devices_state": (["day"], ["Device"], "OrderId"),
                "visits_state": (["day"], ["Country", "ProductName"], "HostIp")}


def refresh_states(run, sales: DataFrame | None = None, devices: DataFrame | None = None, visits: DataFrame | None = None) -> None:
    """Put the states of the given rows into a gold run. The rows must hold whole periods: a period's
    state is replaced, other periods keep theirs."""
    day = F.date_format("VisitedAt", "yyyy-MM-dd").alias("day")
    for name, rows in (("sales_state", sales), ("devices_state", devices), ("visits_state", visits)):
        if rows is not None:
            periods, groups, value = STATE_TABLES[name]
            reduce_ = value_state if name == "visits_state" else bitmap_state   # addresses lie far apart
            state = reduce_(rows if "day" not in periods else rows.select("*", day), [*periods, *groups], value)
            run.replace_partitions(name, state, state.schema, periods)


def reports_from_states(sales_state: DataFrame, devices_state: DataFrame, visits_state: DataFrame, as_of, top: int = 5) -> dict[str, DataFrame]:
    """The three reports, read from states."""
    year = last_year_text(as_of)
    orders = (distinct_counts(sales_state.filter(F.col("year_partition") == year), ["year_partition", "month_partition"], "qttOrders")
              .select(F.col("year_partition").alias("lastYear"), F.col("month_partition").alias("month"), "qttOrders").orderBy("month"))
    devices = distinct_counts(devices_state, ["Device"], "qttOrders").orderBy(F.desc("qttOrders"), F.asc("Device")).limit(top)
    busiest = distinct_counts(visits_state, ["Country"]).orderBy(F.desc("n"), F.asc("Country")).limit(1).select("Country")
    products = (distinct_counts(visits_state.join(busiest, "Country", "left_semi"), ["Country", "ProductName"], "qttLogs")
                .orderBy(F.desc("qttLogs"), F.asc("ProductName")))
    return {"last_year_orders_report": orders, "order_devices_report": devices, "popular_products_report": products}
