"""The data mart in Spark's catalog: three tables in a database of their own, and the report views over them.

Views are catalog objects that hold SQL, not frames: they outlive the frames they were made from and
read whatever their tables hold. A table that is overwritten under a view may leave the view stale
(it keeps the columns it was made with), so a load drops the views first, then overwrites the
tables, then makes the views again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# view -> SQL over the mart's tables
REPORTS = {
    "last_year_orders_report": """
        select max(date_format(orderDate, 'yyyy')) as lastYear, date_format(orderDate, 'MM') as month, count(distinct orderId) as qttOrders
        from {db}.last_year_orders group by date_format(orderDate, 'MM') order by month""",
    "order_devices_report": """
        select Device, count(distinct OrderId) as qttOrders from {db}.order_devices
        group by Device order by qttOrders desc, Device limit 5""",
    "popular_products_report": """
        with busiest as (select Country from {db}.popular_products group by Country order by count(distinct HostIp) desc, Country limit 1)
        select Country, ProductName, count(distinct HostIp) as qttLogs from {db}.popular_products
        where Country in (select Country from busiest) group by Country, ProductName order by qttLogs desc, ProductName""",
}


def drop_report_views(spark: SparkSession, database: str) -> None:
    for view in REPORTS:
        spark.sql(f"drop view if exists {database}.{view}")


def create_report_views(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """Create the report views; returns what they show."""
    for view, sql in REPORTS.items():
        spark.sql(f"create view {database}.{view} as {sql.format(db=database)}")
    return {view: spark.table(f"{database}.{view}") for view in REPORTS}


def load_mart(spark: SparkSession, mart: dict[str, DataFrame], database: str, location: str) -> dict[str, DataFrame]:
    """Overwrite the mart's tables (parquet under ``location``) and make its report views anew, in that order:
    views dropped, tables overwritten, views created. Returns the views' frames."""
    spark.sql(f"create database if not exists {database}")
    drop_report_views(spark, database)
    for name, df in mart.items():
        df.write.mode("overwrite").format("parquet").option("path", f"{location.rstrip('/')}/{name}").saveAsTable(f"{database}.{name}")
    return create_report_views(spark, database)


def drop_mart(spark: SparkSession, database: str) -> None:
    """Remove the mart from the catalog (its files stay)."""
    spark.sql(f"drop database if exists {database} cascade")
