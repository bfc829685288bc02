"""Sales fact: order items with their order date and catalog price.

``items LEFT JOIN orders USING (OrderId) LEFT JOIN catalog USING (CatalogId)``.
The item/order join is a sort-merge join on OrderId (both sides large); the
catalog join is left to the planner, which broadcasts the catalog when its
checked size is under the broadcast threshold (statically or, with AQE, at
runtime) and shuffles otherwise.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.dates import month_text, year_text
from ..operators.upsert import upsert


def _ts(d) -> F.Column:
    """A wall-clock timestamp literal, independent of any time zone."""
    if isinstance(d, str):
        d = _dt.datetime.fromisoformat(d)
    elif isinstance(d, _dt.date) and not isinstance(d, _dt.datetime):
        d = _dt.datetime(d.year, d.month, d.day)
    return F.lit(d.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def _month_start(as_of) -> _dt.datetime:
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of[:10])
    return _dt.datetime(as_of.year, as_of.month, 1)


def orders_snapshot(orders: DataFrame, before) -> DataFrame:
    """The orders table as it stood before ``before`` (orders placed earlier)."""
    return orders.filter(F.col("OrderDate") < _ts(before))


def sales_fact(items: DataFrame, orders: DataFrame, catalog: DataFrame) -> DataFrame:
    """Full sales fact with the gold ``sales`` columns (partition columns as text)."""
    joined = (items.select("OrderItemId", "OrderId", "CatalogId")
              .join(orders.select("OrderId", "OrderDate"), on="OrderId", how="left")
              .join(catalog.select("CatalogId", "Price"), on="CatalogId", how="left"))
    return _fact_columns(joined)


def _fact_columns(joined: DataFrame) -> DataFrame:
    return joined.select(
        F.col("OrderItemId").cast("bigint").alias("orderItemId"),
        F.col("OrderId").cast("bigint").alias("orderId"),
        F.col("Price").alias("price"),
        F.col("OrderDate").cast("timestamp_ntz").alias("orderDate"),
        year_text("OrderDate").alias("year_partition"),
        month_text("OrderDate").alias("month_partition"))


def sales_fact_for_orders(items: DataFrame, orders: DataFrame, catalog: DataFrame) -> DataFrame:
    """Sales rows of exactly the given orders (items of other orders are left out)."""
    joined = (items.select("OrderItemId", "OrderId", "CatalogId")
              .join(orders.select("OrderId", "OrderDate"), on="OrderId", how="inner")
              .join(catalog.select("CatalogId", "Price"), on="CatalogId", how="left"))
    return _fact_columns(joined)


def incremental_orders(orders: DataFrame, as_of) -> DataFrame:
    """Orders from the first day of ``as_of``'s month on (a plain timestamp bound,
    so it is pushed to the source scan)."""
    return orders.filter(F.col("OrderDate") >= _ts(_month_start(as_of)))


def sales_fact_incremental(items: DataFrame, orders: DataFrame, catalog: DataFrame, as_of,
                           item_selection: str = "orders") -> DataFrame:
    """Sales rows of the orders placed since the start of ``as_of``'s month.

    ``item_selection="orders"`` (default) keeps exactly the items of those orders.
    ``item_selection="min_id"`` keeps every item whose OrderId is at least the
    smallest selected OrderId (the legacy bound; older orders' items then come
    with a null date). An empty month yields an empty result in both modes.
    """
    recent = incremental_orders(orders, as_of)
    if item_selection == "orders":
        return sales_fact_for_orders(items, recent, catalog)
    if item_selection == "min_id":
        lowest = recent.select(F.min("OrderId")).scalar()
        return sales_fact(items.filter(F.col("OrderId") >= lowest), recent, catalog)
    raise ValueError(f"unknown item_selection {item_selection!r}")


def order_id_bounds(orders: DataFrame, as_of=None) -> DataFrame:
    """One row: smallest and largest OrderId (of the month's orders when ``as_of``
    is given); nulls for an empty selection."""
    sel = orders if as_of is None else incremental_orders(orders, as_of)
    return sel.agg(F.min("OrderId").alias("minOrderId"), F.max("OrderId").alias("maxOrderId"))


def sales_upsert(current: DataFrame, batch: DataFrame) -> DataFrame:
    """Merge a sales batch into the current sales table on orderItemId."""
    return upsert(schemas.conform(current, schemas.SALES), schemas.conform(batch, schemas.SALES),
                  schemas.SALES_KEYS)
