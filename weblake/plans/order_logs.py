"""Order activity rendered as access-log lines.

For every order: one product-page visit per distinct product of its items,
shortly before the order (0-30 minutes and 0-59 seconds earlier, seeded per
order and product), plus one order-page line at the order time. Lines are
partitioned by the year and month of their event time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import minus_minutes_seconds
from ..functions.text import log_line, user_slug
from ..operators.sampling import seeded_draw


def order_products(items: DataFrame, catalog: DataFrame) -> DataFrame:
    """Distinct (OrderId, ProductId) pairs of the order items (kept normalised:
    one row per pair, never a per-order list)."""
    return (items.select("OrderId", "CatalogId")
            .join(catalog.select("CatalogId", "ProductId"), on="CatalogId", how="inner")
            .select("OrderId", "ProductId").distinct())


def _line(host, user, ts, referer, ua) -> F.Column:
    return log_line(host, F.lit("-"), user, F.date_format(ts, "yyyy-MM-dd"), F.date_format(ts, "HH:mm:ss"),
                    F.lit("-"), F.lit("200"), F.lit("-"), referer, ua)


def order_log_lines(orders: DataFrame, products: DataFrame, site: str, seed) -> DataFrame:
    """``orders``: OrderId, OrderDate, CustomerName, HostIp, UserAgent.
    ``products``: distinct OrderId, ProductId. Output: value, year, month."""
    o = orders.select("OrderId", "OrderDate", user_slug("CustomerName").alias("__user"), "HostIp", "UserAgent")
    visits = products.join(o, on="OrderId", how="inner")
    minutes = F.pmod(seeded_draw(seed, F.lit("visit-min"), "OrderId", "ProductId"), F.lit(31))
    seconds = F.pmod(seeded_draw(seed, F.lit("visit-sec"), "OrderId", "ProductId"), F.lit(60))
    at = minus_minutes_seconds("OrderDate", minutes, seconds)
    product_lines = visits.select(
        _line(F.col("HostIp"), F.concat(F.lit('"'), F.col("__user"), F.lit('"')), at,
              F.concat(F.lit(site + "/products/"), F.col("ProductId").cast("string")), F.col("UserAgent")).alias("value"),
        F.year(at).alias("year"), F.month(at).alias("month"))
    ts = F.col("OrderDate")
    order_lines = o.select(
        _line(F.col("HostIp"), F.col("__user"), ts,
              F.concat(F.lit(site + "/orders/"), F.col("OrderId").cast("string")), F.col("UserAgent")).alias("value"),
        F.year(ts).alias("year"), F.month(ts).alias("month"))
    return product_lines.unionByName(order_lines)
