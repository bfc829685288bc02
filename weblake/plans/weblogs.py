"""Weblog enrichment and the two log-derived gold datasets.

Field extraction happens before the range join so that only the derived
columns travel through the join, and page-type filters of the downstream
datasets are pushed below the join by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.dates import parse_log_timestamp, month_text, year_text
from ..functions.text import device_text, entity_id, page_type
from ..operators.range_join import ip_range_join
from ..operators.upsert import upsert

ENRICHED_COLUMNS = ["HostIp", "Country", "Username", "VisitedAt", "PageType", "Id", "Device",
                    "year_partition", "month_partition"]


def parse_weblogs(logs: DataFrame) -> DataFrame:
    """Access-log columns -> typed visit fields (before geo resolution)."""
    return logs.select(
        F.col("host").alias("HostIp"),
        F.col("username").alias("Username"),
        parse_log_timestamp("date", "time").alias("VisitedAt"),
        page_type("referer").alias("PageType"),
        entity_id("referer").alias("Id"),
        device_text("useragent").alias("Device"),
        year_text("date").alias("year_partition"),
        month_text("date").alias("month_partition"))


def enrich_weblogs(logs: DataFrame, ranges: DataFrame, mode: str = "exact", **options) -> DataFrame:
    """Visit rows with the country of the host's address range (inner join)."""
    parsed = parse_weblogs(logs)
    geo = ranges.select(F.col("country").alias("Country"), F.col("iprange").alias("__range"))
    joined = ip_range_join(parsed, geo, host_col="HostIp", range_col="__range", mode=mode, **options)
    return joined.select(*ENRICHED_COLUMNS)


def order_devices(enriched: DataFrame) -> DataFrame:
    """Order page visits: who ordered, when, which order, from which device."""
    return (enriched.filter(F.col("PageType") == "order")
            .select("Username", "VisitedAt", F.col("Id").try_cast("bigint").alias("OrderId"), "Device"))


def product_visits(enriched: DataFrame, products: DataFrame) -> DataFrame:
    """Distinct product page visits with the product's name (inner join on id, the products' key).

    Visits are made distinct before they meet the products: the distinct shuffles fewer and
    narrower rows, spread by all four columns, and the join on the id that follows has an
    exchange of its own, so AQE can split a hot product."""
    visits = (enriched.filter(F.col("PageType") == "product")
              .select("HostIp", "Country", "VisitedAt", F.col("Id").try_cast("bigint").alias("ProductId")).distinct())
    return (visits.join(products.select("ProductId", "ProductName"), on="ProductId", how="inner")
            .select("HostIp", "Country", "VisitedAt", "ProductId", "ProductName"))


def devices_upsert(current: DataFrame, batch: DataFrame) -> DataFrame:
    return upsert(schemas.conform(current, schemas.DEVICES), schemas.conform(batch, schemas.DEVICES),
                  schemas.DEVICES_KEYS)


def products_upsert(current: DataFrame, batch: DataFrame) -> DataFrame:
    return upsert(schemas.conform(current, schemas.PRODUCT_VISITS),
                  schemas.conform(batch, schemas.PRODUCT_VISITS), schemas.PRODUCT_VISITS_KEYS)


def render_weblog_lines(logs: DataFrame) -> DataFrame:
    """Parsed log rows back to text lines, with the event year and month as the
    landing partition values."""
    from ..functions.text import log_line
    d = F.col("date").try_cast("date")
    return logs.select(
        log_line("host", "ident", "username", "date", "time", "request", "status", "size", "referer",
                 "useragent").alias("value"),
        F.year(d).alias("year"), F.month(d).alias("month"))
