"""Declared schemas of the landing logs and the three gold tables.

Column names and order are fixed values that must equal the reference's table
documents. Two deliberate type choices differ from those documents:
identifiers are 64-bit (``long``) so keys beyond 2^31 survive at scale, and
timestamps are ``timestamp_ntz`` -- the type of a time-zone-less database
timestamp and of the driver parquet files.
"""

from __future__ import annotations

import json

from pyspark.sql.types import (DataType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampNTZType)


def _struct(*fields: tuple[str, DataType]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# --- fixed values: landing weblog columns (space-separated access log) ---
WEBLOG_COLUMNS = ["host", "ident", "username", "date", "time", "request",
                  "status", "size", "referer", "useragent"]
WEBLOG_PARTITIONS = ["year", "month"]

WEBLOGS = _struct(*[(c, StringType()) for c in WEBLOG_COLUMNS],
                  ("year", IntegerType()), ("month", IntegerType()))

# --- fixed values: gold tables ---
SALES = _struct(("orderItemId", LongType()), ("orderId", LongType()), ("price", DoubleType()),
                ("orderDate", TimestampNTZType()), ("year_partition", StringType()),
                ("month_partition", StringType()))
SALES_KEYS = ["orderItemId"]
SALES_PARTITIONS = ["year_partition", "month_partition"]

DEVICES = _struct(("Username", StringType()), ("VisitedAt", TimestampNTZType()),
                  ("OrderId", LongType()), ("Device", StringType()))
DEVICES_KEYS = ["OrderId"]

PRODUCT_VISITS = _struct(("HostIp", StringType()), ("Country", StringType()),
                         ("VisitedAt", TimestampNTZType()), ("ProductId", LongType()),
                         ("ProductName", StringType()))
PRODUCT_VISITS_KEYS = ["HostIp", "VisitedAt", "ProductId"]


def schema_from_json(doc: str | dict) -> StructType:
    """A ``StructType`` from a Spark schema JSON document (text, dict or file path)."""
    if isinstance(doc, str):
        text = doc.strip()
        if not text.startswith("{"):
            from pyspark.sql import SparkSession
            spark = SparkSession.getActiveSession()   # the path may lie on any storage that Spark reads
            text = "\n".join(r[0] for r in spark.read.text(doc, wholetext=True).collect())
        doc = json.loads(text)
    return StructType.fromJson(doc)


def conform(df, schema: StructType):
    """Select ``schema``'s columns from ``df`` (by name) and cast them to its types."""
    from pyspark.sql import functions as F
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
