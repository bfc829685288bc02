"""Relational sources over JDBC.

Three read shapes: a whole table, one partition per predicate, and a numeric
range split into ``num_partitions`` strides of equal width -- or, for a key that is
dense here and sparse there, of about equal row counts. Monthly predicates let an
incremental or historical order scan run in parallel, one month per task,
instead of through a single connection.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, url: str, table: str, properties: dict | None = None) -> DataFrame:
    return spark.read.jdbc(url=url, table=table, properties=dict(properties or {}))


def read_with_predicates(spark: SparkSession, url: str, table: str, predicates: list[str],
                         properties: dict | None = None) -> DataFrame:
    """One partition per predicate (the predicates must not overlap)."""
    return spark.read.jdbc(url=url, table=table, predicates=list(predicates),
                           properties=dict(properties or {}))


def read_range_partitioned(spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int,
                           num_partitions: int, properties: dict | None = None) -> DataFrame:
    """Stride partitions on a numeric column. The bounds only shape the strides:
    rows outside them land in the first or last partition, not filtered."""
    return spark.read.jdbc(url=url, table=table, column=column, lowerBound=lower, upperBound=upper,
                           numPartitions=num_partitions, properties=dict(properties or {}))


def quantile_predicates(keys: DataFrame, column: str, num_partitions: int, quote: str = "", accuracy: int = 10_000) -> list[str]:
    """One predicate per partition so that each holds about as many rows of ``keys`` (a frame with the
    key column: the table's, or a sample of it). Split points are approximate quantiles, combined from
    partial sketches per task; ``num_partitions`` numbers reach the driver. A key value that makes up
    more than a partition's share is not split. The first predicate is open below (and takes
    nulls), the last is open above: rows outside the sample are read as well."""
    shares = [i / num_partitions for i in range(1, num_partitions)]
    splits = keys.agg(F.percentile_approx(column, shares, accuracy).alias("q")).first().q if shares else None
    splits = sorted(set(splits or []))
    if not splits:
        return ["1 = 1"]
    c = _quote(column, quote)
    return ([f"{c} < {splits[0]} or {c} is null"] + [f"{c} >= {a} and {c} < {b}" for a, b in zip(splits, splits[1:])]
            + [f"{c} >= {splits[-1]}"])


def read_balanced(spark: SparkSession, url: str, table: str, column: str, num_partitions: int,
                  properties: dict | None = None, quote: str = "") -> DataFrame:
    """Range-partitioned read on a numeric key whose values are unevenly spread. Two passes over the table:
    the key column alone in strides of equal width, for the quantiles, then whole rows in strides of
    about equal row counts."""
    c = _quote(column, quote)
    key = f"(select {c} as {quote}k{quote} from {table}) keys"
    ends = spark.read.jdbc(url=url, table=f"(select min({c}) as lo, max({c}) as hi from {table}) ends", properties=dict(properties or {})).first()
    if ends[0] is None:
        return read_with_predicates(spark, url, table, ["1 = 1"], properties)
    keys = read_range_partitioned(spark, url, key, _quote("k", quote), int(ends[0]), int(ends[1]) + 1, num_partitions, properties)
    predicates = [p.replace(_quote("k", quote), c) for p in quantile_predicates(keys, "k", num_partitions, quote)]
    return read_with_predicates(spark, url, table, predicates, properties)


def _quote(column: str, quote: str) -> str:
    return f"{quote}{column}{quote}" if quote else column


def month_predicates(column: str, start: _dt.date, end: _dt.date, quote: str = "") -> list[str]:
    """One predicate per month from ``start``'s month to ``end``'s month.

    Written on the raw column (no function around it) so the database can use
    an index. The first predicate is open below (and takes nulls), the last is
    open above, so together they cover every row exactly once.
    """
    months = []
    y, m = start.year, start.month
    while (y, m) <= (end.year, end.month):
        months.append(_dt.date(y, m, 1))
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    if not months:
        return ["1 = 0"]   # start after end: no month, no rows
    if len(months) == 1:
        return ["1 = 1"]
    c = _quote(column, quote)
    bound = [f"'{d.isoformat()} 00:00:00'" for d in months]
    preds = [f"{c} < {bound[1]} or {c} is null"]
    preds += [f"{c} >= {bound[i]} and {c} < {bound[i + 1]}" for i in range(1, len(months) - 1)]
    preds.append(f"{c} >= {bound[-1]}")
    return preds


def since_month_predicate(column: str, as_of: _dt.date, quote: str = "") -> list[str]:
    """Incremental scan: rows from the first day of ``as_of``'s month on."""
    return [f"{_quote(column, quote)} >= '{_dt.date(as_of.year, as_of.month, 1).isoformat()} 00:00:00'"]


def read_range_for(spark: SparkSession, url: str, table: str, column: str, bounds: DataFrame,
                   num_partitions: int, properties: dict | None = None, quote: str = "") -> DataFrame:
    """Range-partitioned read whose stride bounds come from a one-row
    (min, max) frame, e.g. the OrderId bounds of a month's orders. Rows below
    the lower bound are filtered out (the stride bounds alone do not filter);
    an empty selection (null bounds) reads nothing instead of failing."""
    row = bounds.first()  # exactly one row: two scalars reach the driver
    if row is None or row[0] is None:
        return read_with_predicates(spark, url, table, ["1 = 0"], properties)
    lo, hi = int(row[0]), int(row[1])
    df = read_range_partitioned(spark, url, table, _quote(column, quote), lo, hi + 1, num_partitions, properties)
    return df.filter(df[column] >= lo)
