"""Access-log text scan over a ``year=YYYY/month=MM`` landing folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas


def with_log_format(reader, schema=schemas.WEBLOGS):
    """Reader options of the log layout (for a batch or a streaming reader)."""
    return reader.schema(schema).option("sep", " ").option("quote", '"').option("mode", "PERMISSIVE")


def read_weblogs(spark: SparkSession, root: str, year: int | None = None, month: int | None = None,
                 schema=schemas.WEBLOGS) -> DataFrame:
    """Space-separated, ``"``-quoted log lines under ``root``.

    The root is always read (so ``year``/``month`` come from the folder names)
    and a month is selected with a partition filter, which prunes the listing to
    that folder. Short lines are padded with nulls (permissive mode).
    """
    df = with_log_format(spark.read, schema).csv(root)
    if year is not None:
        df = df.filter(F.col("year") == year)
    if month is not None:
        df = df.filter(F.col("month") == month)
    return df
