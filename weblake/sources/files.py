"""CSV domain imports (gold-table scans: ``sinks.tables.read_table``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.serial import file_order_keys, serial_keys


def read_domain_csv(spark: SparkSession, path: str, schema: StructType | str, key: str | None = None,
                    order_by: list[str] | None = None) -> DataFrame:
    """Header-less comma-separated domain file with a declared column list.

    Leading blanks are ignored (`` TRUE`` parses as a boolean). With ``key``, a
    serial surrogate key 1..n is added in file order (files by path, then by the
    place in the file, however many files and splits there are) -- or in
    ``order_by`` order -- as a database serial column would.
    """
    df = (spark.read.option("sep", ",").option("ignoreLeadingWhiteSpace", True)
          .option("ignoreTrailingWhiteSpace", True).schema(schema).csv(path))
    if key:
        df = serial_keys(df, order_by, name=key) if order_by else file_order_keys(df, name=key)
        df = df.select(key, *[c for c in df.columns if c != key])
    return df
