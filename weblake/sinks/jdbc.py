"""JDBC sinks for the data mart."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None, mode: str = "overwrite",
               batch_size: int = 10000, num_partitions: int | None = None) -> None:
    """Write ``df`` to ``table``: ``overwrite`` drops and recreates it,
    ``errorifexists`` only creates it. ``num_partitions`` caps concurrent
    connections (the frame is coalesced down to it, without a shuffle)."""
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch_size)
    if num_partitions:
        writer = writer.option("numPartitions", num_partitions)
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    writer.mode(mode).save()
