"""Serial (1..n) keys without a single-partition window.

The rows are range-partitioned on the ordering columns and sorted inside each
partition; each row's position inside its partition plus the row count of all
earlier partitions gives its global number. Only the per-partition counts --
one row per partition, a size bound known in advance -- are combined in one
place and broadcast back. Without ordering columns, the input's own partition
order is numbered (for the rows of files in file order, see :func:`file_order_keys`).

The tagged rows are read twice (for the counts and for the numbering), so they
are staged as a table in the shared checkpoint folder first: both reads then see the
same partitioning even if the input is recomputed differently or an executor
is lost. Rows that tie on the ordering columns receive consecutive numbers in
an unspecified order; give a unique ordering for repeatable numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage


def serial_keys(df: DataFrame, order_cols: list, name: str = "serial", start: int = 1,
                num_partitions: int | None = None) -> DataFrame:
    if order_cols:
        n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    tagged = stage(df.withColumn("__sk_pid", F.spark_partition_id())
                   .withColumn("__sk_mid", F.monotonically_increasing_id()), "serial")
    counts = tagged.groupBy("__sk_pid").agg(F.count(F.lit(1)).alias("__sk_n"))
    before = Window.orderBy("__sk_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__sk_pid", F.coalesce(F.sum("__sk_n").over(before), F.lit(0)).alias("__sk_off"))
    local = F.col("__sk_mid") - F.shiftleft(F.col("__sk_pid").cast("bigint"), 33)
    return (tagged.join(F.broadcast(offsets), on="__sk_pid", how="inner")
            .withColumn(name, F.col("__sk_off") + local + F.lit(start))
            .drop("__sk_pid", "__sk_mid", "__sk_off"))


def file_order_keys(scan: DataFrame, name: str = "serial", start: int = 1) -> DataFrame:
    """Serial keys for the rows of a file scan in file order: files by their path, rows by their place in the file.

    Spark deals splits of files to tasks by size, several to a task, so the order of partitions says nothing. Each
    row is tagged with its split (file and the byte where it begins) and its place in the split; splits
    are counted, and a split's offset is the rows of earlier files plus those of earlier splits of its file. No task
    sees more than one file's splits (a row each) or one row per file, and no row is shuffled for its number."""
    tagged = stage(scan.select("*", F.col("_metadata.file_path").alias("__fk_file"), F.col("_metadata.file_block_start").alias("__fk_at"))
                   .withColumn("__fk_mid", F.monotonically_increasing_id()), "file-order")
    splits = tagged.groupBy("__fk_file", "__fk_at").agg(F.count(F.lit(1)).alias("__fk_n"), F.min("__fk_mid").alias("__fk_first"))
    files = splits.groupBy("__fk_file").agg(F.sum("__fk_n").alias("__fk_rows"))

    def before(column: str, window) -> F.Column:
        return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    files = files.select("__fk_file", before("__fk_rows", Window.orderBy("__fk_file")).alias("__fk_files"))
    splits = splits.join(files, "__fk_file").select(
        "__fk_file", "__fk_at", "__fk_first",
        (F.col("__fk_files") + before("__fk_n", Window.partitionBy("__fk_file").orderBy("__fk_at"))).alias("__fk_off"))
    return (tagged.join(splits, ["__fk_file", "__fk_at"])
            .withColumn(name, F.col("__fk_off") + F.col("__fk_mid") - F.col("__fk_first") + F.lit(start))
            .drop("__fk_file", "__fk_at", "__fk_mid", "__fk_first", "__fk_off"))


def positional_join(left: DataFrame, right: DataFrame, left_order: list, right_order: list) -> DataFrame:
    """Pair the i-th row of ``left`` with the i-th row of ``right`` (each in its
    own order); the longer side's extra rows are dropped, as when zipping lists.
    Both sides are numbered with :func:`serial_keys`, then equi-joined on the
    number -- no single-partition step."""
    lnum = serial_keys(left, left_order, name="__zip_pos")
    rnum = serial_keys(right, right_order, name="__zip_pos")
    return lnum.join(rnum, on="__zip_pos", how="inner").drop("__zip_pos")
