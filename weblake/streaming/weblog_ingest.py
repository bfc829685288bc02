"""Landing logs -> gold device and product-visit tables, as a file stream.

The landing folder is read as a stream of new files (``year=``/``month=``
folders are discovered, each file is processed once; progress lives in the
checkpoint location). Every micro-batch is enriched and merged into the two
gold tables as one run, published with the stream's epoch number: a micro-batch
that is delivered again finds its epoch published and is skipped, also if it
holds null keys or repeated keys. Delivery at least once thus becomes content
exactly once, of both tables together.

Run with ``available_now=True`` (process everything present, then stop) from a
scheduler in place of a monthly batch job, or continuously with a
processing-time trigger.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..plans.runs import merge_visits
from ..sinks.tables import gold_run
from ..sources.logs import with_log_format


def start_weblog_ingest(spark: SparkSession, landing_root: str, gold_root: str, ranges: DataFrame,
                        products: DataFrame, checkpoint_location: str, available_now: bool = True,
                        max_files_per_trigger: int | None = None, processing_time: str = "1 minute"):
    """Start the stream; returns the ``StreamingQuery``."""
    reader = with_log_format(spark.readStream)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    logs = reader.csv(landing_root)
    root, stream = gold_root.rstrip("/"), checkpoint_location.rstrip("/")   # epochs count per checkpoint

    def merge_batch(batch: DataFrame, epoch_id: int) -> None:
        with gold_run(batch.sparkSession, root, epoch=(stream, epoch_id)) as run:
            if not run.repeated:
                merge_visits(run, batch, ranges, products)

    writer = logs.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
