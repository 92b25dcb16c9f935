"""File-stream ingestion into bronze.

Each micro-batch goes through the same checks and keyed merge as a batch load, so replayed or overlapping files change
nothing and the table equals the batch result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterlake.operators.tables import Lake
from meterlake.plans.refresh import dated_readings, load, scan_readings
from meterlake.sources.staging import released

_FILE = "path string, modificationTime timestamp, length bigint, content binary"  # fixed by the source


def new_files(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """path of every new CSV file of a folder.  Their content is not read here, so each batch can take columns by the header
    of its own files."""
    reader = spark.readStream.format("binaryFile").schema(_FILE).option("pathGlobFilter", "*.csv")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder).select("path")


def run_available(stream: DataFrame, merge: Callable[[DataFrame], None], checkpoint: str) -> None:
    """Process everything that is there now in micro-batches, then stop; ``checkpoint`` remembers what was done."""
    (
        stream.writeStream.foreachBatch(lambda batch, _: merge(batch))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def ingest_readings(lake: Lake, folder: str, checkpoint: str, files_per_batch: int | None = None) -> None:
    """Merge newly landed reading files into the bronze table; lines that do not fit go to quarantine."""

    def merge(batch: DataFrame) -> None:
        files = [row.path for row in batch.collect()]  # one name a file
        if files:
            with released(lake.spark):
                load(lake, "bronze.bronze_meter_readings", dated_readings(scan_readings(lake, files)))

    run_available(new_files(lake.spark, folder, files_per_batch), merge, checkpoint)
