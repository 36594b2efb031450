"""Incremental ingestion: new part files of a folder, found by Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from chartmill.config import CleaningRules, Layout
from chartmill.plans import bronze, silver


def incremental_parts(
    spark: SparkSession, layout: Layout, table: str, folder: str, pattern: str, checkpoint: str,
    rules: CleaningRules = CleaningRules(), max_files: int = 1000, update_silver: bool = False,
) -> StreamingQuery:
    """Load the parts that appeared since the last run, then stop.

    The stream only discovers files; each batch is loaded like any other, so the ledger still decides
    what is already done and a replayed batch adds nothing.  With ``update_silver`` each batch is also
    added to the silver table.  Start it on a schedule.
    """
    found = (
        spark.readStream.format("binaryFile")
        .schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", max_files)
        .load(folder)
        .select("path")  # the content is never read here
    )

    def load(batch: DataFrame, _batch_id: int) -> None:
        # One row per new source file reaches the driver.
        paths = [row.path for row in batch.distinct().collect()]
        if paths:
            bronze.ingest(batch.sparkSession, layout, table, paths, rules)
            if update_silver:
                silver.update(batch.sparkSession, layout, table, rules)

    return (
        found.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
