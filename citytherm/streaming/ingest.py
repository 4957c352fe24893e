"""Landed daily payloads -> raw observation rows, as a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from citytherm.sources.payloads import DAILY_SCHEMA, daily_rows


def daily_stream(spark: SparkSession, landing: str, zero_is_missing: bool = False,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame of parsed daily rows from JSON payload files."""
    r = spark.readStream.schema(DAILY_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    payload = r.json(landing)
    return daily_rows(payload, zero_is_missing).withColumn("source", F.lit("openmeteo"))


def start_daily_ingest(spark: SparkSession, landing: str, raw_table: str, checkpoint: str,
                       zero_is_missing: bool = False, available_now: bool = True) -> StreamingQuery:
    """Append parsed weather rows to a Parquet table (partitioned by city): the
    weather part of a raw row; constants and surface columns join it later, in batch.

    The file sink with a checkpoint in the shared folder gives exactly-once
    appends across restarts and lost executors.
    """
    rows = daily_stream(spark, landing, zero_is_missing)
    w = (rows.writeStream.format("parquet").option("path", raw_table)
             .option("checkpointLocation", checkpoint).partitionBy("name").outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
