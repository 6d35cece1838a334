"""Micro-batch statistics over arriving records with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumisift.runtime import shared_dir


def windowed(events: DataFrame, time_col: str, group: str, value: str, width: str = "1 day", late: str = "30 days") -> DataFrame:
    """(window_start, group, n, total) by event time; rows later than ``late`` behind the newest are left to the watermark."""
    counted = events.withWatermark(time_col, late).groupBy(F.window(time_col, width).alias("w"), F.col(group).alias("group"))
    return counted.agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("window_start"), "group", "n", "total")


def run_once(spark: SparkSession, aggregated: DataFrame, name: str) -> DataFrame:
    """Runs a stream over all that is there now and returns its complete result, kept in the shared folder."""
    import uuid

    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def keep(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/result")

    query = aggregated.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(aggregated.schema).parquet(f"{path}/result")


def daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table read as a stream, counted by day and type."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    stream = stream.withColumn("ts", F.col("ts").cast("timestamp"))
    return run_once(spark, windowed(stream, "ts", "event_type", "value"), "daily-events")
