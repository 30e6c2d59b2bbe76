"""Structured Streaming over pixel tables that grow by image pairs.

An extension: every batch job here is also a stream's micro-batch, so that new pairs are unwrapped as they
come and statistics of late pixels are kept by event time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.unwrapping import unwrap


def pixel_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 16) -> DataFrame:
    """Pixels of new Parquet files in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def process_new_pairs(pixels: DataFrame, out: str, checkpoint: str, job: Callable[[DataFrame], DataFrame] = unwrap, partition: str = "image") -> StreamingQuery:
    """Runs a per-image job over each micro-batch and overwrites just its images, so a repeated batch is harmless.

    A file must hold whole images.  The query ends when all files there are have been handled.
    """
    def write(batch: DataFrame, _: int) -> None:
        job(batch).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(out)

    return pixels.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_quality(events: DataFrame, time: str = "ts", value: str = "value", span: str = "5 days", late: str = "1 day") -> DataFrame:
    """(start, pixels, mean) per span of event time; pixels later than ``late`` are left out."""
    got = events.withWatermark(time, late).groupBy(F.window(time, span)).agg(F.count(value).alias("pixels"), F.avg(value).alias("mean"))
    return got.select(F.col("window.start").alias("start"), "pixels", "mean")
