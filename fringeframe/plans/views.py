"""Raster views of relational tables: images of 8 x 8 pixels, a stack over epochs, a network of dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SIDE = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(image, row, col, phase): each 64-vector of ``embeddings`` as a dense image, times 20."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("image"), F.posexplode("embedding").alias("p", "v"))
    return e.select("image", F.floor(F.col("p") / SIDE).cast("int").alias("row"), (F.col("p") % SIDE).cast("int").alias("col"), (F.lit(20.0) * F.col("v").cast("double")).alias("phase"))


def hollow(pixels: DataFrame) -> DataFrame:
    """Tiles with a masked pixel in eleven; they stay as rows."""
    return pixels.withColumn("phase", F.when((F.col("image") * 7 + F.col("row") * 3 + F.col("col")) % 11 != 0, F.col("phase")))


def with_elevation(pixels: DataFrame) -> DataFrame:
    """Adds ``elev``, the pixel of the next image (null for the last)."""
    after = pixels.select((F.col("image") - 1).alias("image"), "row", "col", F.col("phase").alias("elev"))
    return pixels.join(after, ["image", "row", "col"], "left")


def geolocation(pixels: DataFrame) -> DataFrame:
    """Adds ``lon`` and ``lat`` of the pixel grid."""
    return pixels.withColumns({"lon": F.lit(-118.4) + F.lit(0.001) * F.col("col"), "lat": F.lit(33.76) - F.lit(0.001) * F.col("row")})


def epochs(spark: SparkSession, sf_dir: str, only: str | None = None) -> DataFrame:
    """(row, epoch, m): a user's mean value in each of six spans of five days (the last has the 31st too)."""
    e = table(spark, sf_dir, "events")
    e = e.where(F.col("event_type") == only) if only else e
    return e.groupBy(F.col("user_id").alias("row"), F.least(F.floor((F.dayofmonth("ts") - 1) / 5), F.lit(5)).cast("int").alias("epoch")).agg(F.avg("value").alias("m"))


def epoch_date(epoch: Column) -> Column:
    return F.date_add(F.lit("2024-01-01").cast("date"), (epoch * 12).cast("int"))


def stack(spark: SparkSession, sf_dir: str, only: str | None = None) -> DataFrame:
    """(image, first, second, row, col, phase): differences of a user's epochs, an image for each pair of them."""
    a = epochs(spark, sf_dir, only)
    b = a.select("row", F.col("epoch").alias("j"), F.col("m").alias("mj"))
    pair = a.withColumnRenamed("epoch", "i").join(b, "row").where("i < j")
    return pair.select((F.col("i") * 10 + F.col("j")).alias("image"), epoch_date(F.col("i")).alias("first"), epoch_date(F.col("j")).alias("second"), "row", F.lit(0).alias("col"), (F.col("mj") - F.col("m")).alias("phase"))


def day_pairs(spark: SparkSession, sf_dir: str, lags: int = 4) -> DataFrame:
    """(pair, first, second, d, lag): pairs of distinct days of ``events`` up to ``lags`` days apart.

    A day meets its followers by an equi-join on the date, each day being spelt out once for each lag.
    """
    day = table(spark, sf_dir, "events").select(F.to_date("ts").alias("first")).distinct()
    reach = day.select("first", F.explode(F.sequence(F.lit(1), F.lit(lags))).alias("lag")).withColumn("second", F.date_add("first", F.col("lag")))
    both = reach.join(day.select(F.col("first").alias("second")), "second")
    lag = F.col("lag")
    text = F.concat_ws("-", F.date_format("first", "yyyyMMdd"), F.date_format("second", "yyyyMMdd"))
    return both.select(text.alias("pair"), "first", "second", F.dayofmonth("first").alias("d"), lag.alias("lag"))
