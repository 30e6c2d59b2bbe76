"""Aggregates over images, pixels and blocks.  Nulls are skipped; quantiles are exact and interpolate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.phase import TWO_PI


def with_group_value(df: DataFrame, keys: list[str], value: Column, name: str) -> DataFrame:
    """Adds a group's aggregate to its rows; summed before it is shuffled, then joined back."""
    return df.join(df.groupBy(*keys).agg(value.alias(name)), keys)


def robust_std(df: DataFrame, keys: list[str], column: str, name: str = "robust_std") -> DataFrame:
    """(keys, name): 1.4826 times the median distance from the median."""
    centred = with_group_value(df.select(*keys, column), keys, F.median(column), "centre__")
    return centred.groupBy(*keys).agg((F.lit(1.4826) * F.median(F.abs(F.col(column) - F.col("centre__")))).alias(name))


def spread(x: str | Column, low: float, high: float) -> Column:
    """Distance of two percentiles, given as fractions."""
    return F.percentile(x, F.lit(high)) - F.percentile(x, F.lit(low))


def robust_range(df: DataFrame, keys: list[str], column: str, name: str = "robust_range") -> DataFrame:
    return df.groupBy(*keys).agg(spread(column, 0.02, 0.98).alias(name))


def phase_range_cycles(column: str) -> Column:
    return spread(column, 0.01, 0.99) / F.lit(TWO_PI)


def stable_pixels(stack: DataFrame, least_fraction: float = 0.8, percentile: float = 70.0, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, row, col, valid_fraction, temporal_mad, stable) of a stack (by, image, row, col, phase).

    Images are centred on their medians; a pixel's dispersion is its median distance from its own median.
    Stable: valid often enough, and of no larger dispersion than the percentile over the valid pixels (of each
    group of ``by``, such as a dataset).
    """
    centred = with_group_value(stack.select(*by, "image", "row", "col", "phase"), [*by, "image"], F.median("phase"), "middle").withColumn("x", F.col("phase") - F.col("middle"))
    # A pixel's few images are gathered once, and both medians are taken from them.
    pixel = centred.groupBy(*by, "row", "col").agg((F.count("phase") / F.count(F.lit(1))).alias("valid_fraction"), F.array_sort(F.collect_list("x")).alias("x__"))
    pixel = pixel.withColumn("c__", _array_median(F.col("x__")))
    pixel = pixel.withColumn("temporal_mad", _array_median(F.array_sort(F.transform("x__", lambda x: F.abs(x - F.col("c__")))))).drop("x__", "c__")
    often = F.col("valid_fraction") >= least_fraction
    limit = pixel.groupBy(*by).agg(F.percentile(F.when(often, F.col("temporal_mad")), F.lit(percentile / 100)).alias("limit__"))
    pixel = pixel.join(limit, [*by]) if by else pixel.withColumn("limit__", F.lit(limit.first()["limit__"]).cast("double"))
    return pixel.withColumn("stable", F.coalesce(often & (F.col("temporal_mad") <= F.col("limit__")), F.lit(False))).drop("limit__")


def _array_median(x: Column) -> Column:
    """Median of a sorted array; null if it is empty."""
    n = F.size(x)
    return F.when(n > 0, (F.get(x, F.floor((n - 1) / 2).cast("int")) + F.get(x, F.floor(n / 2).cast("int"))) / 2)


def mean_coherence(stack: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return stack.groupBy(*by, "row", "col").agg(F.avg("coh").alias("mean_coherence"))


def quantile_bins(df: DataFrame, keys: list[str], x: str, y: str, bins: int = 30, least: int = 100) -> DataFrame:
    """(keys, bin, centre, middle, n): medians of x and y in bins between quantiles of x.

    Equal edges merge; a bin takes its lower edge, the last one both; bins under ``least`` rows are left out.
    """
    steps = [k / bins for k in range(bins + 1)]
    edges = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*keys).agg(F.array_distinct(F.percentile(x, F.array(*map(F.lit, steps)))).alias("edges__"))
    joined = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).join(edges, keys)
    below = F.size(F.filter("edges__", lambda e: e <= F.col(x)))
    binned = joined.withColumn("bin", F.least(below, F.size("edges__") - 1))
    return binned.groupBy(*keys, "bin").agg(F.median(x).alias("centre"), F.median(y).alias("middle"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def local_worsening(df: DataFrame, keys: list[str], before: str, after: str, block: int = 96, tolerance: float = 0.15, least: int = 200) -> DataFrame:
    """(keys, worst_ratio, bad_blocks, blocks): robust spread after over before, in square blocks of pixels."""
    both = df.where(F.col(before).isNotNull() & F.col(after).isNotNull()).withColumns({"block_row__": F.floor(F.col("row") / block), "block_col__": F.floor(F.col("col") / block)})
    where = [*keys, "block_row__", "block_col__"]
    count = both.groupBy(*where).agg(F.count(F.lit(1)).alias("n__"))
    ratio = robust_std(both, where, before, "b__").join(robust_std(both, where, after, "a__"), where).join(count, where).where((F.col("n__") >= least) & (F.col("b__") > 1e-10))
    return ratio.groupBy(*keys).agg(F.greatest(F.max(F.col("a__") / F.col("b__")), F.lit(1.0)).alias("worst_ratio"), F.count_if(F.col("a__") / F.col("b__") > 1 + tolerance).alias("bad_blocks"), F.count(F.lit(1)).alias("blocks"))


def elevation_correlation(df: DataFrame, keys: list[str], phase: str, elevation: str) -> DataFrame:
    """(keys, correlation): null under three pixels, 0 where the phase's robust spread is under 1e-10."""
    both = df.where(F.col(phase).isNotNull() & F.col(elevation).isNotNull())
    value = both.groupBy(*keys).agg(F.corr(phase, elevation).alias("r__"), F.count(F.lit(1)).alias("n__"))
    joined = value.join(robust_std(both, keys, phase, "s__"), keys)
    return joined.select(*keys, F.when(F.col("n__") < 3, None).when(F.col("s__") < 1e-10, 0.0).otherwise(F.col("r__")).alias("correlation"))


def filter_quality(pixels: DataFrame) -> DataFrame:
    """Medians per image of (image, coh, concentration, phase_change)."""
    return pixels.groupBy("image").agg(F.median("coh").alias("median_coherence"), F.median("concentration").alias("median_concentration"), F.median(F.abs("phase_change")).alias("median_phase_change"))


def display_limits(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Colour limits: the 2nd and 98th percentiles, and the symmetric 98th of the sizes."""
    return df.groupBy(*keys).agg(F.percentile(column, F.lit(0.02)).alias("low"), F.percentile(column, F.lit(0.98)).alias("high"), F.percentile(F.abs(column), F.lit(0.98)).alias("symmetric"))


def coverage(df: DataFrame, keys: list[str], valid: str, done: str) -> DataFrame:
    """Percent of the valid pixels that were unwrapped."""
    return df.groupBy(*keys).agg((F.lit(100.0) * F.count(done) / F.greatest(F.count(valid), F.lit(1))).alias("coverage_percent"))
