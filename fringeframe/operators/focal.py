"""Neighbourhood operators as windows over (row, col) of dense pixel tables.

``rangeBetween`` on the integer coordinate stays right where a row is missing; a masked pixel is a row of
nulls, so a window's mean skips it and still gives it a value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.phase import TWO_PI, wrap

KEY = "image"


def _along(axis: str, radius: int):
    other = "row" if axis == "col" else "col"
    return Window.partitionBy(KEY, other).orderBy(axis).rangeBetween(-radius, radius)


def _step(axis: str):
    other = "row" if axis == "col" else "col"
    return Window.partitionBy(KEY, other).orderBy(axis)


def neighbour(x: Column, axis: str, offset: int) -> Column:
    """Value ``offset`` pixels further along the axis; null beyond the image or where that row is missing."""
    w = _step(axis).rangeBetween(offset, offset)
    return F.first(x).over(w)


def shift(pixels: DataFrame, column: str, dy: int, dx: int, name: str) -> DataFrame:
    """out[row, col] = in[row - dy, col - dx], null beyond the image."""
    out = pixels.withColumn(name, neighbour(F.col(column), "row", -dy)) if dy else pixels.withColumn(name, F.col(column))
    return out.withColumn(name, neighbour(F.col(name), "col", -dx)) if dx else out


def box_mean(pixels: DataFrame, column: str, radius: int, name: str, passes: int = 1) -> DataFrame:
    """Mean of the unmasked pixels along rows and then columns; ``radius`` 0 copies."""
    out = pixels.withColumn(name, F.col(column))
    for _ in range(passes if radius > 0 else 0):
        out = out.withColumn(name, F.avg(name).over(_along("row", radius)))
        out = out.withColumn(name, F.avg(name).over(_along("col", radius)))
    return out


def lowpass_elevation(pixels: DataFrame, column: str, radius: int, name: str, passes: int = 2) -> DataFrame:
    """Smoothed elevation, masked where the elevation is."""
    return box_mean(pixels, column, radius, name, passes).withColumn(name, F.when(F.col(column).isNotNull(), F.col(name)))


def lowpass_residual(pixels: DataFrame, column: str, fit: Column, radius: int, name: str, passes: int = 3) -> DataFrame:
    """Smooth part of the fit pixels' residual at every unmasked pixel; for inspection, never subtracted."""
    out = box_mean(pixels.withColumn("fit_value__", F.when(fit, F.col(column))), "fit_value__", radius, name, passes)
    return out.withColumn(name, F.when(F.col(column).isNotNull(), F.col(name))).drop("fit_value__")


def residues(pixels: DataFrame, column: str = "phase", name: str = "residue") -> DataFrame:
    """Circulation in cycles of the 2 x 2 loop below and right of each pixel; 0 at the last row and column and
    where a corner is masked."""
    a = F.col(column)
    out = pixels.withColumns({"b__": neighbour(a, "col", 1), "d__": neighbour(a, "row", 1)})
    out = out.withColumn("c__", neighbour(F.col("d__"), "col", 1))
    b, c, d = F.col("b__"), F.col("c__"), F.col("d__")
    loop = wrap(b - a) + wrap(c - b) + wrap(d - c) + wrap(a - d)
    return out.withColumn(name, F.coalesce(F.rint(loop / F.lit(TWO_PI)).cast("int"), F.lit(0))).drop("b__", "c__", "d__")


def gradient(pixels: DataFrame, column: str, name: str) -> DataFrame:
    """Size of the gradient: central differences, one-sided at the edges."""
    parts = {}
    for axis in ("row", "col"):
        before, after = neighbour(F.col(column), axis, -1), neighbour(F.col(column), axis, 1)
        parts[f"{axis}__"] = F.when(before.isNull(), after - F.col(column)).when(after.isNull(), F.col(column) - before).otherwise((after - before) / 2)
    return pixels.withColumns(parts).withColumn(name, F.hypot("row__", "col__")).drop("row__", "col__")


def domain_boundary(pixels: DataFrame, column: str, name: str) -> DataFrame:
    """Unmasked pixels on the image's edge or beside a masked one."""
    alone = [neighbour(F.col(column), axis, k).isNull() for axis in ("row", "col") for k in (-1, 1)]
    return pixels.withColumn(name, F.col(column).isNotNull() & (alone[0] | alone[1] | alone[2] | alone[3]))


def dilate_disc(pixels: DataFrame, mask: str, radius: int, name: str) -> DataFrame:
    """Pixels within a Euclidean radius of a set one: for each row offset of the disc, a window along the row."""
    out, parts = pixels, []
    for dy in range(-radius, radius + 1):
        reach = int((radius * radius - dy * dy) ** 0.5)
        set_there = F.max(F.col(mask).cast("int")).over(_along("col", reach))
        out = out.withColumn(f"reach{dy + radius}__", set_there)
        parts.append((f"reach{dy + radius}__", dy))
    for c, dy in parts:
        out = out.withColumn(c, F.coalesce(neighbour(F.col(c), "row", dy), F.lit(0)))
    return out.withColumn(name, F.greatest(*(c for c, _ in parts), F.lit(0)) > 0).drop(*(c for c, _ in parts))


def circular_variance(pixels: DataFrame, phase: str = "phase") -> DataFrame:
    """(image, circular_variance): median over unmasked pixels of 1 - |3 x 3 mean phasor|.

    The image is mirrored at its edges: there the edge pixel counts twice.  Masked phasors are zero.
    """
    out = pixels.withColumns({"c__": F.coalesce(F.cos(phase), F.lit(0.0)), "s__": F.coalesce(F.sin(phase), F.lit(0.0))})
    for axis in ("row", "col"):
        for c in ("c__", "s__"):
            x = F.col(c)
            out = out.withColumn(c, (x + F.coalesce(neighbour(x, axis, -1), x) + F.coalesce(neighbour(x, axis, 1), x)) / 3)
    return out.where(F.col(phase).isNotNull()).groupBy(KEY).agg(F.median(1 - F.hypot("c__", "s__")).alias("circular_variance"))
