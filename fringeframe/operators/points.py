"""Points and deformation masks of velocity maps."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import images


def top_velocity_point(velocity: DataFrame) -> DataFrame:
    """The pixel of the largest speed, the first by row and column of equals."""
    return velocity.where(F.col("velocity").isNotNull()).orderBy(F.desc(F.abs("velocity")), "row", "col").limit(1)


def nearest_valid_pixel(velocity: DataFrame, row: float, col: float) -> DataFrame:
    """The pixel with a value that is nearest to a point, the first by row and column of equals."""
    d2 = F.pow(F.col("row") - F.lit(float(row)), F.lit(2)) + F.pow(F.col("col") - F.lit(float(col)), F.lit(2))
    return velocity.where(F.col("velocity").isNotNull()).orderBy(d2, "row", "col").limit(1)


def point_series(series: DataFrame, velocity: DataFrame, row: float, col: float) -> DataFrame:
    """Displacements in millimetres of the nearest pixel with a value; series has (row, col, date, disp)."""
    at = nearest_valid_pixel(velocity, row, col).select("row", "col")
    return series.join(F.broadcast(at), ["row", "col"]).select("row", "col", "date", (F.col("disp") * F.lit(1000.0)).alias("mm"))


def velocity_threshold(velocity: DataFrame, percentile: float = 85.0, least: float = 0.02) -> DataFrame:
    """(image, limit): the percentile of each map's speeds, or ``least`` where that is more."""
    got = velocity.groupBy("image").agg(F.percentile(F.abs("velocity"), F.lit(percentile / 100)).alias("limit"))
    return got.withColumn("limit", F.greatest(F.coalesce("limit", F.lit(float(least))), F.lit(float(least))))


def component_labels(pixels: DataFrame, mask: str, diagonal: bool = False) -> DataFrame:
    """(image, row, col, label, size, first_row, first_col) of the mask's connected regions, numbered in row-major
    order of their first pixels."""
    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        row, col = frame["row"].to_numpy(np.int64), frame["col"].to_numpy(np.int64)
        grid = np.zeros((int(row.max()) + 1, int(col.max()) + 1), bool)
        grid[row, col] = frame[mask].fillna(False).astype(bool)
        label, _ = images.components(grid, diagonal)
        number, first, size = np.unique(label.ravel(), return_index=True, return_counts=True)
        got = np.searchsorted(number, label[row, col])
        out = pd.DataFrame({"image": key[0], "row": row.astype("int32"), "col": col.astype("int32"), "label": number[got].astype("int32"), "size": size[got], "first_row": (first[got] // grid.shape[1]).astype("int32"), "first_col": (first[got] % grid.shape[1]).astype("int32")})
        return out[out["label"] > 0]

    kind = pixels.schema["image"].dataType.simpleString()
    return pixels.select("image", "row", "col", mask).groupBy("image").applyInPandas(run, f"image {kind}, row int, col int, label int, size long, first_row int, first_col int")


def deformation_mask(velocity: DataFrame, percentile: float = 85.0, least: float = 0.02, min_pixels: int = 80, radius: int = 6) -> DataFrame:
    """Adds ``moving``: fast pixels in 8-connected regions of ``min_pixels``, widened by a disc, where there is a value.

    Several maps are told apart by ``image``; without that column the table is one map.
    """
    from .focal import dilate_disc

    flat = velocity if "image" in velocity.columns else velocity.withColumn("image", F.lit(0))
    flat = flat.join(velocity_threshold(flat, percentile, least), "image").withColumn("fast", F.coalesce(F.abs("velocity") >= F.col("limit"), F.lit(False)))
    large = component_labels(flat, "fast", diagonal=True).where(F.col("size") >= min_pixels).select("image", "row", "col", F.lit(True).alias("core"))
    marked = flat.join(large, ["image", "row", "col"], "left").withColumn("core", F.coalesce("core", F.lit(False)))
    out = dilate_disc(marked, "core", radius, "moving").withColumn("moving", F.col("moving") & F.col("velocity").isNotNull())
    return out.select(*velocity.columns, "moving")


def mask_outlines(mask: np.ndarray) -> list[np.ndarray]:
    """Closed outlines (row, col) of a mask's regions, along pixel corners, outer rings and holes alike."""
    wide = np.pad(mask, 1)
    steps: dict[tuple[int, int], list[tuple[int, int]]] = {}
    # Every side between a set and an unset pixel is walked with the set pixel on its right.
    for r, c in np.argwhere(wide).tolist():
        for (dr, dc), a, b in (((-1, 0), (r, c), (r, c + 1)), ((0, 1), (r, c + 1), (r + 1, c + 1)), ((1, 0), (r + 1, c + 1), (r + 1, c)), ((0, -1), (r + 1, c), (r, c))):
            if not wide[r + dr, c + dc]:
                steps.setdefault(a, []).append(b)
    rings = []
    while steps:
        start = next(iter(steps))
        ring = [start]
        while True:
            to = steps[ring[-1]]
            ring.append(to.pop())
            if not to:
                del steps[ring[-2]]
            if ring[-1] == start:
                break
        rings.append(np.array(ring, float) - 1.5)
    return rings


def ring_area(ring: np.ndarray) -> float:
    y, x = ring[:, 0], ring[:, 1]
    return float(abs(np.dot(x[:-1], y[1:]) - np.dot(x[1:], y[:-1])) / 2)


def largest_outlines(mask: np.ndarray, least_area: float = 100.0, most: int = 20) -> list[np.ndarray]:
    """Outlines of four corners or more and at least an area, the largest first."""
    rings = [r for r in mask_outlines(mask) if len(r) > 4 and ring_area(r) >= least_area]
    return sorted(rings, key=ring_area, reverse=True)[:most]
