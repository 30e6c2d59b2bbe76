"""Predicates on pixels: water, validity, frames, polygons, boxes, elevation cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.phase import valid_crop_geo, valid_geo

#: Largest side that is broadcast, in rows; larger ones are joined by a shuffle.
BROADCAST_ROWS = 100_000


def maybe_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hints a broadcast where a count shows that the side is small."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def unwrap_valid(phase: Column, coh: Column, threshold: float = 0.05) -> Column:
    return F.coalesce(phase.isNotNull() & (coh > threshold), F.lit(False))


def filter_valid(re: Column, im: Column) -> Column:
    return F.coalesce(F.hypot(re, im) > 0, F.lit(False))


def edge_guard(row: Column, col: Column, lines: int, width: int, pixels: int) -> Column:
    """Whether a pixel lies in a frame of ``pixels`` along the edge."""
    if 2 * pixels >= min(lines, width):
        raise ValueError("the edge guard leaves no pixel")
    return (row < pixels) | (row >= lines - pixels) | (col < pixels) | (col >= width - pixels)


def border_fit(row: Column, col: Column, lines: int, width: int, fraction: float) -> Column:
    """Whether a pixel lies in the outer fraction of the image."""
    if not 0 < fraction < 0.5:
        raise ValueError("fraction must lie between 0 and 0.5")
    r, c = max(1, round(lines * fraction)), max(1, round(width * fraction))
    return (row < r) | (row >= lines - r) | (col < c) | (col >= width - c)


def elevation_cells(geo: DataFrame, dem: DataFrame, west: float, north: float, dx: float, dy: float) -> DataFrame:
    """Adds ``elev`` of the cell that holds each pixel; dem has (cell_row, cell_col, elev)."""
    on = geo.withColumns({"cell_col": F.floor((F.col("lon") - F.lit(west)) / F.lit(dx)).cast("int"), "cell_row": F.floor((F.lit(north) - F.col("lat")) / F.lit(dy)).cast("int")})
    return on.join(maybe_broadcast(dem.select("cell_row", "cell_col", "elev")), ["cell_row", "cell_col"], "left").drop("cell_row", "cell_col")


def water_mask(geo: DataFrame, highest: float = 0.0, covered: bool = True) -> DataFrame:
    """Adds ``water``: valid geolocation at or under ``highest``.  Raises if ``covered`` and a valid pixel has no elevation."""
    ok = valid_geo(F.col("lon"), F.col("lat"))
    if covered and geo.where(ok & F.col("elev").isNull()).limit(1).count():
        raise ValueError("the elevation model does not cover every valid pixel")
    return geo.withColumn("water", F.coalesce(ok & (F.col("elev") <= F.lit(float(highest))), F.lit(False)))


def mask_water(pixels: DataFrame, geo: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls the columns on water, by dataset where both tables have one; pixels stay as rows."""
    on = [c for c in ("dataset", "row", "col") if c in geo.columns and c in pixels.columns]
    wet = geo.where("water").select(*on, F.lit(True).alias("wet__"))
    out = pixels.join(maybe_broadcast(wet), on, "left")
    return out.withColumns({c: F.when(F.col("wet__").isNull(), F.col(c)) for c in columns}).drop("wet__")


def crop_window(geo: DataFrame, west: float, south: float, east: float, north: float) -> dict | None:
    """Rows and columns, end-exclusive, of the box's pixels; None where there is none."""
    inside = valid_crop_geo(F.col("lon"), F.col("lat")) & F.col("lon").between(west, east) & F.col("lat").between(south, north)
    got = geo.where(inside).agg(F.min("row"), F.max("row"), F.min("col"), F.max("col")).first()
    return None if got[0] is None else {"row_start": got[0], "row_end": got[1] + 1, "col_start": got[2], "col_end": got[3] + 1}


def in_polygons(points: DataFrame, rings: DataFrame, x: str = "lon", y: str = "lat", name: str = "inside") -> DataFrame:
    """Adds whether a point lies in any ring (ring, lon, lat, seq), rings being closed implicitly.

    Half-open ray casting; inner rings are rings of their own and not cut out.  Segments are few and
    collected once into an expression-free array, so the points are never shuffled.
    """
    by_ring: dict = {}
    for r in rings.select("ring", "seq", "lon", "lat").orderBy("ring", "seq").collect():
        by_ring.setdefault(r["ring"], []).append((float(r["lon"]), float(r["lat"])))
    if not by_ring:
        raise ValueError("no ring")
    inside = F.lit(False)
    for ring in by_ring.values():
        segments = F.array(*(F.struct(F.lit(a[0]).alias("x0"), F.lit(a[1]).alias("y0"), F.lit(b[0]).alias("x1"), F.lit(b[1]).alias("y1")) for a, b in zip(ring, ring[1:] + ring[:1])))
        px, py = F.col(x), F.col(y)
        crossed = F.filter(segments, lambda s: ((s["y0"] > py) != (s["y1"] > py)) & (px < (s["x1"] - s["x0"]) * (py - s["y0"]) / (s["y1"] - s["y0"]) + s["x0"]))
        inside = inside | (F.size(crossed) % 2 == 1)
    return points.withColumn(name, F.coalesce(inside, F.lit(False)))
