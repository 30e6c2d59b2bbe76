"""Column expressions on phases, surfaces, dates and coordinates.

All literals are doubles: an integer divided by a decimal literal would be a decimal.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_PI = 2 * math.pi


def nullable(x: Column) -> Column:
    """NaN and infinities to null: every aggregate then skips them."""
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), None).otherwise(x)


def wrap(x: Column) -> Column:
    """Phase to (-pi, pi]."""
    return F.atan2(F.sin(x), F.cos(x))


def angle(re: Column, im: Column) -> Column:
    return F.atan2(im, re)


def amplitude(re: Column, im: Column) -> Column:
    return F.hypot(re, im)


def unit_phasor(re: Column, im: Column) -> tuple[Column, Column]:
    size = F.hypot(re, im)
    return F.when(size > 0, re / size), F.when(size > 0, im / size)


def closure_cycles(ab: Column, bc: Column, ac: Column) -> Column:
    return (ab + bc - ac) / F.lit(TWO_PI)


def displacement(phase: Column, wavelength: float = 0.056, sign: float = 1.0) -> Column:
    """Metres along the line of sight."""
    return phase * F.lit(sign * wavelength / (4 * math.pi))


def years_between(last: Column, first: Column) -> Column:
    return F.datediff(last, first) / F.lit(365.25)


def unit_grid(index: Column, size: Column | int) -> Column:
    """Row or column to [-1, 1]."""
    last = F.greatest((F.lit(size) if isinstance(size, int) else size) - 1, F.lit(1))
    return F.lit(2.0) * index / last - F.lit(1.0)


def polynomial_terms(x: Column, y: Column, degree: int) -> list[Column]:
    """1, x, y, x2, xy, y2 up to the degree."""
    if degree not in (0, 1, 2):
        raise ValueError("degree must be 0, 1 or 2")
    return [F.lit(1.0), x, y, x * x, x * y, y * y][: (1, 3, 6)[degree]]


def orbit_terms(x: Column, y: Column, model: str = "plane", degree: int = 1) -> list[Column]:
    """Basis of an orbit surface; ``degree`` counts for the model of that name only."""
    one = F.lit(1.0)
    edge = F.greatest((x - F.lit(0.35)) / F.lit(0.65), F.lit(0.0))
    models = {
        "constant": [one],
        "plane": [one, x, y],
        "range_quadratic": [one, x, y, x * x],
        "range_cubic": [one, x, y, x * x, x * x * x],
        "azimuth_quadratic": [one, x, y, y * y],
        "additive_quadratic": [one, x, y, x * x, y * y],
        "full_quadratic": [one, x, y, x * x, x * y, y * y],
        "right_edge_quadratic": [one, x, y, edge * edge, edge * edge * edge],
    }
    if model == "degree":
        return polynomial_terms(x, y, degree)
    if model not in models:
        raise ValueError(f"unknown orbit model: {model}")
    return models[model]


def terrain_terms(h: Column, degree: int) -> list[Column]:
    return [h, h * h][:degree]


def spatial_terrain_terms(h: Column, x: Column, y: Column, degree: int) -> list[Column]:
    """A terrain slope that varies over the image."""
    terms = [h, h * x, h * y]
    return terms if degree < 2 else terms + [h * x * x, h * x * y, h * y * y, h * h]


def edge_weight(fraction: Column, cycles: Column, detrending_accepted: Column, protected: Column) -> Column:
    """Inversion weight of an image pair by its residual fraction and phase range in cycles."""
    w = F.exp(F.lit(-8.0) * fraction - F.lit(0.4) * F.greatest(cycles - 1, F.lit(0.0)))
    w = w * F.when(detrending_accepted, 1.0).otherwise(0.2) * F.when(protected, 0.25).otherwise(1.0)
    return F.greatest(F.least(w, F.lit(1.0)), F.lit(0.03))


def valid_geo(lon: Column, lat: Column) -> Column:
    """On the globe, and not the (0, 0) of missing geolocation."""
    ok = lon.between(-180, 180) & lat.between(-90, 90) & ~((lon == 0) & (lat == 0))
    return F.coalesce(ok, F.lit(False))


def valid_crop_geo(lon: Column, lat: Column) -> Column:
    """Cropping's own rule: neither coordinate may be zero."""
    return F.coalesce(~F.isnan(lon) & ~F.isnan(lat) & (lon != 0) & (lat != 0), F.lit(False))


def expand_bounds(west: Column, south: Column, east: Column, north: Column, fraction: float) -> tuple[Column, Column, Column, Column]:
    """Bounds grown by a fraction of their width and height on every side."""
    dx, dy = (east - west) * F.lit(fraction), (north - south) * F.lit(fraction)
    return west - dx, south - dy, east + dx, north + dy


def piecewise_linear(x: Column, knots: Column) -> Column:
    """Linear interpolation in an array of (x, y) sorted by x, held constant beyond its ends."""
    below = F.filter(knots, lambda k: k["x"] <= x)
    above = F.filter(knots, lambda k: k["x"] > x)
    lo, hi = F.element_at(below, -1), F.get(above, F.lit(0))
    inside = lo["y"] + (hi["y"] - lo["y"]) * (x - lo["x"]) / (hi["x"] - lo["x"])
    return F.when(x.isNull(), None).when(F.size(below) == 0, hi["y"]).when(F.size(above) == 0, lo["y"]).otherwise(inside)


def shoelace(ring: Column) -> Column:
    """Area of a ring given as an array of (x, y) structs, closed or not."""
    n = F.size(ring)
    twice = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0.0), lambda s, i: s + ring[i]["x"] * ring[(i + 1) % n]["y"] - ring[(i + 1) % n]["x"] * ring[i]["y"])
    return F.when(n >= 3, F.abs(twice) / 2).otherwise(F.lit(0.0))


def line_cells(y0: Column, x0: Column, y1: Column, x1: Column) -> Column:
    """Cells (y, x) of a straight line, ends included, as an array."""
    n = F.greatest(F.abs(y1 - y0), F.abs(x1 - x0))
    step = lambda a, b, i: F.rint(a + (b - a) * i / F.greatest(n, F.lit(1))).cast("int")
    return F.transform(F.sequence(F.lit(0), n.cast("int")), lambda i: F.struct(step(y0, y1, i).alias("y"), step(x0, x1, i).alias("x")))


def pair_dates(name: Column) -> tuple[Column, Column]:
    """Dates of an image pair in a file name: eight digits, - or _, eight digits, no digit beside them."""
    pattern = r"(?<![0-9])([0-9]{8})[-_]([0-9]{8})(?![0-9])"
    return F.try_to_date(F.regexp_extract(name, pattern, 1), "yyyyMMdd"), F.try_to_date(F.regexp_extract(name, pattern, 2), "yyyyMMdd")


def pair_text(first: Column, second: Column) -> Column:
    return F.concat_ws("-", F.date_format(first, "yyyyMMdd"), F.date_format(second, "yyyyMMdd"))


def dataset_name(name: str) -> str:
    """A dataset's folder name, with its prefix."""
    return name if name.startswith("Dataset_") else f"Dataset_{name}"
