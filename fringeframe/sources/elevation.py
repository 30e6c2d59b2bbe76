"""Elevation models: GeoTIFFs of one band as tables of cells, and positions in their coordinates."""

from __future__ import annotations

import math
import struct
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.phase import valid_geo
from ..operators.masks import elevation_cells

_SIZE = {1: 1, 2: 1, 3: 2, 4: 4, 6: 1, 8: 2, 9: 4, 11: 4, 12: 8, 16: 8}
_CODE = {1: "B", 2: "s", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q"}


@dataclass(frozen=True)
class Elevation:
    """Cells (row, col), the outer corner and size of cells, and the EPSG code of the coordinates."""

    cells: np.ndarray
    west: float
    north: float
    dx: float
    dy: float
    epsg: int


def _tags(raw: bytes) -> tuple[str, dict[int, tuple]]:
    order = {b"II": "<", b"MM": ">"}.get(raw[:2])
    if order is None or struct.unpack_from(order + "H", raw, 2)[0] != 42:
        raise ValueError("not a GeoTIFF, or one of over 4 GB")
    at, out = struct.unpack_from(order + "I", raw, 4)[0], {}
    for k in range(struct.unpack_from(order + "H", raw, at)[0]):
        tag, kind, n = struct.unpack_from(order + "HHI", raw, at + 2 + 12 * k)
        spot = at + 10 + 12 * k if n * _SIZE[kind] <= 4 else struct.unpack_from(order + "I", raw, at + 10 + 12 * k)[0]
        out[tag] = struct.unpack_from(f"{order}{n}{_CODE[kind]}", raw, spot)
    return order, out


def _block(raw: bytes, order: str, dtype: np.dtype, shape: tuple[int, int], packing: int, predictor: int) -> np.ndarray:
    if packing in (8, 32946):
        raw = zlib.decompress(raw)
    elif packing != 1:
        raise ValueError(f"compression {packing} of a GeoTIFF is not supported")
    rows = len(raw) // (shape[1] * dtype.itemsize)
    if predictor == 3:
        planes = np.cumsum(np.frombuffer(raw, np.uint8).reshape(rows, -1), axis=1, dtype=np.uint8)
        whole = np.ascontiguousarray(planes.reshape(rows, dtype.itemsize, shape[1]).transpose(0, 2, 1))
        return whole.view(f">f{dtype.itemsize}").reshape(rows, shape[1])
    out = np.frombuffer(raw, dtype.newbyteorder(order)).reshape(rows, shape[1])
    return np.cumsum(out, axis=1, dtype=dtype) if predictor == 2 else out


def read_elevation(content: bytes) -> Elevation:
    """The first band of a GeoTIFF, in strips or tiles, plain or deflated; no-data cells are NaN."""
    order, tags = _tags(content)
    width, height = tags[256][0], tags[257][0]
    if tags.get(277, (1,))[0] != 1:
        raise ValueError("an elevation model has one band")
    kind = {1: "u", 2: "i", 3: "f"}[tags.get(339, (1,))[0]]
    dtype = np.dtype(f"{kind}{tags[258][0] // 8}")
    packing, predictor = tags.get(259, (1,))[0], tags.get(317, (1,))[0]
    tiled = 322 in tags
    size = (tags[323][0], tags[322][0]) if tiled else (tags.get(278, (height,))[0], width)
    across = -(-width // size[1])
    cells = np.full((-(-height // size[0]) * size[0], across * size[1]), np.nan)
    for k, (at, n) in enumerate(zip(tags[324 if tiled else 273], tags[325 if tiled else 279])):
        part = _block(content[at : at + n], order, dtype, size, packing, predictor)
        r, c = k // across * size[0], k % across * size[1]
        cells[r : r + len(part), c : c + size[1]] = part
    cells = cells[:height, :width]
    if 42113 in tags and (text := tags[42113][0].split(b"\0")[0].strip()):
        cells = np.where(np.isclose(cells, float(text)), np.nan, cells)
    scale, tie = tags[33550], tags[33922]
    keys = dict(zip(tags.get(34735, ())[4::4], tags.get(34735, ())[7::4]))
    # Points at cells' centres, as the raster type 2 has them, lie half a cell inside.
    shift = 0.5 if keys.get(1025) == 2 else 0.0
    epsg = keys.get(3072) or keys.get(2048) or 4326
    return Elevation(cells, tie[3] - (tie[0] + shift) * scale[0], tie[4] + (tie[1] + shift) * scale[1], scale[0], scale[1], int(epsg))


def project(lon: Column, lat: Column, epsg: int) -> tuple[Column, Column]:
    """Coordinates of geographic positions: themselves (EPSG 4326, 4269), or a UTM zone's metres (326xx, 327xx, 269xx)."""
    if epsg in (4326, 4269):
        return lon, lat
    zone = epsg % 100
    if epsg // 100 not in (326, 327, 269) or not 1 <= zone <= 60:
        raise ValueError(f"coordinates of EPSG {epsg} are not supported")
    # Transverse Mercator by Krueger's series in the third flattening, to its third power.
    flat = 1 / 298.257222101 if epsg // 100 == 269 else 1 / 298.257223563
    n, e = flat / (2 - flat), math.sqrt(flat * (2 - flat))
    radius = 0.9996 * 6378137.0 / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    series = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    s = F.sin(F.radians(lat))
    t = F.sinh(F.atanh(s) - F.lit(e) * F.atanh(F.lit(e) * s))
    away = F.radians(lon - F.lit(6.0 * zone - 183.0))
    xi, eta = F.atan2(t, F.cos(away)), F.atanh(F.sin(away) / F.sqrt(1 + t * t))
    x = eta + sum((F.lit(a) * F.cos(2 * k * xi) * F.sinh(2 * k * eta) for k, a in enumerate(series, 1)), F.lit(0.0))
    y = xi + sum((F.lit(a) * F.sin(2 * k * xi) * F.cosh(2 * k * eta) for k, a in enumerate(series, 1)), F.lit(0.0))
    return F.lit(500000.0) + F.lit(radius) * x, F.lit(1e7 if epsg // 100 == 327 else 0.0) + F.lit(radius) * y


def sample_elevation(spark: SparkSession, geo: DataFrame, path: str) -> DataFrame:
    """Adds ``elev`` of the cell that holds each valid position of (.., lon, lat); null on no-data and outside.

    The file is read by Spark and its cells become a table, which is broadcast only if it is small.
    """
    content = spark.read.format("binaryFile").load(path).select("content").first()
    if content is None:
        raise ValueError(f"no elevation model at {path}")
    model = read_elevation(bytes(content[0]))
    row, col = np.nonzero(np.isfinite(model.cells))
    import pandas as pd

    cells = spark.createDataFrame(pd.DataFrame({"cell_row": row.astype(np.int32), "cell_col": col.astype(np.int32), "elev": model.cells[row, col].astype(float)}), "cell_row int, cell_col int, elev double")
    x, y = project(F.col("lon"), F.col("lat"), model.epsg)
    fine = valid_geo(F.col("lon"), F.col("lat"))
    placed = geo.withColumns({"lon__": F.col("lon"), "lat__": F.col("lat")}).withColumns({"lon": F.when(fine, x), "lat": F.when(fine, y)})
    got = elevation_cells(placed, cells, model.west, model.north, model.dx, model.dy)
    return got.withColumns({"lon": F.col("lon__"), "lat": F.col("lat__")}).select(*geo.columns, "elev")
