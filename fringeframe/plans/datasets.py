"""Datasets on disk: folders of big-endian rasters in, tables and map products out."""

from __future__ import annotations

import json
import re
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.phase import dataset_name
from ..operators import cropping, masks, points
from ..sources import elevation as terrain
from ..sources import gamma, geotiff, vector
from . import stages


def _one(folder: Path, suffix: str) -> str:
    found = sorted(folder.rglob(f"*{suffix}"))
    if len(found) != 1:
        raise ValueError(f"{folder} has {len(found)} files *{suffix}, not one")
    return str(found[0])


def list_datasets(root: str) -> list[str]:
    """Names of all dataset folders under a root, sorted."""
    return sorted(p.name for p in Path(root).glob("Dataset_*") if p.is_dir())


def read_dataset(spark: SparkSession, root: str, name: str, shape: tuple[int, int] | None = None, pair: str | None = None) -> tuple[DataFrame, DataFrame, tuple[int, int]]:
    """Pixels (KEYS, row, col, re, im, coh) and geolocation (row, col, lon, lat) of a dataset, and its shape.

    Every image needs a coherence raster of its pair; a coherence without an image is ignored.
    """
    folder = Path(root) / dataset_name(name)
    shape = gamma.discover_shape(folder, shape)
    keys = ["first", "second"]
    phase = gamma.with_pair(gamma.read_raster(spark, f"{folder}/INT/*.filt", shape)).drop("file")
    coh = gamma.with_pair(gamma.read_raster(spark, f"{folder}/INT/*.coh", shape, "float32")).select(*keys, "row", "col", F.col("value").alias("coh"), F.lit(True).alias("has__"))
    if pair:
        phase = phase.where(F.concat_ws("-", *(F.date_format(k, "yyyyMMdd") for k in keys)) == pair.replace("_", "-"))
    lone = phase.select(*keys).distinct().join(coh.select(*keys).distinct(), keys, "left_anti").collect()
    if lone:
        raise ValueError(f"no coherence for {[f'{r[0]}-{r[1]}' for r in lone]}")
    pixels = phase.join(coh, [*keys, "row", "col"], "left").drop("has__").withColumn("dataset", F.lit(dataset_name(name)))
    lon, lat = (gamma.read_raster(spark, _one(folder / "GEO", s), shape, "float32").select("row", "col", F.col("value").alias(c)) for s, c in ((".lon", "lon"), (".lat", "lat")))
    return pixels, lon.join(lat, ["row", "col"]), shape


def require_shape(lines: int | None, width: int | None) -> tuple[int, int] | None:
    """Lines and width, which are given together or not at all."""
    if (lines is None) != (width is None):
        raise ValueError("lines and width must be given together")
    return None if lines is None else (lines, width)


def discover_unwrapped(folder: str | Path) -> list[Path]:
    """Unwrapped rasters under a folder in order of their names, one a pair."""
    found = sorted(Path(folder).glob("*.unw"))
    if not found:
        raise FileNotFoundError(f"no unwrapped image in {folder}")
    pairs: dict[str, Path] = {}
    for path in found:
        pair = re.search(r"(?<!\d)(\d{8})[-_](\d{8})(?!\d)", path.name)
        if not pair or pair[1] >= pair[2]:
            raise ValueError(f"{path.name} names no pair of dates in order")
        if pairs.setdefault("-".join(pair.groups()), path) != path:
            raise ValueError(f"{path.name} and {pairs['-'.join(pair.groups())].name} are of one pair")
    return found


def find_geolocation(folder: str | Path) -> tuple[Path, Path]:
    """Longitude and latitude rasters of a result folder: its own, else those its run summary leads to."""
    folder = Path(folder)
    summary = json.loads((folder / "run_summary.json").read_text())
    origin = summary.get("source_unwrapping_summary", summary)
    places = [folder / "GEO"]
    if root := summary.get("config", {}).get("geo_root"):
        places.append(Path(root) / folder.name / "GEO")
    if source := origin.get("input_directory"):
        places.append(Path(source) / "GEO")
    for place in places:
        if list(place.glob("*.lon")) and list(place.glob("*.lat")):
            return Path(_one(place, ".lon")), Path(_one(place, ".lat"))
    raise FileNotFoundError(f"no geolocation of {folder} in {[str(p) for p in places]}")


def optional_geolocation(folder: str | Path) -> tuple[Path, Path] | None:
    """The same, or None where it cannot be found."""
    try:
        return find_geolocation(folder)
    except (OSError, ValueError):
        return None


#: What a finished run leaves, by which kind of folder.
OUTPUTS = {"tables": ("unwrapped", "quality", "detrended", "detrending", "series"), "products": ("velocity.tif", "run_summary.json")}


def require_outputs(folder: str | Path, kind: str = "tables") -> Path:
    """The folder of a finished run; raises and names what is missing."""
    folder = Path(str(folder).removeprefix("file://"))
    missing = [name for name in OUTPUTS[kind] if not (folder / name).exists()]
    if missing:
        raise FileNotFoundError(f"{folder} is missing: {', '.join(missing)}")
    return folder


def guard_overwrite(folder: str | Path, overwrite: bool = False) -> Path:
    """The folder, empty or new, unless overwriting is asked for."""
    folder = Path(folder)
    if not overwrite and folder.is_dir() and any(folder.iterdir()):
        raise FileExistsError(f"{folder} is not empty")
    folder.mkdir(parents=True, exist_ok=True)
    return folder


def purge_stale(folder: str | Path, pairs: set[str], patterns: tuple[str, ...] = ("*.unw", "*.npy", "*.png")) -> list[str]:
    """Removes products of pairs that are not among the inputs any more; their names."""
    gone = []
    for pattern in patterns:
        for path in sorted(Path(folder).rglob(pattern)):
            pair = re.search(r"(?<!\d)(\d{8})[-_](\d{8})(?!\d)", path.name)
            if pair and "-".join(pair.groups()) not in pairs:
                path.unlink()
                gone.append(path.name)
    return gone


def crop_dataset(spark: SparkSession, source: str, kml: str, target: str, margin: float = 0.20, shape: tuple[int, int] | None = None, overwrite: bool = False, pair: str | None = None) -> dict:
    """Cuts every raster of a scene to a region of interest; writes the rasters and ``crop_metadata.json``."""
    folder = Path(source)
    shape = gamma.discover_shape(folder, shape)
    files = {kind: sorted(p for s in suffixes for p in folder.rglob(f"*{s}") if pair is None or s in (".lon", ".lat") or pair.replace("_", "-") in p.name.replace("_", "-")) for kind, suffixes in (("complex64", (".filt",)), ("float32", (".coh", ".lon", ".lat")))}
    lon, lat = (gamma.read_raster(spark, _one(folder, s), shape, "float32").select("row", "col", F.col("value").alias(c)) for s, c in ((".lon", "lon"), (".lat", "lat")))
    bounds = vector.kml_bounds(vector.read_kml(spark, kml)).first()
    bounds = (bounds["west"], bounds["south"], bounds["east"], bounds["north"])
    window = masks.crop_window(lon.join(lat, ["row", "col"]), *cropping.grown(bounds, margin))
    if window is None:
        raise cropping.NoOverlap(f"the region {bounds} does not meet the scene")
    out = guard_overwrite(target, overwrite)
    rows, cols = (window["row_start"], window["row_end"]), (window["col_start"], window["col_end"])
    for kind, paths in files.items():
        for path in paths:
            gamma.write_window(str(path), str(out / path.relative_to(folder)), kind, shape[1], rows, cols)
    meta = {"bounds": bounds, "margin": margin, "source_shape_lines_width": list(shape), "cropped_shape_lines_width": [rows[1] - rows[0], cols[1] - cols[0]], "window": window}
    vector.write_json(str(out / "crop_metadata.json"), meta)
    return meta


def _grid(df: DataFrame, column: str, shape: tuple[int, int]) -> np.ndarray:
    """One image-sized column on the driver, for map products."""
    out = np.full(shape, np.nan)
    got = df.select("row", "col", F.col(column).cast("double").alias("v")).where("v IS NOT NULL").toArrow()
    out[got["row"].to_numpy(), got["col"].to_numpy()] = got["v"].to_numpy()
    return out


def write_products(spark: SparkSession, folder: str, geo: DataFrame, shape: tuple[int, int], summary: dict, out: str, has_mask: bool = True) -> None:
    """Velocity GeoTIFF in mm a year, outlines of the deformation mask as KML, representative point, summary."""
    series = spark.read.parquet(f"{folder}/series")
    lon, lat = _grid(geo, "lon", shape), _grid(geo, "lat", shape)
    Path(out).mkdir(parents=True, exist_ok=True)
    geotiff.write_geotiff(f"{out}/velocity.tif", *geotiff.regrid(_grid(series, "velocity", shape) * 1000, lon, lat))
    marked = spark.read.parquet(f"{folder}/moving") if has_mask else series.limit(0).withColumn("moving", F.lit(False))
    moving = _grid(marked.withColumn("m", F.col("moving").cast("int")), "m", shape) == 1
    rings = [vector.outline_coordinates(r, lon, lat) for r in points.largest_outlines(moving, least_area=1.0)]
    if rings:
        vector.write_kml(f"{out}/moving.kml", "moving", rings)
    top = points.top_velocity_point(series.join(geo, ["row", "col"])).select(F.lit("P1").alias("id"), F.col("lon").alias("longitude"), F.col("lat").alias("latitude"), "velocity")
    features = [r["feature"] for r in vector.point_features(top).collect()]
    Path(f"{out}/points.geojson").write_text('{"type": "FeatureCollection", "features": [' + ", ".join(features) + "]}")
    vector.write_json(f"{out}/run_summary.json", summary)


def region_pixels(geo: DataFrame, rings: DataFrame) -> DataFrame:
    """(row, col, inside): which pixels lie in any ring of a KML table (file, ring, seq, lon, lat)."""
    named = rings.withColumn("ring", F.concat_ws("#", "file", F.col("ring").cast("string")))
    return masks.in_polygons(geo, named).select("row", "col", "inside")


def run_dataset(spark: SparkSession, root: str, name: str, folder: str, out: str, dem: str | DataFrame | None = None, corner: tuple[float, float, float, float] | None = None, shape: tuple[int, int] | None = None, settings: stages.PipelineSettings = stages.PipelineSettings(), pair: str | None = None, region: str | None = None, skip: frozenset[str] = frozenset()) -> dict:
    """All stages of one dataset.  With an elevation model (a GeoTIFF's path, or a table (cell_row, cell_col, elev)
    and its (west, north, dx, dy)) water is masked and terrain taken off; ``region`` is a KML file of the polygons
    that the reference must lie in; ``skip`` as in ``stages.run_pipeline``."""
    pixels, geo, shape = read_dataset(spark, root, name, shape, pair)
    water = elevation = None
    if dem is not None:
        elevation = terrain.sample_elevation(spark, geo, dem) if isinstance(dem, str) else masks.elevation_cells(geo, dem, *corner)
        water = masks.water_mask(elevation)
    inside = region_pixels(geo, vector.read_kml(spark, region, strict=True)) if region else None
    summary = stages.run_pipeline(pixels, shape, folder, water, elevation, settings, inside, skip)
    summary["input_directory"] = str(Path(root) / dataset_name(name))
    if "timeseries" not in skip:
        write_products(spark, folder, geo, shape, summary, out, "mask" not in skip)
    return summary
