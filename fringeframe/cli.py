"""Command line: crop scenes, run datasets or single stages, query points."""

from __future__ import annotations

import argparse
import json
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import points
from .operators.detrending import DetrendSettings
from .plans import datasets
from .plans.stages import PipelineSettings


#: Stages that a run can leave out.
STAGES = ("filtering", "unwrapping", "mask", "detrending", "timeseries")
#: Settings of the detrending that are options of their own.
_DETREND = [f for f in DetrendSettings.__dataclass_fields__.values() if f.type in ("int", "float", "str")]


def _dataset_options(sub: argparse.ArgumentParser) -> None:
    sub.add_argument("root")
    sub.add_argument("--dataset", action="append", help="default: all under root")
    sub.add_argument("--pair", help="one pair, as YYYYMMDD-YYYYMMDD")
    sub.add_argument("--tables", required=True, help="folder of the result tables")
    sub.add_argument("--products", help="folder of maps and summaries; default: beside the tables")
    sub.add_argument("--lines", type=int)
    sub.add_argument("--width", type=int)
    sub.add_argument("--dem", help="GeoTIFF of elevations, for water and terrain")
    sub.add_argument("--reference-kml", help="polygons that the reference must lie in")
    for f in PipelineSettings.__dataclass_fields__.values():
        if f.type in ("int", "float"):
            sub.add_argument("--" + f.name.replace("_", "-"), type={"int": int, "float": float}[f.type], default=f.default)
    for f in _DETREND:
        sub.add_argument("--" + f.name.replace("_", "-"), type={"int": int, "float": float, "str": str}[f.type], default=f.default)
    sub.add_argument("--strict", action="store_true", help="refuse low-quality bridges")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="fringeframe", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)
    crop = sub.add_parser("crop", help="cut a scene's rasters to a region of interest")
    for name in ("source", "kml", "target"):
        crop.add_argument(name)
    crop.add_argument("--margin", type=float, default=0.20)
    crop.add_argument("--lines", type=int)
    crop.add_argument("--width", type=int)
    crop.add_argument("--pair")
    crop.add_argument("--overwrite", action="store_true")
    run = sub.add_parser("run", help="filter, unwrap, detrend and invert datasets")
    _dataset_options(run)
    for stage in STAGES:
        run.add_argument(f"--skip-{stage}", action="store_true")
    # Each of these runs up to its stage, on the tables of the stages before it.
    for name, text in (("unwrap", "filter, unwrap and repair"), ("detrend", "detrend what was unwrapped"), ("timeseries", "invert what was detrended"), ("mask", "mark deformation in what was unwrapped")):
        _dataset_options(sub.add_parser(name, help=text))
    point = sub.add_parser("point", help="displacement series nearest to a pixel")
    point.add_argument("tables")
    point.add_argument("row", type=float)
    point.add_argument("col", type=float)
    return top


def skipped(a: argparse.Namespace) -> frozenset[str]:
    """Stages that a command leaves out."""
    if a.command == "run":
        return frozenset(s for s in STAGES if getattr(a, f"skip_{s}"))
    return frozenset({"unwrap": ("mask", "detrending", "timeseries"), "mask": ("unwrapping", "detrending", "timeseries"), "detrend": ("unwrapping", "timeseries"), "timeseries": ("unwrapping", "mask", "detrending")}[a.command])


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("fringeframe").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.command == "crop":
        meta = datasets.crop_dataset(spark, a.source, a.kml, a.target, a.margin, datasets.require_shape(a.lines, a.width), a.overwrite, a.pair)
        print(f"{a.target}: {meta['cropped_shape_lines_width'][0]} x {meta['cropped_shape_lines_width'][1]}")
        return 0
    if a.command == "point":
        datasets.require_outputs(a.tables)
        series = spark.read.parquet(f"{a.tables}/series").where(F.col("disp").isNotNull())
        long = series.select("row", "col", F.posexplode("disp").alias("date", "disp"))
        rows = points.point_series(long, series, a.row, a.col).orderBy("date").collect()
        print(json.dumps([{"row": r["row"], "col": r["col"], "epoch": r["date"], "mm": r["mm"]} for r in rows]))
        return 0
    settings = PipelineSettings(allow_bridges=not a.strict, **{k: getattr(a, k) for k, f in PipelineSettings.__dataclass_fields__.items() if f.type in ("int", "float")})
    settings = replace(settings, detrend=DetrendSettings(**{f.name: getattr(a, f.name) for f in _DETREND}))
    products, shape = a.products or f"{a.tables.removeprefix('file://')}/products", datasets.require_shape(a.lines, a.width)
    for name in a.dataset or datasets.list_datasets(a.root):
        summary = datasets.run_dataset(spark, a.root, name, f"{a.tables}/{name}", f"{products}/{name}", a.dem, shape=shape, settings=settings, pair=a.pair, region=a.reference_kml, skip=skipped(a))
        print(f"{name}: {len(summary['dates'])} dates, {sum(e['selected'] for e in summary['edges'])} pairs used")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
