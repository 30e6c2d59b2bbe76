"""The stages of the raster pipeline on one pixel table: filter, unwrap, detrend, invert.

A stage takes and returns tables (dataset, first, second, row, col, ...).  Only unwrapped phases are
written out in between: they cost most and are read twice.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, field
from datetime import date

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.phase import pair_text
from ..operators import detrending, inversion, masks, network, points, region_repair, stats
from ..operators.closure import repair_closure_stack
from ..operators.filtering import goldstein, nonlocal_strips
from ..operators.images import smooth_valid
from ..operators.rasters import image_array, nullable
from ..operators.unwrapping import unwrap_image
from ..sources.vector import write_report

KEYS = ["dataset", "first", "second"]


@dataclass(frozen=True)
class PipelineSettings:
    search: int = 7
    patch: int = 3
    bandwidth: float = 0.70
    goldstein_strength: float = 0.40
    threshold: float = 0.05
    longest_cut: float = 15.0
    plateau: dict = field(default_factory=dict)
    region: dict = field(default_factory=dict)
    strip: dict = field(default_factory=dict)
    closure: dict = field(default_factory=dict)
    quality_sigma: float = 12.0
    most_fraction: float = 0.04
    most_cycles: float = 2.0
    stable_percentile: float = 40.0
    detrend: detrending.DetrendSettings = detrending.DetrendSettings()
    fit_edge_guard: int = 0
    output_edge_guard: int = 0
    border_fraction: float = 0.0
    reference_window: int = 5
    reference_count: int = 5
    most_days: int = 12
    wavelength: float = 0.056
    sign: float = 1.0
    allow_bridges: bool = True
    mask_percentile: float = 85.0
    mask_least: float = 0.02
    mask_min_pixels: int = 80
    mask_radius: int = 6


def _kinds(df: DataFrame) -> str:
    return ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in KEYS)


def filter_stage(pixels: DataFrame, s: PipelineSettings = PipelineSettings()) -> DataFrame:
    """Filters (KEYS, row, col, re, im, coh); ``coh`` becomes the phase concentration, ``raw_coh`` what it was."""
    mean = nonlocal_strips(pixels, tuple(KEYS), s.search, s.patch, s.bandwidth)

    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        a = image_array(frame, ["re", "im", "coh"])
        z = goldstein(np.nan_to_num(a["re"] + 1j * a["im"]), a["coh"], s.goldstein_strength)
        at = (frame["row"].to_numpy(int), frame["col"].to_numpy(int))
        out = frame[[*KEYS, "row", "col"]].copy()
        for n, v in (("re", z.real), ("im", z.imag)):
            out[n] = nullable(v[at])
        return out.assign(coh=frame["concentration"].to_numpy(), raw_coh=frame["coh"].to_numpy())

    return mean.drop("support").groupBy(*KEYS).applyInPandas(run, f"{_kinds(pixels)}, row int, col int, re double, im double, coh double, raw_coh double")


def unwrap_stage(pixels: DataFrame, water: DataFrame | None = None, s: PipelineSettings = PipelineSettings()) -> DataFrame:
    """Unwraps and repairs (KEYS, row, col, phase, coh), water masked first: adds ``unwrapped`` and ``cycles``.

    Every image is one task: unwrapping, then the repairs of plateaus, regions and strips.
    """
    if water is not None:
        pixels = masks.mask_water(pixels, water, ["phase", "coh"])

    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        a = image_array(frame, ["phase", "coh"])
        out, cycles, cuts, _ = unwrap_image(a["phase"], a["coh"], s.threshold, s.longest_cut)
        for repair in (lambda x: region_repair.repair_plateaus(x, **s.plateau), lambda x: region_repair.repair_regions(x, a["coh"], cuts, **s.region), lambda x: region_repair.repair_strips(x, a["coh"], **s.strip)):
            out, shift, _ = repair(out)
            cycles = cycles + shift
        at = (frame["row"].to_numpy(int), frame["col"].to_numpy(int))
        return frame[[*KEYS, "row", "col", "phase", "coh"]].assign(unwrapped=nullable(out[at]), cycles=cycles[at].astype("int32"))

    return pixels.select(*KEYS, "row", "col", "phase", "coh").groupBy(*KEYS).applyInPandas(run, f"{_kinds(pixels)}, row int, col int, phase double, coh double, unwrapped double, cycles int")


def quality_stage(unwrapped: DataFrame, s: PipelineSettings = PipelineSettings()) -> tuple[DataFrame, DataFrame]:
    """Closure repair over the whole network, then exclusion of outliers that leaves all dates connected.

    Returns the kept pixels (``phase`` is the repaired one) and the report of all pairs.
    """
    stack = unwrapped.select("dataset", "first", "second", "row", "col", F.col("unwrapped").alias("phase"), "coh")
    fixed = repair_closure_stack(stack, **s.closure).join(unwrapped.select(*KEYS, "row", "col", "coh"), [*KEYS, "row", "col"])

    def measure(key, frame: pd.DataFrame) -> pd.DataFrame:
        x = image_array(frame, ["repaired"])["repaired"]
        valid = np.isfinite(x)
        if not valid.any():
            return pd.DataFrame([(*key, 1.0, float("inf"))], columns=[*KEYS, "fraction", "range_cycles"])
        off = np.abs(x - smooth_valid(x, valid, s.quality_sigma))[valid] / (2 * np.pi)
        low, high = np.percentile(x[valid], [1, 99])
        return pd.DataFrame([(*key, float((off >= 0.45).mean()), float(high - low) / (2 * np.pi))], columns=[*KEYS, "fraction", "range_cycles"])

    rows = fixed.select(*KEYS, "row", "col", "repaired").groupBy(*KEYS).applyInPandas(measure, f"{_kinds(unwrapped)}, fraction double, range_cycles double").collect()
    out = []
    for name in sorted({r["dataset"] for r in rows}):
        mine = sorted((r for r in rows if r["dataset"] == name), key=lambda r: (r["first"], r["second"]))
        status = network.safe_exclusion([(r["first"], r["second"]) for r in mine], [(r["fraction"], r["range_cycles"]) for r in mine], s.most_fraction, s.most_cycles)
        out += [(name, r["first"], r["second"], r["fraction"], r["range_cycles"], st, not st.startswith("excluded")) for r, st in zip(mine, status)]
    report = unwrapped.sparkSession.createDataFrame(out, f"{_kinds(unwrapped)}, spatial_residual_fraction double, robust_phase_range_cycles double, status string, included boolean")
    kept = fixed.join(F.broadcast(report.where("included").select(*KEYS)), KEYS).select(*KEYS, "row", "col", F.col("repaired").alias("phase"), "coh")
    return kept, report.withColumn("pair", pair_text(F.col("first"), F.col("second")))


def _on(df: DataFrame) -> list[str]:
    """Columns by which a table of pixels, of one dataset or of several, joins others."""
    return [c for c in ("dataset", "row", "col") if c in df.columns]


def fit_pixels(image: DataFrame, shape: tuple[int, int], exclude: DataFrame | None = None, s: PipelineSettings = PipelineSettings()) -> DataFrame:
    """(dataset, row, col, valid_fraction, temporal_mad, stable, exclude): stable pixels off the edge guard and, if
    asked for, in the border only; ``exclude`` where deformation was found."""
    row, col = F.col("row"), F.col("col")
    pixel = stats.stable_pixels(image, percentile=s.stable_percentile, by=("dataset",))
    if s.fit_edge_guard > 0:
        pixel = pixel.withColumn("stable", F.col("stable") & ~masks.edge_guard(row, col, *shape, s.fit_edge_guard))
    if s.border_fraction > 0:
        pixel = pixel.withColumn("stable", F.col("stable") & masks.border_fit(row, col, *shape, s.border_fraction))
    if exclude is None:
        return pixel.withColumn("exclude", F.lit(False))
    moving = exclude.where("moving").select(*_on(exclude), F.lit(True).alias("exclude"))
    return pixel.join(moving, _on(exclude), "left").withColumn("exclude", F.coalesce("exclude", F.lit(False)))


def reference_stage(image: DataFrame, pixel: DataFrame, shape: tuple[int, int], region: DataFrame | None = None, s: PipelineSettings = PipelineSettings()) -> DataFrame:
    """Reference pixels of each dataset, inside the region's pixels (row, col, inside) if there is one."""
    candidate = pixel.withColumn("stable", F.col("stable") & ~F.col("exclude"))
    if region is not None:
        inside = region.where("inside").select(*_on(region), F.lit(True).alias("in__"))
        candidate = candidate.join(inside, _on(region), "left").withColumn("stable", F.col("stable") & F.col("in__").isNotNull()).drop("in__")
    coherent = candidate.join(stats.mean_coherence(image, ("dataset",)), ["dataset", "row", "col"])
    return detrending.reference_pixels(coherent, shape, s.reference_window, s.reference_count, ("dataset",))


def detrend_stage(pixels: DataFrame, shape: tuple[int, int], elevation: DataFrame | None = None, exclude: DataFrame | None = None, s: PipelineSettings = PipelineSettings(), region: DataFrame | None = None, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Detrends the images of all datasets over their stable pixels and zeroes them at the reference; pixels (with
    ``surface``, what was taken off, offset included) and reports.

    The stable pixels are found before the output's edge guard is masked.  Every image is fitted once; with a
    ``folder`` the fitted images, with the layers they were taken apart into, are written there as ``fitted``, for
    both results to be read from.
    """
    image = pixels.withColumn("image", F.concat_ws("|", *(F.col(k).cast("string") for k in KEYS)))
    pixel = fit_pixels(image, shape, exclude, s)
    outer = masks.edge_guard(F.col("row"), F.col("col"), *shape, s.output_edge_guard) if s.output_edge_guard > 0 else F.lit(False)
    image = image.withColumn("phase", F.when(~outer, F.col("phase")))
    reference = reference_stage(image, pixel, shape, region, s)
    ready = image.join(pixel.select("dataset", "row", "col", F.col("stable").cast("double").alias("fit"), F.col("exclude").cast("double").alias("exclude")), ["dataset", "row", "col"])
    if elevation is not None:
        ready = ready.join(elevation.select(*_on(elevation), "elev"), _on(elevation), "left")
    flat = detrending.detrend_with_reports(ready.select(*(c for c in ("image", "row", "col", "phase", "elev", "fit", "exclude") if c in ready.columns)), s.detrend, layers=True)
    if folder:
        flat.write.mode("overwrite").parquet(f"{folder}/fitted")
        flat = pixels.sparkSession.read.parquet(f"{folder}/fitted")
    names = image.select("image", *KEYS).distinct()
    fitted = flat.drop("report", "orbit", "terrain", "turbulent", "fitted").withColumnRenamed("detrended", "phase").join(names, "image")
    zeroed = detrending.zero_to_reference(fitted, reference, by=("dataset",)).withColumn("surface", F.col("surface") + F.col("reference_offset"))
    reports = flat.where("report IS NOT NULL").select("image", "report.*").join(names, "image")
    offsets = zeroed.groupBy("image").agg(F.max("reference_offset").alias("reference_offset_rad"))
    return zeroed.select(*KEYS, "row", "col", "phase", "surface"), reports.join(offsets, "image").drop("image").withColumn("pair", pair_text(F.col("first"), F.col("second")))


def timeseries_stage(pixels: DataFrame, quality: DataFrame | None = None, s: PipelineSettings = PipelineSettings()) -> tuple[DataFrame, list[network.Edge], list[date]]:
    """Displacements of one dataset from its selected network; pixels, edges and dates."""
    found = pixels.select("first", "second").distinct().withColumn("pair", pair_text(F.col("first"), F.col("second")))
    rows = sorted((network.attach_quality(found, quality) if quality is not None else found).collect(), key=lambda r: (r["first"], r["second"]))
    edges = network.select_network([(r["first"], r["second"]) for r in rows], s.most_days, [r.asDict() for r in rows] if quality is not None else None)
    if not s.allow_bridges:
        network.require_quality(edges)
    used = [e for e in edges if e.selected]
    dates = sorted({d for e in edges for d in (e.first, e.second)})
    pairs = [(e.first, e.second) for e in used]
    obs = inversion.observations(pixels, ["row", "col"], pairs)
    return inversion.invert(obs, pairs, dates, s.wavelength, s.sign, [e.weight for e in used]), edges, dates


def run_summary(edges: list[network.Edge], dates: list[date], s: PipelineSettings) -> dict:
    return {"dates": [d.isoformat() for d in dates], "edges": [asdict(e) for e in edges], "redundant_cycles": network.redundancy(edges), "danger_bridges": len(network.danger_bridges(edges)), "settings": asdict(s)}


def run_pipeline(pixels: DataFrame, shape: tuple[int, int], folder: str, water: DataFrame | None = None, elevation: DataFrame | None = None, s: PipelineSettings = PipelineSettings(), region: DataFrame | None = None, skip: frozenset[str] = frozenset()) -> dict:
    """All stages for one dataset of complex pixels (KEYS, row, col, re, im, coh); tables are written under ``folder``,
    their reports as CSV beside them.

    A preliminary inversion of the unwrapped stack marks deformation, which the detrending then leaves out.
    ``skip``: "filtering" takes the pixels as they are, "unwrapping" and "detrending" take the tables of an earlier
    run, "mask" marks no deformation, "timeseries" ends before the inversion.
    """
    spark = pixels.sparkSession

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    if "unwrapping" not in skip:
        filtered = pixels if "filtering" in skip else stored(filter_stage(pixels, s), "filtered")
        filtered = filtered.withColumn("phase", F.when(F.hypot("re", "im") > 0, F.atan2("im", "re")))
        kept, qc = quality_stage(stored(unwrap_stage(filtered, water, s), "unwrapped"), s)
        stored(kept, "repaired")
        write_report(stored(qc, "quality").drop("included"), f"{folder}/quality_csv", overwrite=True)
    kept, qc = spark.read.parquet(f"{folder}/repaired"), spark.read.parquet(f"{folder}/quality")
    moving = None
    if "mask" not in skip:
        first, _, _ = timeseries_stage(kept, None, s)
        moving = stored(points.deformation_mask(first.select("row", "col", "velocity"), s.mask_percentile, s.mask_least, s.mask_min_pixels, s.mask_radius), "moving")
    if "detrending" not in skip:
        flat, reports = detrend_stage(kept, shape, elevation, moving, s, region, folder)
        stored(flat, "detrended")
        write_report(stored(reports, "detrending"), f"{folder}/detrending_csv", overwrite=True)
    if "timeseries" in skip:
        return run_summary([], [], s)
    quality = network.edge_quality(qc, spark.read.parquet(f"{folder}/detrending").select("pair", "accepted"))
    series, edges, dates = timeseries_stage(spark.read.parquet(f"{folder}/detrended"), quality, s)
    stored(series, "series")
    return run_summary(edges, dates, s)
