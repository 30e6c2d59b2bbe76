"""Removal of orbit and terrain surfaces from unwrapped images, and the reference that zeroes them.

Surfaces of few, well-conditioned terms are fitted from sums over the cluster (``fit_surfaces``).  The full
chain, whose terrain bases are nearly dependent, solves by least squares in one task an image.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, fields

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import images
from .rasters import image_array, nullable
from .stats import with_group_value


def _cut(df: DataFrame) -> DataFrame:
    """``df`` without its lineage where the session names a shared folder for that."""
    return df.checkpoint() if df.sparkSession.sparkContext.getCheckpointDir() else df


def _solver(n: int):
    """Weights from the sums of normal equations, one row an image; null where they are singular or too few."""

    @F.pandas_udf("array<double>")
    def solve(count: pd.Series, sums: pd.Series) -> pd.Series:
        upper = np.triu_indices(n)
        out = []
        for k, row in zip(count, sums):
            a, b = np.zeros((n, n)), np.array(row[len(upper[0]) :], float)
            a[upper] = np.array(row[: len(upper[0])], float)
            a = a + np.triu(a, 1).T
            out.append(np.linalg.solve(a, b).tolist() if k >= 3 * n and np.linalg.matrix_rank(a) == n else None)
        return pd.Series(out)

    return solve


def fit_surfaces(pixels: DataFrame, terms: list[Column], fit: Column, mad_scale: float = 3.5, iterations: int = 5, value: str = "phase", keys: tuple[str, ...] = ("image",)) -> DataFrame:
    """Adds ``surface``, the robust least-squares combination of ``terms`` over each image's fit pixels.

    Each round sums the normal equations of the pixels kept (a few numbers an image, solved where they are
    summed), and then keeps the fit pixels whose residual is within ``mad_scale`` robust deviations of the median
    of those kept so far; a last solve uses the pixels kept.  Images that begin with under three pixels a term,
    or with singular sums, get a null surface.  Nothing is collected; a round's state is cut from its lineage.
    """
    keys, n = list(keys), len(terms)
    state = pixels.withColumns({f"t{i}__": t for i, t in enumerate(terms)} | {"fit__": F.coalesce(fit & F.col(value).isNotNull(), F.lit(False))}).withColumn("keep__", F.col("fit__"))
    products = [F.col(f"t{i}__") * F.col(f"t{j}__") for i in range(n) for j in range(i, n)] + [F.col(f"t{i}__") * F.col(value) for i in range(n)]

    def solved(df: DataFrame) -> DataFrame:
        sums = df.where("keep__").groupBy(*keys).agg(F.count(F.lit(1)).alias("n__"), F.array(*(F.sum(p) for p in products)).alias("s__"))
        weights = sums.select(*keys, _solver(n)("n__", "s__").alias("w__"))
        total = sum((F.col(f"t{i}__") * F.col("w__")[i] for i in range(n)), F.lit(0.0))
        return df.join(weights, keys, "left").withColumn("surface", total).drop("w__")

    for _ in range(iterations):
        left = solved(state).withColumn("rest__", F.col(value) - F.col("surface"))
        left = with_group_value(left, keys, F.median(F.when(F.col("keep__"), F.col("rest__"))), "middle__").withColumn("far__", F.abs(F.col("rest__") - F.col("middle__")))
        left = with_group_value(left, keys, F.lit(1.4826) * F.median(F.when(F.col("keep__"), F.col("far__"))), "scale__")
        near = (F.col("far__") <= F.lit(mad_scale) * F.col("scale__")) | (F.col("scale__") <= 1e-10)
        state = _cut(left.withColumn("keep__", F.col("fit__") & F.coalesce(near, F.lit(False))).drop("surface", "rest__", "middle__", "far__", "scale__"))
    return solved(state).select(*pixels.columns, "surface", F.col("keep__").alias("fitted"))


@dataclass(frozen=True)
class DetrendSettings:
    degree: int = 1
    orbit_model: str = "plane"
    mad_scale: float = 3.5
    iterations: int = 5
    preserve_median: bool = False
    terrain_degree: int = 2
    terrain_method: str = "spatial"
    terrain_bins: int = 30
    terrain_min_bin: int = 100
    terrain_radius: int = 80
    terrain_strength: float = 0.3
    terrain_range_fraction: float = 0.6
    guard_block: int = 96
    guard_tolerance: float = 0.15
    guard_least: int = 200
    turbulence_radius: int = 60


@dataclass(frozen=True)
class DetrendReport:
    accepted: bool
    orbit_accepted: bool
    terrain_accepted: bool
    valid_pixels: int
    initial_fit_pixels: int
    final_fit_pixels: int
    orbit_iterations: int
    terrain_iterations: int
    terrain_method: str
    terrain_bins_used: int
    terrain_local_worst_ratio: float
    terrain_local_bad_blocks: int
    terrain_local_blocks: int
    before_robust_std_rad: float
    after_robust_std_rad: float
    correction_range_rad: float
    orbit_range_rad: float
    terrain_range_rad: float
    turbulent_range_rad: float
    terrain_enabled: bool
    terrain_degree: int
    correlation_before: float
    correlation_after: float


def _orbit_design(shape: tuple[int, int], model: str, degree: int) -> np.ndarray:
    one, x, y, xx, xy, yy = images.quadratic_terms(shape).T
    edge = np.maximum((x - 0.35) / 0.65, 0)
    models = {
        "constant": [one],
        "plane": [one, x, y],
        "range_quadratic": [one, x, y, xx],
        "range_cubic": [one, x, y, xx, xx * x],
        "azimuth_quadratic": [one, x, y, yy],
        "additive_quadratic": [one, x, y, xx, yy],
        "full_quadratic": [one, x, y, xx, xy, yy],
        "right_edge_quadratic": [one, x, y, edge**2, edge**3],
        "degree": [one, x, y, xx, xy, yy][: (1, 3, 6)[degree]],
    }
    if model not in models:
        raise ValueError(f"unknown orbit model: {model}")
    return np.stack(models[model], axis=1)


def robust_surface(values: np.ndarray, design: np.ndarray, fit: np.ndarray, mad_scale: float = 3.5, iterations: int = 5) -> tuple[np.ndarray, np.ndarray, int]:
    """Surface, pixels kept and rounds: all candidates are tested again in every round, against those kept."""
    z = values.ravel()
    candidates = fit.ravel() & np.isfinite(z) & np.isfinite(design).all(axis=1)
    if candidates.sum() < 3 * design.shape[1]:
        raise ValueError("too few pixels to fit a surface")

    def solve(keep: np.ndarray) -> np.ndarray:
        return design @ np.linalg.lstsq(design[keep], z[keep], rcond=None)[0]

    keep, rounds, settled = candidates, 0, False
    while rounds < iterations and not settled:
        rounds += 1
        rest = z - solve(keep)
        scale = images.robust_std(rest[keep])
        near = candidates if scale <= 1e-10 else candidates & (np.abs(rest - np.median(rest[keep])) <= mad_scale * scale)
        settled, keep = np.array_equal(near, keep), near
    return solve(keep).reshape(values.shape), keep.reshape(values.shape), rounds


def _range(x: np.ndarray, mask: np.ndarray) -> float:
    x = x[mask & np.isfinite(x)]
    return float(np.subtract(*np.percentile(x, [98, 2]))) if x.size else float("nan")


def _enough(h: np.ndarray, pixels: int, bins: int, least_bins: int) -> None:
    """Raises where there are too few pixels, or their elevations fall into too few bins."""
    if h.size < max(10, pixels):
        raise ValueError("too few pixels for a fit over elevation bins")
    if len(np.unique(np.percentile(h, np.linspace(0, 100, max(3, bins) + 1)))) <= least_bins:
        raise ValueError("the elevation varies too little for bins")


def bin_medians(h: np.ndarray, z: np.ndarray, bins: int, least: int) -> np.ndarray:
    """(bin, 3): median elevation, median phase and count of the bins between elevation quantiles."""
    edges = np.unique(np.percentile(h, np.linspace(0, 100, max(3, bins) + 1)))
    at = np.minimum(np.searchsorted(edges, h, side="right") - 1, len(edges) - 2)
    out = [(np.median(h[at == k]), np.median(z[at == k]), n) for k, n in enumerate(np.bincount(at, minlength=max(1, len(edges) - 1))) if n and n >= least]
    return np.array(out, float).reshape(-1, 3)


def _terrain(values: np.ndarray, h: np.ndarray, fit: np.ndarray, s: DetrendSettings) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Terrain surface, pixels fitted, rounds and bins (or pixels) used, by the settings' method."""
    one, x, y, xx, xy, yy = images.quadratic_terms(values.shape).T
    g = h.ravel()
    known = fit & np.isfinite(values) & np.isfinite(h)
    if s.terrain_method in ("spatial", "pixel"):
        terms = [g, g * g][: s.terrain_degree]
        if s.terrain_method == "spatial":
            terms = [g, g * x, g * y] + ([g * xx, g * xy, g * yy, g * g] if s.terrain_degree >= 2 else [])
        surface, mask, rounds = robust_surface(values, np.stack(terms, axis=1), known, s.mad_scale, s.iterations)
        return surface, mask, rounds, 0
    if s.terrain_method == "binned":
        _enough(h[known], (s.terrain_degree + 1) * s.terrain_min_bin, s.terrain_bins, s.terrain_degree + 1)
        table = bin_medians(h[known], values[known], s.terrain_bins, s.terrain_min_bin)
        if len(table) < s.terrain_degree + 1:
            raise ValueError("too few populated elevation bins")
        powers = np.arange(1, s.terrain_degree + 1)
        w = np.sqrt(table[:, 2])
        weights = np.linalg.lstsq(table[:, :1] ** powers * w[:, None], table[:, 1] * w, rcond=None)[0]
        return (g[:, None] ** powers @ weights).reshape(h.shape), known, 1, len(table)

    def curve() -> tuple[np.ndarray, int]:
        _enough(h[known], 3 * s.terrain_min_bin, s.terrain_bins, 3)
        table = bin_medians(h[known], values[known], s.terrain_bins, s.terrain_min_bin)
        if len(table) < 3:
            raise ValueError("too few populated elevation bins")
        table = table[table[:, 0].argsort(kind="stable")]
        out = np.interp(g, table[:, 0], table[:, 1]).reshape(h.shape)
        return np.where(np.isfinite(values), out - np.median(out[known]), np.nan), len(table)

    def slope(rest: np.ndarray) -> tuple[np.ndarray, int]:
        if known.sum() < 100:
            raise ValueError("too few pixels for a local terrain fit")
        up, down = (images.nan_mean(np.where(known, a, np.nan), s.terrain_radius, 2) for a in (h * rest, h * h))
        beta = np.where(np.abs(down) > 1e-10, up / np.where(np.abs(down) > 1e-10, down, 1), np.nan)
        fine = np.isfinite(beta)
        if fine.sum() < 100:
            raise ValueError("too few local slopes")
        most = np.percentile(np.abs(beta[fine]), 98)
        beta = images.nan_mean(np.clip(beta, -most, most) if most > 0 else beta, s.terrain_radius)
        return np.where(np.isfinite(values), beta * h, np.nan), int(fine.sum())

    if s.terrain_method == "local":
        surface, used = slope(values)
        return surface, known, 1, used
    if s.terrain_method == "hybrid":
        low, bins = curve()
        local, used = slope(values - low)
        surface = low + local
        return surface - np.nanmedian(surface[known]), known, 2, max(bins, used)
    raise ValueError(f"unknown terrain method: {s.terrain_method}")


def worsening(before: np.ndarray, after: np.ndarray, mask: np.ndarray, block: int, tolerance: float, least: int) -> tuple[float, int, int]:
    """Worst ratio of robust spreads over square blocks, blocks that grew beyond tolerance, blocks measured."""
    ratios = []
    for r in range(0, before.shape[0], block):
        for c in range(0, before.shape[1], block):
            here = (slice(r, r + block), slice(c, c + block))
            use = mask[here] & np.isfinite(before[here]) & np.isfinite(after[here])
            if use.sum() >= least and (b := images.robust_std(before[here][use])) > 1e-10:
                ratios.append(images.robust_std(after[here][use]) / b)
    return max([1.0, *ratios]), sum(x > 1 + tolerance for x in ratios), len(ratios)


def detrend_image(image: np.ndarray, elevation: np.ndarray | None = None, fit: np.ndarray | None = None, exclude: np.ndarray | None = None, settings: DetrendSettings = DetrendSettings()) -> tuple[np.ndarray, np.ndarray, np.ndarray, DetrendReport, dict[str, np.ndarray]]:
    """Corrected image, surface taken off, fit pixels, report and component surfaces.

    The orbit surface is taken off only if the robust spread falls; the terrain surface, scaled to at most
    ``terrain_strength`` and a fraction of the residual's range, only if it also worsens no block.
    """
    s, z = settings, np.asarray(image, float)
    valid = np.isfinite(z)
    allowed = valid if exclude is None else valid & ~exclude
    use = allowed if fit is None else allowed & fit
    terrain_on = elevation is not None and s.terrain_degree > 0
    if terrain_on:
        elevation = np.asarray(elevation, float)
        if elevation.shape != z.shape:
            raise ValueError("elevation and phase differ in shape")
        use = use & np.isfinite(elevation)
    initial = int(use.sum())
    orbit, mask, rounds = robust_surface(z, _orbit_design(z.shape, s.orbit_model, s.degree), use, s.mad_scale, s.iterations)
    if s.preserve_median:
        orbit = orbit - np.median(orbit[mask])
    before = images.robust_std(z[mask])
    orbit_ok = images.robust_std((z - orbit)[mask]) < before
    if not orbit_ok:
        orbit, mask = np.zeros_like(z), use
    flat = z - orbit
    terrain, terrain_ok, terrain_rounds, bins_used, guard = np.zeros_like(z), False, 0, 0, (float("nan"), 0, 0)
    final, h = mask, None
    if terrain_on:
        scale = float(np.std(elevation[use]))
        if scale < 1e-10:
            raise ValueError("the elevation does not vary")
        h = (elevation - np.median(elevation[use])) / scale
        surface, terrain_mask, terrain_rounds, bins_used = _terrain(flat, h, mask, s)
        if not np.isfinite(s.terrain_strength) or s.terrain_strength < 0:
            raise ValueError("terrain_strength must be a finite number, 0 or more")
        factor, wide, rest = min(s.terrain_strength, 1.0), _range(surface, terrain_mask), _range(flat, terrain_mask)
        if wide > 1e-10 and rest > 0 and s.terrain_range_fraction > 0:
            factor = min(factor, s.terrain_range_fraction * rest / wide)
        surface = surface * factor
        guard = worsening(flat, flat - surface, allowed, s.guard_block, s.guard_tolerance, s.guard_least)
        terrain_ok = bool(images.robust_std((flat - surface)[terrain_mask]) < images.robust_std(flat[terrain_mask])) and not guard[1]
        if terrain_ok:
            terrain, final = surface, terrain_mask
    out = flat - terrain
    correlation = [float("nan")] * 2
    if terrain_on:
        both = final & np.isfinite(h)
        if both.sum() >= 3:
            correlation = [0.0 if k and images.robust_std(v[both]) < 1e-10 else float(np.corrcoef(v[both], h[both])[0, 1]) for k, v in enumerate((flat, out))]
    rough = np.full_like(z, np.nan)
    if s.turbulence_radius > 0:
        rough = np.where(valid, images.nan_mean(np.where(final, out, np.nan), s.turbulence_radius, 3), np.nan)
    orbit, terrain, out = (np.where(valid, a, np.nan) for a in (orbit, terrain, out))
    report = DetrendReport(
        bool(orbit_ok or terrain_ok), bool(orbit_ok), terrain_ok, int(valid.sum()), initial, int(final.sum()), rounds, terrain_rounds, s.terrain_method, bins_used, *guard,
        before, images.robust_std(out[final]), _range(orbit + terrain, valid), _range(orbit, valid), _range(terrain, valid), _range(rough, valid), terrain_on, s.terrain_degree if terrain_on else 0, *correlation,
    )
    parts = {"orbit": orbit, "terrain": terrain, "turbulent": rough, "after_orbit": flat, "after_terrain": out, "after_turbulent": out - rough}
    return out, orbit + terrain, final, report, parts


def _kind(f) -> str:
    return {"bool": "boolean", "int": "long", "float": "double", "str": "string"}[f.type]


_REPORT = ", ".join(f"{f.name} {_kind(f)}" for f in fields(DetrendReport)) + ", status string"


def detrend_with_reports(pixels: DataFrame, settings: DetrendSettings = DetrendSettings(), layers: bool = False) -> DataFrame:
    """Detrends each image of (image, row, col, phase, elev[, fit, exclude]): adds ``detrended``, ``surface``, and
    on one row an image its ``report``.  With ``layers`` the parts come along: ``orbit``, ``terrain``, ``turbulent``
    (what lies left after ``surface`` and is smooth), and whether a pixel was ``fitted``.

    An image that cannot be fitted (too few pixels, a flat elevation) stays, with null results and the reason as
    its report's ``status``, which is "ok" otherwise.
    """
    names = [f.name for f in fields(DetrendReport)]

    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        given = [c for c in ("phase", "elev", "fit", "exclude") if c in frame.columns]
        a = image_array(frame, given)
        try:
            out, surface, final, report, part = detrend_image(a["phase"], a.get("elev"), a["fit"] == 1 if "fit" in a else None, a["exclude"] == 1 if "exclude" in a else None, settings)
            report = {k: None if isinstance(v, float) and np.isnan(v) else v for k, v in asdict(report).items()} | {"status": "ok"}
        except ValueError as e:
            out = surface = np.full(a["phase"].shape, np.nan)
            final, part = np.zeros(out.shape, bool), dict.fromkeys(("orbit", "terrain", "turbulent"), out)
            report = dict.fromkeys(names) | {"accepted": False, "orbit_accepted": False, "terrain_accepted": False, "valid_pixels": int(np.isfinite(a["phase"]).sum()), "status": str(e)}
        at = (frame["row"].to_numpy(int), frame["col"].to_numpy(int))
        cols = {n: nullable(x[at]) for n, x in (("detrended", out), ("surface", surface))}
        if layers:
            cols |= {n: nullable(part[n][at]) for n in ("orbit", "terrain", "turbulent")} | {"fitted": final[at]}
        return pd.DataFrame({"image": key[0], "row": frame["row"], "col": frame["col"]} | cols | {"report": [report] + [None] * (len(frame) - 1)})

    kind = pixels.schema["image"].dataType.simpleString()
    report = ", ".join(f"{x.split()[0]}: {x.split()[1]}" for x in _REPORT.split(", "))
    more = "orbit double, terrain double, turbulent double, fitted boolean, " if layers else ""
    return pixels.groupBy("image").applyInPandas(run, f"image {kind}, row int, col int, detrended double, surface double, {more}report struct<{report}>")


def detrend(pixels: DataFrame, settings: DetrendSettings = DetrendSettings()) -> DataFrame:
    """(image, row, col, detrended, surface) of ``detrend_with_reports``."""
    return detrend_with_reports(pixels, settings).drop("report")


def detrend_reports(pixels: DataFrame, settings: DetrendSettings = DetrendSettings()) -> DataFrame:
    """One row of statistics per image."""
    return detrend_with_reports(pixels, settings).where("report IS NOT NULL").select("image", "report.*")


def reference_pixels(pixel: DataFrame, shape: tuple[int, int], window: int = 5, count: int = 5, by: tuple[str, ...] = ()) -> DataFrame:
    """The best reference pixels (by, row, col, score, representative); none where fewer than five qualify.

    ``pixel`` has (by, row, col, valid_fraction, temporal_mad, stable[, mean_coherence]).  Score: coherence less a
    quarter of the dispersion over its 95th percentile, or less the whole without coherence; ties by row and
    column.  Representative: the first of the best 2000 with enough stable pixels around it.
    """
    radius = max(1, window // 2)
    coherent = "mean_coherence" in pixel.columns
    ok = F.col("stable") & F.col("temporal_mad").isNotNull() & (F.col("valid_fraction") >= 0.8) & F.col("row").between(radius, shape[0] - 1 - radius) & F.col("col").between(radius, shape[1] - 1 - radius)
    if coherent:
        ok = ok & (F.col("mean_coherence") > 0)
    near = pixel
    for axis, other in (("row", "col"), ("col", "row")):
        w = Window.partitionBy(*by, other).orderBy(axis).rangeBetween(-radius, radius)
        near = near.withColumn("near", F.sum(F.col("near") if "near" in near.columns else F.col("stable").cast("int")).over(w))
    candidates = near.where(F.coalesce(ok, F.lit(False))).withColumn("all__", F.lit(0))
    group = ["all__", *by]
    candidates = candidates.join(candidates.groupBy(*group).agg(F.percentile("temporal_mad", F.lit(0.95)).alias("scale__"), F.count(F.lit(1)).alias("n__")), group)
    part = F.col("temporal_mad") / F.when(F.col("scale__") > 0, F.col("scale__")).otherwise(1.0)
    candidates = candidates.where("n__ >= 5").withColumn("score", F.col("mean_coherence") - F.lit(0.25) * part if coherent else -part)
    # Only the best of each task reach the ranking.
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("score"), "row", "col"))
    ranked = candidates.withColumn("rank__", rank).where(F.col("rank__") <= max(2000, count))
    least = max(5, (2 * radius + 1) ** 2 // 2)
    fine = F.when((F.col("near") >= least) & (F.col("rank__") <= 2000), F.col("rank__"))
    ranked = ranked.withColumn("best__", F.min(fine).over(Window.partitionBy(*group)))
    representative = F.col("rank__") == F.col("best__")
    return ranked.where(F.col("best__").isNotNull() & ((F.col("rank__") <= max(5, count)) | representative)).select(*by, "row", "col", "score", representative.alias("representative"))


def zero_to_reference(pixels: DataFrame, reference: DataFrame | None, column: str = "phase", by: tuple[str, ...] = ()) -> DataFrame:
    """Takes off each image's median over the reference pixels (0 where it has none); adds ``reference_offset``."""
    if reference is None:
        return pixels.withColumn("reference_offset", F.lit(0.0))
    offset = pixels.join(F.broadcast(reference.select(*by, "row", "col")), [*by, "row", "col"], "left_semi").groupBy("image").agg(F.median(column).alias("reference_offset"))
    out = pixels.join(offset, "image", "left").withColumn("reference_offset", F.coalesce("reference_offset", F.lit(0.0)))
    return out.withColumn(column, F.col(column) - F.col("reference_offset"))
