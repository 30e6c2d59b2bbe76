"""Queries over the whole-image kernels, the robust fits, sources and sinks.

Their SQL works the result out by itself (robust fits by Gram-Schmidt in windows, filters by sums over pixels,
spectra by their definition), or is the clean image that a repair has to restore.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import phase as fx
from ..operators import closure, detrending, filtering, images, network, points, rasters, region_repair, stats, unwrapping
from ..sources import gamma, geotiff, vector
from .queries import ORACLE_SQL, QUERIES, SIDE, H, S, T, _boxed, _complex, flagship, query, r6
from .views import geolocation, hollow, stack, tiles, with_elevation

__all__ = ["ORACLE_SQL", "QUERIES", "flagship"]

_W = "OVER (PARTITION BY image)"


# Robust fits in SQL.

def _fitted(source: str, terms: list[str], keep: str, z: str) -> str:
    """Adds ``surface``: least squares of the terms over the rows kept, the terms being made orthogonal one by one."""
    out = f"(SELECT *, {', '.join(f'({t})::DOUBLE AS t{k}' for k, t in enumerate(terms))} FROM {source})"
    for k in range(len(terms)):
        taken = "".join(f" - q{j} * (sum(t{k} * q{j}) FILTER (WHERE {keep}) {_W}) / (sum(q{j} * q{j}) FILTER (WHERE {keep}) {_W})" for j in range(k))
        out = f"(SELECT *, t{k}{taken} AS q{k} FROM {out})"
    total = " + ".join(f"q{k} * (sum({z} * q{k}) FILTER (WHERE {keep}) {_W}) / (sum(q{k} * q{k}) FILTER (WHERE {keep}) {_W})" for k in range(len(terms)))
    gone = ", ".join(f"t{k}, q{k}" for k in range(len(terms)))
    return f"(SELECT * EXCLUDE ({gone}), {total} AS surface FROM {out})"


def _spread(source: str, x: str, mask: str, name: str) -> str:
    """Adds the robust deviation of ``x`` over the masked rows of each image."""
    out = f"(SELECT *, median(CASE WHEN {mask} THEN {x} END) {_W} AS middle_ FROM {source})"
    return f"(SELECT * EXCLUDE (middle_), 1.4826 * median(CASE WHEN {mask} THEN abs({x} - middle_) END) {_W} AS {name} FROM {out})"


def _robust(source: str, terms: list[str], candidate: str, z: str, rounds: int = 5, scale: float = 3.5) -> str:
    """Adds ``surface`` and ``keep`` of the robust fit."""
    out = f"(SELECT *, coalesce({candidate}, false) AS keep FROM {source})"
    for _ in range(rounds):
        out = f"(SELECT * EXCLUDE (surface), {z} - surface AS rest FROM {_fitted(out, terms, 'keep', z)})"
        out = f"(SELECT *, median(CASE WHEN keep THEN rest END) {_W} AS mid FROM {_spread(out, 'rest', 'keep', 'dev')})"
        out = f"(SELECT * EXCLUDE (rest, mid, dev) REPLACE (coalesce({candidate} AND (dev <= 1e-10 OR abs(rest - mid) <= {scale} * dev), false) AS keep) FROM {out})"
    return _fitted(out, terms, "keep", z)


def _grid(source: str, side: int = SIDE) -> str:
    return f"(SELECT *, 2.0::DOUBLE * col / {side - 1} - 1 AS x, 2.0::DOUBLE * row / {side - 1} - 1 AS y FROM {source})"


#: Terms of the orbit models.
_EDGE = "greatest((x - 0.35) / 0.65, 0)"
_MODELS = {
    "constant": ["1"],
    "plane": ["1", "x", "y"],
    "range_quadratic": ["1", "x", "y", "x * x"],
    "range_cubic": ["1", "x", "y", "x * x", "x * x * x"],
    "azimuth_quadratic": ["1", "x", "y", "y * y"],
    "additive_quadratic": ["1", "x", "y", "x * x", "y * y"],
    "full_quadratic": ["1", "x", "y", "x * x", "x * y", "y * y"],
    "right_edge_quadratic": ["1", "x", "y", f"pow({_EDGE}, 2)", f"pow({_EDGE}, 3)"],
    "degree0": ["1"],
    "degree1": ["1", "x", "y"],
    "degree2": ["1", "x", "y", "x * x", "x * y", "y * y"],
}


@query(" UNION ALL ".join(f"SELECT image, row, col, '{m}' AS model, round(surface, 6) + 0.0 AS surface FROM {_fitted(_grid(H), t, 'phase IS NOT NULL', 'phase')}" for m, t in _MODELS.items()))
def orbit_models(spark, d):
    """Every orbit model, fitted over the pixels that are not masked."""
    pixels = hollow(tiles(spark, d))
    x, y = fx.unit_grid(F.col("col"), SIDE), fx.unit_grid(F.col("row"), SIDE)
    out = None
    for m in _MODELS:
        terms = fx.orbit_terms(x, y, "degree", int(m[-1])) if m.startswith("degree") else fx.orbit_terms(x, y, m)
        got = detrending.fit_surfaces(pixels, terms, F.lit(True), iterations=0).select("image", "row", "col", F.lit(m).alias("model"), r6("surface").alias("surface"))
        out = got if out is None else out.union(got)
    return out


ORACLE_SQL["robust_plane_detrend"] = f"SELECT image, row, col, round(phase - surface, 6) + 0.0 AS flat, keep AS fitted FROM {_robust(_grid(H), _MODELS['plane'], 'phase IS NOT NULL', 'phase', 3)}"


# The whole chain of detrending.

def _quads(spark: SparkSession, d: str) -> DataFrame:
    """Four tiles side by side as one image of 16 x 16 pixels."""
    k = F.col("image") % 4
    return tiles(spark, d).select(F.floor(F.col("image") / 4).cast("long").alias("image"), (F.col("row") + F.floor(k / 2) * SIDE).cast("int").alias("row"), (F.col("col") + k % 2 * SIDE).cast("int").alias("col"), "phase")


QUADS = f"(SELECT (image // 4)::BIGINT AS image, (row + (image % 4) // 2 * 8)::INT AS row, (col + image % 2 * 8)::INT AS col, phase FROM {T})"


def _holed(source: str) -> str:
    return f"(SELECT image, row, col, CASE WHEN (image * 7 + row * 3 + col) % 11 <> 0 THEN phase END AS phase FROM {source})"


def _raised(source: str) -> str:
    return f"(SELECT a.*, b.phase AS elev FROM {source} a LEFT JOIN {source} b ON b.image = a.image + 1 AND b.row = a.row AND b.col = a.col)"


def _bins(source: str, bins: int, least: int) -> str:
    """(image, c, m, n) of the populated bins between elevation quantiles of the known pixels; edges are pixels
    themselves, worked out a second time, hence the tolerance."""
    steps = ", ".join(f"quantile_cont(h, {k / bins})" for k in range(bins + 1))
    edges = f"(SELECT image, [{steps}] AS edges FROM {source} WHERE known GROUP BY 1)"
    binned = f"(SELECT image, h, flat, least({bins}, len(list_filter(edges, lambda e: e <= h + 1e-9))) AS bin FROM {source} JOIN {edges} USING (image) WHERE known)"
    return f"(SELECT image, median(h) AS c, median(flat) AS m, count(*) AS n FROM {binned} GROUP BY image, bin HAVING count(*) >= {least})"


def _curve(source: str, bins: int, least: int) -> str:
    """Adds ``low``: the bins' medians, interpolated at each pixel's elevation and centred."""
    lists = f"(SELECT image, list(c ORDER BY c) AS cs, list(m ORDER BY c) AS ms FROM {_bins(source, bins, least)} GROUP BY 1)"
    out = f"(SELECT *, len(list_filter(cs, lambda e: e <= h)) AS i FROM {source} LEFT JOIN {lists} USING (image))"
    out = f"(SELECT * EXCLUDE (cs, ms, i), CASE WHEN h IS NULL OR flat IS NULL THEN NULL WHEN i = 0 THEN ms[1] WHEN i = len(cs) THEN ms[i] ELSE ms[i] + (h - cs[i]) / (cs[i + 1] - cs[i]) * (ms[i + 1] - ms[i]) END AS low FROM {out})"
    return f"(SELECT * REPLACE (low - median(CASE WHEN known THEN low END) {_W} AS low) FROM {out})"


def _slope(source: str, z: str, radius: int) -> str:
    """Adds ``local``: the elevation times its smoothed local slope."""
    out = f"(SELECT *, CASE WHEN known THEN h * ({z}) END AS up, CASE WHEN known THEN h * h END AS down FROM {source})"
    out = _boxed(_boxed(out, "up", radius, 2), "down", radius, 2)
    out = f"(SELECT * EXCLUDE (up, down), CASE WHEN abs(down) > 1e-10 THEN up / down END AS beta FROM {out})"
    out = f"(SELECT *, quantile_cont(abs(beta), 0.98) {_W} AS most FROM {out})"
    out = f"(SELECT * EXCLUDE (most) REPLACE (CASE WHEN most > 0 THEN greatest(-most, least(most, beta)) ELSE beta END AS beta) FROM {out})"
    return f"(SELECT * EXCLUDE (beta), CASE WHEN flat IS NOT NULL THEN beta * h END AS local FROM {_boxed(out, 'beta', radius, 1)})"


def _detrended(source: str, side: int, s: detrending.DetrendSettings) -> str:
    """Every pixel with what the chain makes of it, and its image's statistics."""
    out = f"(SELECT *, phase IS NOT NULL AND elev IS NOT NULL AS cand FROM {_grid(source, side)})"
    out = f"(SELECT * EXCLUDE (surface, keep), surface AS orbit, keep AS mask, phase - surface AS flat, count(*) FILTER (WHERE cand) {_W} AS initial FROM {_robust(out, _MODELS['plane'], 'cand', 'phase')})"
    out = _spread(_spread(out, "phase", "mask", "before"), "flat", "mask", "fell")
    out = f"(SELECT *, fell < before AS orbit_ok FROM {out})"
    out = f"(SELECT * REPLACE (CASE WHEN orbit_ok THEN orbit ELSE 0 END AS orbit, CASE WHEN orbit_ok THEN mask ELSE cand END AS mask, CASE WHEN orbit_ok THEN flat ELSE phase END AS flat) FROM {out})"
    out = f"(SELECT *, (elev - median(CASE WHEN cand THEN elev END) {_W}) / (stddev_pop(elev) FILTER (WHERE cand) {_W}) AS h FROM {out})"
    out = f"(SELECT *, mask AND flat IS NOT NULL AND h IS NOT NULL AS known FROM {out})"
    if s.terrain_method in ("pixel", "spatial"):
        terms = ["h", "h * h"] if s.terrain_method == "pixel" else ["h", "h * x", "h * y", "h * x * x", "h * x * y", "h * y * y", "h * h"]
        out = f"(SELECT * EXCLUDE (keep), keep AS fitted FROM {_robust(out, terms, 'known', 'flat')})"
    else:
        if s.terrain_method == "binned":
            sums = f"(SELECT image, sum(n * c * c) AS s2, sum(n * pow(c, 3)) AS s3, sum(n * pow(c, 4)) AS s4, sum(n * m * c) AS p1, sum(n * m * c * c) AS p2 FROM {_bins(out, s.terrain_bins, s.terrain_min_bin)} GROUP BY 1)"
            out = f"(SELECT * EXCLUDE (s2, s3, s4, p1, p2), ((p1 * s4 - p2 * s3) * h + (s2 * p2 - s3 * p1) * h * h) / (s2 * s4 - s3 * s3) AS surface FROM {out} LEFT JOIN {sums} USING (image))"
        elif s.terrain_method == "local":
            out = f"(SELECT * EXCLUDE (local), local AS surface FROM {_slope(out, 'flat', s.terrain_radius)})"
        else:
            out = f"(SELECT * EXCLUDE (low, local), low + local AS surface FROM {_slope(_curve(out, s.terrain_bins, s.terrain_min_bin), 'flat - low', s.terrain_radius)})"
            out = f"(SELECT * REPLACE (surface - median(CASE WHEN known THEN surface END) {_W} AS surface) FROM {out})"
        out = f"(SELECT *, known AS fitted FROM {out})"
    wide = lambda x: " - ".join(f"quantile_cont(CASE WHEN fitted THEN {x} END, {q}) {_W}" for q in (0.98, 0.02))
    out = f"(SELECT *, {wide('surface')} AS wide, {wide('flat')} AS room FROM {out})"
    out = f"(SELECT * REPLACE (surface * CASE WHEN wide > 1e-10 AND room > 0 AND {s.terrain_range_fraction} > 0 THEN least({min(s.terrain_strength, 1.0)}, {s.terrain_range_fraction} * room / wide) ELSE {min(s.terrain_strength, 1.0)} END AS surface) FROM {out})"
    cell = f"OVER (PARTITION BY image, row // {s.guard_block}, col // {s.guard_block})"
    both = "flat IS NOT NULL AND surface IS NOT NULL"
    out = f"(SELECT *, median(CASE WHEN {both} THEN flat END) {cell} AS mb, median(CASE WHEN {both} THEN flat - surface END) {cell} AS ma FROM {out})"
    out = f"(SELECT *, count(CASE WHEN {both} THEN 1 END) {cell} AS nb, 1.4826 * median(CASE WHEN {both} THEN abs(flat - mb) END) {cell} AS sb, 1.4826 * median(CASE WHEN {both} THEN abs(flat - surface - ma) END) {cell} AS sa FROM {out})"
    out = f"(SELECT *, bool_or(coalesce(nb >= {s.guard_least} AND sb > 1e-10 AND sa / sb > {1 + s.guard_tolerance}, false)) {_W} AS worse FROM {out})"
    out = _spread(_spread(out, "flat", "fitted", "rough"), "(flat - surface)", "fitted", "smooth")
    out = f"(SELECT *, smooth < rough AND NOT worse AS terrain_ok FROM {out})"
    out = f"(SELECT *, flat - CASE WHEN terrain_ok THEN surface ELSE 0 END AS detrended, CASE WHEN phase IS NOT NULL THEN orbit + CASE WHEN terrain_ok THEN surface ELSE 0 END END AS taken, CASE WHEN terrain_ok THEN fitted ELSE mask END AS final FROM {out})"
    return f"(SELECT *, initial >= 9 AS fine FROM {_spread(out, 'detrended', 'final', 'after')})"


def _detrend_sql(base: str) -> str:
    return f"SELECT image, row, col, CASE WHEN fine THEN round(detrended, 6) + 0.0 END AS detrended, CASE WHEN fine THEN round(taken, 6) + 0.0 END AS surface FROM {base}"


def _method(name: str, **more) -> detrending.DetrendSettings:
    return detrending.DetrendSettings(**{"terrain_method": name, "terrain_strength": 1.0, "guard_block": 4, "guard_least": 8, "turbulence_radius": 2, "terrain_bins": 4, "terrain_min_bin": 3, "terrain_radius": 2} | more)


def _detrend(pixels: DataFrame, s: detrending.DetrendSettings) -> DataFrame:
    return detrending.detrend(with_elevation(pixels), s).select("image", "row", "col", r6("detrended").alias("detrended"), r6("surface").alias("surface"))


_SMALL = _raised(H)
_LARGE = _raised(_holed(QUADS))


@query(_detrend_sql(_detrended(_SMALL, SIDE, _method("pixel"))))
def full_detrend(spark, d):
    """Orbit plane, then a quadratic of the elevation; images without elevation have no result."""
    return _detrend(hollow(tiles(spark, d)), _method("pixel"))


@query(_detrend_sql(_detrended(_SMALL, SIDE, _method("spatial", terrain_strength=0.3))))
def spatial_terrain(spark, d):
    return _detrend(hollow(tiles(spark, d)), _method("spatial", terrain_strength=0.3))


@query(_detrend_sql(_detrended(_SMALL, SIDE, _method("binned"))))
def binned_terrain(spark, d):
    return _detrend(hollow(tiles(spark, d)), _method("binned"))


@query(_detrend_sql(_detrended(_LARGE, 2 * SIDE, _method("local"))))
def local_terrain(spark, d):
    return _detrend(hollow(_quads(spark, d)), _method("local"))


@query(_detrend_sql(_detrended(_LARGE, 2 * SIDE, _method("hybrid"))))
def hybrid_terrain(spark, d):
    return _detrend(hollow(_quads(spark, d)), _method("hybrid"))


@query(
    f"""SELECT image, coalesce(any_value(fine AND (orbit_ok OR terrain_ok)), false) AS accepted, coalesce(any_value(fine AND orbit_ok), false) AS orbit_accepted, coalesce(any_value(fine AND terrain_ok), false) AS terrain_accepted,
count(phase) AS valid_pixels, CASE WHEN any_value(fine) THEN any_value(initial) END AS initial_fit_pixels, CASE WHEN any_value(fine) THEN count(*) FILTER (WHERE final) END AS final_fit_pixels,
CASE WHEN any_value(fine) THEN round(any_value(before), 6) END AS before_std, CASE WHEN any_value(fine) THEN round(any_value("after"), 6) END AS after_std, any_value(fine) AS fitted
FROM {_detrended(_SMALL, SIDE, _method("pixel"))} GROUP BY 1"""
)
def detrend_reports(spark, d):
    got = detrending.detrend_reports(with_elevation(hollow(tiles(spark, d))), _method("pixel"))
    return got.select("image", "accepted", "orbit_accepted", "terrain_accepted", "valid_pixels", "initial_fit_pixels", "final_fit_pixels", F.round("before_robust_std_rad", 6).alias("before_std"), F.round("after_robust_std_rad", 6).alias("after_std"), (F.col("status") == "ok").alias("fitted"))


# Filters.

_Z = f"(SELECT image, row, col, phase IS NOT NULL AS valid, coalesce(cos(phase), 0) AS c, coalesce(sin(phase), 0) AS s, 1.0::DOUBLE + row AS size, (row + col + 1) / 16.0::DOUBLE AS coh FROM {H})"
_NONLOCAL = f"""(WITH z AS {_Z}, d AS (SELECT y.range AS dy, x.range AS dx FROM range(-2, 3) y, range(-2, 3) x),
u AS (SELECT a.image, a.row, a.col, dy, dx, coalesce(a.valid AND b.valid, false) AS both_, CASE WHEN a.valid AND b.valid THEN 1 - (a.c * b.c + a.s * b.s) ELSE 1 END AS unlike, b.c AS bc, b.s AS bs, b.coh AS bcoh
  FROM z a CROSS JOIN d LEFT JOIN z b ON b.image = a.image AND b.row = a.row - dy AND b.col = a.col - dx),
m AS (SELECT a.image, a.row, a.col, u.dy, u.dx, avg(u.unlike) AS unlike FROM z a, range(-1, 2) i(p), range(-1, 2) j(q), u
  WHERE u.image = a.image AND u.row = least(7, greatest(0, a.row + p)) AND u.col = least(7, greatest(0, a.col + q)) GROUP BY 1, 2, 3, 4, 5),
w AS (SELECT z.*, u.bc, u.bs, CASE WHEN u.both_ THEN exp(-m.unlike / pow(greatest(0.08, 0.70 * (0.35 + 0.90 * (1 - z.coh))), 2) - (dy * dy + dx * dx) / 18.0) * (0.2 + 0.8 * sqrt(greatest(z.coh * u.bcoh, 1e-3))) ELSE 0 END
  + CASE WHEN dy = 0 AND dx = 0 AND z.valid THEN 1 ELSE 0 END AS weight FROM z JOIN u USING (image, row, col) JOIN m USING (image, row, col, dy, dx)),
t AS (SELECT image, row, col, any_value(valid) AS valid, any_value(size) AS size, any_value(coh) AS coh, any_value(c) AS c, any_value(s) AS s, coalesce(sum(weight * bc), 0) AS tc, coalesce(sum(weight * bs), 0) AS ts, sum(weight) AS support FROM w GROUP BY 1, 2, 3),
n AS (SELECT *, CASE WHEN support > 1e-12 THEN tc / support ELSE c END AS mc, CASE WHEN support > 1e-12 THEN ts / support ELSE s END AS ms FROM t),
l AS (SELECT *, sqrt(mc * mc + ms * ms) AS len FROM n)
SELECT image, row, col, coh, CASE WHEN NOT valid THEN 0 WHEN len > 1e-12 THEN size * mc / len ELSE size * c END AS re, CASE WHEN NOT valid THEN 0 WHEN len > 1e-12 THEN size * ms / len ELSE size * s END AS im, greatest(0, least(1, len)) AS concentration, support FROM l)"""
_TAPS = np.exp(-0.5 * np.arange(-4, 5) ** 2)
_TAPS_SQL = "(VALUES " + ", ".join(f"({k - 4}, {w!r}::DOUBLE)" for k, w in enumerate((_TAPS / _TAPS.sum()).tolist())) + ")"


def _goldstein(source: str) -> str:
    angle = "2 * pi() * ((k * row + l * col) % 8) / 8"
    return f"""(WITH z AS {source}, f AS (SELECT y.range AS k, x.range AS l FROM range(8) y, range(8) x),
g AS (SELECT image, k, l, sum(re * cos({angle}) + im * sin({angle})) AS fr, sum(im * cos({angle}) - re * sin({angle})) AS fi FROM z, f GROUP BY 1, 2, 3),
a AS (SELECT b.image, f.k, f.l, sum(v.w * h.w * sqrt(b.fr * b.fr + b.fi * b.fi)) AS size FROM f, {_TAPS_SQL} v(i, w), {_TAPS_SQL} h(j, w), g b WHERE b.k = (f.k + v.i + 8) % 8 AND b.l = (f.l + h.j + 8) % 8 GROUP BY 1, 2, 3),
p AS (SELECT image, least(0.8, greatest(0, 0.4 * median(1 - coh))) AS power FROM z GROUP BY 1),
e AS (SELECT g.image, g.k, g.l, fr * pow(greatest(size / greatest(max(size) OVER (PARTITION BY image), 1e-12), 1e-8), power) AS fr, fi * pow(greatest(size / greatest(max(size) OVER (PARTITION BY image), 1e-12), 1e-8), power) AS fi FROM g JOIN a USING (image, k, l) JOIN p USING (image)),
o AS (SELECT z.image, z.row, z.col, any_value(z.re) AS re, any_value(z.im) AS im, sum(fr * cos({angle}) - fi * sin({angle})) AS rr, sum(fi * cos({angle}) + fr * sin({angle})) AS ri FROM z JOIN e USING (image) GROUP BY 1, 2, 3)
SELECT image, row, col, sqrt(re * re + im * im) * rr / sqrt(rr * rr + ri * ri) AS re, sqrt(re * re + im * im) * ri / sqrt(rr * rr + ri * ri) AS im FROM o)"""


_PLAIN = f"(SELECT image, row, col, coh, CASE WHEN valid THEN size * c ELSE 0 END AS re, CASE WHEN valid THEN size * s ELSE 0 END AS im FROM {_Z})"
_PAIR = "round(re, 6) + 0.0 AS re, round(im, 6) + 0.0 AS im"
ORACLE_SQL["nonlocal_filter"] = f"SELECT image, row, col, {_PAIR}, round(concentration, 6) + 0.0 AS concentration, round(support, 6) + 0.0 AS support FROM {_NONLOCAL}"
ORACLE_SQL["goldstein_filter"] = f"SELECT image, row, col, {_PAIR} FROM {_goldstein(_PLAIN)}"
ORACLE_SQL["hybrid_filter"] = f"SELECT g.image, g.row, g.col, round(g.re, 6) + 0.0 AS re, round(g.im, 6) + 0.0 AS im, round(n.concentration, 6) + 0.0 AS concentration FROM {_goldstein(f'(SELECT image, row, col, coh, re, im FROM {_NONLOCAL})')} g JOIN {_NONLOCAL} n USING (image, row, col)"


# Unwrapping: the true phase is known.

_SLOPES = f"(SELECT image, max(CASE WHEN col = 0 THEN phase END) / 8 AS gx, max(CASE WHEN col = 1 THEN phase END) / 8 AS gy FROM {T} WHERE row = 0 GROUP BY 1)"


def _ramps(spark: SparkSession, d: str) -> DataFrame:
    """Ramps whose slopes are the tiles' first pixels: (image, row, col, true, phase, coh)."""
    pixels = tiles(spark, d)
    slopes = pixels.where("row = 0").groupBy("image").agg((F.max(F.when(F.col("col") == 0, F.col("phase"))) / 8).alias("gx"), (F.max(F.when(F.col("col") == 1, F.col("phase"))) / 8).alias("gy"))
    true = F.col("gx") * F.col("col") + F.col("gy") * F.col("row")
    return pixels.join(slopes, "image").select("image", "row", "col", true.alias("true"), fx.wrap(true).alias("phase"), (F.lit(0.5) + F.col("row") / 20).alias("coh"))


def _from_corner(df: DataFrame, value: str) -> DataFrame:
    corner = df.where("row = 0 AND col = 0").select("image", F.col(value).alias("corner"))
    return df.join(corner, "image").select("image", "row", "col", r6(F.col(value) - F.col("corner")).alias(value))


@query(f"SELECT image, row, col, round(gx * col + gy * row, 6) + 0.0 AS unwrapped FROM {T} JOIN {_SLOPES} USING (image)")
def unwrapped_ramps(spark, d):
    """Growth restores a ramp, counted from its corner."""
    return _from_corner(unwrapping.unwrap(_ramps(spark, d), longest=6.0), "unwrapped")


@query(f"SELECT image, row, col, round(gx * col + gy * row, 6) + 0.0 AS aligned FROM {T} JOIN {_SLOPES} USING (image)")
def aligned_regions(spark, d):
    """Two parts of a ramp, one of them off by whole cycles, are brought together across the bars between them."""

    def run(a: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        right, down = np.zeros((SIDE, SIDE - 1), bool), np.zeros((SIDE - 1, SIDE), bool)
        right[:, 4] = True
        out, region, _ = unwrapping.grow(a["phase"], a["coh"], np.isfinite(a["phase"]), right, down)
        out[:, 5:] += 2 * np.pi * (1 + int(a["image"][0, 0]) % 3)
        return {"aligned": unwrapping.align_regions(a["phase"], out, region, right, down)[0]}

    pixels = _ramps(spark, d)
    got = rasters.per_image(pixels.withColumn("image", F.col("image")), ["phase", "coh"], lambda a: run(a | {"image": np.rint(np.abs(a["phase"][:1, :1]) * 10)}), "aligned double")
    return _from_corner(got, "aligned")


_RES = ORACLE_SQL["residue_counts"].replace(H, f"(SELECT image, row, col, atan2(sin(phase), cos(phase)) AS phase FROM {T})")


@query(f"SELECT r.image, r.positive::BIGINT AS positive_residues, r.negative::BIGINT AS negative_residues, p.valid_pixels, p.valid_pixels AS unwrapped_pixels FROM ({_RES}) r JOIN (SELECT image, count(phase) AS valid_pixels FROM {T} GROUP BY 1) p USING (image)")
def unwrap_reports(spark, d):
    """Residues of every image, and that unwrapping reaches every valid pixel."""
    pixels = tiles(spark, d).withColumn("phase", fx.wrap(F.col("phase"))).withColumn("coh", F.lit(0.5) + F.col("row") / 20)
    return unwrapping.unwrap_reports(pixels, longest=6.0).select("image", "positive_residues", "negative_residues", "valid_pixels", "unwrapped_pixels")


_DIPOLE = "(SELECT vec_id AS image, vec_id % 3 AS r0, vec_id % 4 AS c0, 5 + vec_id % 3 AS r1, 4 + (vec_id // 3) % 4 AS c1 FROM embeddings)"
_NEAREST = "least({c}, 7 - {c}, {r}, 7 - {r})"


@query(
    f"""WITH p AS (SELECT *, sqrt(pow(r1 - r0, 2) + pow(c1 - c0, 2)) <= 6 AS near, {_NEAREST.format(r='r0', c='c0')} AS e0, {_NEAREST.format(r='r1', c='c1')} AS e1 FROM {_DIPOLE})
SELECT image, CASE WHEN near THEN 1 ELSE 2 END::BIGINT AS cuts, CASE WHEN near THEN greatest(abs(r1 - r0), abs(c1 - c0)) + 1 ELSE e0 + e1 + 2 END::BIGINT AS cut_pixels, (NOT near)::INT::BIGINT AS dropped FROM p"""
)
def dipole_cuts(spark, d):
    """A positive and a negative residue are joined if they are near, and else each is cut to its nearest border."""

    def run(frame):
        import pandas as pd

        out = []
        for k in frame["image"].tolist():
            r = np.zeros((SIDE, SIDE), np.int8)
            r[k % 3, k % 4], r[5 + k % 3, 4 + k // 3 % 4] = 1, -1
            pixels, _, _, cuts, dropped = unwrapping.branch_cuts(r, np.ones(r.shape), 6.0)
            out.append((k, len(cuts), int(pixels.sum()), dropped))
        return pd.DataFrame(out, columns=["image", "cuts", "cut_pixels", "dropped"])

    ids = tiles(spark, d).select("image").distinct()
    return ids.mapInPandas(lambda frames: (run(f) for f in frames), "image long, cuts long, cut_pixels long, dropped long")


# Repairs: what is raised by whole cycles comes back to the clean image.

@query(
    f"""WITH b AS (SELECT image, row, col, phase / 50 AS p, sin(phase) / 10 AS q FROM {QUADS})
SELECT image AS dataset, pair, row, col, round(CASE pair WHEN 0 THEN p WHEN 1 THEN q ELSE p + q END, 6) + 0.0 AS repaired, CASE WHEN row BETWEEN 3 AND 11 AND col BETWEEN 4 AND 12 AND pair = image % 3 THEN -1 ELSE 0 END::INT AS cycles FROM b, range(3) r(pair)"""
)
def closure_repair(spark, d):
    """A plateau on one of a triangle's three images is found by the closure and taken off that image."""
    base = _quads(spark, d).select("image", "row", "col", (F.col("phase") / 50).alias("p"), (F.sin("phase") / 10).alias("q")).withColumn("pair", F.explode(F.array(*map(F.lit, range(3)))))
    clean = F.when(F.col("pair") == 0, F.col("p")).when(F.col("pair") == 1, F.col("q")).otherwise(F.col("p") + F.col("q"))
    raised = F.col("row").between(3, 11) & F.col("col").between(4, 12) & (F.col("pair") == F.col("image") % 3)
    first, second = F.when(F.col("pair") == 1, 2).otherwise(1), F.when(F.col("pair") == 0, 2).otherwise(3)
    pixels = base.select(F.col("image").alias("dataset"), first.alias("first"), second.alias("second"), "row", "col", (clean + F.when(raised, fx.TWO_PI).otherwise(0.0)).alias("phase"), F.lit(1.0).alias("coh"))
    got = closure.repair_closure_stack(pixels, width=2)
    pair = F.when(F.col("second") == 2, 0).when(F.col("first") == 2, 1).otherwise(2)
    return got.select("dataset", pair.cast("long").alias("pair"), "row", "col", r6("repaired").alias("repaired"), "cycles")


def _blown(spark: SparkSession, d: str, times: int, value) -> DataFrame:
    """Every tile's pixels as squares of ``times`` x ``times``."""
    n = times * times
    wide = tiles(spark, d).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    at = wide.select("image", "phase", (F.col("row") * times + F.floor(F.col("k") / times)).cast("int").alias("row"), (F.col("col") * times + F.col("k") % times).cast("int").alias("col"))
    return at.select("image", "row", "col", value.alias("phase"))


def _blown_sql(times: int) -> str:
    return f"(SELECT image, (row * {times} + k // {times})::INT AS row, (col * {times} + k % {times})::INT AS col, phase FROM {T}, range({times * times}) r(k))"


def _whole_square(rows: str, cols: str, cycles: str) -> str:
    return f"CASE WHEN row BETWEEN {rows} AND col BETWEEN {cols} THEN {cycles} ELSE 0 END"


def _repaired(pixels: DataFrame, repair: Callable, near: str = "false") -> DataFrame:
    """Sums over the repaired images, but for the pixels near the step's corners, where smoothing hides the step."""
    got = rasters.per_image(pixels, ["phase"], lambda a: dict(zip(("fixed", "cycles"), repair(a["phase"])[:2])), "fixed double, cycles short").where(f"NOT ({near})")
    return got.groupBy("image").agg(F.round(F.sum("fixed"), 6).alias("total"), F.round(F.sum(F.abs("fixed")), 6).alias("size"), F.count_if(F.col("cycles") != 0).alias("shifted"), F.sum("cycles").alias("cycles"))


def _repaired_sql(times: int, clean: str, cycles: str, near: str = "false") -> str:
    return f"SELECT image, round(sum(v), 6) AS total, round(sum(abs(v)), 6) AS size, count(*) FILTER (WHERE c <> 0) AS shifted, (-sum(c))::BIGINT AS cycles FROM (SELECT image, {clean} AS v, {cycles} AS c FROM {_blown_sql(times)} WHERE NOT ({near})) GROUP BY 1"


_UP = "(1 + image % 2)"


_CORNERS = "(row BETWEEN 8 AND 15 OR row BETWEEN 26 AND 33) AND (col BETWEEN 8 AND 15 OR col BETWEEN 26 AND 33)"


@query(_repaired_sql(6, "phase / 400", _whole_square("12 AND 29", "12 AND 29", _UP), _CORNERS))
def repaired_regions(spark, d):
    """A raised block inside an image goes back by its whole cycles, and nothing else moves."""
    raised = F.when(F.col("row").between(12, 29) & F.col("col").between(12, 29), fx.TWO_PI * (1 + F.col("image") % 2)).otherwise(0.0)
    return _repaired(_blown(spark, d, 6, F.col("phase") / 400 + raised), region_repair.repair_regions, _CORNERS)


@query(_repaired_sql(5, "phase / 400", _whole_square("15 AND 24", "10 AND 19", "1")))
def repaired_plateaus(spark, d):
    raised = F.when(F.col("row").between(15, 24) & F.col("col").between(10, 19), fx.TWO_PI).otherwise(0.0)
    return _repaired(_blown(spark, d, 5, F.col("phase") / 400 + raised), region_repair.repair_plateaus)


_BOWL = "(0.01::DOUBLE * col + 0.0002::DOUBLE * (1 + image % 3) * col * col - 0.01::DOUBLE * row)"


_RIM = "row < 2 OR row BETWEEN 15 AND 24 AND col BETWEEN 19 AND 52 OR row <= 24 AND (col BETWEEN 19 AND 28 OR col BETWEEN 43 AND 52)"


@query(_repaired_sql(8, _BOWL, _whole_square("0 AND 19", "24 AND 47", "1"), _RIM))
def repaired_strips(spark, d):
    """A raised strip at the border of a curved image goes back, by the background and by its step."""
    bowl = 0.01 * F.col("col") + 0.0002 * (1 + F.col("image") % 3) * F.col("col") * F.col("col") - 0.01 * F.col("row")
    raised = F.when(F.col("row").between(0, 19) & F.col("col").between(24, 47), fx.TWO_PI).otherwise(0.0)
    return _repaired(_blown(spark, d, 8, bowl + raised), region_repair.repair_strips, _RIM)


@query(f"SELECT image, row, col, round({_BOWL}, 6) + 0.0 AS background FROM {_blown_sql(5)}")
def quadratic_background(spark, d):
    """The robust background of a curved image does not see a raised block."""
    bowl = 0.01 * F.col("col") + 0.0002 * (1 + F.col("image") % 3) * F.col("col") * F.col("col") - 0.01 * F.col("row")
    raised = F.when(F.col("row").between(15, 24) & F.col("col").between(10, 19), fx.TWO_PI).otherwise(0.0)
    pixels = _blown(spark, d, 5, bowl + raised)
    got = rasters.per_image(pixels, ["phase"], lambda a: {"background": region_repair.quadratic_background(a["phase"], np.isfinite(a["phase"]), None)}, "background double")
    return got.select("image", "row", "col", r6("background").alias("background"))


# Exclusion of image pairs: a bad pair stays if only worse ones join its dates.

_QUALITY = f"(SELECT image, avg(CASE WHEN phase IS NOT NULL THEN (abs((phase - smooth) / (2 * pi())) >= 0.45)::INT::DOUBLE END) AS f, (quantile_cont(phase, 0.99) - quantile_cont(phase, 0.01)) / (2 * pi()) AS r FROM (SELECT *, median(phase) OVER (PARTITION BY image) AS smooth FROM {S}) GROUP BY 1)"


@query(
    f"""WITH RECURSIVE q AS {_QUALITY}, e AS (SELECT image, image // 10 AS a, image % 10 AS b, f, r, f >= 0.04 AND r >= 2.0 AS bad, f * r AS badness FROM q),
g AS (SELECT a, b, bad, badness, image FROM e UNION ALL SELECT b, a, bad, badness, image FROM e),
w(image, node) AS (SELECT image, a FROM e WHERE bad UNION SELECT w.image, g.b FROM w JOIN e ON e.image = w.image JOIN g ON g.a = w.node AND g.image <> e.image AND (NOT g.bad OR g.badness < e.badness OR (g.badness = e.badness AND g.image > e.image)))
SELECT image::INT AS image, round(f, 6) AS fraction, round(r, 6) AS range_cycles, CASE WHEN NOT bad THEN 'included' WHEN EXISTS (SELECT 1 FROM w WHERE w.image = e.image AND w.node = e.b) THEN 'excluded_spatial_outlier' ELSE 'network_protected' END AS status FROM e"""
)
def qc_exclusion(spark, d):
    pixels = stats.with_group_value(stack(spark, d), ["image"], F.median("phase"), "smooth")
    got = {r["image"]: (r["fraction"], r["range_cycles"]) for r in network.spatial_quality(pixels, "smooth").collect()}
    pairs = sorted(got)
    status = network.safe_exclusion([(k // 10, k % 10) for k in pairs], [got[k] for k in pairs])
    return spark.createDataFrame([(k, *(round(x, 6) for x in map(float, got[k])), s) for k, s in zip(pairs, status)], "image int, fraction double, range_cycles double, status string")


# Sources and sinks.

def _shared(spark: SparkSession) -> str:
    """A folder that all workers see: of this machine in local mode, else where the session's checkpoints go."""
    if spark.sparkContext.master.startswith("local["):
        return tempfile.mkdtemp(prefix="fringeframe-")
    return f"{spark.conf.get('spark.checkpoint.dir').removeprefix('file://').rstrip('/')}/fringeframe-{uuid.uuid4().hex}"


@query(f"SELECT image, row, col, round(phase::FLOAT::DOUBLE, 5) + 0.0 AS value FROM {H}")
def float_rasters(spark, d):
    """Tiles written as big-endian float rasters, and read again as files."""
    folder = _shared(spark)
    pixels = hollow(tiles(spark, d)).select("image", "row", "col", F.col("phase").alias("value"), F.format_string("%08d.unw", F.col("image")).alias("name"))
    gamma.write_rasters(pixels, folder, "name").count()
    back = gamma.read_raster(spark, f"{folder}/*.unw", (SIDE, SIDE), "float32")
    number = F.regexp_extract("file", r"(\d+)\.unw$", 1).cast("long")
    return back.select(number.alias("image"), "row", "col", (F.round("value", 5) + 0.0).alias("value"))


@query(f"SELECT image, row, col, round(atan2(((1 + row) * sin(phase))::FLOAT::DOUBLE, ((1 + row) * cos(phase))::FLOAT::DOUBLE), 6) + 0.0 AS phase FROM {H} WHERE row BETWEEN 2 AND 5")
def complex_rasters(spark, d):
    """Complex rasters through the seeking data source: rows outside the filter are not read."""
    folder = _shared(spark)
    pixels = _complex(spark, d).withColumn("name", F.format_string("%08d.filt", F.col("image")))
    gamma.write_rasters(pixels, folder, "name", "complex64").count()
    spark.dataSource.register(gamma.GammaSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    back = spark.read.format("gamma").options(path=folder, lines=SIDE, width=SIDE, rows=2).load().where("row >= 2 AND row < 6")
    number = F.regexp_extract("file", r"(\d+)\.filt$", 1).cast("long")
    return gamma.wrapped_phase(back).select(number.alias("image"), "row", "col", r6("phase").alias("phase"))


@query("SELECT n_nationkey AS nation, round(n_nationkey * 2.5 - 0.5, 6) + 0.0 AS west, round(-n_nationkey - 0.25, 6) + 0.0 AS south, round(n_nationkey * 2.5 + 1.5, 6) + 0.0 AS east, round(-n_nationkey + 0.75, 6) + 0.0 AS north FROM nation")
def region_files(spark, d):
    """A KML file for each nation, written, read again, and bounded."""
    folder = _shared(spark)
    import os

    os.makedirs(folder, exist_ok=True)
    for r in spark.read.parquet(f"{d}/nation.parquet").select("n_nationkey").collect():
        x, y = r[0] * 2.5, -float(r[0])
        vector.write_kml(f"{folder}/{r[0]:04d}.kml", "nation", [[(x - 0.5, y), (x + 1.5, y - 0.25), (x, y + 0.75)]])
    bounds = vector.kml_bounds(vector.read_kml(spark, f"file://{folder}/*.kml"))
    return bounds.select(F.regexp_extract("file", r"(\d+)\.kml$", 1).cast("int").alias("nation"), *(r6(c).alias(c) for c in ("west", "south", "east", "north")))


@query("SELECT s_suppkey AS id, round(s_suppkey / 10.0::DOUBLE, 6) AS longitude, round(s_acctbal / 1000, 6) AS velocity, round(s_acctbal, 6) AS mm FROM supplier")
def point_geojson(spark, d):
    """Points as GeoJSON features, read again."""
    s = spark.read.parquet(f"{d}/supplier.parquet").select(F.col("s_suppkey").alias("id"), (F.col("s_suppkey") / 10).alias("longitude"), F.lit(34.5).alias("latitude"), (F.col("s_acctbal") / 1000).alias("velocity"))
    kind = "type string, geometry struct<type: string, coordinates: array<double>>, properties struct<id: bigint, velocity_m_per_year: double, velocity_mm_per_year: double>"
    f = vector.point_features(s).select(F.from_json("feature", kind).alias("f"))
    return f.select(F.col("f.properties.id").alias("id"), F.round(F.col("f.geometry.coordinates")[0], 6).alias("longitude"), F.round("f.properties.velocity_m_per_year", 6).alias("velocity"), F.round("f.properties.velocity_mm_per_year", 6).alias("mm"))


@query("SELECT 'scene-' || o_orderkey AS pair, max(o_totalprice) FILTER (o_orderkey % 7 <> 0) AS value, max(o_orderkey) AS seen FROM orders GROUP BY 1")
def pair_reports(spark, d):
    """A quality report written as CSV and read again by pair, the last row of a pair counting."""
    o = spark.read.parquet(f"{d}/orders.parquet").select(F.format_string("scene_%d", F.col("o_orderkey")).alias("name"), F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).alias("value"), F.col("o_orderkey").alias("seen"))
    path = f"file://{_shared(spark)}/quality"
    vector.write_report(o, path)
    return vector.read_pair_report(spark, path, "name").select("pair", F.col("value").cast("double").alias("value"), F.col("seen").cast("long").alias("seen"))


@query("SELECT x.range::INT AS col, y.range::INT AS row, round(3 + 0.53::DOUBLE * (x.range + 0.5) * 7 / 8 - 0.27::DOUBLE * (y.range + 0.5) * 7 / 8, 5) AS value FROM range(8) x, range(8) y")
def geotiff_cells(spark, d):
    """A plane over a mesh of positions, on the north-up grid of a GeoTIFF: cells are the box divided by the mesh."""
    geo = geolocation(tiles(spark, d).select("row", "col").distinct())
    lon, lat = np.zeros((SIDE, SIDE)), np.zeros((SIDE, SIDE))
    for r in geo.collect():
        lon[r["row"], r["col"]], lat[r["row"], r["col"]] = r["lon"], r["lat"]
    y, x = np.indices((SIDE, SIDE))
    folder = _shared(spark)
    import os

    os.makedirs(folder, exist_ok=True)
    geotiff.write_geotiff(f"{folder}/v.tif", *geotiff.regrid(3 + 0.53 * x - 0.27 * y, lon, lat))
    grid, _ = geotiff.read_geotiff(f"{folder}/v.tif")
    return spark.createDataFrame([(int(c), int(r), round(float(grid[r, c]), 5)) for r in range(SIDE) for c in range(SIDE)], "col int, row int, value double")


@query(f"SELECT image, count(*) AS rings, round(sum(n), 6) AS area FROM (SELECT image, root, count(*)::DOUBLE AS n FROM ({ORACLE_SQL['component_labels']}) GROUP BY 1, 2) GROUP BY 1")
def mask_outlines(spark, d):
    """Outer outlines of a mask's regions: as many as regions, and around as many pixels once holes are taken off."""

    def run(key, frame):
        import pandas as pd

        grid = np.zeros((SIDE, SIDE), bool)
        grid[frame["row"], frame["col"]] = frame["phase"] > 0
        rings = points.mask_outlines(grid)
        area = [(np.dot(r[:-1, 1], r[1:, 0]) - np.dot(r[1:, 1], r[:-1, 0])) / 2 for r in rings]
        label, n = images.components(grid)
        return pd.DataFrame([(key[0], n, round(abs(sum(area)), 6))], columns=["image", "rings", "area"])

    return tiles(spark, d).groupBy("image").applyInPandas(run, "image long, rings long, area double").where("rings > 0")
