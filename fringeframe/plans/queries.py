"""Registered queries over the raster views, and the same in DuckDB's SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import phase as fx
from ..operators import closure, cropping, detrending, filtering, focal, inversion, masks, network, points, stats, unwrapping
from .views import SIDE, day_pairs, epochs, geolocation, hollow, stack, tiles, with_elevation

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def r6(x: str | Column) -> Column:
    """Rounded to six digits, without a negative zero."""
    return F.round(x, 6) + F.lit(0.0)


def _days(*names: str) -> list[Column]:
    return [F.col(n).cast("string").alias(n) for n in names]


# The views, in SQL.
T = "(SELECT vec_id AS image, ((i - 1) // 8)::INT AS row, ((i - 1) % 8)::INT AS col, 20.0::DOUBLE * embedding[i]::DOUBLE AS phase FROM embeddings, range(1, 65) r(i))"
H = f"(SELECT image, row, col, CASE WHEN (image * 7 + row * 3 + col) % 11 <> 0 THEN phase END AS phase FROM {T})"
TE = f"(SELECT a.*, b.phase AS elev FROM {T} a LEFT JOIN {T} b ON b.image = a.image + 1 AND b.row = a.row AND b.col = a.col)"
E = "(SELECT user_id AS row, least((day(ts) - 1) // 5, 5)::INT AS epoch, avg(value) AS m FROM events WHERE true GROUP BY ALL)"
S = f"(SELECT a.epoch * 10 + b.epoch AS image, (DATE '2024-01-01' + a.epoch * 12)::DATE AS first, (DATE '2024-01-01' + b.epoch * 12)::DATE AS second, a.row, b.m - a.m AS phase FROM {E} a JOIN {E} b ON a.row = b.row AND a.epoch < b.epoch)"
DAYS = "(SELECT DISTINCT ts::DATE AS d FROM events)"
P = f"(SELECT strftime(a.d, '%Y%m%d') || '-' || strftime(b.d, '%Y%m%d') AS pair, a.d AS first, b.d AS second, day(a.d)::INT AS d, (b.d - a.d)::INT AS lag FROM {DAYS} a JOIN {DAYS} b ON b.d - a.d BETWEEN 1 AND 4)"


def _boxed(source: str, column: str, radius: int, passes: int) -> str:
    for _ in range(passes):
        source = f"(SELECT * REPLACE (avg({column}) OVER (PARTITION BY image, col ORDER BY row RANGE BETWEEN {radius} PRECEDING AND {radius} FOLLOWING) AS {column}) FROM {source})"
        source = f"(SELECT * REPLACE (avg({column}) OVER (PARTITION BY image, row ORDER BY col RANGE BETWEEN {radius} PRECEDING AND {radius} FOLLOWING) AS {column}) FROM {source})"
    return source


@query(f"SELECT image, row, col, round(atan2(sin(phase), cos(phase)), 6) + 0.0 AS wrapped FROM {T}")
def wrap_phase(spark, d):
    return tiles(spark, d).select("image", "row", "col", r6(fx.wrap(F.col("phase"))).alias("wrapped"))


_W = "atan2(sin({0}), cos({0}))"
_LOOP = " + ".join(_W.format(x) for x in ("b.phase - a.phase", "c.phase - b.phase", "d.phase - c.phase", "a.phase - d.phase"))


@query(
    f"SELECT a.image, a.row, a.col, coalesce(round_even(({_LOOP}) / (2 * pi()), 0), 0)::INT AS residue FROM {H} a LEFT JOIN {H} b ON b.image = a.image AND b.row = a.row AND b.col = a.col + 1 "
    f"LEFT JOIN {H} c ON c.image = a.image AND c.row = a.row + 1 AND c.col = a.col + 1 LEFT JOIN {H} d ON d.image = a.image AND d.row = a.row + 1 AND d.col = a.col"
)
def phase_residues(spark, d):
    return focal.residues(hollow(tiles(spark, d))).select("image", "row", "col", "residue")


@query(f"SELECT image, row, col, round(phase, 6) + 0.0 AS mean FROM {_boxed(H, 'phase', 1, 1)}")
def box_mean(spark, d):
    return focal.box_mean(hollow(tiles(spark, d)), "phase", 1, "mean").select("image", "row", "col", r6("mean").alias("mean"))


@query(f"SELECT a.image, a.row, a.col, CASE WHEN b.phase IS NOT NULL THEN round(a.phase, 6) + 0.0 END AS smooth FROM {_boxed(H, 'phase', 2, 2)} a JOIN {H} b USING (image, row, col)")
def lowpass_elevation(spark, d):
    return focal.lowpass_elevation(hollow(tiles(spark, d)), "phase", 2, "smooth").select("image", "row", "col", r6("smooth").alias("smooth"))


_FIT = f"(SELECT image, row, col, CASE WHEN (row + col) % 2 = 0 THEN phase END AS phase FROM {H})"


@query(f"SELECT a.image, a.row, a.col, CASE WHEN b.phase IS NOT NULL THEN round(a.phase, 6) + 0.0 END AS rough FROM {_boxed(_FIT, 'phase', 1, 3)} a JOIN {H} b USING (image, row, col)")
def lowpass_residual(spark, d):
    fit = (F.col("row") + F.col("col")) % 2 == 0
    return focal.lowpass_residual(hollow(tiles(spark, d)), "phase", fit, 1, "rough").select("image", "row", "col", r6("rough").alias("rough"))


@query(f"SELECT a.image, a.row, a.col, round(b.phase, 6) + 0.0 AS shifted FROM {T} a LEFT JOIN {T} b ON b.image = a.image AND b.row = a.row - 1 AND b.col = a.col + 2")
def shifted_pixels(spark, d):
    return focal.shift(tiles(spark, d), "phase", 1, -2, "s").select("image", "row", "col", r6("s").alias("shifted"))


def _diff(axis: str) -> str:
    o = "col" if axis == "row" else "row"
    w = f"OVER (PARTITION BY image, {o} ORDER BY {axis})"
    return f"CASE WHEN lag(phase) {w} IS NULL THEN lead(phase) {w} - phase WHEN lead(phase) {w} IS NULL THEN phase - lag(phase) {w} ELSE (lead(phase) {w} - lag(phase) {w}) / 2 END"


@query(f"SELECT image, row, col, round(sqrt(pow(gy, 2) + pow(gx, 2)), 6) + 0.0 AS gradient FROM (SELECT *, {_diff('row')} AS gy, {_diff('col')} AS gx FROM {T})")
def phase_gradient(spark, d):
    return focal.gradient(tiles(spark, d), "phase", "g").select("image", "row", "col", r6("g").alias("gradient"))


@query(
    f"SELECT a.image, a.row, a.col, a.phase IS NOT NULL AND count(b.phase) < 4 AS boundary FROM {H} a LEFT JOIN {H} b ON b.image = a.image AND abs(b.row - a.row) + abs(b.col - a.col) = 1 GROUP BY a.image, a.row, a.col, a.phase"
)
def domain_boundary(spark, d):
    return focal.domain_boundary(hollow(tiles(spark, d)), "phase", "boundary").select("image", "row", "col", "boundary")


@query(f"SELECT a.image, a.row, a.col, bool_or(b.phase > 6) AS near FROM {T} a JOIN {T} b ON b.image = a.image AND pow(b.row - a.row, 2) + pow(b.col - a.col, 2) <= 4 GROUP BY 1, 2, 3")
def disc_dilation(spark, d):
    fast = tiles(spark, d).withColumn("high", F.col("phase") > 6)
    return focal.dilate_disc(fast, "high", 2, "near").select("image", "row", "col", "near")


_MIRROR = f"(SELECT a.image, a.row, a.col, sqrt(pow(avg(coalesce(cos(b.phase), 0)), 2) + pow(avg(coalesce(sin(b.phase), 0)), 2)) AS r FROM {H} a, range(-1, 2) y(dy), range(-1, 2) x(dx), {H} b WHERE a.phase IS NOT NULL AND b.image = a.image AND b.row = least(7, greatest(0, a.row + dy)) AND b.col = least(7, greatest(0, a.col + dx)) GROUP BY 1, 2, 3)"


@query(f"SELECT image, round(median(1 - r), 6) + 0.0 AS circular_variance FROM {_MIRROR} GROUP BY 1")
def circular_variance(spark, d):
    return focal.circular_variance(hollow(tiles(spark, d))).select("image", r6("circular_variance").alias("circular_variance"))


@query(f"SELECT image, round(1.4826 * median(abs(phase - m)), 6) + 0.0 AS robust_std FROM (SELECT *, median(phase) OVER (PARTITION BY image) AS m FROM {H}) GROUP BY 1")
def robust_std(spark, d):
    return stats.robust_std(hollow(tiles(spark, d)), ["image"], "phase").select("image", r6("robust_std").alias("robust_std"))


@query(f"SELECT image, round(quantile_cont(phase, 0.98) - quantile_cont(phase, 0.02), 6) + 0.0 AS robust_range FROM {H} GROUP BY 1")
def robust_range(spark, d):
    return stats.robust_range(hollow(tiles(spark, d)), ["image"], "phase").select("image", r6("robust_range").alias("robust_range"))


@query(f"SELECT image, round(quantile_cont(phase, 0.02), 6) + 0.0 AS low, round(quantile_cont(phase, 0.98), 6) + 0.0 AS high, round(quantile_cont(abs(phase), 0.98), 6) + 0.0 AS symmetric FROM {H} GROUP BY 1")
def display_limits(spark, d):
    got = stats.display_limits(hollow(tiles(spark, d)), ["image"], "phase")
    return got.select("image", *(r6(c).alias(c) for c in ("low", "high", "symmetric")))


_ST = f"""(WITH c AS (SELECT *, phase - median(phase) OVER (PARTITION BY image) AS x FROM {{0}}),
 k AS (SELECT *, median(x) OVER (PARTITION BY row, col) AS mid FROM c),
 p AS (SELECT row, col, count(phase)::DOUBLE / count(*) AS valid_fraction, median(abs(x - mid)) AS temporal_mad FROM k GROUP BY 1, 2),
 l AS (SELECT quantile_cont(temporal_mad, {{1}}) FILTER (valid_fraction >= 0.8) AS lim FROM p)
 SELECT p.*, coalesce(valid_fraction >= 0.8 AND temporal_mad <= lim, false) AS stable FROM p, l)"""
_HS = _ST.format(H, 0.7)


@query(f"SELECT row, col, round(valid_fraction, 6) AS valid_fraction, round(temporal_mad, 6) + 0.0 AS temporal_mad, stable FROM {_HS}")
def stable_mask(spark, d):
    return stats.stable_pixels(hollow(tiles(spark, d))).select("row", "col", F.round("valid_fraction", 6).alias("valid_fraction"), r6("temporal_mad").alias("temporal_mad"), "stable")


_NEAR = f"(SELECT a.*, (SELECT count(*) FROM {_HS} b WHERE b.stable AND abs(b.row - a.row) <= 1 AND abs(b.col - a.col) <= 1) AS near FROM {_HS} a WHERE a.stable AND a.row BETWEEN 1 AND 6 AND a.col BETWEEN 1 AND 6)"
_RANK = f"(SELECT *, -temporal_mad / (SELECT quantile_cont(temporal_mad, 0.95) FROM {_NEAR}) AS score, row_number() OVER (ORDER BY temporal_mad, row, col) AS k FROM {_NEAR})"
_REF = f"(SELECT row, col, score, k = (SELECT min(k) FROM {_RANK} WHERE near >= 5) AS representative FROM {_RANK} WHERE k <= 5 OR k = (SELECT min(k) FROM {_RANK} WHERE near >= 5))"


@query(f"SELECT row, col, round(score, 6) + 0.0 AS score, representative FROM {_REF}")
def reference_pixels(spark, d):
    got = detrending.reference_pixels(stats.stable_pixels(hollow(tiles(spark, d))), (SIDE, SIDE), window=3, count=5)
    return got.select("row", "col", r6("score").alias("score"), "representative")


@query(f"SELECT t.image, t.row, t.col, round(t.phase - coalesce(o.m, 0), 6) + 0.0 AS phase, round(coalesce(o.m, 0), 6) + 0.0 AS reference_offset FROM {H} t LEFT JOIN (SELECT image, median(phase) AS m FROM {H} JOIN {_REF} USING (row, col) GROUP BY 1) o USING (image)")
def reference_zeroing(spark, d):
    pixels = hollow(tiles(spark, d))
    ref = detrending.reference_pixels(stats.stable_pixels(pixels), (SIDE, SIDE), window=3, count=5)
    return detrending.zero_to_reference(pixels, ref).select("image", "row", "col", r6("phase").alias("phase"), r6("reference_offset").alias("reference_offset"))


@query(f"SELECT image, row, col, round(phase - (avg(phase) OVER w + regr_slope(phase, col) OVER w * (col - 3.5) + regr_slope(phase, row) OVER w * (row - 3.5)), 6) + 0.0 AS flat FROM {T} WINDOW w AS (PARTITION BY image)")
def plane_detrend(spark, d):
    x, y = fx.unit_grid(F.col("col"), SIDE), fx.unit_grid(F.col("row"), SIDE)
    got = detrending.fit_surfaces(tiles(spark, d), fx.orbit_terms(x, y, "plane"), F.lit(True), iterations=0)
    return got.select("image", "row", "col", r6(F.col("phase") - F.col("surface")).alias("flat"))


@query()
def robust_plane_detrend(spark, d):
    x, y = fx.unit_grid(F.col("col"), SIDE), fx.unit_grid(F.col("row"), SIDE)
    got = detrending.fit_surfaces(hollow(tiles(spark, d)), fx.orbit_terms(x, y, "plane"), F.lit(True), iterations=3)
    return got.select("image", "row", "col", r6(F.col("phase") - F.col("surface")).alias("flat"), "fitted")


@query(
    f"""WITH e AS (SELECT image, [quantile_cont(elev, 0.0), quantile_cont(elev, 0.25), quantile_cont(elev, 0.5), quantile_cont(elev, 0.75), quantile_cont(elev, 1.0)] AS e FROM {TE} WHERE elev IS NOT NULL GROUP BY 1),
b AS (SELECT image, phase, elev, least(4, (SELECT count(*) FROM unnest(e) u(x) WHERE x <= elev))::INT AS bin FROM {TE} JOIN e USING (image) WHERE elev IS NOT NULL)
SELECT image, bin, round(median(elev), 6) + 0.0 AS centre, round(median(phase), 6) + 0.0 AS middle, count(*) AS n FROM b GROUP BY 1, 2 HAVING count(*) >= 5"""
)
def terrain_bins(spark, d):
    got = stats.quantile_bins(with_elevation(tiles(spark, d)), ["image"], "elev", "phase", bins=4, least=5)
    return got.select("image", F.col("bin").cast("int").alias("bin"), r6("centre").alias("centre"), r6("middle").alias("middle"), "n")


_AFTER = f"(SELECT image, row // 4 AS r, col // 4 AS c, phase AS b, 0.9 * phase + 0.1 * elev AS a FROM {TE} WHERE elev IS NOT NULL)"


@query(
    f"""WITH m AS (SELECT *, median(b) OVER w AS mb, median(a) OVER w AS ma FROM {_AFTER} WINDOW w AS (PARTITION BY image, r, c)),
s AS (SELECT image, r, c, 1.4826 * median(abs(b - mb)) AS sb, 1.4826 * median(abs(a - ma)) AS sa, count(*) AS n FROM m GROUP BY 1, 2, 3)
SELECT image, round(greatest(max(sa / sb), 1), 6) AS worst_ratio, count(*) FILTER (sa / sb > 1.15) AS bad_blocks, count(*) AS blocks FROM s WHERE n >= 8 AND sb > 1e-10 GROUP BY 1"""
)
def local_worsening(spark, d):
    both = with_elevation(tiles(spark, d)).withColumn("after", F.lit(0.9) * F.col("phase") + F.lit(0.1) * F.col("elev"))
    both = both.where(F.col("elev").isNotNull())
    got = stats.local_worsening(both, ["image"], "phase", "after", block=4, least=8)
    return got.select("image", F.round("worst_ratio", 6).alias("worst_ratio"), "bad_blocks", "blocks")


@query(f"SELECT image, round(corr(phase, elev), 6) + 0.0 AS correlation FROM {TE} WHERE elev IS NOT NULL GROUP BY 1")
def elevation_correlation(spark, d):
    return stats.elevation_correlation(with_elevation(tiles(spark, d)), ["image"], "phase", "elev").select("image", r6("correlation").alias("correlation"))


@query(f"SELECT image, round(100.0 * count(CASE WHEN phase > 0 THEN phase END) / greatest(count(phase), 1), 6) AS coverage_percent FROM {H} GROUP BY 1")
def coverage(spark, d):
    pixels = hollow(tiles(spark, d)).withColumn("done", F.when(F.col("phase") > 0, F.col("phase")))
    return stats.coverage(pixels, ["image"], "phase", "done").select("image", F.round("coverage_percent", 6).alias("coverage_percent"))


@query(f"SELECT image, row, col, elev <= 0 AS water FROM {TE} WHERE elev IS NOT NULL")
def water_mask(spark, d):
    geo = geolocation(with_elevation(tiles(spark, d))).where(F.col("elev").isNotNull())
    return masks.water_mask(geo).select("image", "row", "col", "water")


_MEAN = f"(SELECT row, col, avg(phase) AS elev FROM {T} GROUP BY 1, 2)"


@query(f"SELECT g.image, g.row, g.col, round(m.elev, 6) + 0.0 AS elev FROM {T} g LEFT JOIN {_MEAN} m ON m.row = g.row // 2 AND m.col = g.col // 2")
def elevation_cells(spark, d):
    pixels = tiles(spark, d)
    dem = pixels.groupBy(F.col("row").alias("cell_row"), F.col("col").alias("cell_col")).agg(F.avg("phase").alias("elev"))
    # Half a pixel of margin keeps grid points off the cells' borders.
    geo = geolocation(pixels.select("image", "row", "col"))
    return masks.elevation_cells(geo, dem, -118.4005, 33.7605, 0.002, 0.002).select("image", "row", "col", r6("elev").alias("elev"))


@query(f"SELECT image, row - 1 AS row, col - 2 AS col, round(phase, 6) + 0.0 AS phase FROM {T} WHERE row BETWEEN 1 AND 5 AND col BETWEEN 2 AND 6")
def bbox_crop(spark, d):
    pixels = tiles(spark, d)
    geo = geolocation(pixels.select("row", "col").distinct())
    cut, _, _ = cropping.crop(pixels, geo, (-118.3975, 33.7555, -118.3945, 33.7585), margin=0.2)
    return cut.select("image", "row", "col", r6("phase").alias("phase"))


_SEGMENTS = "(VALUES (0, -118.3995, 33.7595, -118.3945, 33.7585), (0, -118.3945, 33.7585, -118.3965, 33.7535), (0, -118.3965, 33.7535, -118.3995, 33.7595), (1, -118.3955, 33.7555, -118.3925, 33.7555), (1, -118.3925, 33.7555, -118.3925, 33.7525), (1, -118.3925, 33.7525, -118.3955, 33.7525), (1, -118.3955, 33.7525, -118.3955, 33.7555)) s(ring, x0, y0, x1, y1)"


@query(
    f"""WITH g AS (SELECT DISTINCT row, col, -118.4::DOUBLE + 0.001::DOUBLE * col AS x, 33.76::DOUBLE - 0.001::DOUBLE * row AS y FROM {T}),
c AS (SELECT row, col, ring, count(*) FILTER ((y0 > y) <> (y1 > y) AND x < (x1 - x0) * (y - y0) / (y1 - y0) + x0) AS n FROM g, {_SEGMENTS} GROUP BY 1, 2, 3)
SELECT row, col, bool_or(n % 2 = 1) AS inside FROM c GROUP BY 1, 2"""
)
def point_in_polygon(spark, d):
    geo = geolocation(tiles(spark, d).select("row", "col").distinct())
    rings = [(0, [(-118.3995, 33.7595), (-118.3945, 33.7585), (-118.3965, 33.7535)]), (1, [(-118.3955, 33.7555), (-118.3925, 33.7555), (-118.3925, 33.7525), (-118.3955, 33.7525)])]
    rows = [(k, s, x, y) for k, ring in rings for s, (x, y) in enumerate(ring)]
    return masks.in_polygons(geo, spark.createDataFrame(rows, "ring int, seq int, lon double, lat double")).select("row", "col", "inside")


@query(f"SELECT image, row, col, row < 2 OR row >= 6 OR col < 2 OR col >= 6 AS guarded, row < 1 OR row >= 7 OR col < 1 OR col >= 7 AS border FROM {T}")
def edge_guard(spark, d):
    row, col = F.col("row"), F.col("col")
    return tiles(spark, d).select("image", "row", "col", masks.edge_guard(row, col, SIDE, SIDE, 2).alias("guarded"), masks.border_fit(row, col, SIDE, SIDE, 0.15).alias("border"))


_REACH = """WITH RECURSIVE m AS (SELECT image, row, col, row * 8 + col AS id FROM {0} WHERE {1}),
r(image, id, node) AS (SELECT image, id, id FROM m UNION SELECT r.image, r.id, n.id FROM r JOIN m c ON c.image = r.image AND c.id = r.node JOIN m n ON n.image = r.image AND {2}),
q AS (SELECT image, id, min(node)::INT AS root, count(*) AS size FROM r GROUP BY 1, 2) """


@query(_REACH.format(T, "phase > 0", "abs(n.row - c.row) + abs(n.col - c.col) = 1") + "SELECT image, (id // 8)::INT AS row, (id % 8)::INT AS col, root, size FROM q")
def component_labels(spark, d):
    got = points.component_labels(tiles(spark, d).withColumn("high", F.col("phase") > 0), "high")
    return got.select("image", "row", "col", (F.col("first_row") * 8 + F.col("first_col")).alias("root"), "size")


_V = f"(SELECT image, row, col, phase / 100 AS velocity FROM {H})"


@query(
    f"""WITH RECURSIVE v AS {_V}, lim AS (SELECT image, greatest(quantile_cont(abs(velocity), 0.6), 0.02) AS x FROM v GROUP BY 1),
m AS (SELECT image, row, col, row * 8 + col AS id FROM v JOIN lim USING (image) WHERE abs(velocity) >= x),
r(image, id, node) AS (SELECT image, id, id FROM m UNION SELECT r.image, r.id, n.id FROM r JOIN m c ON c.image = r.image AND c.id = r.node JOIN m n ON n.image = r.image AND greatest(abs(n.row - c.row), abs(n.col - c.col)) = 1),
k AS (SELECT image, (id // 8) AS row, (id % 8) AS col FROM r GROUP BY image, id HAVING count(*) >= 3)
SELECT v.image, v.row, v.col, v.velocity IS NOT NULL AND EXISTS (SELECT 1 FROM k WHERE k.image = v.image AND pow(k.row - v.row, 2) + pow(k.col - v.col, 2) <= 1) AS moving FROM v"""
)
def velocity_mask(spark, d):
    velocity = hollow(tiles(spark, d)).select("image", "row", "col", (F.col("phase") / 100).alias("velocity"))
    return points.deformation_mask(velocity, percentile=60.0, min_pixels=3, radius=1).select("image", "row", "col", "moving")


# Time series: six epochs twelve days apart, all fifteen pairs.

def _network() -> tuple[list, list]:
    from datetime import date, timedelta

    dates = [date(2024, 1, 1) + timedelta(days=12 * k) for k in range(6)]
    return dates, [(a, b) for k, a in enumerate(dates) for b in dates[k + 1 :]]


def _series(spark, d, only=None, **settings) -> DataFrame:
    dates, pairs = _network()
    return inversion.invert(inversion.observations(stack(spark, d, only), ["row"], pairs), pairs, dates, **settings)


_SCALE = "0.056::DOUBLE / (4 * pi())"
_FULL = f"(SELECT row, epoch, (m - first(m) OVER (PARTITION BY row ORDER BY epoch)) * {_SCALE} AS disp, epoch * 12 / 365.25::DOUBLE AS years, count(*) OVER (PARTITION BY row) AS n FROM {E})"


@query(f"SELECT row, round(regr_slope(disp, years), 6) + 0.0 AS velocity, 0.0::DOUBLE AS rms FROM {_FULL} WHERE n = 6 GROUP BY 1")
def sbas_velocity(spark, d):
    return _series(spark, d).where(F.col("disp").isNotNull()).select("row", r6("velocity").alias("velocity"), r6("rms").alias("rms"))


@query(f"SELECT row, epoch, round(disp, 6) + 0.0 AS disp FROM {_FULL} WHERE n = 6")
def displacement_series(spark, d):
    long = _series(spark, d, weights=[1.0 + k % 3 for k in range(15)]).where(F.col("disp").isNotNull())
    return long.select("row", F.posexplode("disp").alias("epoch", "x")).select("row", "epoch", r6("x").alias("disp"))


_PURCHASE = E.replace("FROM events WHERE", "FROM events WHERE event_type = 'purchase' AND")


@query(f"SELECT row, count(*) = 6 AS solved FROM {_PURCHASE} GROUP BY 1 HAVING count(*) > 1")
def incomplete_pixels(spark, d):
    return _series(spark, d, "purchase").select("row", F.col("disp").isNotNull().alias("solved"))


_SOME = f"(SELECT a.row, a.epoch AS i, b.epoch AS j, CASE WHEN (a.row + 7 * a.epoch + b.epoch) % 4 <> 0 THEN 1 END AS ok FROM {E} a JOIN {E} b ON a.row = b.row AND a.epoch < b.epoch)"


@query(f"SELECT pattern, count(*) AS pixels, length(replace(pattern, '0', ''))::INT AS pairs FROM (SELECT row, string_agg(coalesce(max_ok, 0)::VARCHAR, '' ORDER BY p.i, p.j) AS pattern FROM (SELECT u.row, g.i, g.j, max(s.ok) AS max_ok FROM (SELECT DISTINCT row FROM {_SOME} WHERE ok = 1) u CROSS JOIN (SELECT a.range AS i, b.range AS j FROM range(6) a, range(6) b WHERE a.range < b.range) g LEFT JOIN {_SOME} s ON s.row = u.row AND s.i = g.i AND s.j = g.j GROUP BY 1, 2, 3) p GROUP BY 1) GROUP BY 1")
def validity_patterns(spark, d):
    _, pairs = _network()
    some = stack(spark, d).where((F.col("row") + 7 * F.floor(F.col("image") / 10) + F.col("image") % 10) % 4 != 0)
    return inversion.validity_patterns(inversion.observations(some, ["row"], pairs))


@query(f"SELECT row, round(regr_slope(disp, years), 6) + 0.0 AS velocity FROM {_FULL} WHERE n = 6 GROUP BY 1 ORDER BY abs(regr_slope(disp, years)) DESC, row LIMIT 1")
def top_velocity_point(spark, d):
    return points.top_velocity_point(_series(spark, d).withColumn("col", F.lit(0))).select("row", r6("velocity").alias("velocity"))


@query(f"SELECT row, round(regr_slope(disp, years), 6) + 0.0 AS velocity FROM {_FULL} WHERE n = 6 GROUP BY 1 ORDER BY pow(row - 7.4, 2), row LIMIT 1")
def nearest_valid_pixel(spark, d):
    return points.nearest_valid_pixel(_series(spark, d).withColumn("col", F.lit(0)), 7.4, 0).select("row", r6("velocity").alias("velocity"))


@query(f"SELECT DISTINCT x.first::VARCHAR AS a, x.second::VARCHAR AS b, y.second::VARCHAR AS c FROM {P} x JOIN {P} y ON y.first = x.second JOIN {P} z ON z.first = x.first AND z.second = y.second")
def closure_triangles(spark, d):
    return closure.triangles(day_pairs(spark, d)).select(*_days("a", "b", "c"))


_WS = f"(SELECT *, atan2(sin(phase), cos(phase)) AS w FROM {S})"
_CL = f"(SELECT x.row, x.first::VARCHAR AS a, x.second::VARCHAR AS b, y.second::VARCHAR AS c, (x.w + y.w - z.w) / (2 * pi()) AS cycles FROM {_WS} x JOIN {_WS} y ON y.row = x.row AND y.first = x.second JOIN {_WS} z ON z.row = x.row AND z.first = x.first AND z.second = y.second)"


def _wrapped_stack(spark, d):
    return stack(spark, d).withColumn("phase", fx.wrap(F.col("phase") * 1.0))


@query(f"SELECT row, a, b, c, round(cycles, 6) + 0.0 AS cycles FROM {_CL}")
def closure_cycles(spark, d):
    return closure.closures(_wrapped_stack(spark, d)).select("row", *_days("a", "b", "c"), r6("cycles").alias("cycles"))


@query(f"SELECT a, b, c, count(*) FILTER (abs(cycles - round_even(cycles, 0)) < 0.2 AND abs(round_even(cycles, 0)) >= 0.45) AS bad, count(*) AS pixels FROM {_CL} GROUP BY 1, 2, 3")
def bad_closure_pixels(spark, d):
    return closure.closures(_wrapped_stack(spark, d)).groupBy(*_days("a", "b", "c")).agg(F.count_if(closure.is_bad(F.col("cycles"))).alias("bad"), F.count(F.lit(1)).alias("pixels"))


_QC = f"(SELECT pair, ((d * 7 + lag * 3) % 10) / 100.0::DOUBLE AS f, ((d * 5 + lag) % 7) / 2.0::DOUBLE AS r, CASE (d + lag) % 6 WHEN 0 THEN 'network_protected' WHEN 1 THEN 'excluded_spatial_outlier' ELSE 'included' END AS status FROM {P} WHERE lag <= 3)"
_DT = f"(SELECT pair, (d * lag) % 4 <> 1 AS accepted FROM {P} WHERE (d + 2 * lag) % 5 <> 0)"
_Q = f"""(SELECT pair, CASE WHEN NOT coalesce(accepted, true) OR starts_with(coalesce(status, ''), 'excluded') THEN 3 WHEN status = 'network_protected' THEN 2 ELSE 0 END AS tier,
 greatest(0.03, least(1, exp(-8.0 * coalesce(f, 0) - 0.4 * greatest(coalesce(r, 0) - 1, 0)) * CASE WHEN coalesce(accepted, true) THEN 1 ELSE 0.2 END * CASE WHEN status = 'network_protected' THEN 0.25 ELSE 1 END)) AS weight,
 coalesce(status, 'quality_metadata_unavailable') AS qc_status, accepted AS detrending_accepted FROM {_QC} FULL JOIN {_DT} USING (pair))"""


def _reports(spark, d) -> tuple[DataFrame, DataFrame]:
    p = day_pairs(spark, d)
    day, lag = F.col("d"), F.col("lag")
    kind = (day + lag) % 6
    status = F.when(kind == 0, "network_protected").when(kind == 1, "excluded_spatial_outlier").otherwise("included")
    qc = p.where(lag <= 3).select("pair", (((day * 7 + lag * 3) % 10) / F.lit(100.0)).alias("spatial_residual_fraction"), (((day * 5 + lag) % 7) / F.lit(2.0)).alias("robust_phase_range_cycles"), status.alias("status"))
    return qc, p.where((day + 2 * lag) % 5 != 0).select("pair", ((day * lag) % 4 != 1).alias("accepted"))


@query(f"SELECT pair, tier::INT AS tier, round(weight, 6) AS weight, qc_status, detrending_accepted FROM {_Q}")
def edge_quality(spark, d):
    return network.edge_quality(*_reports(spark, d)).select("pair", "tier", F.round("weight", 6).alias("weight"), "qc_status", "detrending_accepted")


@query(
    f"""WITH RECURSIVE e AS (SELECT p.pair, p.first, p.second, p.lag, coalesce(q.tier, 0) AS tier FROM {P} p LEFT JOIN {_Q} q USING (pair)),
o AS (SELECT *, lag <= 2 AND tier <= 1 AS pre, row_number() OVER (ORDER BY lag <= 2 AND tier <= 1 DESC, tier, lag, first, second) AS k FROM e),
g AS (SELECT first AS a, second AS b, pre, k FROM o UNION ALL SELECT second, first, pre, k FROM o),
r(k, node) AS (SELECT k, first FROM o WHERE NOT pre UNION SELECT r.k, g.b FROM r JOIN g ON g.a = r.node AND (g.pre OR g.k < r.k))
SELECT pair, pre OR NOT EXISTS (SELECT 1 FROM r WHERE r.k = o.k AND r.node = o.second) AS selected,
 CASE WHEN pre THEN 'within_threshold_quality_ok' WHEN EXISTS (SELECT 1 FROM r WHERE r.k = o.k AND r.node = o.second) THEN 'not_required' WHEN tier >= 2 THEN 'low_quality_connectivity_bridge' ELSE 'quality_connectivity_bridge' END AS reason FROM o"""
)
def network_selection(spark, d):
    quality = network.edge_quality(*_reports(spark, d))
    rows = network.attach_quality(day_pairs(spark, d), quality).orderBy("first", "second").collect()
    edges = network.select_network([(r["first"], r["second"]) for r in rows], 2, [r.asDict() for r in rows])
    return spark.createDataFrame([(r["pair"], e.selected, e.reason) for r, e in zip(rows, edges)], "pair string, selected boolean, reason string")


_SQ = f"(SELECT *, median(phase) OVER (PARTITION BY image) AS smooth FROM {H})"


@query(f"SELECT image, round(avg(CASE WHEN phase IS NOT NULL THEN (abs((phase - smooth) / (2 * pi())) >= 0.45)::INT::DOUBLE END), 6) AS fraction, round((quantile_cont(phase, 0.99) - quantile_cont(phase, 0.01)) / (2 * pi()), 6) AS range_cycles FROM {_SQ} GROUP BY 1")
def spatial_quality(spark, d):
    pixels = stats.with_group_value(hollow(tiles(spark, d)), ["image"], F.median("phase"), "smooth")
    return network.spatial_quality(pixels, "smooth").select("image", F.round("fraction", 6).alias("fraction"), F.round("range_cycles", 6).alias("range_cycles"))


@query(f"SELECT image, row, col, round(sin(phase), 6) + 0.0 AS y, round(cos(phase), 6) + 0.0 AS x FROM {T}")
def unwrap_congruence(spark, d):
    """Unwrapping reaches every pixel and adds whole cycles: its phase, less its cycles, points where the tile's does."""
    pixels = tiles(spark, d).withColumn("phase", fx.wrap(F.col("phase"))).withColumn("coh", F.lit(0.5) + F.col("row") / 20)
    done = unwrapping.unwrap(pixels, longest=6.0).withColumn("w", F.col("unwrapped") - F.lit(fx.TWO_PI) * F.col("cycles"))
    return done.where(F.abs("w") <= fx.TWO_PI / 2 + 1e-9).select("image", "row", "col", r6(F.sin("w")).alias("y"), r6(F.cos("w")).alias("x"))


def _complex(spark, d) -> DataFrame:
    p = hollow(tiles(spark, d))
    size = F.lit(1.0) + F.col("row")
    return p.select("image", "row", "col", F.coalesce(size * F.cos("phase"), F.lit(0.0)).alias("re"), F.coalesce(size * F.sin("phase"), F.lit(0.0)).alias("im"), ((F.col("row") + F.col("col") + 1) / 16).alias("coh"))


@query()
def nonlocal_filter(spark, d):
    got = filtering.filter_phase(_complex(spark, d), "nonlocal", search=2, patch=1)
    return got.select("image", "row", "col", *(r6(c).alias(c) for c in ("re", "im", "concentration", "support")))


@query()
def goldstein_filter(spark, d):
    return filtering.filter_phase(_complex(spark, d), "goldstein").select("image", "row", "col", r6("re").alias("re"), r6("im").alias("im"))


@query()
def hybrid_filter(spark, d):
    got = filtering.filter_phase(_complex(spark, d), "hybrid", search=2, patch=1)
    return got.select("image", "row", "col", r6("re").alias("re"), r6("im").alias("im"), r6("concentration").alias("concentration"))


@query(f"SELECT image, row, round(abs(sum(x * ny - nx * y)) / 2, 6) AS area FROM (SELECT image, row, col AS x, phase AS y, lead(col, 1, 0) OVER w AS nx, coalesce(lead(phase) OVER w, first_value(phase) OVER w) AS ny FROM {T} WINDOW w AS (PARTITION BY image, row ORDER BY col ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) GROUP BY 1, 2")
def ring_area(spark, d):
    ring = tiles(spark, d).groupBy("image", "row").agg(F.array_sort(F.collect_list(F.struct(F.col("col").cast("double").alias("x"), F.col("phase").alias("y")))).alias("ring"))
    return ring.select("image", "row", F.round(fx.shoelace(F.col("ring")), 6).alias("area"))


_KN = f"(SELECT image, row, col, phase, CASE WHEN phase < -5 THEN 2.0 WHEN phase >= 5 THEN 3.0 WHEN phase < 0 THEN 2 + (phase + 5) / 5 * (-1 - 2) ELSE -1 + phase / 5 * (3 + 1) END AS y FROM {T})"


@query(f"SELECT image, row, col, round(y, 6) + 0.0 AS y FROM {_KN}")
def curve_lookup(spark, d):
    knots = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((-5.0, 2.0), (0.0, -1.0), (5.0, 3.0))))
    return tiles(spark, d).select("image", "row", "col", r6(fx.piecewise_linear(F.col("phase"), knots)).alias("y"))


@query(f"SELECT pair, first::VARCHAR AS first, second::VARCHAR AS second, round(lag / 365.25::DOUBLE, 6) AS years FROM {P}")
def pair_parse(spark, d):
    named = day_pairs(spark, d).select("pair", F.concat(F.lit("scene_"), F.replace("pair", F.lit("-"), F.lit("_")), F.lit(".unw")).alias("file"))
    first, second = fx.pair_dates(F.col("file"))
    years = F.round(fx.years_between(second, first), 6)
    return named.select("pair", first.cast("string").alias("first"), second.cast("string").alias("second"), years.alias("years"))


@query(f"SELECT i.image, (2 + k)::INT AS y, round_even(1 + k * i.n / 5.0, 0)::INT AS x FROM (SELECT vec_id AS image, vec_id % 5 AS n FROM embeddings) i, range(0, 6) r(k)")
def line_cells(spark, d):
    image = tiles(spark, d).select("image").distinct()
    cells = fx.line_cells(F.lit(2), F.lit(1), F.lit(7), (F.lit(1) + F.col("image") % 5).cast("int"))
    return image.select("image", F.explode(cells).alias("c")).select("image", "c.y", "c.x")


@query(f"SELECT image, row, col, CASE WHEN elev > 0 THEN round(phase, 6) + 0.0 END AS phase FROM (SELECT t.image, t.row, t.col, t.phase, g.elev FROM {T} t JOIN {_MEAN} g USING (row, col))")
def water_applied(spark, d):
    pixels = tiles(spark, d)
    geo = masks.water_mask(geolocation(pixels.groupBy("row", "col").agg(F.avg("phase").alias("elev"))))
    return masks.mask_water(pixels, geo, ["phase"]).select("image", "row", "col", r6("phase").alias("phase"))


@query(f"SELECT image, round(median((row + col + 1) / 16.0::DOUBLE), 6) AS median_coherence, round(median(abs(cos(phase))), 6) AS median_concentration, round(median(abs(atan2(sin(phase - elev), cos(phase - elev)))), 6) AS median_phase_change FROM {TE} WHERE elev IS NOT NULL GROUP BY 1")
def filter_quality(spark, d):
    p = with_elevation(tiles(spark, d)).where(F.col("elev").isNotNull())
    p = p.withColumns({"coh": (F.col("row") + F.col("col") + 1) / F.lit(16.0), "concentration": F.abs(F.cos("phase")), "phase_change": fx.wrap(F.col("phase") - F.col("elev"))})
    got = stats.filter_quality(p)
    return got.select("image", *(F.round(c, 6).alias(c) for c in ("median_coherence", "median_concentration", "median_phase_change")))


@query(f"SELECT row, col, round(avg(CASE WHEN phase IS NOT NULL THEN abs(sin(phase)) END), 6) AS mean_coherence FROM {H} GROUP BY 1, 2")
def mean_coherence(spark, d):
    got = stats.mean_coherence(hollow(tiles(spark, d)).withColumn("coh", F.abs(F.sin("phase"))))
    return got.select("row", "col", F.round("mean_coherence", 6).alias("mean_coherence"))


@query(f"SELECT image, round((quantile_cont(phase, 0.99) - quantile_cont(phase, 0.01)) / (2 * pi()), 6) AS cycles FROM {H} GROUP BY 1")
def phase_range_cycles(spark, d):
    return hollow(tiles(spark, d)).groupBy("image").agg(F.round(stats.phase_range_cycles("phase"), 6).alias("cycles"))


_RES = ORACLE_SQL["phase_residues"]


@query(f"SELECT image, count(*) FILTER (residue > 0) AS positive, count(*) FILTER (residue < 0) AS negative FROM ({_RES}) GROUP BY 1")
def residue_counts(spark, d):
    r = F.col("residue")
    return focal.residues(hollow(tiles(spark, d))).groupBy("image").agg(F.count_if(r > 0).alias("positive"), F.count_if(r < 0).alias("negative"))


@query(_REACH.format(T, "phase > 0", "greatest(abs(n.row - c.row), abs(n.col - c.col)) = 1") + "SELECT image, count(DISTINCT root) AS regions, max(size) AS largest FROM q GROUP BY 1")
def region_sizes(spark, d):
    got = points.component_labels(tiles(spark, d).withColumn("high", F.col("phase") > 0), "high", diagonal=True)
    return got.groupBy("image").agg(F.count_distinct("label").alias("regions"), F.max("size").alias("largest"))


@query(f"SELECT row, CASE WHEN count(*) = 6 THEN round(regr_slope(disp, years), 6) + 0.0 END AS velocity FROM {_FULL} GROUP BY 1")
def long_velocity(spark, d):
    first = Window.partitionBy("row").orderBy("epoch")
    long = epochs(spark, d).withColumn("disp", fx.displacement(F.col("m") - F.first("m").over(first))).withColumn("years", F.col("epoch") * 12 / F.lit(365.25))
    return inversion.velocity_of(long, ["row"], 6).select("row", r6("velocity").alias("velocity"))


@query(f"SELECT epoch, round(disp * 1000, 6) + 0.0 AS mm FROM {_FULL} WHERE n = 6 AND row = (SELECT row FROM {_FULL} WHERE n = 6 GROUP BY 1 ORDER BY pow(row - 3.2, 2), row LIMIT 1)")
def point_series(spark, d):
    got = _series(spark, d).where(F.col("disp").isNotNull()).withColumn("col", F.lit(0))
    long = got.select("row", "col", F.posexplode("disp").alias("date", "disp"))
    return points.point_series(long, got, 3.2, 0).select(F.col("date").alias("epoch"), r6("mm").alias("mm"))


@query(f"SELECT p.pair, coalesce(q.tier, 0)::INT AS tier, round(coalesce(q.weight, 1.0), 6) AS weight, coalesce(qc_status, 'quality_metadata_unavailable') AS qc_status FROM {P} p LEFT JOIN {_Q} q USING (pair)")
def attached_quality(spark, d):
    got = network.attach_quality(day_pairs(spark, d), network.edge_quality(*_reports(spark, d)))
    return got.select("pair", "tier", F.round("weight", 6).alias("weight"), "qc_status")


_SELECTED = ORACLE_SQL["network_selection"]


@query(_SELECTED.replace("SELECT pair, pre OR", "SELECT (count(*) FILTER (selected) - (SELECT count(*) FROM (SELECT first FROM o UNION SELECT second FROM o)) + 1)::BIGINT AS cycles, count(*) FILTER (selected AND reason = 'low_quality_connectivity_bridge') AS bridges FROM (SELECT pair, pre OR") + ")")
def network_redundancy(spark, d):
    rows = network.attach_quality(day_pairs(spark, d), network.edge_quality(*_reports(spark, d))).orderBy("first", "second").collect()
    edges = network.select_network([(r["first"], r["second"]) for r in rows], 2, [r.asDict() for r in rows])
    return spark.createDataFrame([(network.redundancy(edges), len(network.danger_bridges(edges)))], "cycles long, bridges long")


_XY = "(2.0::DOUBLE * col / 7 - 1) AS x, (2.0::DOUBLE * row / 7 - 1) AS y"


@query(f"SELECT image, row, col, round(1 + 2 * x + 3 * y + 4 * pow(greatest((x - 0.35) / 0.65, 0), 2) + 5 * pow(greatest((x - 0.35) / 0.65, 0), 3), 6) + 0.0 AS edge, round(elev + 2 * elev * x + 3 * elev * y + 4 * elev * x * x + 5 * elev * x * y + 6 * elev * y * y + 7 * elev * elev, 6) + 0.0 AS terrain FROM (SELECT *, {_XY} FROM {TE} WHERE elev IS NOT NULL)")
def surface_bases(spark, d):
    p = with_elevation(tiles(spark, d)).where(F.col("elev").isNotNull())
    x, y = fx.unit_grid(F.col("col"), SIDE), fx.unit_grid(F.col("row"), SIDE)
    total = lambda terms: sum((F.lit(float(k)) * t for k, t in enumerate(terms, 1)), F.lit(0.0))
    return p.select("image", "row", "col", r6(total(fx.orbit_terms(x, y, "right_edge_quadratic"))).alias("edge"), r6(total(fx.spatial_terrain_terms(F.col("elev"), x, y, 2))).alias("terrain"))


@query(f"SELECT image, round(min(phase) - 0.2 * (max(phase) - min(phase)), 6) + 0.0 AS west, round(max(phase) + 0.2 * (max(phase) - min(phase)), 6) + 0.0 AS east FROM {T} GROUP BY 1")
def expanded_bounds(spark, d):
    p = tiles(spark, d).groupBy("image").agg(F.min("phase").alias("a"), F.max("phase").alias("b"))
    west, _, east, _ = fx.expand_bounds(F.col("a"), F.lit(0.0), F.col("b"), F.lit(1.0), 0.2)
    return p.select("image", r6(west).alias("west"), r6(east).alias("east"))


@query(f"SELECT image, row, col, CASE WHEN phase IS NOT NULL THEN round(cos(phase), 6) + 0.0 END AS re, CASE WHEN phase IS NOT NULL THEN round(sin(phase), 6) + 0.0 END AS im FROM {H}")
def unit_phasors(spark, d):
    re, im = fx.unit_phasor(F.col("re"), F.col("im"))
    return _complex(spark, d).select("image", "row", "col", r6(re).alias("re"), r6(im).alias("im"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Velocities of the epochs' stack: scan, self-join, grouped inversion."""
    return sbas_velocity(spark, sf_dir)
