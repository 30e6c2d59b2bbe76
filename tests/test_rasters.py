import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fringeframe.operators import detrending, filtering, inversion, masks, network, points, stats
from fringeframe.operators.images import wrap
from fringeframe.plans import stages
from fringeframe.sources import gamma, geotiff, vector
from fringeframe.streaming import pairs as streaming

D = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in (0, 12, 24, 40, 52)]


def test_filter_lowers_circular_error():
    rng = np.random.default_rng(7)
    y, x = np.indices((48, 56))
    true = 0.08 * x + 0.05 * y
    z = np.exp(1j * (true + rng.normal(0, 0.65, true.shape)))
    out, concentration, support = filtering.nonlocal_mean(z, np.full(true.shape, 0.45), search=3, patch=1)
    error = lambda a: np.sqrt(np.mean(wrap(np.angle(a) - true) ** 2))
    assert error(out) < error(z) and ((concentration >= 0) & (concentration <= 1)).all() and (support > 0).all()
    both, _, _ = filtering.hybrid(z, np.full(true.shape, 0.45), search=3, patch=1)
    assert np.allclose(np.abs(both), 1) and error(both) < error(z)


def test_nonlocal_mean_against_the_definition():
    rng = np.random.default_rng(1)
    z = rng.normal(size=(6, 7)) + 1j * rng.normal(size=(6, 7))
    z[2, 3] = 0
    coh = rng.random((6, 7))
    got, concentration, support = filtering.nonlocal_mean(z, coh, search=1, patch=1)
    valid = np.abs(z) > 0
    u = np.where(valid, z / np.where(valid, np.abs(z), 1), 0)
    inside = lambda r, c: 0 <= r < 6 and 0 <= c < 7
    for r in range(6):
        for c in range(7):
            total = weight_sum = 0
            for dy in (-1, 0, 1):
                for dx in (-1, 0, 1):
                    dist = []
                    for a in (-1, 0, 1):
                        for b in (-1, 0, 1):
                            p, q = min(max(r + a, 0), 5), min(max(c + b, 0), 6)
                            ok = inside(p - dy, q - dx) and valid[p, q] and valid[p - dy, q - dx]
                            dist.append(1 - (u[p, q] * np.conj(u[p - dy, q - dx])).real if ok else 1.0)
                    if not (inside(r - dy, c - dx) and valid[r, c] and valid[r - dy, c - dx]):
                        continue
                    band = max(0.08, 0.7 * (0.35 + 0.9 * (1 - coh[r, c])))
                    w = np.exp(-np.mean(dist) / band**2) * np.exp(-(dy * dy + dx * dx) / 18) * (0.2 + 0.8 * np.sqrt(max(coh[r, c] * coh[r - dy, c - dx], 1e-3)))
                    w += dy == dx == 0
                    total += w * u[r - dy, c - dx]
                    weight_sum += w
            if valid[r, c]:
                assert abs(got[r, c] - abs(z[r, c]) * total / abs(total)) < 1e-9
                assert abs(concentration[r, c] - abs(total / weight_sum)) < 1e-9 and abs(support[r, c] - weight_sum) < 1e-9
            else:
                assert got[r, c] == 0


def test_strips_give_the_whole_images_filter(spark):
    rng = np.random.default_rng(4)
    h, w = 40, 11
    z = rng.normal(size=(h, w)) + 1j * rng.normal(size=(h, w))
    z[rng.random((h, w)) < 0.1] = 0
    coh = rng.random((h, w))
    rows = [(k, r, c, float(z[r, c].real), float(z[r, c].imag), float(coh[r, c])) for k in range(2) for r in range(h) for c in range(w)]
    pixels = spark.createDataFrame(rows, "image int, row int, col int, re double, im double, coh double")
    want, concentration, support = filtering.nonlocal_mean(z, coh, 3, 2)
    got = filtering.nonlocal_strips(pixels, search=3, patch=2, rows=7).collect()
    assert len(got) == len(rows)
    for r in got:
        at = r["row"], r["col"]
        assert abs(r["re"] + 1j * r["im"] - want[at]) < 1e-9 and abs(r["concentration"] - concentration[at]) < 1e-9 and abs(r["support"] - support[at]) < 1e-9


def test_detrend_keeps_a_blob():
    """A quadratic surface goes, a local signal on it stays."""
    y, x = np.meshgrid(np.linspace(-1, 1, 80), np.linspace(-1, 1, 90), indexing="ij")
    trend = 1.2 + 0.8 * x - 0.5 * y + 0.35 * x * x + 0.2 * x * y
    blob = 3 * np.exp(-((x - 0.25) ** 2 + (y + 0.15) ** 2) / 0.015)
    s = detrending.DetrendSettings(degree=2, orbit_model="degree", mad_scale=2.5)
    out, surface, used, _, _ = detrending.detrend_image(trend + blob, settings=s)
    assert np.sqrt(np.mean((surface - trend)[blob < 0.05] ** 2)) < 0.03 and out.max() > 2.8 and used.sum() < used.size


def test_detrend_keeps_masked_rows():
    image = np.arange(400.0).reshape(20, 20)
    image[:3] = np.nan
    out, *_ = detrending.detrend_image(image)
    assert np.isnan(out[:3]).all() and np.abs(out[3:]).max() < 1e-8


@pytest.mark.parametrize("method", ["pixel", "binned", "spatial", "hybrid", "local"])
def test_orbit_and_elevation_come_off(method):
    rng = np.random.default_rng(0)
    y, x = np.indices((80, 90))
    h = rng.normal(size=(80, 90)) * 100 + 500
    phase = 0.02 * x - 0.01 * y + 0.01 * h
    s = detrending.DetrendSettings(terrain_method=method, terrain_degree=1, terrain_strength=1.0, terrain_range_fraction=1.0, terrain_radius=20)
    out, _, _, report, _ = detrending.detrend_image(phase, h, settings=s)
    assert report.orbit_accepted and report.terrain_accepted
    assert np.std(out) < (0.03 if method in ("pixel", "spatial") else 0.15)


def test_distributed_surface_equals_least_squares(spark):
    from fringeframe.functions.phase import orbit_terms, unit_grid

    rng = np.random.default_rng(4)
    y, x = np.indices((12, 15))
    z = 0.3 * x - 0.2 * y + rng.normal(size=x.shape)
    z[3, 4] += 40
    z[5] = np.nan
    frame = pd.DataFrame({"image": 1, "row": y.ravel(), "col": x.ravel(), "phase": z.ravel()}).astype({"row": "int32", "col": "int32"})
    df = spark.createDataFrame(frame).withColumn("phase", F.nanvl("phase", F.lit(None)))
    got = detrending.fit_surfaces(df, orbit_terms(unit_grid(F.col("col"), 15), unit_grid(F.col("row"), 12), "full_quadratic"), F.lit(True)).toPandas()
    assert not got[(got["row"] == 3) & (got["col"] == 4)]["fitted"].any() and len(got) == 180
    keep = got["fitted"].to_numpy(bool)
    from fringeframe.operators.images import quadratic_terms

    design = quadratic_terms((12, 15))[got["row"] * 15 + got["col"]]
    w = np.linalg.lstsq(design[keep], got["phase"].to_numpy(float)[keep], rcond=None)[0]
    assert np.allclose(design @ w, got["surface"], atol=1e-8)


def select(edges, quality=None, days=12):
    return [e.index for e in network.select_network(edges, days, quality) if e.selected]


def test_networks():
    a, b, c, d, e = D
    assert select([(a, b), (b, d), (d, e)]) == [0, 1, 2]
    assert select([(a, b), (b, c), (a, c)], days=24) == [0, 1, 2]
    assert select([(a, b), (b, c), (a, c)], [{}, {"tier": 3, "weight": 0.03}, {}]) == [0, 2]
    only = network.select_network([(a, b), (b, c)], 12, [{}, {"tier": 2, "weight": 0.03}])
    assert [x.selected for x in only] == [True, True] and only[1].weight == 0.03 and network.danger_bridges(only) == [only[1]]
    with pytest.raises(ValueError):
        network.require_quality(only)
    with pytest.raises(ValueError):
        network.select_network([(a, b), (c, d)])
    assert network.redundancy(network.select_network([(a, b), (b, c), (a, c)], 24)) == 1


def test_exclusion_never_parts_the_network():
    pairs = [(1, 2), (2, 3), (1, 3)]
    assert network.safe_exclusion(pairs, [(0.1, 3.0), (0, 0), (0, 0)]) == ["excluded_spatial_outlier", "included", "included"]
    assert network.safe_exclusion(pairs[:2], [(0.1, 3.0), (0, 0)]) == ["network_protected", "included"]


def test_inversion_of_a_triangle_and_of_patterns():
    a, b, c = D[:3]
    x, _, rms = inversion.solve(np.array([[1.5, 2.5, 4.0]]), [(a, b), (b, c), (a, c)], [a, b, c], wavelength=4 * np.pi)
    assert np.allclose(x, [[0, 1.5, 4]]) and rms[0] < 1e-12
    rng = np.random.default_rng(0)
    true = np.cumsum(rng.normal(size=(200, 5)), axis=1)
    true -= true[:, :1]
    pairs = [(i, j) for i in range(5) for j in range(i + 1, 5)]
    y = np.array([[t[j] - t[i] for i, j in pairs] for t in true])
    y[rng.random(y.shape) < 0.4] = np.nan
    x, velocity, _ = inversion.solve(y, [(D[i], D[j]) for i, j in pairs], D, 4 * np.pi, weights=rng.uniform(0.1, 1, 10))
    for k in range(200):
        joined = network.connected([(i, j) for i, j in pairs], [n for n in range(10) if np.isfinite(y[k, n])])
        assert np.isfinite(x[k]).all() == joined and np.isfinite(velocity[k]) == joined
        if joined:
            assert np.allclose(x[k], true[k])
    with pytest.raises(ValueError):
        inversion.solve(y, pairs, D, weights=[0.0] * 10)


def test_gamma_round_trip(spark, tmp_path):
    z = (np.arange(12).reshape(3, 4) + 1j * (20 + np.arange(12).reshape(3, 4))).astype(">c8")
    path = tmp_path / "scene_20240101_20240113.filt"
    z.tofile(path)
    assert (gamma.read_window(str(path), "complex64", 4, (2, 3), (2, 4)) == z[1:3, 1:4]).all()
    df = gamma.with_pair(gamma.read_raster(spark, str(path), (3, 4)))
    assert df.where("re = row * 4 + col and im = re + 20").count() == 12 and df.select("first", "second").distinct().collect() == [(dt.date(2024, 1, 1), dt.date(2024, 1, 13))]
    spark.dataSource.register(gamma.GammaSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    source = spark.read.format("gamma").options(path=str(path), lines=3, width=4, rows=2).load()
    assert source.where("row >= 1 and row < 2").select("re").orderBy("re").collect() == [(float(k),) for k in range(4, 8)]
    out = df.withColumns({"image": F.lit(1), "name": F.lit("sub/out.filt")})
    assert gamma.write_rasters(out, str(tmp_path), "name", "complex64").collect()[0]["bytes"] == 96
    assert (np.fromfile(tmp_path / "sub/out.filt", ">c8").reshape(3, 4) == z).all()
    path.write_bytes(b"123")
    with pytest.raises(Exception, match="bytes"):
        gamma.read_raster(spark, str(path), (3, 4)).count()
    (tmp_path / "a.par").write_text("range_samples: 4\nazimuth_lines: 3\n")
    assert gamma.discover_shape(tmp_path) == (3, 4)


def test_gamma_reads_many_small_rasters_in_few_tasks(spark, tmp_path):
    """A task a block would be 1,200 of them here; rows, files and gaps come out the same."""
    n = 600
    for k in range(n):
        z = (np.arange(32).reshape(8, 4) + 1j * k).astype(">c8")
        z[3, 1] = complex(np.nan, np.nan)
        z.tofile(tmp_path / f"{k:08d}.filt")
    spark.dataSource.register(gamma.GammaSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    df = spark.read.format("gamma").options(path=str(tmp_path), lines=8, width=4, rows=2).load().where("row >= 2 AND row < 6")
    assert df.rdd.getNumPartitions() < 20
    rows = df.collect()
    assert {(r["file"], r["row"], r["col"]) for r in rows} == {(f"{tmp_path}/{k:08d}.filt", r, c) for k in range(n) for r in range(2, 6) for c in range(4)} and len(rows) == n * 16
    for r in rows:
        hole = (r["row"], r["col"]) == (3, 1)
        assert (r["re"], r["im"]) == ((None, None) if hole else (float(4 * r["row"] + r["col"]), float(int(r["file"][-13:-5]))))


def test_gamma_keeps_large_blocks_apart(tmp_path):
    np.zeros((600, 4000), ">c8").tofile(tmp_path / "a.filt")
    parts = gamma._GammaReader({"lines": "600", "width": "4000", "path": str(tmp_path)}).partitions()
    assert [p.blocks for p in parts] == [[("a.filt", 0, 256)], [("a.filt", 256, 512)], [("a.filt", 512, 600)]]


def test_geotiff_round_trip(tmp_path):
    y, x = np.indices((20, 30))
    lon, lat = -119 + 0.001 * x + 0.00005 * y, 34 - 0.001 * y
    velocity = 3 * (lon + 119) / 0.001 + 2 * (34 - lat) / 0.001
    grid, corner = geotiff.regrid(velocity, lon, lat)
    path = tmp_path / "v.tif"
    geotiff.write_geotiff(str(path), grid, corner)
    got, tags = geotiff.read_geotiff(str(path))
    assert got.shape == (20, 30) and tags[34735][-1] == 4326 and tags[42113][0].startswith(b"-9999") and b"mm/year" in tags[270][0]
    assert np.allclose(got, grid.astype(np.float32), equal_nan=True)
    rows, cols = np.indices(grid.shape)
    fine = np.isfinite(grid)
    want = 3 * (corner[0] + (cols + 0.5) * corner[2] + 119) / 0.001 + 2 * (34 - corner[1] + (rows + 0.5) * corner[3]) / 0.001
    assert fine.mean() > 0.9 and np.allclose(grid[fine], want[fine], atol=1e-6)


def test_kml_and_bounds(spark, tmp_path):
    ring = [(10.0, 30.0), (20.0, 30.0), (20.0, 40.0), (10.0, 40.0)]
    vector.write_kml(str(tmp_path / "roi.kml"), "roi", [ring])
    got = vector.kml_bounds(vector.read_kml(spark, str(tmp_path / "roi.kml"))).collect()[0]
    assert (got["west"], got["south"], got["east"], got["north"]) == (10, 30, 20, 40)
    from fringeframe.operators.cropping import grown

    assert grown((10, 30, 20, 40), 0.2) == (8, 28, 22, 42)
    bad = "<k><coordinates>1,2 x,y 3,4 5,6</coordinates></k>"
    assert vector.kml_rings(bad, strict=True) == [[(1, 2), (3, 4), (5, 6)]]
    with pytest.raises(ValueError):
        vector.kml_rings(bad)


def test_water_and_points(spark):
    geo = spark.createDataFrame([(0, 0, -118.0, 34.0, 10.0), (0, 1, -118.0, 34.1, -1.0), (1, 0, -118.1, 34.0, 5.0), (1, 1, -118.1, 34.1, 0.0)], "row int, col int, lon double, lat double, elev double")
    assert [r["water"] for r in masks.water_mask(geo).orderBy("row", "col").collect()] == [False, True, False, True]
    v = spark.createDataFrame([(r, c, 1.0 if (r, c) == (2, 3) else None) for r in range(4) for c in range(5)], "row int, col int, velocity double")
    assert points.nearest_valid_pixel(v, 0, 0).select("row", "col").collect() == [(2, 3)]
    v = spark.createDataFrame([(r, c, 1.0 if (r, c) in {(1, 1), (4, 4)} else None) for r in range(5) for c in range(5)], "row int, col int, velocity double")
    assert points.nearest_valid_pixel(v, 1.5, 2).select("row", "col").collect() == [(1, 1)]


def test_outlines():
    mask = np.zeros((20, 20), bool)
    mask[3:9, 4:15] = True
    mask[5:7, 6:9] = False
    rings = points.mask_outlines(mask)
    assert sorted(points.ring_area(r) for r in rings) == [6, 66]
    assert len(points.largest_outlines(mask, 50)) == 1


def test_bins_match_kernel(spark):
    rng = np.random.default_rng(0)
    h, z = np.round(rng.normal(size=600), 1), rng.normal(size=600)
    df = spark.createDataFrame(pd.DataFrame({"image": 1, "h": h, "z": z}))
    got = stats.quantile_bins(df, ["image"], "h", "z", 8, 20).orderBy("bin").select("centre", "middle", "n").toPandas().to_numpy(float)
    assert np.allclose(got, detrending.bin_medians(h, z, 8, 20))


def synthetic(spark, shape=(24, 26)):
    """Four dates, steady motion of a patch, ramps and noise."""
    rng = np.random.default_rng(9)
    y, x = np.indices(shape)
    patch = np.exp(-((x - 13) ** 2 + (y - 12) ** 2) / 18.0)
    dates, rows = D[:4], []
    atmosphere = rng.normal(size=(4, 2)) * 0.02
    for i in range(4):
        for j in range(i + 1, 4):
            ramp = (atmosphere[j] - atmosphere[i]) @ np.stack([x.ravel(), y.ravel()])
            phase = 0.02 * (dates[j] - dates[i]).days * patch.ravel() + ramp + rng.normal(0, 0.05, x.size)
            rows.append(pd.DataFrame({"dataset": "d", "first": dates[i], "second": dates[j], "row": y.ravel(), "col": x.ravel(), "re": np.cos(phase), "im": np.sin(phase), "coh": 0.8}))
    frame = pd.concat(rows)
    return spark.createDataFrame(frame).selectExpr("dataset", "first", "second", "int(row) row", "int(col) col", "re", "im", "coh"), patch


def test_whole_pipeline(spark, tmp_path):
    pixels, patch = synthetic(spark)
    s = stages.PipelineSettings(search=2, patch=1, most_days=30, detrend=detrending.DetrendSettings(turbulence_radius=3), mask_min_pixels=4, mask_radius=1, quality_sigma=3)
    summary = stages.run_pipeline(pixels, patch.shape, f"file://{tmp_path}/out", s=s)
    assert len(summary["dates"]) == 4 and summary["redundant_cycles"] >= 0
    got = spark.read.parquet(f"file://{tmp_path}/out/series").toPandas()
    v = np.full(patch.shape, np.nan)
    v[got["row"], got["col"]] = got["velocity"]
    assert len(got) == patch.size and np.corrcoef(v.ravel(), patch.ravel())[0, 1] > 0.9


def test_stream_equals_batch(spark, tmp_path):
    pixels = spark.range(400).selectExpr("int(id div 100) image", "int((id % 100) div 10) row", "int(id % 10) col", "atan2(sin(id * 0.7), cos(id * 0.7)) phase", "double(1) coh")
    for k in range(4):
        pixels.where(f"image = {k}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = streaming.pixel_stream(spark, str(tmp_path / "in"), pixels.schema, 2)
    q = streaming.process_new_pairs(stream, str(tmp_path / "out"), str(tmp_path / "check"))
    q.awaitTermination(120)
    from fringeframe.operators.unwrapping import unwrap

    want = unwrap(pixels).select("image", "row", "col", "cycles").orderBy("image", "row", "col").collect()
    assert spark.read.parquet(str(tmp_path / "out")).select("image", "row", "col", "cycles").orderBy("image", "row", "col").collect() == want
