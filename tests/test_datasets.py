import json

import numpy as np
import pytest
from test_rasters import synthetic

from pyspark.sql import functions as F

from fringeframe import cli
from fringeframe.operators import detrending
from fringeframe.plans import datasets
from fringeframe.sources import arrays, elevation, geotiff


def scene(spark, tmp_path):
    """A dataset's folder of rasters."""
    pixels, patch = synthetic(spark)
    h, w = patch.shape
    root = tmp_path / "in"
    (root / "Dataset_A/INT").mkdir(parents=True)
    (root / "Dataset_A/GEO").mkdir()
    for (first, second), frame in pixels.toPandas().groupby(["first", "second"]):
        z, coh = np.zeros((h, w), ">c8"), np.zeros((h, w), ">f4")
        z[frame["row"], frame["col"]] = frame["re"] + 1j * frame["im"]
        coh[frame["row"], frame["col"]] = frame["coh"]
        name = f"{first:%Y%m%d}-{second:%Y%m%d}"
        z.tofile(root / f"Dataset_A/INT/{name}.filt")
        coh.tofile(root / f"Dataset_A/INT/{name}.coh")
    y, x = np.indices((h, w))
    (-118 + 0.001 * x).astype(">f4").tofile(root / "Dataset_A/GEO/a.lon")
    (34 - 0.001 * y).astype(">f4").tofile(root / "Dataset_A/GEO/a.lat")
    (root / "Dataset_A/a.par").write_text(f"range_samples: {w}\nazimuth_lines: {h}\n")
    return root, h, w


REGION = "<kml><Placemark><coordinates>{} {} {}</coordinates></Placemark></kml>"


def test_folder_to_products(spark, tmp_path, capsys):
    root, h, w = scene(spark, tmp_path)
    args = ["run", str(root), "--tables", f"file://{tmp_path}/tables", "--products", str(tmp_path / "out"), "--search", "2", "--patch", "1", "--most-days", "30", "--mask-min-pixels", "4", "--mask-radius", "1", "--quality-sigma", "3"]
    assert cli.main(args, spark) == 0 and "Dataset_A: 4 dates" in capsys.readouterr().out
    assert datasets.require_outputs(f"file://{tmp_path}/tables/Dataset_A") and datasets.require_outputs(tmp_path / "out/Dataset_A", "products")
    assert len(spark.read.csv(f"file://{tmp_path}/tables/Dataset_A/detrending_csv", header=True).collect()) == spark.read.parquet(f"file://{tmp_path}/tables/Dataset_A/quality").where("included").count()
    grid, tags = geotiff.read_geotiff(str(tmp_path / "out/Dataset_A/velocity.tif"))
    assert grid.shape == (h, w) and tags[34735][-1] == 4326
    point = json.loads((tmp_path / "out/Dataset_A/points.geojson").read_text())["features"][0]
    assert point["properties"]["id"] == "P1" and -118 <= point["geometry"]["coordinates"][0] <= -117
    assert "<coordinates>" in (tmp_path / "out/Dataset_A/moving.kml").read_text()
    assert cli.main(["point", f"file://{tmp_path}/tables/Dataset_A", "12", "13"], spark) == 0
    assert len(json.loads(capsys.readouterr().out)) == 4
    next((root / "Dataset_A/INT").glob("*.coh")).unlink()
    with pytest.raises(ValueError, match="no coherence"):
        datasets.read_dataset(spark, str(root), "A")


def test_single_stages_and_reference_region(spark, tmp_path, capsys):
    root, h, w = scene(spark, tmp_path)
    (tmp_path / "region.kml").write_text(REGION.format("-118.1,34.1", "-117.9,34.1", "-118.0,33.8"))
    common = [str(root), "--tables", f"file://{tmp_path}/tables", "--products", str(tmp_path / "out"), "--search", "2", "--patch", "1", "--most-days", "30", "--mask-min-pixels", "4", "--mask-radius", "1", "--quality-sigma", "3"]
    assert cli.main(["unwrap", *common], spark) == 0
    with pytest.raises(FileNotFoundError, match="detrended"):
        datasets.require_outputs(f"file://{tmp_path}/tables/Dataset_A")
    assert cli.main(["mask", *common], spark) == 0
    assert cli.main(["detrend", *common, "--reference-kml", f"file://{tmp_path}/region.kml", "--output-edge-guard", "2", "--fit-edge-guard", "2"], spark) == 0
    flat = spark.read.parquet(f"file://{tmp_path}/tables/Dataset_A/detrended")
    assert flat.where("row < 2 OR col < 2").where("phase IS NOT NULL").count() == 0 and flat.where("phase IS NOT NULL").count() > 0
    assert cli.main(["timeseries", *common], spark) == 0
    assert spark.read.parquet(f"file://{tmp_path}/tables/Dataset_A/series").where("velocity IS NOT NULL").count() > 0


def test_crop_command(spark, tmp_path, capsys):
    root, h, w = scene(spark, tmp_path)
    (tmp_path / "roi.kml").write_text(REGION.format("-117.9955,33.9965", "-117.9915,33.9965", "-117.9915,33.9925"))
    args = ["crop", str(root / "Dataset_A"), f"file://{tmp_path}/roi.kml", str(tmp_path / "roi"), "--margin", "0"]
    assert cli.main(args, spark) == 0
    meta = json.loads((tmp_path / "roi/crop_metadata.json").read_text())
    assert meta["cropped_shape_lines_width"] == [4, 4] and meta["window"]["row_start"] == 4 and meta["window"]["col_start"] == 5
    lon = np.fromfile(tmp_path / "roi/GEO/a.lon", ">f4").reshape(4, 4)
    assert np.allclose(lon, -118 + 0.001 * (5 + np.arange(4))[None, :], atol=1e-5)
    assert {p.stat().st_size for p in (tmp_path / "roi/INT").glob("*.filt")} == {4 * 4 * 8}
    with pytest.raises(FileExistsError):
        cli.main(args, spark)
    assert cli.main([*args, "--overwrite"], spark) == 0
    with pytest.raises(ValueError, match="together"):
        cli.main([*args, "--overwrite", "--lines", "4"], spark)


def test_unwrapped_files_are_one_a_pair(tmp_path):
    with pytest.raises(FileNotFoundError):
        datasets.discover_unwrapped(tmp_path)
    for name in ("20240113-20240125.unw", "20240101-20240113.unw"):
        (tmp_path / name).touch()
    assert [p.name for p in datasets.discover_unwrapped(tmp_path)] == ["20240101-20240113.unw", "20240113-20240125.unw"]
    (tmp_path / "x_20240101_20240113.unw").touch()
    with pytest.raises(ValueError, match="one pair"):
        datasets.discover_unwrapped(tmp_path)
    assert datasets.purge_stale(tmp_path, {"20240113-20240125"}) == ["20240101-20240113.unw", "x_20240101_20240113.unw"]
    assert len(datasets.discover_unwrapped(tmp_path)) == 1


def test_geolocation_is_found_through_the_summary(tmp_path):
    out, source = tmp_path / "out/Dataset_A", tmp_path / "in/Dataset_A"
    out.mkdir(parents=True)
    (out / "run_summary.json").write_text(json.dumps({"config": {"geo_root": str(tmp_path / "geo")}, "source_unwrapping_summary": {"input_directory": str(source)}}))
    assert datasets.optional_geolocation(out) is None
    for folder in (source / "GEO", tmp_path / "geo/Dataset_A/GEO", out / "GEO"):
        folder.mkdir(parents=True)
        for s in ("lon", "lat"):
            (folder / f"a.{s}").touch()
        assert datasets.find_geolocation(out) == (folder / "a.lon", folder / "a.lat")
    with pytest.raises(FileNotFoundError):
        datasets.find_geolocation(tmp_path / "nowhere")


def test_npy_round_trip(spark, tmp_path):
    stack = np.arange(24, dtype=np.float32).reshape(2, 3, 4)
    stack[1, 2, 3] = np.nan
    np.save(tmp_path / "stack.npy", stack)
    table = arrays.read_npy(spark, f"file://{tmp_path}/stack.npy")
    assert table.count() == 24 and table.where("value IS NULL").count() == 1
    assert arrays.write_npy(table.withColumnRenamed("image", "name"), str(tmp_path / "out"), "name", "value").count() == 2
    assert np.array_equal(np.load(tmp_path / "out/1.npy"), stack[1], equal_nan=True)


def test_elevation_model_with_no_data_and_projection(spark, tmp_path):
    grid = np.arange(30.0).reshape(5, 6)
    grid[2, 3] = np.nan
    geotiff.write_geotiff(str(tmp_path / "dem.tif"), grid, (-118.0, 34.0, 0.5, 0.25))
    model = elevation.read_elevation((tmp_path / "dem.tif").read_bytes())
    assert np.allclose(model.cells, grid, equal_nan=True) and (model.west, model.north, model.dx, model.dy, model.epsg) == (-118.0, 34.0, 0.5, 0.25, 4326)
    geo = spark.createDataFrame([(0, 0, -117.9, 33.9), (0, 1, -116.4, 33.4), (1, 0, -115.1, 32.9), (1, 1, 0.0, 0.0), (2, 0, -119.0, 33.9)], "row int, col int, lon double, lat double")
    got = {(r["row"], r["col"]): r["elev"] for r in elevation.sample_elevation(spark, geo, f"file://{tmp_path}/dem.tif").collect()}
    assert got == {(0, 0): 0.0, (0, 1): None, (1, 0): 29.0, (1, 1): None, (2, 0): None}
    # Positions on a central meridian, and one with coordinates known from a public converter.
    x, y = elevation.project(F.col("lon"), F.col("lat"), 32611)
    rows = spark.createDataFrame([(-117.0, 0.0), (-117.0, 34.0), (-118.0, 34.0)], "lon double, lat double").select(x.alias("x"), y.alias("y")).collect()
    assert abs(rows[0]["x"] - 500000) < 1e-6 and abs(rows[0]["y"]) < 1e-6 and abs(rows[1]["x"] - 500000) < 1e-6
    arc = quadrature(34.0)
    assert abs(rows[1]["y"] - 0.9996 * arc) < 1e-3
    assert abs(rows[2]["x"] - 407650.40) < 0.5 and abs(rows[2]["y"] - 3762606.66) < 0.5
    with pytest.raises(ValueError, match="EPSG"):
        elevation.project(F.col("lon"), F.col("lat"), 3857)


def quadrature(lat):
    """Length of a meridian from the equator, by the trapezoidal rule."""
    f = 1 / 298.257223563
    e2, phi = f * (2 - f), np.linspace(0, np.radians(lat), 200_001)
    return float(np.trapezoid(6378137.0 * (1 - e2) / (1 - e2 * np.sin(phi) ** 2) ** 1.5, phi))


def test_an_image_that_cannot_be_fitted_is_reported(spark):
    rows = [(k, r, c, None if k == 1 and r else float(r + c)) for k in range(2) for r in range(6) for c in range(6)]
    pixels = spark.createDataFrame(rows, "image long, row int, col int, phase double")
    got = {r["image"]: r for r in detrending.detrend_reports(pixels).collect()}
    assert got[0]["status"] == "ok" and got[0]["valid_pixels"] == 36
    assert "too few" in got[1]["status"] and got[1]["valid_pixels"] == 6 and not got[1]["accepted"]
    out = detrending.detrend(pixels).where("image = 1").collect()
    assert len(out) == 36 and all(r["detrended"] is None for r in out)
