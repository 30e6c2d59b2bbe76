"""Regions in KML, and points and reports in GeoJSON, JSON and CSV."""

from __future__ import annotations

import json
import xml.etree.ElementTree as ET
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kml_rings(text: str, strict: bool = False) -> list[list[tuple[float, float]]]:
    """(lon, lat) points of each coordinate list.

    Loose: lists of one point or more, a bad number raises.  Strict: bad tokens are skipped, a ring has three
    points or more, and no ring at all raises.
    """
    rings = []
    for node in ET.fromstring(text).iter():
        if node.tag.rpartition("}")[2] != "coordinates" or not node.text:
            continue
        ring = []
        for token in node.text.split():
            try:
                lon, lat = map(float, token.split(",")[:2])
                ring.append((lon, lat))
            except ValueError:
                if not strict:
                    raise
        if len(ring) >= (3 if strict else 1):
            rings.append(ring)
    if strict and not rings:
        raise ValueError("no ring of three points")
    return rings


def read_kml(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """(file, ring, seq, lon, lat) of all KML files at a path or glob."""
    rows = []
    for r in spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("file")).collect():
        rows += [(r["file"], k, s, lon, lat) for k, ring in enumerate(kml_rings(r["value"], strict)) for s, (lon, lat) in enumerate(ring)]
    return spark.createDataFrame(rows, "file string, ring int, seq int, lon double, lat double")


def kml_bounds(points: DataFrame) -> DataFrame:
    """(file, west, south, east, north) of a KML table."""
    return points.groupBy("file").agg(F.min("lon").alias("west"), F.min("lat").alias("south"), F.max("lon").alias("east"), F.max("lat").alias("north"))


def write_kml(path: str, name: str, rings: list[list[tuple[float, float]]]) -> None:
    """One placemark of polygons per ring, closed."""
    root = ET.Element("kml", xmlns="http://www.opengis.net/kml/2.2")
    document = ET.SubElement(root, "Document")
    ET.SubElement(document, "name").text = name
    for k, ring in enumerate(rings, 1):
        mark = ET.SubElement(document, "Placemark")
        ET.SubElement(mark, "name").text = f"{name} {k}"
        node = mark
        for tag in ("Polygon", "outerBoundaryIs", "LinearRing"):
            node = ET.SubElement(node, tag)
        closed = ring if ring[0] == ring[-1] else [*ring, ring[0]]
        ET.SubElement(node, "coordinates").text = " ".join(f"{lon:.8f},{lat:.8f},0" for lon, lat in closed)
    ET.ElementTree(root).write(path, encoding="utf-8", xml_declaration=True)


def outline_coordinates(ring, lon, lat) -> list[tuple[float, float]]:
    """Coordinates of the pixels nearest to an outline's (row, col) vertices."""
    h, w = lon.shape
    at = [(min(max(int(round(r)), 0), h - 1), min(max(int(round(c)), 0), w - 1)) for r, c in ring]
    return [(float(lon[p]), float(lat[p])) for p in dict.fromkeys(at)]


def read_pair_report(spark: SparkSession, path: str, key: str) -> DataFrame:
    """A CSV report by ``pair``, with - between its dates; of rows of one pair the last one counts; empty if missing."""
    if not path.startswith(("hdfs:", "s3", "viewfs:", "abfs")) and not Path(path.removeprefix("file://")).exists():
        return spark.createDataFrame([], "pair string")
    rows = spark.read.csv(path, header=True).withColumn("at__", F.monotonically_increasing_id())
    rows = rows.withColumn("pair", F.replace(F.col(key), F.lit("_"), F.lit("-")))
    last = rows.groupBy("pair").agg(F.max("at__").alias("at__"))
    return rows.join(last, ["pair", "at__"], "left_semi").drop("at__")


def write_report(rows: DataFrame, path: str, overwrite: bool = False) -> None:
    """A report as one CSV file with a header, in its own folder; one that is there is only replaced if asked for."""
    rows.coalesce(1).write.mode("overwrite" if overwrite else "errorifexists").csv(path, header=True)


def point_features(points: DataFrame) -> DataFrame:
    """GeoJSON features of (id, longitude, latitude, velocity)."""
    geometry = F.struct(F.lit("Point").alias("type"), F.array("longitude", "latitude").alias("coordinates"))
    properties = F.struct("id", F.col("velocity").alias("velocity_m_per_year"), (F.col("velocity") * F.lit(1000.0)).alias("velocity_mm_per_year"))
    return points.select(F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), properties.alias("properties"))).alias("feature"))


def write_json(path: str, value: dict) -> None:
    Path(path).write_text(json.dumps(value, indent=2, default=str))
