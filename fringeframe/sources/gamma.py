"""Headerless big-endian rasters: discovery of their shape, reading in row blocks, writing.

``read_raster`` goes through Spark's binary file reader and so reaches any store Spark does; the "gamma"
data source reads blocks of rows with seeks, and skips rows that a filter excludes, on a shared file system.
"""

from __future__ import annotations

import itertools
import json
import os
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from ..functions.phase import pair_dates

KINDS = {"complex64": (np.dtype(">c8"), "re double, im double"), "float32": (np.dtype(">f4"), "value double")}


def parse_shape(text: str) -> tuple[int, int]:
    """(lines, width) of a parameter file's text."""
    found = [re.search(rf"^\s*{k}:\s*(\d+)", text, re.M) for k in ("azimuth_lines", "range_samples")]
    if not all(found):
        raise ValueError("the parameter file has no azimuth_lines or range_samples")
    return int(found[0][1]), int(found[1][1])


def discover_shape(folder: str | Path, explicit: tuple[int, int] | None = None) -> tuple[int, int]:
    """Explicit, else of ``crop_metadata.json``, else of all ``.par`` files, which must agree."""
    if explicit:
        return explicit
    folder = Path(folder)
    for path in sorted(folder.rglob("crop_metadata.json")):
        meta = json.loads(path.read_text())
        shape = meta.get("cropped_shape_lines_width") or meta.get("shape_lines_width")
        if shape:
            return int(shape[0]), int(shape[1])
    shapes = {parse_shape(p.read_text(errors="replace")) for p in sorted(folder.rglob("*.par"))}
    if len(shapes) != 1:
        raise ValueError(f"the shape of {folder} is {'unknown' if not shapes else f'ambiguous: {sorted(shapes)}'}")
    return shapes.pop()


def _columns(block: np.ndarray, first_row: int, kind: str) -> dict[str, pa.Array]:
    """Arrow columns of consecutive rows; NaN and infinities become nulls, pixels stay."""
    lines, width = block.shape
    cols = {"row": pa.array(np.repeat(np.arange(first_row, first_row + lines, dtype=np.int32), width)), "col": pa.array(np.tile(np.arange(width, dtype=np.int32), lines))}
    parts = {"re": block.real, "im": block.imag} if kind == "complex64" else {"value": block}
    for name, part in parts.items():
        flat = part.astype(np.float64).ravel()
        cols[name] = pa.array(flat, mask=~np.isfinite(flat))
    return cols


def read_raster(spark: SparkSession, path: str, shape: tuple[int, int], kind: str = "complex64", rows: int = 256) -> DataFrame:
    """(file, row, col, re, im) or (file, row, col, value) of all rasters at a path or glob; sizes must fit."""
    dtype, fields = KINDS[kind]
    lines, width = shape

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = content.as_buffer()
                if raw.size != lines * width * dtype.itemsize:
                    raise ValueError(f"{name} has {raw.size} bytes, not {lines} x {width} x {dtype.itemsize}")
                a = np.frombuffer(raw, dtype).reshape(shape)
                for r in range(0, lines, rows):
                    cols = _columns(a[r : r + rows], r, kind)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(cols["row"])), *cols.values()], names=["file", *cols])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(decode, f"file string, row int, col int, {fields}")


def with_pair(df: DataFrame, file: str = "file") -> DataFrame:
    """Adds the ``first`` and ``second`` dates in a file's name."""
    name = F.element_at(F.split(F.col(file), "/"), -1)
    first, second = pair_dates(name)
    return df.withColumns({"first": first, "second": second})


def wrapped_phase(df: DataFrame) -> DataFrame:
    """Phase of complex pixels; null where the amplitude is zero or unknown."""
    return df.withColumn("phase", F.when(F.hypot("re", "im") > 0, F.atan2("im", "re")))


#: Bytes of raster rows that a task of the data source reads, what opening one more file counts for, and pixels of a batch.
_TASK_BYTES, _OPEN_BYTES, _BATCH_PIXELS = 8 << 20, 16 << 10, 1 << 16


class _Blocks(InputPartition):
    """Blocks of rows (file's name, first, end) of the rasters in a folder, read by one task."""

    def __init__(self, folder: str, blocks: list[tuple[str, int, int]]):
        self.folder, self.blocks = folder, blocks


class _GammaReader(DataSourceReader):
    def __init__(self, options: dict):
        self.kind = options.get("kind", "complex64")
        self.lines, self.width = int(options["lines"]), int(options["width"])
        self.block, self.path = int(options.get("rows", 256)), options["path"]
        self.low, self.high = 0, self.lines

    def pushFilters(self, filters):
        """Bounds on the row become seeks; all other filters stay with Spark."""
        for f in filters:
            row = getattr(f, "attribute", None) == ("row",)
            if row and isinstance(f, GreaterThanOrEqual):
                self.low = max(self.low, f.value)
            elif row and isinstance(f, GreaterThan):
                self.low = max(self.low, f.value + 1)
            elif row and isinstance(f, LessThanOrEqual):
                self.high = min(self.high, f.value + 1)
            elif row and isinstance(f, LessThan):
                self.high = min(self.high, f.value)
            else:
                yield f

    def partitions(self):
        """Blocks in order of files and rows; a large block is a task of its own, small ones share a task."""
        row_bytes = self.width * KINDS[self.kind][0].itemsize
        size = self.lines * row_bytes
        path = Path(self.path)
        if path.is_dir():
            folder = str(path)
            with os.scandir(path) as entries:
                files = sorted((e.name, e.stat().st_size) for e in entries if e.is_file())
        else:
            folder, files = str(path.parent), [(path.name, path.stat().st_size)]
        tasks, room = [], 0
        for name, found in files:
            if found != size:
                raise ValueError(f"{Path(folder, name)} has {found} bytes, not {size}")
            for r in range(self.low, self.high, self.block):
                end = min(r + self.block, self.high)
                cost = (end - r) * row_bytes + _OPEN_BYTES * (r == self.low)
                if not tasks or cost > room:
                    tasks.append(_Blocks(folder, []))
                    room = _TASK_BYTES
                tasks[-1].blocks.append((name, r, end))
                room -= cost
        return tasks

    def read(self, partition):
        dtype = KINDS[self.kind][0]
        waiting, pixels = [], 0
        for name, blocks in itertools.groupby(partition.blocks, key=lambda b: b[0]):
            path = str(Path(partition.folder, name))
            with open(path, "rb") as f:
                for _, first, end in blocks:
                    f.seek(first * self.width * dtype.itemsize)
                    waiting.append((path, first, np.fromfile(f, dtype, (end - first) * self.width).reshape(-1, self.width)))
                    pixels += waiting[-1][2].size
                    if pixels >= _BATCH_PIXELS:
                        yield self._batch(waiting)
                        waiting, pixels = [], 0
        if waiting:
            yield self._batch(waiting)

    def _batch(self, blocks: list[tuple[str, int, np.ndarray]]) -> pa.RecordBatch:
        """One batch of the pixels of several blocks (path, first row, values)."""
        cols = _columns(np.concatenate([a for _, _, a in blocks]), 0, self.kind)
        rows = np.concatenate([np.arange(first, first + len(a), dtype=np.int32) for _, first, a in blocks])
        cols["row"] = pa.array(np.repeat(rows, self.width))
        owner = pa.array(np.repeat(np.arange(len(blocks), dtype=np.int32), [a.size for _, _, a in blocks]))
        return pa.RecordBatch.from_arrays([pa.array([p for p, _, _ in blocks]).take(owner), *cols.values()], names=["file", *cols])


class GammaSource(DataSource):
    """``spark.read.format("gamma")`` with options path, lines, width, kind, rows.

    Needs ``spark.sql.python.filterPushdown.enabled``, for its filters on rows are seeks.
    """

    @classmethod
    def name(cls) -> str:
        return "gamma"

    def schema(self) -> str:
        return f"file string, row int, col int, {KINDS[self.options.get('kind', 'complex64')][1]}"

    def reader(self, schema):
        return _GammaReader(self.options)


def read_window(path: str, kind: str, width: int = 0, rows: tuple[int, int] = (1, 0), cols: tuple[int, int] = (1, 0), lines: int = 0) -> np.ndarray:
    """A window of one raster; rows and columns count from 1, inclusive, 0 meaning the first or last.

    The width follows from the file's size where only the lines are given.
    """
    if kind not in KINDS:
        raise ValueError(f"unsupported format: {kind}")
    dtype = KINDS[kind][0]
    cells = os.path.getsize(path) // dtype.itemsize
    if not width:
        if not lines or cells % lines:
            raise ValueError("the width cannot be inferred")
        width = cells // lines
    a = np.memmap(path, dtype, "r", shape=(cells // width, width))
    return np.array(a[max(rows[0], 1) - 1 : rows[1] or None, max(cols[0], 1) - 1 : cols[1] or None])


def write_window(source: str, target: str, kind: str, width: int, rows: tuple[int, int], cols: tuple[int, int]) -> tuple[int, int]:
    """Copies a window of one raster, end-exclusive and from 0, in the same format; its (lines, width)."""
    part = read_window(source, kind, width, (rows[0] + 1, rows[1]), (cols[0] + 1, cols[1]))
    os.makedirs(os.path.dirname(target), exist_ok=True)
    part.tofile(f"{target}.part")
    os.replace(f"{target}.part", target)
    return part.shape


def write_rasters(pixels: DataFrame, folder: str, name: str, kind: str = "float32") -> DataFrame:
    """Writes one big-endian raster per image of a dense table into a shared folder; (image, path, bytes).

    ``name`` is the column with the file's name; nulls are written as NaN (complex: as 0).  A file appears
    whole or not at all, and a task that runs again replaces it by itself.
    """
    dtype = KINDS[kind][0]
    parts = ["re", "im"] if kind == "complex64" else ["value"]

    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        from ..operators.rasters import image_array

        a = image_array(frame, parts)
        out = np.nan_to_num(a["re"]) + 1j * np.nan_to_num(a["im"]) if kind == "complex64" else a["value"]
        path = f"{folder}/{frame[name].iloc[0]}"
        part = f"{path}.{os.getpid()}.part"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        out.astype(dtype).tofile(part)
        os.replace(part, path)
        return pd.DataFrame([{"image": key[0], "path": path, "bytes": out.size * dtype.itemsize}])

    k = pixels.schema["image"].dataType.simpleString()
    return pixels.select("image", "row", "col", name, *parts).groupBy("image").applyInPandas(run, f"image {k}, path string, bytes long")
