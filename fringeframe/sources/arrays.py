"""NumPy files as tables of pixels, and tables of pixels as NumPy files."""

from __future__ import annotations

import io
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def read_npy(spark: SparkSession, path: str) -> DataFrame:
    """(file, image, row, col, value) of all ``.npy`` files at a path or glob: matrices (image 0), or stacks of them.

    Numbers and booleans become doubles, NaN and infinities nulls; pixels stay as rows.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                stack = np.load(io.BytesIO(content), allow_pickle=False)
                if stack.ndim not in (2, 3):
                    raise ValueError(f"{name} has {stack.ndim} dimensions, not 2 or 3")
                for k, image in enumerate(stack if stack.ndim == 3 else stack[None]):
                    row, col = (x.ravel().astype(np.int32) for x in np.indices(image.shape))
                    value = image.astype(float).ravel()
                    yield pa.RecordBatch.from_arrays([pa.array([name] * value.size), pa.array(np.full(value.size, k, np.int32)), pa.array(row), pa.array(col), pa.array(value, mask=~np.isfinite(value))], names=["file", "image", "row", "col", "value"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(decode, "file string, image int, row int, col int, value double")


def write_npy(pixels: DataFrame, folder: str, name: str, column: str) -> DataFrame:
    """Writes one float32 matrix for each value of the column ``name`` into a shared folder; (name, path).  Nulls
    become NaN; a file appears whole or not at all."""

    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        from ..operators.rasters import image_array

        path = f"{folder}/{key[0]}.npy"
        os.makedirs(folder, exist_ok=True)
        part = f"{path}.{os.getpid()}.part"
        with open(part, "wb") as f:
            np.save(f, image_array(frame, [column])[column].astype(np.float32))
        os.replace(part, path)
        return pd.DataFrame([{"name": str(key[0]), "path": path}])

    return pixels.select(name, "row", "col", column).groupBy(name).applyInPandas(run, "name string, path string")
