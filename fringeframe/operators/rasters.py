"""From pixel tables to images and back.

A pixel table is dense: (image, row, col, values...), a masked pixel being a row of nulls.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def image_array(frame: pd.DataFrame, columns: list[str]) -> dict[str, np.ndarray]:
    """Arrays (row, col) of one image's rows; NaN for nulls and for rows that are missing."""
    row, col = frame["row"].to_numpy(np.int64), frame["col"].to_numpy(np.int64)
    shape = (int(row.max()) + 1, int(col.max()) + 1)
    out = {}
    for c in columns:
        a = np.full(shape, np.nan)
        a[row, col] = frame[c].astype(float).to_numpy()
        out[c] = a
    return out


def nullable(values: np.ndarray) -> pd.arrays.FloatingArray:
    """Floats whose NaN are gaps: they reach Spark as nulls."""
    return pd.arrays.FloatingArray(np.nan_to_num(values), ~np.isfinite(values))


def per_image(pixels: DataFrame, columns: list[str], run: Callable[[dict[str, np.ndarray]], dict[str, np.ndarray]], added: str) -> DataFrame:
    """Applies a whole-image function: one task an image, results joined to the pixels it came from.

    ``added`` is the schema of the new columns; NaN comes back as null.
    """
    names = [x.split()[0] for x in added.split(",")]
    kind = pixels.schema["image"].dataType.simpleString()

    def apply(key, frame: pd.DataFrame) -> pd.DataFrame:
        got = run(image_array(frame, columns))
        out = frame[["row", "col"]].copy()
        out.insert(0, "image", key[0])
        for n in names:
            values = got[n][out["row"], out["col"]]
            out[n] = nullable(values) if values.dtype.kind == "f" else values
        return out

    return pixels.select("image", "row", "col", *columns).groupBy("image").applyInPandas(apply, f"image {kind}, row int, col int, {added}")
