"""Displacement series from a network of image pairs, by weighted least squares per pixel.

Pixels that miss the same pairs share a pseudo-inverse, so one is made for each pattern of valid pairs and
every pixel's solution is a matrix product in its batch.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .network import design_matrix


def solve(y: np.ndarray, pairs: list[tuple], dates: list, wavelength: float = 0.056, sign: float = 1.0, weights: list[float] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Displacements (pixel, date), velocity a year and residual of observations (pixel, pair) in radians.

    Pixels with fewer valid pairs than dates less one, or of deficient rank, are NaN.  The residual is the
    unweighted root mean square in radians over the valid pairs; the velocity is the slope over all dates.
    """
    w = np.ones(len(pairs)) if weights is None else np.asarray(weights, float)
    if (w <= 0).any() or not np.isfinite(w).all():
        raise ValueError("weights must be positive")
    a = design_matrix(dates, pairs)
    ok = np.isfinite(y)
    x, rms = np.full((len(y), len(dates)), np.nan), np.full(len(y), np.nan)
    for pattern, members in _patterns(ok):
        used = a[pattern]
        if pattern.sum() < len(dates) - 1 or np.linalg.matrix_rank(used) < len(dates) - 1:
            continue
        root = np.sqrt(w[pattern])
        mine = y[members][:, pattern]
        got = mine @ (np.linalg.pinv(used * root[:, None]) * root).T
        x[members, 0], x[members, 1:] = 0.0, got
        rms[members] = np.sqrt(np.mean((mine - got @ used.T) ** 2, axis=1))
    x *= sign * wavelength / (4 * math.pi)
    years = np.array([(d - dates[0]).days / 365.25 for d in dates])
    years -= years.mean()
    velocity = (x - x.mean(axis=1, keepdims=True)) @ years / (years @ years) if len(dates) > 1 else np.full(len(y), np.nan)
    return x, velocity, rms


def _patterns(ok: np.ndarray):
    packed = np.packbits(ok, axis=1)
    _, first, back = np.unique(packed, axis=0, return_index=True, return_inverse=True)
    back = back.ravel()
    order = np.argsort(back, kind="stable")
    edge = np.searchsorted(back[order], np.arange(len(first) + 1))
    for k, f in enumerate(first):
        yield ok[f], order[edge[k] : edge[k + 1]]


def observations(stack: DataFrame, keys: list[str], pairs: list[tuple]) -> DataFrame:
    """One row a pixel: ``y``, its phases in the order of ``pairs``, null where a pair is missing.

    The stack (keys, first, second, phase) is shuffled once, by pixel, after selecting the pairs.
    """
    index = F.create_map(*(x for k, (a, b) in enumerate(pairs) for x in (F.lit(f"{a}|{b}"), F.lit(k))))
    at = index[F.concat_ws("|", F.col("first").cast("string"), F.col("second").cast("string"))]
    picked = stack.withColumn("k__", at).where(F.col("k__").isNotNull())
    slots = [F.max(F.when(F.col("k__") == k, F.col("phase"))) for k in range(len(pairs))]
    return picked.groupBy(*keys).agg(F.array(*slots).alias("y"))


def invert(obs: DataFrame, pairs: list[tuple], dates: list, wavelength: float = 0.056, sign: float = 1.0, weights: list[float] | None = None) -> DataFrame:
    """Adds ``disp`` (array, metres, a value a date), ``velocity`` (metres a year) and ``rms`` to rows with ``y``."""
    number = T.DoubleType()
    schema = T.StructType([*obs.drop("y").schema, T.StructField("disp", T.ArrayType(number)), T.StructField("velocity", number), T.StructField("rms", number)])
    solve(np.zeros((0, len(pairs))), pairs, dates, wavelength, sign, weights)

    def run(batches):
        for batch in batches:
            y = np.array([[np.nan if v is None else v for v in row] for row in batch.column("y").to_pylist()], float).reshape(batch.num_rows, len(pairs))
            x, velocity, rms = solve(y, pairs, dates, wavelength, sign, weights)
            lost = np.isnan(rms)
            keep = [batch.column(n) for n in batch.schema.names if n != "y"]
            series = pa.array([None if bad else row.tolist() for bad, row in zip(lost, x)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*keep, series, pa.array(velocity, mask=lost), pa.array(rms, mask=lost)], names=schema.names)

    return obs.select(*[c for c in obs.columns if c != "y"], "y").mapInArrow(run, schema)


def validity_patterns(obs: DataFrame) -> DataFrame:
    """(pattern, pixels, pairs): how many pixels share each pattern of valid pairs."""
    pattern = F.array_join(F.transform("y", lambda v: F.when(v.isNull(), "0").otherwise("1")), "")
    return obs.groupBy(pattern.alias("pattern")).agg(F.count(F.lit(1)).alias("pixels")).withColumn("pairs", F.length(F.translate("pattern", "0", "")))


def velocity_of(series: DataFrame, keys: list[str], dates: int) -> DataFrame:
    """(keys, velocity) of a long series (keys, years, disp): the slope, where all dates have a value."""
    got = series.groupBy(*keys).agg(F.regr_slope("disp", "years").alias("v__"), F.count("disp").alias("n__"))
    return got.select(*keys, F.when(F.col("n__") == dates, F.col("v__")).alias("velocity"))
