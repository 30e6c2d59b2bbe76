"""Phase filters on complex images: coherence-adaptive non-local mean and spectral enhancement."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import images
from .rasters import image_array, nullable, per_image


def nonlocal_mean(z: np.ndarray, coherence: np.ndarray, search: int = 7, patch: int = 3, bandwidth: float = 0.70, spread: float = 3.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Filtered image (amplitudes kept, invalid pixels 0), phase concentration, and sum of weights.

    A pixel's phasor becomes the mean of those around it, weighted by how alike the patches' phases are
    around the circle, by nearness, and by the coherence of both; low coherence widens the tolerance.
    Support is local, so strips with a margin of search + patch pixels give the same answer.
    """
    z, coh = np.asarray(z, complex), np.clip(np.nan_to_num(coherence), 0, 1)
    size = np.abs(z)
    valid = np.isfinite(size) & (size > 0)
    unit = np.where(valid, z, 0) / np.where(valid, size, 1)
    tolerance = np.maximum(0.08, bandwidth * (0.35 + 0.90 * (1 - coh))) ** 2
    h, w = z.shape
    total, weight_sum = np.zeros((h, w), complex), np.zeros((h, w))
    wide = lambda a: np.pad(a, search)
    units, cohs, valids = wide(unit), wide(coh), wide(valid)
    for dy in range(-search, search + 1):
        for dx in range(-search, search + 1):
            view = (slice(search - dy, search - dy + h), slice(search - dx, search - dx + w))
            both = valid & valids[view]
            unlike = np.where(both, 1 - (unit * units[view].conj()).real, 1.0)
            weight = np.exp(-images.box_mean(unlike, patch) / tolerance - (dy * dy + dx * dx) / (2 * spread * spread))
            weight = weight * (0.2 + 0.8 * np.sqrt(np.maximum(coh * cohs[view], 1e-3))) * both
            if not dy and not dx:
                weight = weight + valid
            total += weight * units[view]
            weight_sum += weight
    mean = np.where(weight_sum > 1e-12, total / np.where(weight_sum > 1e-12, weight_sum, 1), unit)
    length = np.abs(mean)
    phasor = np.where(length > 1e-12, mean / np.where(length > 1e-12, length, 1), unit)
    return np.where(valid, np.where(valid, size, 0) * phasor, 0), np.clip(length, 0, 1), weight_sum


def goldstein(z: np.ndarray, coherence: np.ndarray, strength: float = 0.40, sigma: float = 1.0) -> np.ndarray:
    """Raises the whole image's spectrum by its smoothed magnitude to one power, the larger the lower the
    median coherence; amplitudes are kept.  The spectrum is the whole image's, so it cannot be tiled."""
    spectrum = np.fft.fft2(np.asarray(z, complex))
    size = images.gaussian(np.abs(spectrum), sigma, "wrap")
    power = float(np.clip(strength * np.nanmedian(1 - np.asarray(coherence, float)), 0, 0.8))
    raised = np.fft.ifft2(spectrum * np.maximum(size / max(float(size.max()), 1e-12), 1e-8) ** power)
    length = np.abs(raised)
    return np.abs(z) * np.where(length > 0, raised / np.where(length > 0, length, 1), 0)


def hybrid(z: np.ndarray, coherence: np.ndarray, search: int = 7, patch: int = 3, bandwidth: float = 0.70, strength: float = 0.40) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Non-local mean, then spectral enhancement of its result."""
    mean, concentration, support = nonlocal_mean(z, coherence, search, patch, bandwidth)
    return goldstein(mean, coherence, strength), concentration, support


def nonlocal_strips(pixels: DataFrame, keys: tuple[str, ...] = ("image",), search: int = 7, patch: int = 3, bandwidth: float = 0.70, rows: int = 128) -> DataFrame:
    """The non-local mean of every image of (keys, row, col, re, im, coh): (keys, row, col, re, im, coh, concentration,
    support).  A task is a strip of ``rows`` rows with the margin it needs, so large scenes spread over many."""
    margin = search + patch
    first, last = (F.floor((F.col("row") + x) / rows).cast("int") for x in (-margin, margin))
    dealt = pixels.select(*keys, "row", "col", "re", "im", "coh", F.explode(F.sequence(F.greatest(first, F.lit(0)), last)).alias("strip"))

    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        first = key[-1] * rows
        top = max(0, first - margin)
        mine = frame["row"].between(first, first + rows - 1)
        if not mine.any():
            return frame.iloc[:0].assign(concentration=pd.array([], "Float64"), support=pd.array([], "Float64"))[names]
        a = image_array(frame.assign(row=frame["row"] - top), ["re", "im", "coh"])
        z, concentration, support = nonlocal_mean(a["re"] + 1j * a["im"], a["coh"], search, patch, bandwidth)
        out = frame.loc[mine, [*keys, "row", "col", "coh"]].copy()
        spot = (out["row"].to_numpy(int) - top, out["col"].to_numpy(int))
        for n, v in (("re", z.real), ("im", z.imag), ("concentration", concentration), ("support", support)):
            out[n] = nullable(v[spot])
        return out[names]

    names = [*keys, "row", "col", "re", "im", "coh", "concentration", "support"]
    kinds = ", ".join(f"{k} {pixels.schema[k].dataType.simpleString()}" for k in keys)
    return dealt.groupBy(*keys, "strip").applyInPandas(run, f"{kinds}, row int, col int, re double, im double, coh double, concentration double, support double")


def filter_phase(pixels: DataFrame, method: str = "hybrid", **settings) -> DataFrame:
    """Filters every image of (image, row, col, re, im, coh): (image, row, col, re, im, concentration, support).

    The non-local mean runs in strips, the spectral part, which sees whole images, one task an image.  Stages
    that follow take ``concentration`` as the filtered image's coherence.
    """
    if method not in ("nonlocal", "goldstein", "hybrid"):
        raise ValueError(f"unknown filter: {method}")
    strength = {k: settings.pop(k) for k in ("strength",) if k in settings}
    mean = pixels.select("image", "row", "col", "re", "im", "coh").withColumns({"concentration": F.lit(None).cast("double"), "support": F.lit(None).cast("double")})
    if method != "goldstein":
        mean = nonlocal_strips(pixels, **settings)
    if method == "nonlocal":
        return mean.drop("coh")

    def run(a: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        out = goldstein(np.nan_to_num(a["re"] + 1j * a["im"]), a["coh"], **strength)
        return {"re": out.real, "im": out.imag, "concentration": a["concentration"], "support": a["support"]}

    return per_image(mean, ["re", "im", "coh", "concentration", "support"], run, "re double, im double, concentration double, support double")
