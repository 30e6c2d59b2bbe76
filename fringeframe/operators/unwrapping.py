"""Phase unwrapping of one image: residues, branch cuts, growth from good pixels, alignment of regions.

The order of growth defines the answer, so an image is one task; images are independent of each other.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from . import images
from .rasters import per_image

TWO_PI = 2 * np.pi
#: More pairs of residues than this are matched greedily within the longest cut.
DENSE_PAIRS = 10_000_000


@dataclass(frozen=True)
class UnwrapReport:
    positive_residues: int
    negative_residues: int
    branch_cut_pixels: int
    branch_cut_edges: int
    valid_pixels: int
    unwrapped_pixels: int
    components: int
    rejected_long_cuts: int
    maximum_cut_length: float


def residues(wrapped: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """Circulation, in cycles, of the 2 x 2 loop whose top left pixel it is; 0 unless all four are valid."""
    a, b, c, d = wrapped[:-1, :-1], wrapped[:-1, 1:], wrapped[1:, 1:], wrapped[1:, :-1]
    loop = sum(images.wrap(q - p) for p, q in ((a, b), (b, c), (c, d), (d, a)))
    whole = valid[:-1, :-1] & valid[:-1, 1:] & valid[1:, 1:] & valid[1:, :-1]
    out = np.zeros(wrapped.shape, np.int8)
    out[:-1, :-1] = np.where(whole, np.rint(np.nan_to_num(loop) / TWO_PI), 0)
    return out


def _ends_factor(coherence: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cheaper cuts where the mean coherence of both ends is low; unknown counts as none."""
    return 0.75 + 0.5 * np.nan_to_num((coherence[tuple(a.T)] + coherence[tuple(b.T)]) / 2)


def match_residues(plus: np.ndarray, minus: np.ndarray, coherence: np.ndarray, longest: float, dense_pairs: int = DENSE_PAIRS) -> tuple[list[tuple[int, int]], int]:
    """Pairs of opposite residues, and how many matches were too long.

    Few: the matching of least total cost, from which long pairs are dropped.  Many: candidates within the
    longest cut, found on a grid, cheapest first; none then counts as too long.
    """
    if not len(plus) or not len(minus):
        return [], 0
    if len(plus) * len(minus) <= dense_pairs:
        length = np.hypot(plus[:, None, 0] - minus[None, :, 0], plus[:, None, 1] - minus[None, :, 1])
        ends = (coherence[tuple(plus.T)][:, None] + coherence[tuple(minus.T)][None, :]) / 2
        rows, cols = images.assign(length * (0.75 + 0.5 * np.nan_to_num(ends)))
        short = length[rows, cols] <= longest
        return list(zip(rows[short].tolist(), cols[short].tolist())), int((~short).sum())
    size = max(1, int(np.ceil(longest)))
    cells = defaultdict(list)
    for k, (r, c) in enumerate((minus // size).tolist()):
        cells[r, c].append(k)
    candidates = []
    for k, (r, c) in enumerate((plus // size).tolist()):
        near = np.array([x for dr in (-1, 0, 1) for dc in (-1, 0, 1) for x in cells.get((r + dr, c + dc), [])], int)
        length = np.hypot(*(minus[near] - plus[k]).T)
        near, length = near[length <= longest], length[length <= longest]
        cost = length * _ends_factor(coherence, np.repeat(plus[k : k + 1], len(near), axis=0), minus[near])
        candidates += zip(cost.tolist(), [k] * len(near), near.tolist())
    used, out = (set(), set()), []
    for _, a, b in sorted(candidates):
        if a not in used[0] and b not in used[1]:
            used[0].add(a)
            used[1].add(b)
            out.append((a, b))
    return out, 0


def branch_cuts(residue: np.ndarray, coherence: np.ndarray, longest: float = 15.0, dense_pairs: int = DENSE_PAIRS):
    """Cut pixels, barred steps to the right and down, cuts as pairs of pixels, and the number dropped for length.

    Opposite residues are joined; what is left is cut to the nearest border (left, right, top, bottom).
    """
    h, w = residue.shape
    plus, minus = np.argwhere(residue > 0), np.argwhere(residue < 0)
    matches, dropped = match_residues(plus, minus, coherence, longest, dense_pairs)
    cuts = [(tuple(plus[a]), tuple(minus[b])) for a, b in matches]
    taken = {p for cut in cuts for p in cut}
    for r, c in [tuple(p) for p in (*plus, *minus)]:
        if (r, c) not in taken:
            to = min([(r, 0), (r, w - 1), (0, c), (h - 1, c)], key=lambda q: (q[0] - r) ** 2 + (q[1] - c) ** 2)
            if abs(to[0] - r) + abs(to[1] - c) <= longest:
                cuts.append(((r, c), to))
            else:
                dropped += 1
    pixels, bar_right, bar_down = np.zeros((h, w), bool), np.zeros((h, w - 1), bool), np.zeros((h - 1, w), bool)
    for (r0, c0), (r1, c1) in cuts:
        steps = max(abs(r1 - r0), abs(c1 - c0))
        rows, cols = (np.rint(np.linspace(a, b, steps + 1)).astype(int) for a, b in ((r0, r1), (c0, c1)))
        pixels[rows, cols] = True
        # A sideways step of the cut crosses a vertical edge between pixels, and the other way round.
        side, upright = cols[1:] != cols[:-1], rows[1:] != rows[:-1]
        bar_down[np.minimum(rows[:-1], h - 2)[side], np.maximum(cols[1:], cols[:-1])[side]] = True
        bar_right[np.maximum(rows[1:], rows[:-1])[upright], np.minimum(cols[:-1], w - 2)[upright]] = True
    return pixels, bar_right, bar_down, [((int(a[0]), int(a[1])), (int(b[0]), int(b[1]))) for a, b in cuts], dropped


def grow(wrapped: np.ndarray, coherence: np.ndarray, valid: np.ndarray, bar_right: np.ndarray, bar_down: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Unwrapped phase, region of each pixel (-1: none) and number of regions.

    Growth starts at the most coherent pixel left (first of equals), always goes on from the most coherent
    pixel reached, and never crosses a bar; a pixel's value is fixed when it is reached.
    """
    h, w = wrapped.shape
    score = np.where(valid, np.nan_to_num(coherence), -np.inf).ravel()
    flat, fresh = wrapped.ravel(), valid.ravel().copy()
    out, region, regions = np.full(h * w, np.nan), np.full(h * w, -1, np.int32), 0
    right, down = np.pad(bar_right, ((0, 0), (0, 1)), constant_values=True).ravel(), np.pad(bar_down, ((0, 1), (0, 0)), constant_values=True).ravel()
    for seed in np.argsort(-score, kind="stable").tolist():
        if not fresh[seed]:
            continue
        fresh[seed], out[seed], region[seed] = False, flat[seed], regions
        heap = [(-score[seed], seed)]
        while heap:
            _, p = heapq.heappop(heap)
            row = p // w
            near = []
            if row and not down[p - w]:
                near.append(p - w)
            if not down[p]:
                near.append(p + w)
            if p % w and not right[p - 1]:
                near.append(p - 1)
            if not right[p]:
                near.append(p + 1)
            for q in near:
                if fresh[q]:
                    fresh[q], region[q] = False, regions
                    out[q] = out[p] + images.wrap(flat[q] - flat[p])
                    heapq.heappush(heap, (-score[q], q))
        regions += 1
    return out.reshape(h, w), region.reshape(h, w), regions


def align_regions(wrapped: np.ndarray, unwrapped: np.ndarray, region: np.ndarray, bar_right: np.ndarray, bar_down: np.ndarray) -> tuple[np.ndarray, int]:
    """Shifts regions by whole cycles to agree across the barred steps, from the largest outwards along the
    borders with most observations; returns the number of pixels shifted."""
    seen = defaultdict(list)
    for bars, step in ((bar_right, (0, 1)), (bar_down, (1, 0))):
        a = np.argwhere(bars)
        b = a + step
        ra, rb = region[tuple(a.T)], region[tuple(b.T)]
        apart = (ra >= 0) & (rb >= 0) & (ra != rb)
        a, b, ra, rb = tuple(a[apart].T), tuple(b[apart].T), ra[apart], rb[apart]
        cycles = (unwrapped[a] + images.wrap(wrapped[b] - wrapped[a]) - unwrapped[b]) / TWO_PI
        for i, j, c in zip(ra.tolist(), rb.tolist(), cycles.tolist()):
            seen[min(i, j), max(i, j)].append(c if i < j else -c)
    edges = defaultdict(list)
    for (i, j), values in seen.items():
        shift = int(np.rint(np.median(values)))
        edges[i].append((-len(values), len(edges[i]), j, shift))
        edges[j].append((-len(values), len(edges[j]), i, -shift))
    count = np.bincount(region[region >= 0], minlength=int(region.max(initial=-1)) + 1)
    offset: dict[int, int] = {}
    for root in np.argsort(count)[::-1].tolist():
        if root in offset:
            continue
        offset[root], wave = 0, [root]
        for at in wave:
            for _, _, to, shift in sorted(edges[at]):
                if to not in offset:
                    offset[to] = offset[at] + shift
                    wave.append(to)
    shift = np.array([offset.get(k, 0) for k in range(len(count))] + [0])
    return unwrapped + TWO_PI * shift[region], int((shift[region] != 0).sum())


def unwrap_image(wrapped: np.ndarray, coherence: np.ndarray | None = None, threshold: float = 0.05, longest: float = 15.0):
    """Unwrapped phase, whole cycles added, cut pixels and a report."""
    wrapped = np.asarray(wrapped, float)
    coherence = np.ones(wrapped.shape) if coherence is None else np.asarray(coherence, float)
    valid = np.isfinite(wrapped) & np.isfinite(coherence) & (coherence > threshold)
    residue = residues(wrapped, valid)
    pixels, bar_right, bar_down, cuts, dropped = branch_cuts(residue, coherence, longest)
    pixels &= valid
    bar_right &= valid[:, :-1] & valid[:, 1:]
    bar_down &= valid[:-1] & valid[1:]
    out, region, regions = grow(wrapped, coherence, valid, bar_right, bar_down)
    out, _ = align_regions(wrapped, out, region, bar_right, bar_down)
    done = np.isfinite(out)
    cycles = np.where(done, np.rint((np.nan_to_num(out) - np.nan_to_num(wrapped)) / TWO_PI), 0).astype(np.int32)
    report = UnwrapReport(int((residue > 0).sum()), int((residue < 0).sum()), int(pixels.sum()), len(cuts), int(valid.sum()), int(done.sum()), regions, dropped, float(longest))
    return out, cycles, pixels, report


def unwrap(pixels: DataFrame, threshold: float = 0.05, longest: float = 15.0) -> DataFrame:
    """Unwraps every image of a pixel table (image, row, col, phase, coh): adds ``unwrapped``, ``cycles``, ``cut``."""

    def run(a: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        out, cycles, cut, _ = unwrap_image(a["phase"], a["coh"], threshold, longest)
        return {"unwrapped": out, "cycles": cycles, "cut": cut}

    return per_image(pixels, ["phase", "coh"], run, "unwrapped double, cycles int, cut boolean")


def unwrap_reports(pixels: DataFrame, threshold: float = 0.05, longest: float = 15.0) -> DataFrame:
    """One row of diagnostics per image."""
    from .rasters import image_array

    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        a = image_array(frame, ["phase", "coh"])
        return pd.DataFrame([{"image": key[0]} | asdict(unwrap_image(a["phase"], a["coh"], threshold, longest)[3])])

    kind = pixels.schema["image"].dataType.simpleString()
    whole = ", ".join(f"{c} long" for c in list(UnwrapReport.__dataclass_fields__)[:-1])
    return pixels.select("image", "row", "col", "phase", "coh").groupBy("image").applyInPandas(run, f"image {kind}, {whole}, maximum_cut_length double")
