"""Whole-image primitives in numpy, for the operators that no DataFrame expression covers.

Arrays are (row, col); NaN marks a masked pixel.
"""

from __future__ import annotations

import heapq

import numpy as np


def wrap(x):
    return np.arctan2(np.sin(x), np.cos(x))


def gaussian(x: np.ndarray, sigma: float, mode: str = "edge") -> np.ndarray:
    """Separable Gaussian cut at four sigmas; ``mode`` as in numpy.pad."""
    radius = int(4 * sigma + 0.5)
    weights = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    weights /= weights.sum()
    for axis in (0, 1):
        pad = [(radius, radius) if k == axis else (0, 0) for k in (0, 1)]
        wide, n = np.pad(x, pad, mode=mode), x.shape[axis]
        x = sum(w * np.take(wide, range(k, k + n), axis=axis) for k, w in enumerate(weights))
    return x


def smooth_valid(x: np.ndarray, valid: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian mean of the valid pixels; NaN where none is near."""
    total, weight = gaussian(np.where(valid, x, 0.0), sigma), gaussian(valid.astype(float), sigma)
    return np.where(weight > 1e-6, total / np.where(weight > 1e-6, weight, 1), np.nan)


def box_sum(x: np.ndarray, radius: int) -> np.ndarray:
    """Sums over (2 * radius + 1) squares, zero beyond the image."""
    for axis in (0, 1):
        n = x.shape[axis]
        total = np.cumsum(np.insert(x, 0, 0, axis=axis), axis=axis)
        at = np.arange(n)
        x = np.take(total, np.minimum(at + radius + 1, n), axis=axis) - np.take(total, np.maximum(at - radius, 0), axis=axis)
    return x


def box_mean(x: np.ndarray, radius: int, mode: str = "edge") -> np.ndarray:
    """Mean over (2 * radius + 1) squares of the image extended by numpy.pad's ``mode``."""
    wide = box_sum(np.pad(x, 2 * radius, mode=mode), radius)
    return wide[2 * radius : 2 * radius + x.shape[0], 2 * radius : 2 * radius + x.shape[1]] / (2 * radius + 1) ** 2


def nan_mean_axis(x: np.ndarray, radius: int, axis: int) -> np.ndarray:
    """Mean of the finite pixels within ``radius`` along one axis; NaN where there is none."""
    if radius <= 0:
        return x.copy()
    n, at = x.shape[axis], np.arange(x.shape[axis])

    def window(v):
        total = np.cumsum(np.insert(v, 0, 0, axis=axis), axis=axis)
        return np.take(total, np.minimum(at + radius + 1, n), axis=axis) - np.take(total, np.maximum(at - radius, 0), axis=axis)

    ok = np.isfinite(x)
    count = window(ok.astype(float))
    return np.where(count > 0, window(np.where(ok, x, 0.0)) / np.maximum(count, 1), np.nan)


def nan_mean(x: np.ndarray, radius: int, passes: int = 1) -> np.ndarray:
    for _ in range(passes):
        x = nan_mean_axis(nan_mean_axis(x, radius, 0), radius, 1)
    return x


def median3(x: np.ndarray) -> np.ndarray:
    """3 x 3 median, the image mirrored at its edges."""
    wide = np.pad(x, 1, mode="symmetric")
    h, w = x.shape
    return np.median(np.stack([wide[r : r + h, c : c + w] for r in range(3) for c in range(3)]), axis=0)


def _cross(mask: np.ndarray, grow: bool) -> np.ndarray:
    wide = np.pad(mask, 1)
    parts = [wide[1:-1, 1:-1], wide[:-2, 1:-1], wide[2:, 1:-1], wide[1:-1, :-2], wide[1:-1, 2:]]
    return np.logical_or.reduce(parts) if grow else np.logical_and.reduce(parts)


def dilate(mask: np.ndarray, times: int = 1) -> np.ndarray:
    for _ in range(times):
        mask = _cross(mask, True)
    return mask


def erode(mask: np.ndarray, times: int = 1) -> np.ndarray:
    """What is beyond the image counts as unset."""
    for _ in range(times):
        mask = _cross(mask, False)
    return mask


def close(mask: np.ndarray, times: int = 1) -> np.ndarray:
    return erode(dilate(mask, times), times)


def dilate_disc(mask: np.ndarray, radius: int) -> np.ndarray:
    """All pixels within a Euclidean radius of a set one."""
    return nearest_set(mask)[0] <= radius if mask.any() and radius > 0 else mask.copy()


def components(mask: np.ndarray, diagonal: bool = False) -> tuple[np.ndarray, int]:
    """Labels 1..n of connected regions in row-major order of their first pixels; 0 elsewhere."""
    h, w = mask.shape
    number = np.arange(h * w).reshape(h, w)
    pairs = [(number[:, 1:], number[:, :-1], mask[:, 1:] & mask[:, :-1]), (number[1:], number[:-1], mask[1:] & mask[:-1])]
    if diagonal:
        pairs += [(number[1:, 1:], number[:-1, :-1], mask[1:, 1:] & mask[:-1, :-1]), (number[1:, :-1], number[:-1, 1:], mask[1:, :-1] & mask[:-1, 1:])]
    a, b = (np.concatenate([p[k][p[2]] for p in pairs]) for k in (0, 1))
    root = np.arange(h * w)
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        split = low != high
        if not split.any():
            break
        np.minimum.at(root, high[split], low[split])
        while (root != root[root]).any():
            root = root[root]
    kept, label = np.unique(root[mask.ravel()], return_inverse=True)
    out = np.zeros(h * w, np.int32)
    out[mask.ravel()] = label + 1
    return out.reshape(h, w), len(kept)


def nearest_set(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Exact Euclidean distance to the nearest set pixel, and its row and column (infinite if none is set)."""
    h, w = mask.shape
    rows = np.arange(h)[:, None]
    above = np.maximum.accumulate(np.where(mask, rows, -(10**7)), axis=0)
    below = np.minimum.accumulate(np.where(mask, rows, 10**7)[::-1], axis=0)[::-1]
    row = np.where(rows - above <= below - rows, above, below)
    column_gap = (row - rows).astype(float) ** 2
    best, best_row = column_gap.copy(), row.copy()
    best_col = np.broadcast_to(np.arange(w), (h, w)).copy()
    for k in range(1, w):
        if k * k >= best.max():
            break
        for shift in (-k, k):
            to = slice(max(0, -shift), w - max(0, shift))
            source = slice(max(0, shift), w + min(0, shift))
            trial = column_gap[:, source] + k * k
            better = trial < best[:, to]
            best[:, to][better] = trial[better]
            best_row[:, to][better] = row[:, source][better]
            best_col[:, to][better] = np.broadcast_to(np.arange(w), (h, w))[:, source][better]
    distance = np.sqrt(best)
    return np.where(best >= 10**12, np.inf, distance), best_row, best_col


def assign(cost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of a least-cost matching of the smaller side, by shortest augmenting paths."""
    if cost.shape[0] > cost.shape[1]:
        cols, rows = assign(cost.T)
        by = np.argsort(rows)
        return rows[by], cols[by]
    n, m = cost.shape
    row_price, col_price = np.zeros(n), np.zeros(m)
    row_of, col_of = np.full(m, -1), np.full(n, -1)
    for start in range(n):
        reach, back, done = np.full(m, np.inf), np.full(m, -1), np.zeros(m, bool)
        row, length, end, visited = start, 0.0, -1, []
        while end < 0:
            visited.append(row)
            trial = length + cost[row] - row_price[row] - col_price
            better = ~done & (trial < reach)
            reach[better], back[better] = trial[better], row
            open_reach = np.where(done, np.inf, reach)
            col = int(open_reach.argmin())
            length = float(open_reach[col])
            done[col] = True
            if row_of[col] < 0:
                end = col
            else:
                row = int(row_of[col])
        row_price[start] += length
        for r in visited[1:]:
            row_price[r] += length - reach[col_of[r]]
        col_price[done] += reach[done] - length
        while True:
            r = int(back[end])
            row_of[end] = r
            col_of[r], end = end, int(col_of[r])
            if r == start:
                break
    return np.arange(n), col_of


def cheapest_path(cost: np.ndarray, start: tuple[int, int], goal: tuple[int, int], margin: int = 4) -> list[tuple[int, int]]:
    """Four-neighbour path of least total cost inside the padded box of its ends; empty if there is none."""
    top, left = max(0, min(start[0], goal[0]) - margin), max(0, min(start[1], goal[1]) - margin)
    area = cost[top : max(start[0], goal[0]) + margin + 1, left : max(start[1], goal[1]) + margin + 1]
    source, target = (start[0] - top, start[1] - left), (goal[0] - top, goal[1] - left)
    best, came, heap = {source: 0.0}, {}, [(0.0, source)]
    while heap:
        spent, at = heapq.heappop(heap)
        if at == target:
            path = [at]
            while path[-1] != source:
                path.append(came[path[-1]])
            return [(r + top, c + left) for r, c in reversed(path)]
        if spent > best[at]:
            continue
        for step in ((-1, 0), (1, 0), (0, -1), (0, 1)):
            to = (at[0] + step[0], at[1] + step[1])
            if 0 <= to[0] < area.shape[0] and 0 <= to[1] < area.shape[1] and np.isfinite(area[to]):
                total = spent + float(area[to])
                if total < best.get(to, np.inf):
                    best[to], came[to] = total, at
                    heapq.heappush(heap, (total, to))
    return []


def domain_boundary(valid: np.ndarray) -> np.ndarray:
    """Valid pixels on the image's edge or beside an invalid pixel."""
    return valid & ~erode(valid)


def robust_std(x: np.ndarray) -> float:
    x = x[np.isfinite(x)]
    return float(1.4826 * np.median(np.abs(x - np.median(x)))) if x.size else float("nan")


def quadratic_terms(shape: tuple[int, int]) -> np.ndarray:
    """(pixel, 6) design of 1, x, y, x2, xy, y2 on [-1, 1]."""
    y, x = (2.0 * i / max(n - 1, 1) - 1.0 for i, n in zip(np.indices(shape), shape))
    x, y = x.ravel(), y.ravel()
    return np.stack([np.ones_like(x), x, y, x * x, x * y, y * y], axis=1)
