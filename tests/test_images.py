import itertools

import numpy as np
import pytest

from fringeframe.operators import images


def test_components_match_flood_fill():
    rng = np.random.default_rng(0)
    for diagonal in (False, True):
        for _ in range(20):
            mask = rng.random((9, 11)) < 0.5
            got, n = images.components(mask, diagonal)
            want, k = np.zeros(mask.shape, int), 0
            near = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if (a, b) != (0, 0) and (diagonal or 0 in (a, b))]
            for r, c in np.argwhere(mask).tolist():
                if want[r, c]:
                    continue
                k += 1
                todo = [(r, c)]
                want[r, c] = k
                while todo:
                    y, x = todo.pop()
                    for a, b in near:
                        p = (y + a, x + b)
                        if 0 <= p[0] < 9 and 0 <= p[1] < 11 and mask[p] and not want[p]:
                            want[p] = k
                            todo.append(p)
            assert n == k and (got == want).all()


def test_nearest_set_is_exact():
    rng = np.random.default_rng(1)
    for density in (0.02, 0.2, 0.7):
        mask = rng.random((17, 23)) < density
        mask[3, 4] = True
        distance, row, col = images.nearest_set(mask)
        points = np.argwhere(mask)
        for r, c in itertools.product(range(17), range(23)):
            best = np.hypot(points[:, 0] - r, points[:, 1] - c).min()
            assert abs(distance[r, c] - best) < 1e-9 and mask[row[r, c], col[r, c]]
            assert abs(np.hypot(row[r, c] - r, col[r, c] - c) - best) < 1e-9
    assert np.isinf(images.nearest_set(np.zeros((3, 4), bool))[0]).all()


@pytest.mark.parametrize("shape", [(1, 1), (4, 4), (3, 6), (6, 3)])
def test_assign_is_optimal(shape):
    rng = np.random.default_rng(sum(shape))
    for _ in range(25):
        cost = rng.integers(0, 12, shape).astype(float)
        rows, cols = images.assign(cost)
        small, large = min(shape), max(shape)
        wide = cost if shape[0] <= shape[1] else cost.T
        best = min(sum(wide[i, p[i]] for i in range(small)) for p in itertools.permutations(range(large), small))
        assert len(set(rows.tolist())) == len(set(cols.tolist())) == small and cost[rows, cols].sum() == best


def test_filters_against_direct_sums():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(13, 17))
    sigma, radius = 1.3, int(4 * 1.3 + 0.5)
    k = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    k /= k.sum()
    wide = np.pad(x, radius, mode="edge")
    want = np.array([[(wide[r : r + 2 * radius + 1, c : c + 2 * radius + 1] * np.outer(k, k)).sum() for c in range(17)] for r in range(13)])
    assert np.allclose(images.gaussian(x, sigma), want)
    wide = np.pad(x, 2, mode="edge")
    assert np.allclose(images.box_mean(x, 2), [[wide[r : r + 5, c : c + 5].mean() for c in range(17)] for r in range(13)])
    wide = np.pad(x, 1, mode="symmetric")
    assert np.allclose(images.median3(x), [[np.median(wide[r : r + 3, c : c + 3]) for c in range(17)] for r in range(13)])
    holes = np.where(rng.random(x.shape) < 0.3, np.nan, x)
    rows = np.array([[np.nanmean(h) if np.isfinite(h := holes[max(0, r - 2) : r + 3, c]).any() else np.nan for c in range(17)] for r in range(13)])
    assert np.allclose(images.nan_mean_axis(holes, 2, 0), rows, equal_nan=True)


def test_morphology_uses_a_cross_and_an_unset_outside():
    mask = np.zeros((7, 7), bool)
    mask[3, 3] = True
    assert images.dilate(mask).sum() == 5 and images.dilate(mask, 2).sum() == 13
    assert images.erode(np.ones((5, 5), bool)).sum() == 9
    assert (images.close(mask) == mask).all()
    assert images.dilate_disc(mask, 2).sum() == 13


def test_cheapest_path():
    cost = np.ones((5, 9))
    cost[:4, 4] = np.inf
    path = images.cheapest_path(cost, (0, 0), (0, 8))
    assert path[0] == (0, 0) and path[-1] == (0, 8) and (4, 4) in path and len(path) == 17
    cost[4, 4] = np.inf
    assert images.cheapest_path(cost, (0, 0), (0, 8)) == []
