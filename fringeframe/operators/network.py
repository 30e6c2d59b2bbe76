"""Networks of acquisition dates: quality of image pairs, choice of a connected network, safe exclusion.

Pairs are few (hundreds, not rows of pixels), so the graph walks run on the driver over collected pairs.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.phase import TWO_PI, edge_weight
from .masks import maybe_broadcast


class Joined:
    """Union-find over hashable items."""

    def __init__(self, items: Iterable = ()):
        self.up = {x: x for x in items}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def union(self, a, b) -> bool:
        """Joins two items; whether they were apart."""
        a, b = self.find(a), self.find(b)
        self.up[b] = a
        return a != b


@dataclass(frozen=True)
class Edge:
    index: int
    first: date
    second: date
    baseline_days: int
    selected: bool
    reason: str
    tier: int
    weight: float
    qc_status: str
    detrending_accepted: bool | None


def edge_quality(qc: DataFrame, detrending: DataFrame) -> DataFrame:
    """(pair, tier, weight, qc_status, detrending_accepted) from reports on unwrapping and detrending.

    ``qc`` has (pair, spatial_residual_fraction, robust_phase_range_cycles, status), ``detrending`` (pair,
    accepted); a pair may be in either.  Tier 2: kept only for connectivity; 3: excluded, or its detrending
    was rejected; else 0.
    """
    both = qc.join(detrending, "pair", "full_outer")
    status = F.coalesce("status", F.lit("quality_metadata_unavailable"))
    protected, rejected = status == "network_protected", F.coalesce(~F.col("accepted"), F.lit(False))
    weight = edge_weight(F.coalesce("spatial_residual_fraction", F.lit(0.0)), F.coalesce("robust_phase_range_cycles", F.lit(0.0)), ~rejected, protected)
    tier = F.when(rejected | status.startswith("excluded"), 3).when(protected, 2).otherwise(0)
    return both.select("pair", tier.alias("tier"), weight.alias("weight"), status.alias("qc_status"), F.col("accepted").alias("detrending_accepted"))


def attach_quality(edges: DataFrame, quality: DataFrame) -> DataFrame:
    """Edges (pair, ...) with their quality, or defaults where there is no report."""
    return edges.join(maybe_broadcast(quality), "pair", "left").withColumns({"tier": F.coalesce("tier", F.lit(0)), "weight": F.coalesce("weight", F.lit(1.0)), "qc_status": F.coalesce("qc_status", F.lit("quality_metadata_unavailable"))})


def design_matrix(dates: list, pairs: list[tuple]) -> np.ndarray:
    """A row a pair over the dates but the first, which is the zero."""
    at = {d: k - 1 for k, d in enumerate(dates)}
    out = np.zeros((len(pairs), len(dates) - 1))
    for row, (a, b) in zip(out, pairs):
        if at[a] >= 0:
            row[at[a]] = -1
        row[at[b]] = 1
    return out


def select_network(pairs: list[tuple], most_days: int = 12, quality: list[dict] | None = None) -> list[Edge]:
    """All short pairs of good tier, then, by (tier, baseline, dates), those that connect what is apart.

    Raises where the dates cannot be connected or the network's rank is not their number less one.
    """
    if most_days <= 0:
        raise ValueError("most_days must be positive")
    quality = quality or [{} for _ in pairs]
    if len(quality) != len(pairs):
        raise ValueError("one quality a pair is needed")
    days = [(b - a).days for a, b in pairs]
    tier = [int(q.get("tier") or 0) for q in quality]
    joined, reason = Joined(d for p in pairs for d in p), {}
    for k, p in enumerate(pairs):
        if days[k] <= most_days and tier[k] <= 1:
            joined.union(*p)
            reason[k] = "within_threshold_quality_ok"
    for k in sorted(set(range(len(pairs))) - set(reason), key=lambda k: (tier[k], days[k], pairs[k])):
        if joined.union(*pairs[k]):
            reason[k] = "low_quality_connectivity_bridge" if tier[k] >= 2 else "quality_connectivity_bridge"
    dates = sorted({d for p in pairs for d in p})
    if len({joined.find(d) for d in dates}) != 1:
        raise ValueError("the dates cannot be connected")
    rank = np.linalg.matrix_rank(design_matrix(dates, [pairs[k] for k in sorted(reason)]))
    if rank != len(dates) - 1:
        raise ValueError(f"the network's rank is {rank}, not {len(dates) - 1}")
    return [
        Edge(k, a, b, days[k], k in reason, reason.get(k, "not_required"), tier[k], float(q.get("weight", 1.0)), q.get("qc_status", "quality_metadata_unavailable"), q.get("detrending_accepted"))
        for k, ((a, b), q) in enumerate(zip(pairs, quality))
    ]


def require_quality(edges: list[Edge]) -> None:
    """Strict mode: raises if a selected edge is there only for connectivity."""
    low = [e for e in edges if e.selected and e.reason == "low_quality_connectivity_bridge"]
    if low:
        raise ValueError("low-quality bridges are needed: " + ", ".join(f"{e.first}-{e.second}" for e in low))


def redundancy(edges: list[Edge]) -> int:
    """Independent cycles of the selected network."""
    used = [e for e in edges if e.selected]
    return len(used) - len({d for e in used for d in (e.first, e.second)}) + 1


def danger_bridges(edges: list[Edge]) -> list[Edge]:
    """Selected edges of low quality."""
    return [e for e in edges if e.selected and e.reason == "low_quality_connectivity_bridge"]


def connected(pairs: list[tuple], keep: Iterable[int]) -> bool:
    """Whether the kept pairs connect the dates of all pairs."""
    joined = Joined(d for p in pairs for d in p)
    for k in keep:
        joined.union(*pairs[k])
    return len({joined.find(d) for d in joined.up}) <= 1


def spatial_quality(pixels: DataFrame, smooth: str, phase: str = "phase", threshold: float = 0.45) -> DataFrame:
    """(image, fraction, range_cycles): share of pixels far off the smoothed phase, and the phase's range.

    An image without valid pixels has fraction 1 and an infinite range.
    """
    off = F.abs((F.col(phase) - F.col(smooth)) / F.lit(TWO_PI)) >= threshold
    got = pixels.groupBy("image").agg(F.avg(F.when(F.col(phase).isNotNull(), off.cast("double"))).alias("f__"), ((F.percentile(phase, F.lit(0.99)) - F.percentile(phase, F.lit(0.01))) / F.lit(TWO_PI)).alias("r__"))
    return got.select("image", F.coalesce("f__", F.lit(1.0)).alias("fraction"), F.coalesce("r__", F.lit(float("inf"))).alias("range_cycles"))


def safe_exclusion(pairs: list[tuple], metrics: list[tuple[float, float]], most_fraction: float = 0.04, most_cycles: float = 2.0) -> list[str]:
    """Status of each pair: bad ones go, worst first, as long as every date stays connected."""
    bad = [k for k, (f, r) in enumerate(metrics) if f >= most_fraction and r >= most_cycles]
    status, keep = ["included"] * len(pairs), set(range(len(pairs)))
    for k in sorted(bad, key=lambda k: metrics[k][0] * metrics[k][1], reverse=True):
        if connected(pairs, keep - {k}):
            keep.discard(k)
            status[k] = "excluded_spatial_outlier"
        else:
            status[k] = "network_protected"
    return status
