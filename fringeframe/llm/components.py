"""Connected components of a link table by alternating stars, all on the cluster."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import written

#: Links that one task joins at once.
_TOGETHER = 1 << 17


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of the links' nodes that are not the least of their component, which is their root."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        lo, hi = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        if (lo == hi).all():
            rest = np.flatnonzero(root != np.arange(len(nodes)))
            return nodes[rest], nodes[root[rest]]
        np.minimum.at(root, hi, lo)
        while (root[root] != root).any():
            root = root[root]


def _contracted(links: DataFrame, together: int) -> DataFrame:
    """Links (u, v) that join the same nodes: the stars of at most some ``together`` links at once of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= together:
                yield joined(held)
                held, n = [], 0
        if n:
            yield joined(held)

    def joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        u, v = (np.concatenate([b.column(k).to_numpy() for b in held]) for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in stars(u, v)], names=["u", "v"])

    return links.select("u", "v").mapInArrow(run, "u long, v long")


def _least(links: DataFrame, keep) -> DataFrame:
    """(u, v, m): each link with the least node m among u and u's neighbours that ``keep`` admits."""
    least = links.where(keep).groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return links.where(keep).join(least, "u")


def component_roots(links: DataFrame, together: int = _TOGETHER) -> DataFrame:
    """(node, root) for every node of the link table (u, v); root is the least node of its component.

    Every task first replaces its links by stars, ``together`` at once.  So many that are left are joined by
    one task, as rounds of small joins cost the driver more than they save.  While there are more, large-star
    and small-star steps alternate until the links no longer change; their number grows with the logarithm of
    the longest path.  Every step sums before it shuffles and joins on the node, where adaptive execution
    splits a hub; each round is cut off by a written table.
    """
    state = written(_contracted(links.where("u <> v"), together))
    mark = None
    while True:
        now = tuple(state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        few = now[0] <= together
        if few:
            state = written(_contracted(state.coalesce(1), together + 1))
        if few or now == mark:
            return state.select(F.col("u").alias("node"), F.col("v").alias("root")).union(state.select("v", "v").distinct())
        mark = now
        both = state.union(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both, F.lit(True)).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        small = _least(down, F.lit(True))
        state = written(small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
