"""SimHash near-duplicates: exact links within a Hamming radius by vantage-point trees.

The distinct fingerprints are dealt to shards by the upper levels of a vantage-point tree.  At a node with
vantage point p and radius m, fingerprints at distance d <= m from p go inside and the others outside; those
with m < d <= m + r also visit the inside.  By the triangle inequality two fingerprints within r of each
other then share a shard.  Inside a shard the tree goes on down to small buckets, which are compared in full.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textscan as ts
from .components import component_roots
from .frames import kept_columns, neutral
from .storage import written

_LOWER = bytes(ts.LOWER)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of a text's word shingles, repeats included; 0 for a text without words."""
    words = (text or "").encode("utf-8").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    width = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], 42) for a, b in zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())], np.uint64)
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64) if len(h) > 200 else np.add.reduce(bits, axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", carry: list[str] | None = None, shingle: int = 3) -> DataFrame:
    """Adds ``fingerprint`` (long, the bits as a signed number) to the carried columns."""
    own = kept_columns(docs, carry, ["fingerprint"])
    given = neutral(docs, own, body=text)
    schema = T.StructType([*given.schema.fields[:-1], T.StructField("fingerprint", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = np.array([fingerprint(t, shingle) for t in batch.column(len(own)).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(got)], names=schema.names)

    return given.mapInArrow(run, schema).toDF(*own, "fingerprint")


class VantageTree:
    """Upper levels of the tree: node k has children 2k+1 (inside) and 2k+2 (outside); a node without a radius is a shard."""

    def __init__(self, sample: np.ndarray, depth: int, radius: int, seed: int = 5):
        nodes = 2 ** (depth + 1) - 1
        self.radius, self.point, self.bound = radius, np.zeros(nodes, np.uint64), np.full(nodes, -1, np.int64)
        rng, parts = np.random.default_rng(seed), {0: sample}
        for k in range(2**depth - 1):
            part = parts.pop(k, np.zeros(0, np.uint64))
            if len(part) < 4:
                continue
            point = part[rng.integers(len(part))]
            d = np.bitwise_count(part ^ point).astype(np.int64)
            edge = int(np.median(d))
            edge = edge if (d > edge).any() else edge - 1
            if edge < 0:
                continue
            self.point[k], self.bound[k] = point, edge
            parts[2 * k + 1], parts[2 * k + 2] = part[d <= edge], part[d > edge]

    def route(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, shard) of every shard that a fingerprint lives in or visits."""
        index, node, done_i, done_n = np.arange(len(prints)), np.zeros(len(prints), np.int64), [], []
        while len(index):
            bound = self.bound[node]
            end = bound < 0
            done_i.append(index[end])
            done_n.append(node[end])
            index, node, bound = index[~end], node[~end], bound[~end]
            d = np.bitwise_count(prints[index] ^ self.point[node]).astype(np.int64)
            inside, outside = d <= bound + self.radius, d > bound
            index, node = np.r_[index[inside], index[outside]], np.r_[2 * node[inside] + 1, 2 * node[outside] + 2]
        return np.concatenate(done_i), np.concatenate(done_n)


def _bucket_links(prints: np.ndarray, at: np.ndarray, radius: int) -> list[np.ndarray]:
    """A spanning star of each group of linked fingerprints among ``at``, compared in full, in blocks of rows of
    bounded size: labels fall to the least of a group, links themselves are not kept."""
    n, mine = len(at), prints[at]
    label, rows = np.arange(n), max(1, (1 << 22) // n)
    while True:
        before = label.copy()
        for lo in range(0, n, rows):
            near = np.bitwise_count(mine[lo : lo + rows, None] ^ mine[None, :]) <= radius
            if n <= rows and near.sum() == n:
                return []
            label[lo : lo + rows] = np.where(near, label[None, :], n).min(axis=1)
        label = label[label]
        if (label == before).all():
            break
    moved = np.flatnonzero(label != np.arange(n))
    return [np.stack([at[moved], at[label[moved]]], axis=1)]


def local_links(prints: np.ndarray, radius: int, bucket: int = 256, seed: int = 11) -> np.ndarray:
    """Index pairs that connect all fingerprints linked within ``radius``: at most a few stars, never all pairs."""
    rng, out, todo = np.random.default_rng(seed), [], [np.arange(len(prints))]
    while todo:
        at = todo.pop()
        if len(at) < 2:
            continue
        if len(at) > bucket:
            d = np.bitwise_count(prints[at] ^ prints[at[rng.integers(len(at))]]).astype(np.int64)
            edge = int(np.median(d))
            inside, outside = d <= edge + radius, d > edge
            if inside.sum() < 0.9 * len(at):
                todo += [at[inside], at[outside]]
                continue
        out += _bucket_links(prints, at, radius)
    return np.concatenate(out) if out else np.zeros((0, 2), np.int64)


def near_components(prints: DataFrame, radius: int = 2, shard_rows: int = 4096, most_depth: int = 14) -> DataFrame:
    """(fingerprint, component) for a table of (fingerprint, first): component is the least ``first`` reachable
    over links of at most ``radius`` bits.  ``prints`` has each fingerprint once.

    The tree is built on the driver from 64 fingerprints a shard on average, for at most 2**most_depth shards;
    where that leaves larger shards, their tasks carry the tree on by themselves.
    """
    total = prints.count()
    depth = min(most_depth, max(0, math.ceil(math.log2(max(1, total / shard_rows)))))
    share = min(1.0, 64 * 2**depth / max(1, total))
    picked = prints.where(F.pmod(F.xxhash64("fingerprint", F.lit(3)), F.lit(1 << 30)) < int(share * (1 << 30))).select("fingerprint").collect()
    tree = prints.sparkSession.sparkContext.broadcast(VantageTree(np.sort(np.array([r[0] for r in picked], np.int64)).view(np.uint64), depth, radius))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mine = batch.column(0).to_numpy().astype(np.int64).view(np.uint64)
            index, shard = tree.value.route(mine)
            yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int32)), pa.array(mine[index].view(np.int64))], names=["shard", "fingerprint"])

    def join(group: pd.DataFrame) -> pd.DataFrame:
        mine = group["fingerprint"].to_numpy(np.int64).view(np.uint64)
        pairs = local_links(mine, radius)
        return pd.DataFrame({"u": mine[pairs[:, 0]].view(np.int64), "v": mine[pairs[:, 1]].view(np.int64)})

    links = prints.select("fingerprint").mapInArrow(deal, "shard int, fingerprint long").groupBy("shard").applyInPandas(join, "u long, v long")
    # A table of their own: one Python worker a core, not one for the trees and another for the components.
    roots = component_roots(written(links))
    linked = prints.join(roots, prints["fingerprint"] == roots["node"])
    least = linked.groupBy("root").agg(F.min("first").alias("component"))
    of = linked.select("fingerprint", "root").join(least, "root").select("fingerprint", "component")
    return prints.join(of, "fingerprint", "left").select("fingerprint", F.coalesce("component", "first").alias("component"))


def simhash_groups(docs: DataFrame, radius: int = 2, text: str = "text", carry: list[str] | None = None, shingle: int = 3) -> DataFrame:
    """Adds ``fingerprint`` (16 hex digits) and ``component_id`` to every document.

    Words are runs of other characters than space and \\x09-\\x0D, A-Z lower-cased; a shingle's hash is XXH64
    with seed 42.  A text of fewer words than a shingle is one shingle; a null or empty text, or one of blanks,
    has fingerprint zero and links like any other.  ``component_id`` is the smallest doc_id reachable over
    links of at most ``radius`` bits, the document's own included; rows without doc_id take part but never
    name a component (null if no linked row has an id).  Repeated rows and copies share a fingerprint and so
    a component.  ``carry`` defaults to doc_id; columns named like a result are replaced.  Copies are never
    expanded: trees and links hold each distinct fingerprint once.
    """
    own = kept_columns(docs, ["doc_id"] if carry is None else carry, ["fingerprint", "component_id"])
    given = neutral(docs, own, ident="doc_id", body=text)
    prints = written(fingerprints(given, "body", given.columns[:-1], shingle))
    first = written(prints.groupBy("fingerprint").agg(F.min("ident").alias("first")))
    # The map is a table of its own, so that adaptive execution can split the join at a hot fingerprint.
    of = written(near_components(first, radius))
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return prints.join(of, "fingerprint").select(*given.columns[: len(own)], digits, "component").toDF(*own, "fingerprint", "component_id")
