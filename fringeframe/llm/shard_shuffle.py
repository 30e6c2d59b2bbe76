"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

Row p of the matrix says how many rows source partition p sends to each target.  Under a uniform
permutation of all rows the matrix is a multivariate hypergeometric draw; given the matrix, permuting
inside each source, exchanging, and permuting inside each target makes the permutation uniform.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import kept_columns, named
from .storage import written

#: numpy draws exactly below this population; larger ones are drawn by _large.
_NUMPY_MOST = 10**9


def _step(a: float, d: float) -> float:
    """log gamma(a + d) - log gamma(a), without cancellation for large a."""
    if a < 1e4 or a + d < 1e4:
        return math.lgamma(a + d) - math.lgamma(a)
    return (a + d - 0.5) * math.log1p(d / a) + d * (math.log(a) - 1) + (1 / (a + d) - 1 / a) / 12


def _large(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """Hypergeometric draw by ratio of uniforms, for populations beyond numpy's limit."""
    total = good + bad
    low, high = max(0, sample - bad), min(sample, good)
    if low == high:
        return low
    var = (sample / total) * (good / total) * bad * ((total - sample) / (total - 1))
    centre = sample * (good / total) + 0.5
    wide = 2 * math.sqrt(2 / math.e) * math.sqrt(var + 0.5) + 3 - 2 * math.sqrt(3 / math.e)
    mode = (sample + 1) * (good + 1) // (total + 2)
    while True:
        u, v = 1 - rng.random(), rng.random()
        k = math.floor(centre + wide * (v - 0.5) / u)
        if low <= k <= high:
            d = k - mode
            if 2 * math.log(u) <= -(_step(mode + 1, d) + _step(good - mode + 1, -d) + _step(sample - mode + 1, -d) + _step(bad - sample + mode + 1, d)):
                return k


def draw_counts(rng: np.random.Generator, sizes: np.ndarray, sample: int) -> np.ndarray:
    """How many of ``sample`` rows drawn without replacement fall into each of the ``sizes``."""
    total = int(sizes.sum())
    if total < _NUMPY_MOST:
        return rng.multivariate_hypergeometric(sizes, sample, method="marginals") if len(sizes) > 1 else np.array([sample])
    if len(sizes) == 1:
        return np.array([sample])
    half = len(sizes) // 2
    left = _large(rng, int(sizes[:half].sum()), int(sizes[half:].sum()), sample)
    return np.concatenate([draw_counts(rng, sizes[:half], left), draw_counts(rng, sizes[half:], sample - left)])


class CommunicationMatrix:
    """The matrix, of which any row is drawn alone: sources are halved again and again, each half's counts
    being drawn by a generator seeded with the range, so all tasks see one and the same matrix."""

    def __init__(self, sources: np.ndarray, targets: np.ndarray, seed: int):
        self.edges = np.concatenate([[0], np.cumsum(sources)])
        self.targets, self.seed = np.asarray(targets, np.int64), seed
        assert int(self.edges[-1]) == int(self.targets.sum())

    def __reduce__(self):
        return CommunicationMatrix, (np.diff(self.edges), self.targets, self.seed)

    def row(self, p: int) -> np.ndarray:
        """Rows that source ``p`` sends to each target."""
        lo, hi, counts = 0, len(self.edges) - 1, self.targets
        while hi - lo > 1:
            mid = (lo + hi) // 2
            rng = np.random.default_rng([self.seed, lo, hi])
            left = draw_counts(rng, counts, int(self.edges[mid] - self.edges[lo]))
            lo, hi, counts = (lo, mid, left) if p < mid else (mid, hi, counts - left)
        return counts


def _is_scan(df: DataFrame) -> bool:
    """Whether ``df`` is a plain scan of files, whose rows keep their file and position."""
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    return all(line.lstrip("+-: ").startswith(("Project", "Relation")) for line in lines if line.strip()) and any("parquet" in line for line in lines)


def shuffle_into_shards(df: DataFrame, shards: int = 8, seed: int = 17, chunk_rows: int = 4096, block_rows: int = 65536, most_sources: int = 16384) -> DataFrame:
    """Deals all rows of ``df`` uniformly into ``shards`` whose row counts differ by one at most.

    Adds ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard, in shuffled order); columns of
    these names are replaced, others of any name and nulls are carried along.  Repeated rows are rows of
    their own; an empty table gives an empty result.  Sources are blocks of ``block_rows`` rows of a file:
    a row's place depends on its file and position, never on how a scan is split or a task is run again.
    (Anything but a plain Parquet scan is first written to the shared folder.)  Every shard is cut into
    chunks of about ``chunk_rows`` rows, each a partition of its own; the matrix deals to chunks, so no task
    holds a whole shard.  Blocks and chunks grow with the table where it would have more than
    ``most_sources`` of them, so the matrix stays bounded (files apart, each of which has a block at least).
    Whole rows cross the network once.  The driver holds one count for each block.
    """
    df = df.select(*(named(c) for c in kept_columns(df, None, ["shard", "slot"])))
    own, n = df.columns, len(df.columns)
    if not _is_scan(df) or "_metadata" in (c.lower() for c in own):
        df = written(df.toDF(*(f"c{i}" for i in range(n))))
    rows = df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"), "*").toDF("file", "at", *(f"c{i}" for i in range(n)))
    total = df.count()
    block_rows, chunk_rows = (max(x, -(-total // most_sources)) for x in (block_rows, chunk_rows))
    blocks = sorted((r[0], r[1], r[2]) for r in rows.groupBy("file", F.floor(F.col("at") / block_rows)).count().collect())
    sizes = np.array([b[2] for b in blocks], np.int64)
    each = [total // shards + (s < total % shards) for s in range(shards)]
    chunk_shard, chunk_from, chunk_size = [], [], []
    for s, size in enumerate(each):
        edges = np.linspace(0, size, max(1, math.ceil(size / chunk_rows)) + 1).astype(np.int64)
        chunk_shard += [s] * (len(edges) - 1)
        chunk_from += edges[:-1].tolist()
        chunk_size += np.diff(edges).tolist()
    matrix = CommunicationMatrix(sizes, np.array(chunk_size, np.int64), seed)
    place = rows.sparkSession.sparkContext.broadcast(({(f, b): i for i, (f, b, _) in enumerate(blocks)}, matrix, np.array(chunk_shard, np.int32), np.array(chunk_from, np.int64)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, matrix, shard, begin = place.value

        @lru_cache(maxsize=2)
        def permuted(p: int) -> np.ndarray:
            """The local permutation: the source's row of the matrix, spelt out and shuffled."""
            labels = np.repeat(np.arange(len(shard), dtype=np.int32), matrix.row(p))
            np.random.default_rng([matrix.seed, 1 << 40, p]).shuffle(labels)
            return labels

        for batch in batches:
            files, position = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            got = np.empty(len(position), np.int32)
            edges = [0, *(i for i in range(1, len(files)) if files[i] != files[i - 1] or position[i] // block_rows != position[i - 1] // block_rows), len(files)]
            for lo, hi in zip(edges, edges[1:]):
                if hi > lo:
                    got[lo:hi] = permuted(number[files[lo], int(position[lo]) // block_rows])[position[lo:hi] % block_rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got), pa.array(shard[got]), pa.array(begin[got])], names=schema.names)

    schema = T.StructType([*rows.schema.fields, T.StructField("chunk", T.IntegerType()), T.StructField("shard", T.IntegerType()), T.StructField("begin", T.LongType())])
    dealt = rows.mapInArrow(deal, schema).repartitionById(len(chunk_size), F.col("chunk"))
    again = Window.partitionBy("chunk").orderBy(F.xxhash64(F.lit(seed), "file", "at"), "file", "at")
    slot = (F.col("begin") + F.row_number().over(again) - 1).alias("slot")
    return dealt.select(*(f"c{i}" for i in range(n)), "shard", slot).toDF(*own, "shard", "slot")
