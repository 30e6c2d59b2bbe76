"""Removal of repeated word windows: a count-min sketch sifts the windows, an exact pass groups the rest.

Documents are laid out once as a table bucketed by block, a block being a range of doc_ids.  First pass:
each block sends, for every row of the sketch, the cells its windows fall into; a cell range's reducer merges
the partial sketches and answers each block with one bit a cell: was it hit twice or more?  Cells travel as
sorted deltas, so the sketch can be many times as wide as a dense one.  A window is estimated repeated if all
its cells are; estimates are never too low, so no repeat is lost.  Second pass: each block sends 128-bit
digests of those windows only, once each, and learns which of them start first in this block.  A digest is two
trees of 64-bit mixes over the window's words under independent constants (``textscan``).
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import textscan as ts
from .frames import kept_columns, neutral
from .storage import free_shuffles, new_table, written

_CELLS_PER_SLICE = 22
_MESSAGE = "slice int, block int, n int, body binary"
_ANSWER = "block int, slice int, n int, bits binary"


def _pack_deltas(cells: np.ndarray, twice: np.ndarray) -> bytes:
    """Sorted cells of one slice, with a mark for those hit twice in the block."""
    step = ((np.diff(cells, prepend=0) << 1) | twice).astype("<u4")
    return zlib.compress(np.ascontiguousarray(step.view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _unpack_deltas(body: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    step = np.ascontiguousarray(np.frombuffer(zlib.decompress(body), np.uint8).reshape(4, n).T).view("<u4").ravel()
    return np.cumsum((step >> 1).astype(np.int64)), (step & 1).astype(bool)


class _Block:
    """Words and windows of one block, in order of doc_id, text and position."""

    def __init__(self, docs: pa.Table, width: int, text: str):
        self.data, self.offsets, self.width = *ts.utf8(docs.column(text)), width
        self.starts, self.ends, self.first = ts.spans(self.data, self.offsets)
        self.at, self.window = self.windows(0)

    def windows(self, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of every window."""
        return ts.window_hashes(ts.span_hashes(self.data, self.starts, self.ends, seed), self.first, self.width, seed)

    def cells(self, row: int, log_width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct cells of the windows in a row of the sketch, their counts, and each window's index among them."""
        cell = (ts.mix(self.window + np.uint64(0x9E3779B97F4A7C15 * (row + 1) % 2**64)) >> np.uint64(64 - log_width)).astype(np.int64)
        got, back, count = np.unique(cell, return_inverse=True, return_counts=True)
        return got, count, back


def _answers(table: pa.Table, kind: int) -> dict[int, np.ndarray]:
    """Bits of each slice, by slice."""
    return {s: np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool) for s, n, b, k in zip(table["slice"].to_pylist(), table["n"].to_pylist(), table["bits"].to_pylist(), table["kind"].to_pylist()) if k == kind}


def _slices(cells: np.ndarray, shift: int) -> list[tuple[int, int, int]]:
    """(slice, from, to) of sorted cells."""
    if not len(cells):
        return []
    part = cells >> shift
    edge = np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(cells)]
    return [(int(part[a]), int(a), int(b)) for a, b in zip(edge, edge[1:])]


def _repeated(block: _Block, answers: dict[int, np.ndarray], depth: int, log_width: int) -> np.ndarray:
    """Mask of the windows whose every cell was hit twice or more."""
    out = np.ones(len(block.window), bool)
    for row in range(depth):
        cells, _, back = block.cells(row, log_width)
        hot = np.zeros(len(cells), bool)
        for s, a, b in _slices(cells, _CELLS_PER_SLICE):
            hot[a:b] = answers[s * depth + row]
        out &= hot[back]
    return out


def _digests(block: _Block, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct digests (a, b) of the hot windows in sorted order, and each hot window's index among them."""
    a = block.window[hot]
    b = block.windows(1)[1][hot] if len(a) else a
    by = np.lexsort((b, a))
    a, b = a[by], b[by]
    new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])][: len(by)]
    back = np.empty(len(by), np.int64)
    back[by] = np.cumsum(new) - 1
    return a[new], b[new], back


def _messages(block: int, parts: list[tuple[int, int, bytes]]) -> pa.Table:
    return pa.table({"slice": pa.array([p[0] for p in parts], pa.int32()), "block": pa.array([block] * len(parts), pa.int32()), "n": pa.array([p[1] for p in parts], pa.int32()), "body": pa.array([p[2] for p in parts], pa.binary())})


def _answer_table(slice_: int, rows: list[tuple[int, int, bytes]]) -> pa.Table:
    return pa.table({"block": pa.array([r[0] for r in rows], pa.int32()), "slice": pa.array([slice_] * len(rows), pa.int32()), "n": pa.array([r[1] for r in rows], pa.int32()), "bits": pa.array([r[2] for r in rows], pa.binary())})


def _merge_cells(group: pa.Table) -> pa.Table:
    """Merges the partial sketches of one slice: a bit for each cell sent, whether its total is two or more."""
    if not group.num_rows:
        return _answer_table(0, [])
    parts = [_unpack_deltas(b, n) for b, n in zip(group["body"].to_pylist(), group["n"].to_pylist())]
    total = np.zeros(1 << _CELLS_PER_SLICE, np.uint8)
    for cells, twice in parts:
        total[cells] = np.minimum(total[cells] + 1 + twice, 2)
    rows = [(block, len(cells), np.packbits(total[cells] >= 2).tobytes()) for block, (cells, _) in zip(group["block"].to_pylist(), parts)]
    return _answer_table(group["slice"][0].as_py(), rows)


def _merge_digests(group: pa.Table) -> pa.Table:
    """Groups the digests of one slice exactly: a bit for each digest sent, whether no earlier block has it."""
    if not group.num_rows:
        return _answer_table(0, [])
    sent = sorted(zip(group["block"].to_pylist(), group["n"].to_pylist(), group["body"].to_pylist()))
    a = np.concatenate([np.frombuffer(body, "<u8", n) for _, n, body in sent])
    b = np.concatenate([np.frombuffer(body, "<u8", n, 8 * n) for _, n, body in sent])
    by = np.lexsort((b, a))  # stable: equal digests stay in order of their blocks
    lead = np.r_[True, (np.diff(a[by]) != 0) | (np.diff(b[by]) != 0)]
    bit = np.zeros(len(a), bool)
    bit[by[lead]] = True
    edges = np.cumsum([0, *(n for _, n, _ in sent)])
    return _answer_table(group["slice"][0].as_py(), [(block, n, np.packbits(bit[x : x + n]).tobytes()) for (block, n, _), x in zip(sent, edges)])


_ADDED = ["n_words", "n_removed", "kept_text", "kept_sha256"]


def remove_repeated_windows(docs: DataFrame, width: int = 20, text: str = "text", carry: list[str] | None = None, digests: bool = False, depth: int = 2, cells_per_window: int = 16, block_bytes: int = 8 << 20, digests_per_slice: int = 1 << 18) -> DataFrame:
    """Removes every word covered by a window of ``width`` words that also starts earlier.

    Earlier: in a smaller doc_id, or further left in the same document.  Windows are judged on the input.
    Adds ``n_words``, ``n_removed`` (long) and ``kept_text``, the kept words joined by one space, or with
    ``digests`` its SHA-256 as ``kept_sha256``.  A null or empty text has no words; a null doc_id comes
    first; rows of one doc_id are taken in order of their text, and of equal rows one keeps its words.
    ``carry``: input columns to return, all by default; columns named like a result are replaced.  A window
    of a third of all documents is one digest a block.  The layout takes one shuffle of the texts, later
    passes read the bucketed table in place; ``storage.scratch`` drops it.
    """
    spark = docs.sparkSession
    own = kept_columns(docs, carry, _ADDED)
    held = neutral(docs, own, ident="doc_id", body=text)
    total = held.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    log_width = max(_CELLS_PER_SLICE, math.ceil(math.log2(max(1, total / 6 * cells_per_window))))
    digest_bits = max(0, math.ceil(math.log2(max(1, total / 6 / digests_per_slice))))
    name, ident, body = new_table(spark), "ident", "body"
    laid = held.repartitionByRange(blocks, ident).withColumn("block", F.spark_partition_id()).sortWithinPartitions(ident, body)
    laid.write.format("parquet").option("compression", "zstd").bucketBy(blocks, "block").saveAsTable(name)
    laid = spark.table(name)
    free_shuffles(spark)
    narrow = laid.select("block", ident, body)

    def nulls_first(group: pa.Table) -> pa.Table:
        at = pc.sort_indices(group, [(ident, "ascending"), (body, "ascending")], null_placement="at_start")
        return group.take(at)

    def send_cells(group: pa.Table) -> pa.Table:
        number = group["block"][0].as_py()
        block = _Block(nulls_first(group), width, body)
        parts = []
        for row in range(depth):
            cells, count, _ = block.cells(row, log_width)
            parts += [(s * depth + row, b - a, _pack_deltas(cells[a:b] & ((1 << _CELLS_PER_SLICE) - 1), count[a:b] > 1)) for s, a, b in _slices(cells, _CELLS_PER_SLICE)]
        return _messages(number, parts)

    def send_digests(group: pa.Table, answers: pa.Table) -> pa.Table:
        if not group.num_rows:
            return _messages(0, [])
        block = _Block(nulls_first(group), width, body)
        a, b, _ = _digests(block, _repeated(block, _answers(answers, 0), depth, log_width))
        parts = [(s, y - x, a[x:y].tobytes() + b[x:y].tobytes()) for s, x, y in _slices((a >> np.uint64(32)).astype(np.int64), 32 - digest_bits)]
        return _messages(group["block"][0].as_py(), parts)

    kept_name = "kept_sha256" if digests else "kept_text"
    out_schema = T.StructType([held.schema[f"c{i}"] for i in range(len(own))] + [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField(kept_name, T.StringType())])

    def finish(group: pa.Table, answers: pa.Table) -> pa.Table:
        if not group.num_rows:
            return to_arrow_schema(out_schema).empty_table()
        group = nulls_first(group)
        block = _Block(group, width, body)
        hot = _repeated(block, _answers(answers, 0), depth, log_width)
        a, _, back = _digests(block, hot)
        here = np.zeros(len(a), bool)
        firsts = _answers(answers, 1)
        for s, x, y in _slices((a >> np.uint64(32)).astype(np.int64), 32 - digest_bits):
            here[x:y] = firsts[s]
        lead = np.zeros(len(back), bool)
        lead[np.unique(back, return_index=True)[1]] = True
        again = block.at[hot][~(lead & here[back])]
        gone = ts.covered(again, np.full(len(again), width), len(block.starts))
        removed = ts.per_document(gone, block.first)
        kept = []
        data = block.data.tobytes()
        for d in range(group.num_rows):
            x, y = block.first[d], block.first[d + 1]
            words = data[block.offsets[d] : block.offsets[d + 1]].split()
            if removed[d]:
                words = [words[i] for i in np.flatnonzero(~gone[x:y]).tolist()]
            joined = b" ".join(words)
            kept.append(hashlib.sha256(joined).hexdigest() if digests else joined.decode("utf-8"))
        cols = {f"c{i}": group[f"c{i}"] for i in range(len(own))}
        return pa.table(cols | {"n_words": pa.array(np.diff(block.first)), "n_removed": pa.array(removed), kept_name: pa.array(kept, pa.string())})

    cells = narrow.groupBy("block").applyInArrow(send_cells, _MESSAGE)
    repeated = written(cells.groupBy("slice").applyInArrow(_merge_cells, _ANSWER).withColumn("kind", F.lit(0)))
    free_shuffles(spark)
    sent = narrow.groupBy("block").cogroup(repeated.groupBy("block")).applyInArrow(send_digests, _MESSAGE)
    both = repeated.union(written(sent.groupBy("slice").applyInArrow(_merge_digests, _ANSWER).withColumn("kind", F.lit(1))))
    free_shuffles(spark)
    done = laid.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(finish, out_schema)
    return done.toDF(*own, "n_words", "n_removed", kept_name)
