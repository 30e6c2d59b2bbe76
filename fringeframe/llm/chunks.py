"""Rows packed into chunks of bounded bytes, and sorted keys packed into messages between chunks and slices."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from . import textscan as ts
from .storage import written


def packed(given: DataFrame, at: int, limit: int = ts.CHUNK_BYTES) -> DataFrame:
    """(cid, bytes, body): the rows of ``given`` in chunks of at most ``limit`` bytes of their text, the column
    ``at``, or of one longer text; written, so that a chunk's number stays what it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cid = TaskContext.get().partitionId() << 32
        for batch in batches:
            _, offsets = ts.utf8(batch.column(at))
            for lo, hi in ts.chunks(offsets, limit):
                sink, part = pa.BufferOutputStream(), batch.slice(lo, hi - lo)
                with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_batch(part)
                yield pa.RecordBatch.from_arrays([pa.array([cid]), pa.array([int(offsets[hi] - offsets[lo])]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["cid", "bytes", "body"])
                cid += 1

    return written(given.mapInArrow(run, "cid long, bytes long, body binary"))


def unpacked(body: bytes) -> pa.RecordBatch:
    """The rows of a chunk."""
    return pa.ipc.open_stream(body).read_all().combine_chunks().to_batches()[0]


def to_planes(values: np.ndarray) -> bytes:
    """Numbers as compressed planes of equal bytes."""
    return zlib.compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes(), 1)


def from_planes(body: bytes, n: int, kind: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(body), np.uint8).reshape(-1, n).T).view(kind).ravel()


def sorted_message(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys, by their gaps."""
    return to_planes(np.diff(keys, prepend=np.uint64(0)))


def from_message(body: bytes, n: int) -> np.ndarray:
    return np.cumsum(from_planes(body, n, "<u8"), dtype=np.uint64)


def slice_edges(slots: np.ndarray) -> list[tuple[int, int, int]]:
    """(slot, from, to) of sorted slots."""
    edge = np.r_[0, np.flatnonzero(np.diff(slots)) + 1, len(slots)] if len(slots) else np.zeros(1, np.int64)
    return [(int(slots[a]), int(a), int(b)) for a, b in zip(edge, edge[1:])]
