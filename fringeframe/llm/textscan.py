"""Vectorised scanning of UTF-8 text columns.

A batch of texts is one byte array plus document offsets, straight from Arrow's
own buffers.  Words, lines and n-word windows are spans of that array.  Spans are
hashed eight bytes at a time, windows as trees over their words' hashes; every step
mixes all 64 bits, so no arrangement of words or letters cancels out.
Long texts are scanned in pieces, so that what is held grows with their words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U64 = np.uint64
CHUNK_BYTES = 1 << 20
_PIECE = 1 << 22
#: Spans that long are hashed by xxh3, one by one.
_LONG = 256

#: Bytes that separate words: space and \x09-\x0D.
BLANKS = np.zeros(256, bool)
BLANKS[[9, 10, 11, 12, 13, 32]] = True

#: A-Z lower-cased, every other byte itself.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: The low 0 to 8 bytes of a word.
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)


def _constants(seed: int) -> tuple[np.uint64, np.uint64]:
    """Two odd numbers that tell the hashes of different seeds apart."""
    a, b = np.random.default_rng([0xF17E, seed]).integers(2**62, 2**63, 2, dtype=np.uint64)
    return U64(2) * a + U64(1), U64(2) * b + U64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    h = h.astype(U64, copy=True)
    t = h >> U64(30)
    h ^= t
    h *= U64(0xBF58476D1CE4E5B9)
    np.right_shift(h, U64(27), out=t)
    h ^= t
    h *= U64(0x94D049BB133111EB)
    np.right_shift(h, U64(31), out=t)
    h ^= t
    return h


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and document offsets of an Arrow string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES):
    """Ranges of documents of at most ``limit`` bytes, or of one longer document."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end
        at = end


def spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = BLANKS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of other bytes than separators inside each document.

    Returns starts, ends and, for each document and one past the last, the index of its first span.
    """
    n = len(data)
    starts, ends = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lo in range(0, n, _PIECE):
        hi = min(n, lo + _PIECE)
        # One byte more on either side says where runs that cross a piece's edge go on.
        solid = np.zeros(hi - lo + 2, bool)
        a, b = max(0, lo - 1), min(n, hi + 1)
        solid[a - lo + 1 : b - lo + 1] = ~separators[data[a:b]]
        cut = np.zeros(hi - lo + 1, bool)
        cut[offsets[np.searchsorted(offsets, lo) : np.searchsorted(offsets, hi, side="right")] - lo] = True
        mine = solid[1:-1]
        starts.append(np.flatnonzero(mine & (~solid[:-2] | cut[:-1])) + lo)
        ends.append(np.flatnonzero(mine & (~solid[2:] | cut[1:])) + lo + 1)
    begin = np.concatenate(starts)
    return begin, np.concatenate(ends), np.searchsorted(begin, offsets)


def _short_hashes(data: np.ndarray, starts: np.ndarray, length: np.ndarray, seed: int) -> np.ndarray:
    """Hashes of spans, eight bytes a round; each round is a bijection of the hash so far."""
    add, times = _constants(seed)
    tail = len(data) - 8
    lanes = np.ndarray((tail + 1,), "<u8", data, strides=(1,))
    h = mix(length.astype(U64) * times + add)
    live, at, left = None, starts, length
    while len(at):
        lane = lanes[np.minimum(at, tail)]
        late = np.flatnonzero(at > tail)
        if len(late):
            lane[late] >>= ((at[late] - tail) * 8).astype(U64)
        lane &= _LOW_BYTES[np.minimum(left, 8)]
        if live is None:
            h = mix((h ^ lane) * times)
        else:
            h[live] = mix((h[live] ^ lane) * times)
        more = np.flatnonzero(left > 8)
        live, at, left = more if live is None else live[more], at[more] + 8, left[more] - 8
    return h


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each span's bytes."""
    if len(data) < 8:
        data = np.concatenate([data, np.zeros(8, np.uint8)])
    data = np.ascontiguousarray(data)
    out = np.empty(len(starts), U64)
    for lo in range(0, len(starts), _PIECE // 8):
        part = slice(lo, lo + _PIECE // 8)
        length = ends[part] - starts[part]
        long = np.flatnonzero(length >= _LONG)
        if not len(long):
            out[part] = _short_hashes(data, starts[part], length, seed)
            continue
        short = np.flatnonzero(length < _LONG)
        out[lo + short] = _short_hashes(data, starts[part][short], length[short], seed)
        out[lo + long] = [xxhash.xxh3_64_intdigest(data[a:b], seed) for a, b in zip(starts[part][long].tolist(), ends[part][long].tolist())]
    return out


def window_hashes(words: np.ndarray, first: np.ndarray, width: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Start index and hash of every window of ``width`` consecutive words of one document.

    Windows of 1, 2, 4, ... words are hashed from two halves each; ``width`` is put together from these.
    """
    n = len(words)
    at = np.flatnonzero(np.repeat(first[1:], np.diff(first)) - np.arange(n) >= width)
    if not len(at):
        return at, np.zeros(0, U64)
    _, times = _constants(seed)
    level, size, done, out = words, 1, 0, None
    while True:
        if width & size:
            mine = level[at + done]
            out = mine if out is None else mix(out * times + mine)
            done += size
        if 2 * size > width:
            return at, out
        level = mix(level[:-size] * times + level[size:])
        size *= 2


def per_document(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over each document's slice."""
    out = np.zeros(len(first) - 1, np.int64)
    some = np.flatnonzero(np.diff(first))
    if len(some):
        out[some] = np.add.reduceat(values, first[some], dtype=np.int64)
    return out


def covered(at: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """Mask of the positions in the union of [at, at + length)."""
    step = np.bincount(at, minlength=n + 1) - np.bincount(at + length, minlength=n + 1)
    return np.cumsum(step[:n]) > 0


def take_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans as an Arrow string column."""
    length = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(length, out=offsets[1:])
    index = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], length)
    out = np.ascontiguousarray(data[index]) if len(index) else np.zeros(0, np.uint8)
    return pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(out.tobytes())]).cast(pa.string())
