"""Benchmark passages in documents, by the q-gram lemma and banded alignment.

A passage of n characters within e edits of a benchmark item keeps at least n - q + 1 - q * e of the item's
q-grams, all on diagonals (position in the document less position in the item) that span e at most.  Shared
q-grams are counted in diagonal bands that overlap by half; bands that meet the bound are aligned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from . import textscan as ts
from .frames import named

_SPREAD_BITS = 23
#: Lower case of the basic plane's characters, where it is one character.
_LOWER = np.array([ord(low) if len(low := chr(c).lower()) == 1 else c for c in range(1 << 16)], np.uint32)
_NO_ITEM, _NO_DOC = np.uint32(0xFFFFFFFF), np.uint32(0xFFFFFFFE)


def characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of texts, lower-cased one by one, each run of blanks made one space; and their offsets."""
    blank = ts.BLANKS[data]
    keep = np.ones(len(data), bool)
    if len(data):
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        keep[1:] = ~(blank[1:] & blank[:-1] & ~cut[1 : len(data)])
    kept = np.where(blank, np.uint8(32), data)[keep]
    lead = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep & ((data & 0xC0) != 0x80), out=lead[1:])
    chars = np.frombuffer(kept.tobytes().decode("utf-8").encode("utf-32-le"), "<u4")
    return np.where(chars < len(_LOWER), _LOWER[np.minimum(chars, len(_LOWER) - 1)], chars), lead[offsets]


def gram_hashes(chars: np.ndarray, offsets: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Position and hash of every q-gram that lies in one text."""
    return ts.window_hashes(chars.astype(np.uint64), offsets, q)


@dataclass
class _Items:
    """A block of benchmark items: their characters one after the other, and q-gram postings."""

    ids: list
    chars: np.ndarray
    at: np.ndarray
    length: np.ndarray
    edits: np.ndarray
    bound: np.ndarray
    step: np.ndarray
    grams: np.ndarray
    begin: np.ndarray
    item: np.ndarray
    place: np.ndarray
    q: int

    @staticmethod
    def build(rows: list[tuple], q: int, rate: float, min_chars: int) -> _Items:
        data, offsets = ts.utf8(pa.array([r[1].strip(" \t\n\r\x0b\x0c") for r in rows], pa.string()))
        chars, at = characters(data, offsets)
        length = np.diff(at)
        # Short items must be there as they are.
        edits = np.where(length >= min_chars, np.minimum((rate * length).astype(np.int64), np.maximum(0, (length - q) // q)), 0)
        position, gram = gram_hashes(chars, at, q)
        item = np.searchsorted(at, position, side="right") - 1
        by = np.argsort(gram, kind="stable")
        grams, begin = np.unique(gram[by], return_index=True)
        step = np.maximum(16, edits + 1)
        return _Items([r[0] for r in rows], chars, at, length, edits, length - q + 1 - q * edits, step, grams, np.r_[begin, len(by)], item[by].astype(np.int32), (position - at[item])[by].astype(np.int32), q)


def _candidates(chars: np.ndarray, offsets: np.ndarray, items: _Items, spread: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, item, band) of the bands with enough shared q-grams.  A band is two of its item's steps wide and
    starts every step; an item's diagonals are shifted by its length, so that none is negative."""
    position, gram = gram_hashes(chars, offsets, items.q)
    maybe = spread[(gram >> np.uint64(64 - _SPREAD_BITS)).astype(np.int64)]
    position, gram = position[maybe], gram[maybe]
    spot = np.minimum(np.searchsorted(items.grams, gram), max(0, len(items.grams) - 1))
    hit = items.grams[spot] == gram if len(items.grams) else np.zeros(len(gram), bool)
    position, spot = position[hit], spot[hit]
    many = items.begin[spot + 1] - items.begin[spot]
    post = np.repeat(items.begin[spot], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    position, item = np.repeat(position, many), items.item[post].astype(np.int64)
    doc = np.searchsorted(offsets, position, side="right") - 1
    band = (position - offsets[doc] - items.place[post] + items.length[item]) // items.step[item]
    bands = int(band.max(initial=0)) + 2
    key = (doc * len(items.ids) + item) * bands + band
    key, count = np.unique(np.r_[key, key - 1], return_counts=True)
    band = key % bands
    pair = key // bands
    enough = (count >= items.bound[pair % len(items.ids)]) & (key >= 0)
    return pair[enough] // len(items.ids), pair[enough] % len(items.ids), band[enough]


def _align(chars: np.ndarray, offsets: np.ndarray, items: _Items, doc: np.ndarray, item: np.ndarray, band: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fewest edits of each whole item against a substring on the band's diagonals, with the substring's ends."""
    step, reach, length = items.step[item], items.edits[item] + 1, items.length[item]
    low = band * step - length - reach
    wide, longest = int((2 * step + 2 * reach).max()), int(length.max())
    column = low[:, None] + np.arange(wide + longest)[None, :]
    inside = (column >= 0) & (column < np.diff(offsets)[doc][:, None])
    region = np.where(inside, chars[np.clip(offsets[doc][:, None] + column, 0, max(0, len(chars) - 1))], _NO_DOC)
    place = np.arange(longest)[None, :]
    wanted = np.where(place < length[:, None], items.chars[np.minimum(items.at[item][:, None] + place, len(items.chars) - 1)], _NO_ITEM)
    one = np.int64(1) << 32
    slope = np.arange(wide) * one
    # A cell holds edits and, below them, where its path began.
    cell = np.broadcast_to(np.arange(wide), (len(doc), wide)).astype(np.int64)
    best = np.full(len(doc), 1 << 62, np.int64)
    end = np.zeros(len(doc), np.int64)
    for i in range(longest):
        new = cell + np.where(region[:, i : i + wide] != wanted[:, i][:, None], one, 0)
        new[:, :-1] = np.minimum(new[:, :-1], cell[:, 1:] + one)
        cell = np.minimum.accumulate(new - slope, axis=1) + slope
        last = np.flatnonzero(length == i + 1)
        if len(last):
            to = cell[last].argmin(axis=1)
            best[last], end[last] = cell[last, to], low[last] + to + i + 1
    size = np.diff(offsets)[doc]
    return best >> 32, np.clip(low + (best & (one - 1)), 0, size), np.clip(end, 0, size)


def _find(chars: np.ndarray, offsets: np.ndarray, items: _Items, spread: np.ndarray, batch: int = 256, cells: int = 1 << 22) -> list[tuple[int, int, int, int, int]]:
    """(document, item, start, end, edits), the best place of each pair; items of like length are aligned together,
    at most ``batch`` and in matrices of some ``cells`` at once (of a longer item one)."""
    doc, item, band = _candidates(chars, offsets, items, spread)
    by = np.argsort(items.length[item], kind="stable")
    doc, item, band = doc[by], item[by], band[by]
    need = items.length[item] + 2 * items.step[item] + 2 * items.edits[item] + 2
    found: dict[tuple[int, int], tuple[int, int, int]] = {}
    lo = 0
    while lo < len(doc):
        hi = min(len(doc), lo + batch)
        while hi - lo > 1 and (hi - lo) * need[hi - 1] > cells:
            hi = lo + (hi - lo) // 2
        part = slice(lo, hi)
        edits, start, end = _align(chars, offsets, items, doc[part], item[part], band[part])
        for d, k, e, s, t in zip(doc[part].tolist(), item[part].tolist(), edits.tolist(), start.tolist(), end.tolist()):
            if e <= items.edits[k]:
                found[d, k] = min(found.get((d, k), (e, s, t)), (e, s, t))
        lo = hi
    return [(d, k, s, t, e) for (d, k), (e, s, t) in found.items()]


def find_benchmark_passages(docs: DataFrame, benchmark: DataFrame, q: int = 8, edit_rate: float = 0.10, min_chars: int = 40, text: str = "text", key: str = "doc_id", item_key: str = "item_id", item_text: str = "text", block_chars: int = 1 << 22) -> DataFrame:
    """A row (key, item_key, ``start``, ``end``, ``edits``) for each document and benchmark item it holds.

    A document holds an item if a substring is within ``edit_rate`` of the item's characters (fewer where q
    allows fewer) of the whole item, after characters are lower-cased one by one and runs of blanks made one
    space; start and end count characters of the text so normalised, at the first of the best places.  Items
    under ``min_chars`` characters must be there without an edit; those under ``q``, and null ones, are no
    evidence and are not looked for; null and empty texts hold nothing.  Repeated rows and repeated items give
    a row each; an empty table on either side gives an empty result; other columns, of any name, are ignored.
    Items are taken in blocks of ``block_chars`` characters (some 25 bytes each in a worker), each broadcast
    for one narrow pass over the documents: nothing is shuffled.
    """
    spark = docs.sparkSession
    rows = docs.select(named(key).alias("doc_key"), named(text).alias("doc_text"))
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField(item_key, benchmark.schema[item_key].dataType), *(T.StructField(c, T.IntegerType()) for c in ("start", "end", "edits"))])
    item_type = to_arrow_type(benchmark.schema[item_key].dataType)
    blocks, size = [[]], 0
    for r in benchmark.select(named(item_key).alias("k"), named(item_text).alias("t")).where("t IS NOT NULL").orderBy("k", "t").toLocalIterator():
        if size + len(r[1]) > block_chars and blocks[-1]:
            blocks.append([])
            size = 0
        blocks[-1].append((r[0], r[1]))
        size += len(r[1])
    out = spark.createDataFrame([], schema)
    for block in blocks:
        if not block:
            continue
        items = _Items.build(block, q, edit_rate, min_chars)
        shared = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = shared.value
            spread = np.zeros(1 << _SPREAD_BITS, bool)
            spread[(items.grams >> np.uint64(64 - _SPREAD_BITS)).astype(np.int64)] = True
            for batch in batches:
                data, offsets = ts.utf8(batch.column(1))
                for lo, hi in ts.chunks(offsets):
                    chars, at = characters(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                    found = _find(chars, at, items, spread)
                    if found:
                        cols = list(zip(*found))
                        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([lo + d for d in cols[0]])), pa.array([items.ids[k] for k in cols[1]], item_type), *(pa.array(c, pa.int32()) for c in cols[2:])], names=schema.names)

        out = out.union(rows.mapInArrow(run, schema))
    return out
