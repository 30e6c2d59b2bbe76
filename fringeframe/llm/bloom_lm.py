"""Bigram scores from a log-frequency Bloom filter.

Counts are quantised to levels 1 + floor(log_b(count)); the filter holds an n-gram once for each level up to
its own, and a reader probes level after level until one is missing.  The filter is cut into regions by the
n-gram's hash and grows with the corpus: the reducer that counts a slice of n-grams fills that slice's region
and answers the probes, so no region has to fit more than its reducer's memory.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textscan as ts
from .chunks import from_message, from_planes, packed, slice_edges, sorted_message, to_planes, unpacked
from .frames import kept_columns, neutral
from .storage import written

_SPREAD = np.uint64(0x2545F4914F6CDD1D)
_PROBES = 4
_MAX_LEVEL = 60


@dataclass(frozen=True)
class LmSettings:
    """Every word and every bigram of the training rows takes part.  An entry of the filter has ``bits_per_entry``
    bits; levels are powers of ``log_base``; ``mu`` is the weight of the unigram prior in counts."""

    bits_per_entry: int = 12
    log_base: float = 1.5
    mu: float = 500.0


def _transitions(ids: np.ndarray, first: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(history, word, row) of every token, the end of each row among them; a row starts from the end mark."""
    rows, n = len(first) - 1, len(ids)
    place = np.arange(n) + np.repeat(np.arange(rows), np.diff(first))
    word = np.full(n + rows, end, np.int64)
    word[place] = ids
    history = np.r_[end, word[:-1]][: n + rows]
    return history, word, np.repeat(np.arange(rows), np.diff(first) + 1)


def _bits(keys: np.ndarray, level: int, size: int) -> list[np.ndarray]:
    """Positions of an entry's probes in a filter of ``size`` bits, a power of two."""
    a = ts.mix(keys + (np.uint64(level) << np.uint64(40)))
    b = ts.mix(a ^ np.uint64(0x5851F42D4C957F2D)) | np.uint64(1)
    return [((a + np.uint64(i) * b) >> np.uint64(20)).astype(np.int64) & (size - 1) for i in range(_PROBES)]


def levels(counts: np.ndarray, base: float) -> np.ndarray:
    """1 + floor(log_base(count)); 0 for none."""
    level = np.minimum(1 + np.floor(np.log(np.maximum(counts, 1)) / math.log(base) + 1e-9).astype(np.int64), _MAX_LEVEL)
    return np.where(np.asarray(counts) > 0, level, 0)


class LogFrequencyFilter:
    """One region: as many bits as its entries need, rounded up to a power of two."""

    def __init__(self, keys: np.ndarray, level: np.ndarray, bits_per_entry: int):
        self.size = max(64, 1 << math.ceil(math.log2(max(1, int(level.sum()) * bits_per_entry))))
        bits = np.zeros(self.size, np.uint8)
        for j in range(1, int(level.max(initial=0)) + 1):
            for at in _bits(keys[level >= j], j, self.size):
                bits[at] = 1
        self.bits = np.packbits(bits, bitorder="little")

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Level up to which every entry of a key is held; never under the true one."""
        out, live = np.zeros(len(keys), np.int64), np.arange(len(keys))
        for j in range(1, _MAX_LEVEL + 1):
            held = np.ones(len(live), bool)
            for at in _bits(keys[live], j, self.size):
                held &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            live = live[held]
            if not len(live):
                break
            out[live] = j
        return out


def _lookups(h: np.ndarray, first: np.ndarray):
    """(history, word, row, bigram key) of every token, by hashes; the end mark's hash is 0."""
    history, word, row = _transitions(h.view(np.int64), first, 0)
    history, word = history.view(np.uint64), word.view(np.uint64)
    return history, word, row, ts.mix(history * (_SPREAD | np.uint64(1)) + word)


def _unpacked(blob: bytes, at: int):
    """A packed chunk of rows, its texts' words as ``_lookups``, and the first word of each row."""
    part = unpacked(blob)
    data, offsets = ts.utf8(part.column(at))
    low = ts.LOWER[data]
    starts, ends, first = ts.spans(low, offsets)
    return part, first, *_lookups(ts.span_hashes(low, starts, ends), first)


def score_documents(docs: DataFrame, train: Column, settings: LmSettings = LmSettings(), text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Adds token counts and log10 probabilities of every whole text under a model of the rows where ``train`` holds.

    Tokens: words (runs of other characters than space and \\x09-\\x0D, A-Z lower-cased), then an end.  Adds
    ``n_tokens``, ``n_known`` (tokens seen in training), ``train_tokens`` (long), ``base_score`` (sum over
    tokens of log10((c + 0.5) / (N + 0.5 * (V + 1)))) and ``score``: with p1 that unigram probability, h the
    token before (the end, at the start), c2 the filter's count of the bigram and c1 the count of h,
    P = (c2 + mu * p1) / (c1 + mu).  Unigram counts are exact for every word; words and bigrams are told apart
    by 64-bit hashes.  A null or empty text is an end; a null ``train`` is false; without training rows every
    probability is 1 of 1.  Rows stand alone, repeated ones too; an empty table gives an empty result;
    columns named like a result are replaced.  ``carry``: input columns to return, all by default.

    Each chunk of rows sends its distinct words and bigrams, with their training counts, to the slices of the
    hashes; a slice adds the counts up, fills its own region of the filter, and answers the chunks in the order
    of their keys.
    """
    made = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    own = kept_columns(docs, carry, made)
    names, at = [f"c{i}" for i in range(len(own))], len(own)
    given = neutral(docs, own, lm_text=text, lm_train=train).withColumns({"lm_text": F.coalesce("lm_text", F.lit("")), "lm_train": F.coalesce("lm_train", F.lit(False))})

    chunks = packed(given, at)
    size = chunks.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    slices = 1 << max(0, math.ceil(math.log2(max(1, size / (1 << 23)))))
    shift = np.uint64(65 - slices.bit_length())

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cid, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part, _, _, word, row, pair = _unpacked(body, at)
                learned = part.column(at + 1).to_numpy(zero_copy_only=False).astype(np.float64)[row]
                rows = []
                for kind, all_keys in enumerate((word, pair)):
                    keys, back = np.unique(all_keys, return_inverse=True)
                    n = np.bincount(back, weights=learned).astype(np.int64)
                    slot = (keys >> shift).astype(np.int64) if slices > 1 else np.zeros(len(keys), np.int64)
                    rows += [(s + slices * kind, cid, b - a, sorted_message(keys[a:b]), to_planes(n[a:b].astype("<u4"))) for s, a, b in slice_edges(slot)]
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[3:])], names=["slice", "cid", "n", "keys", "counts"])

    def answer(group: pa.Table) -> pa.Table:
        cid, number = group["cid"].to_pylist(), group["n"].to_pylist()
        slice_ = group["slice"][0].as_py()
        keys = np.concatenate([from_message(k, n) for k, n in zip(group["keys"].to_pylist(), number)])
        counts = np.concatenate([from_planes(c, n, "<u4") for c, n in zip(group["counts"].to_pylist(), number)])
        got, back = np.unique(keys, return_inverse=True)
        total = np.bincount(back, weights=counts).astype(np.int64)
        value, types, tokens = total, 0, 0
        if slice_ < slices:
            types, tokens = int((total > 0).sum()), int(total.sum())
        else:
            value = LogFrequencyFilter(got, levels(total, settings.log_base), settings.bits_per_entry).levels(got)
        edge = np.r_[0, np.cumsum(number)]
        bodies = [to_planes(value[back[a:b]].astype("<i8")) for a, b in zip(edge, edge[1:])]
        none = [0] * (len(cid) - 1)
        return pa.table({"cid": pa.array(cid, pa.int64()), "slice": pa.array([slice_] * len(cid), pa.int32()), "n": pa.array(number, pa.int32()), "answer": pa.array(bodies, pa.binary()), "types": pa.array([types, *none], pa.int64()), "tokens": pa.array([tokens, *none], pa.int64())})

    asked = chunks.select("cid", "body").mapInArrow(send, "slice int, cid long, n int, keys binary, counts binary")
    answers = written(asked.groupBy("slice").applyInArrow(answer, "cid long, slice int, n int, answer binary, types long, tokens long"))
    total, types = answers.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("types"), F.lit(0))).first()
    scale, mu = total + 0.5 * (types + 1), settings.mu

    def score(chunk: pa.Table, replies: pa.Table) -> pa.Table:
        part, first, history, word, row, pair = _unpacked(chunk["body"][0].as_py(), at)
        rows = len(first) - 1
        values: tuple[list, list] = ([], [])
        for s, n, body in sorted(zip(*(replies[c].to_pylist() for c in ("slice", "n", "answer")))):
            values[s >= slices].append(from_planes(body, n, "<i8"))
        known, back = np.unique(word, return_inverse=True)
        count = np.concatenate(values[0])
        c, c1 = count[back], count[np.searchsorted(known, history)]
        level = np.concatenate(values[1])[np.unique(pair, return_inverse=True)[1]]
        c2 = np.minimum(np.where(level > 0, settings.log_base ** (level - 1.0), 0.0), c1)
        base = np.log10((c + 0.5) / scale)
        model = np.log10((c2 + mu * (c + 0.5) / scale) / (c1 + mu))
        sums = [np.bincount(row, weights=x, minlength=rows) for x in (c > 0, base, model)]
        cols = [*(part.column(k) for k in range(at)), pa.array(np.diff(first) + 1), pa.array(sums[0].astype(np.int64)), pa.array(np.full(rows, int(total))), pa.array(sums[1]), pa.array(sums[2])]
        return pa.Table.from_arrays(cols, names=[*names, *made])

    kinds = "".join(f"{n} {given.schema[n].dataType.simpleString()}, " for n in names)
    scored = chunks.select("cid", "body").groupBy("cid").cogroup(answers.select("cid", "slice", "n", "answer").groupBy("cid")).applyInArrow(score, kinds + "n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return scored.toDF(*own, *made)
