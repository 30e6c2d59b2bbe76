"""Repetition rule: maximal repeated word sequences from a suffix array of each document."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import textscan as ts
from .frames import kept_columns, neutral

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_NEWLINE = np.zeros(256, bool)
_NEWLINE[10] = True


@dataclass(frozen=True)
class RepetitionRule:
    """Limits of the rule: repeats of ``min_words`` or more may cover at most ``max_percent`` %
    of the words, and none may be longer than ``max_longest`` words.  The base rule fails texts
    under ``base_words`` words or with over ``base_percent`` % of words in repeated 3-word windows."""

    min_words: int = 10
    max_percent: int = 45
    max_longest: int = 60
    base_words: int = 50
    base_percent: int = 50


def suffix_array(ids: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Ranks of all suffixes by prefix doubling, only unresolved groups being sorted again.

    Returns the suffix array and the ranks by the first 1, 2, 4, ... symbols (equal ranks: equal prefixes).
    """
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    step = np.flatnonzero(np.r_[True, np.diff(ids[order]) != 0]) if n else np.zeros(0, np.int64)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(step, np.diff(np.r_[step, n]))
    levels, width = [rank], 1
    while True:
        size = np.bincount(rank, minlength=n)
        active = np.flatnonzero(size[rank] > 1)
        if not len(active):
            break
        after = active + width
        follow = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        lead = rank[active]
        by = np.lexsort((follow, lead))
        lead, follow, at = lead[by], follow[by], active[by]
        new_group = np.r_[True, np.diff(lead) != 0]
        new_part = new_group | np.r_[True, np.diff(follow) != 0]
        place = np.arange(len(by))
        group_from = np.maximum.accumulate(np.where(new_group, place, 0))
        part_from = np.maximum.accumulate(np.where(new_part, place, 0))
        rank = rank.copy()
        rank[at] = lead + part_from - group_from
        levels.append(rank)
        width *= 2
    array = np.empty(n, np.int64)
    array[rank] = np.arange(n)
    return array, levels


def neighbour_lcp(array: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Longest common prefix of each suffix with the next one in order (0 for the last)."""
    n = len(array)
    lcp = np.zeros(n, np.int64)
    if n < 2:
        return lcp
    pair = np.flatnonzero(levels[0][array[:-1]] == levels[0][array[1:]])
    a, b, got = array[pair], array[pair + 1], np.zeros(len(pair), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = np.maximum(a, b) + got < n
        x, y = np.minimum(a + got, n - 1), np.minimum(b + got, n - 1)
        got += np.where(inside & (levels[k][x] == levels[k][y]), 1 << k, 0)
    lcp[pair] = got
    return lcp


def longest_repeats(ids: np.ndarray) -> np.ndarray:
    """For every position, the length of the longest sequence that starts there and occurs twice.

    The LCP intervals that hold a suffix nest; the deepest has the larger LCP of its two neighbours.
    """
    array, levels = suffix_array(ids)
    lcp = neighbour_lcp(array, levels)
    out = np.zeros(len(ids), np.int64)
    out[array] = np.maximum(lcp, np.r_[0, lcp[:-1]]) if len(ids) else lcp
    return out


def _measure(data: np.ndarray, offsets: np.ndarray, rule: RepetitionRule) -> dict[str, np.ndarray]:
    docs = len(offsets) - 1
    starts, ends, first = ts.spans(data, offsets)
    n, n_words = len(starts), np.diff(first)
    owner = np.repeat(np.arange(docs), n_words)
    solid = ~ts.BLANKS[data]
    lines, line_ends, line_first = ts.spans(data, offsets, _NEWLINE)
    worded = np.searchsorted(starts, line_ends) > np.searchsorted(starts, lines)
    line_owner = np.repeat(np.arange(docs), np.diff(line_first))[worded]
    line_hash = ts.span_hashes(data, lines, line_ends)[worded]
    by = np.lexsort((line_hash, line_owner))
    same = (np.diff(line_owner[by]) == 0) & (np.diff(line_hash[by]) == 0)
    word = ts.span_hashes(data, starts, ends)
    # The same word gets another id in each document, so that no repeat crosses documents.
    by_word = np.lexsort((word, owner))
    ids = np.empty(n, np.int64)
    ids[by_word] = np.cumsum(np.r_[False, (np.diff(owner[by_word]) != 0) | (np.diff(word[by_word]) != 0)][:n])
    longest = longest_repeats(ids)
    triple, long = np.flatnonzero(longest >= 3), np.flatnonzero(longest >= rule.min_words)
    # A span that reaches no further than its left neighbour's is not maximal.
    maximal = (longest >= rule.min_words) & ~np.r_[False, (longest[1:] < longest[:-1]) & (owner[1:] == owner[:-1])][:n]
    out = {
        "n_words": n_words,
        "word_chars": ts.per_document(solid & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": ts.per_document(_SYMBOLS[data], offsets),
        "n_dup_lines": np.bincount(line_owner[by][1:][same], minlength=docs) if len(by) else np.zeros(docs, np.int64),
        "n_repeat_words": ts.per_document(ts.covered(triple, longest[triple], n), first),
        "n_covered_words": ts.per_document(ts.covered(long, longest[long], n), first),
        "n_maximal_repeats": ts.per_document(maximal, first),
    }
    top = np.zeros(docs, np.int64)
    np.maximum.at(top, owner, longest)
    out["longest_repeat"] = top
    out["base_failed"] = (n_words < rule.base_words) | (100 * out["n_repeat_words"] > rule.base_percent * n_words)
    out["kept"] = ~out["base_failed"] & (100 * out["n_covered_words"] <= rule.max_percent * n_words) & (top <= rule.max_longest)
    return out


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered_words", "n_maximal_repeats", "longest_repeat"]
_FLAGS = ["base_failed", "kept"]


def judge_repetition(docs: DataFrame, rule: RepetitionRule = RepetitionRule(), text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Adds counts and verdicts of the repetition rule to every document; ``carry``: input columns to return, all by default.

    Words are runs of other characters than space and \\x09-\\x0D.  A null or empty text has no words and
    fails the base rule.  Rows are judged one by one: repeated rows, ties and an empty table need no care,
    texts of any length are judged whole, and input columns named like a result are replaced.  No shuffle;
    a task holds one chunk of about 2 MB, or one longer document.
    """
    own = kept_columns(docs, carry, _COUNTS + _FLAGS)
    given = neutral(docs, own, body=text)
    names = given.columns[:-1]
    schema = T.StructType([given.schema[c] for c in names] + [T.StructField(c, T.LongType()) for c in _COUNTS] + [T.StructField(c, T.BooleanType()) for c in _FLAGS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = ts.utf8(batch.column(len(own)))
            for lo, hi in ts.chunks(offsets):
                got = _measure(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], rule)
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part.column(k) for k in range(len(own))] + [pa.array(got[c].astype(np.int64)) for c in _COUNTS] + [pa.array(got[c]) for c in _FLAGS], names=names + _COUNTS + _FLAGS)

    return given.mapInArrow(run, schema).toDF(*own, *_COUNTS, *_FLAGS)
