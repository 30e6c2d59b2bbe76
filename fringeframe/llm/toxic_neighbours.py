"""Toxicity by votes of the nearest labelled examples, found in a block-max inverted index.

Every term of every example is indexed, by TF-IDF weights that also count how far a term's use differs between
the labels (1 + chi-square; all terms keep a weight).  Examples are sorted so that like ones share a block of
64.  For every term the index keeps its largest weight in each block; a query bounds its cosine with a block by
these, takes blocks from the highest bound down, and stops once the bound is under its k-th best cosine.  The
neighbours found are exactly the nearest.  Terms of many examples, whose postings would bound nothing, are kept
as dense columns instead and added up first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type as to_arrow

from . import textscan as ts
from .frames import kept_columns, least_hashed, named, neutral
from .storage import written

#: Terms are runs of letters, digits and bytes beyond ASCII; A-Z are lower-cased.
_BREAKS = np.ones(256, bool)
_BREAKS[48:58] = _BREAKS[65:91] = _BREAKS[97:123] = _BREAKS[128:] = False
#: Terms of the vocabulary whose frequencies are added up by one reducer.
_SLICE = 1 << 14


@dataclass(frozen=True)
class NeighbourSettings:
    """``examples``: bound of labelled rows in the index, half of either label where there are as many, and
    ``entries``: of their (example, term) pairs; ``k`` neighbours vote, ``block`` examples share a bound, terms
    of a ``dense`` share of the examples are columns, ``sure`` is the score that predicts 1."""

    examples: int = 4096
    entries: int = 1 << 21
    k: int = 25
    block: int = 64
    dense: float = 1 / 32
    sure: float = 0.7


def term_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, count) of all documents, by document."""
    low = ts.LOWER[data]
    starts, ends, first = ts.spans(low, offsets, _BREAKS)
    owner, h = np.repeat(np.arange(len(offsets) - 1), np.diff(first)), ts.span_hashes(low, starts, ends)
    by = np.lexsort((h, owner))
    lead = np.flatnonzero(np.r_[True, (np.diff(owner[by]) != 0) | (np.diff(h[by]) != 0)][: len(by)])
    return owner[by][lead], h[by][lead], np.diff(np.r_[lead, len(by)])


def label_contrast(doc: np.ndarray, term: np.ndarray, label: np.ndarray, terms: int) -> np.ndarray:
    """Chi-square of each term's document frequency against the labels."""
    n1, n0 = int(label.sum()), int((1 - label).sum())
    if not n1 or not n0:
        return np.zeros(terms)
    one = np.bincount(term, weights=label[doc], minlength=terms)
    zero = np.bincount(term, minlength=terms) - one
    n = n1 + n0
    return n * (one * (n0 - zero) - zero * (n1 - one)) ** 2 / np.maximum(1.0, n1 * n0 * (one + zero) * np.maximum(n - one - zero, 1))


def term_ids(term: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    if not len(vocabulary):
        return np.full(len(term), -1, np.int64)
    spot = np.minimum(np.searchsorted(vocabulary, term), len(vocabulary) - 1)
    return np.where(vocabulary[spot] == term, spot, -1)


def unit_weights(doc: np.ndarray, term: np.ndarray, count: np.ndarray, idf: np.ndarray, docs: int) -> np.ndarray:
    """TF-IDF weights (1 + log tf) * idf of (document, term id) entries, each document's of length 1."""
    w = (1 + np.log(count)) * idf[term]
    norm = np.sqrt(np.bincount(doc, weights=w * w, minlength=docs))
    return w / np.maximum(norm, 1e-300)[doc]


def _spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The ranges [begin, begin + size) one after the other."""
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())


class BlockMaxIndex:
    """Postings of the examples by (term, block), with the largest weight of each; frequent terms as columns."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, weight: np.ndarray, examples: int, terms: int, block: int, dense: float = 1.0):
        # Like examples side by side: by their heaviest term, then by its weight.
        heavy = np.lexsort((weight, doc))
        last = np.flatnonzero(np.r_[np.diff(doc[heavy]) != 0, True][: len(heavy)])
        top_term, top_weight = np.full(examples, terms), np.zeros(examples)
        top_term[doc[heavy][last]], top_weight[doc[heavy][last]] = term[heavy][last], weight[heavy][last]
        self.order = np.lexsort((np.arange(examples), -top_weight, top_term))
        place = np.empty(examples, np.int64)
        place[self.order] = np.arange(examples)
        self.block, self.blocks, self.examples = block, max(1, -(-examples // block)), examples
        often = np.flatnonzero(np.bincount(term, minlength=terms) > max(1.0, dense * examples))
        self.column = np.full(terms, -1, np.int64)
        self.column[often] = np.arange(len(often))
        self.columns = np.zeros((len(often), self.blocks * block))
        wide = self.column[term] >= 0
        self.columns[self.column[term[wide]], place[doc[wide]]] = weight[wide]
        doc, term, weight = doc[~wide], term[~wide], weight[~wide]
        cell = term * self.blocks + place[doc] // block
        by = np.argsort(cell, kind="stable")
        self.slot, self.weight = (place[doc] % block)[by].astype(np.int32), weight[by]
        cell, begin = np.unique(cell[by], return_index=True)
        self.begin, self.cell_block = np.r_[begin, len(by)], cell % self.blocks
        self.most = np.maximum.reduceat(self.weight, begin) if len(begin) else np.zeros(0)
        self.cells = np.searchsorted(cell // self.blocks, np.arange(terms + 1))

    def nearest(self, query: np.ndarray, term: np.ndarray, weight: np.ndarray, queries: int, k: int, leave: np.ndarray | None = None, batch: int = 512) -> tuple[np.ndarray, np.ndarray, int]:
        """Cosines and example numbers of each query's k nearest (0 and -1 beyond the last with a positive
        cosine; of equal cosines the first in index order), and the number of blocks scored.  Entries must be
        sorted by query; ``leave``: an example that a query must not find."""
        at = np.full(queries, -1) if leave is None else np.where(leave >= 0, np.argsort(self.order)[np.maximum(leave, 0)], -1)
        cosine, who, scored = np.zeros((queries, k)), np.full((queries, k), -1, np.int64), 0
        for lo in range(0, queries, batch):
            hi = min(queries, lo + batch)
            a, b = np.searchsorted(query, [lo, hi])
            cosine[lo:hi], who[lo:hi], n = self._nearest(query[a:b] - lo, term[a:b], weight[a:b], hi - lo, k, at[lo:hi])
            scored += n
        return cosine, who, scored

    def _nearest(self, query: np.ndarray, term: np.ndarray, weight: np.ndarray, queries: int, k: int, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        wide = self.column[term] >= 0
        table = np.zeros((queries, len(self.columns)))
        table[query[wide], self.column[term[wide]]] = weight[wide]
        part = (table @ self.columns).reshape(queries, self.blocks, self.block)
        query, term, weight = query[~wide], term[~wide], weight[~wide]
        # Every (query, block) gets the cells of the query's terms in that block.
        many = self.cells[term + 1] - self.cells[term]
        cell, factor = _spread(self.cells[term], many), np.repeat(weight, many)
        key = np.repeat(query, many) * self.blocks + self.cell_block[cell]
        by = np.argsort(key, kind="stable")
        cell, factor = cell[by], factor[by]
        first = np.r_[0, np.cumsum(np.bincount(key, minlength=queries * self.blocks))]
        bound = part.max(axis=2) + np.bincount(key[by], weights=factor * self.most[cell], minlength=queries * self.blocks).reshape(queries, self.blocks)
        turn = np.argsort(-bound, axis=1, kind="stable")
        best, who = np.zeros((queries, k)), np.full((queries, k), self.examples, np.int64)
        live, scored = np.arange(queries), 0
        for r in range(self.blocks):
            block = turn[live, r]
            reach = bound[live, block]
            keep = (reach > 0) & (reach >= best[live, -1] - 1e-9)
            live, block = live[keep], block[keep]
            if not len(live):
                break
            scored += len(live)
            at = live * self.blocks + block
            size = first[at + 1] - first[at]
            mine = _spread(first[at], size)
            posts = self.begin[cell[mine] + 1] - self.begin[cell[mine]]
            post = _spread(self.begin[cell[mine]], posts)
            spot = np.repeat(np.repeat(np.arange(len(live)), size), posts) * self.block + self.slot[post]
            cosine = np.bincount(spot, weights=np.repeat(factor[mine], posts) * self.weight[post], minlength=len(live) * self.block).reshape(len(live), self.block) + part[live, block]
            number = block[:, None] * self.block + np.arange(self.block)[None, :]
            cosine[(number == left[live][:, None]) | (cosine <= 0)] = 0
            cosine = np.round(cosine, 12)
            # Only queries that gain a neighbour, or a tie, choose anew.
            gain = np.flatnonzero(((cosine > 0) & (cosine >= best[live][:, -1:])).any(axis=1))
            mine = live[gain]
            cosine, number = np.concatenate([best[mine], cosine[gain]], axis=1), np.concatenate([who[mine], number[gain]], axis=1)
            number[cosine <= 0] = self.examples
            pick = np.lexsort((number, -cosine), axis=1)[:, :k]
            best[mine], who[mine] = np.take_along_axis(cosine, pick, 1), np.take_along_axis(number, pick, 1)
        return best, np.r_[self.order, -1][who], scored


def votes(cosine: np.ndarray, who: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Share of label 1 among the neighbours, weighted by 1 / (1.05 - cosine); 0 without neighbours."""
    w = np.where(who >= 0, 1 / (1.05 - np.minimum(cosine, 1)), 0.0)
    return (w * np.r_[label, 0][who]).sum(axis=1) / np.maximum(w.sum(axis=1), 1e-300)


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted isotonic regression of y on x by pooling adjacent violators: knots and their values."""
    x, back = np.unique(x, return_inverse=True)
    weight, total = np.bincount(back, weights=w), np.bincount(back, weights=w * y)
    pools: list[list[float]] = []
    for k in range(len(x)):
        pools.append([total[k], weight[k], 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            t, v, c = pools.pop()
            pools[-1] = [pools[-1][0] + t, pools[-1][1] + v, pools[-1][2] + c]
    return x, np.concatenate([np.full(int(c), t / v) for t, v, c in pools]) if pools else x


class NeighbourModel:
    """Vocabulary, term weights, index and calibration; as large as the bounds of its settings.  The index is sent
    as the examples' entries and built again by every worker."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, count: np.ndarray, label: np.ndarray, vocabulary: np.ndarray, idf: np.ndarray, prior: float, settings: NeighbourSettings):
        self.vocabulary, self.label, self.settings, self.prior = vocabulary, label, settings, prior
        self.entries = tuple(x.astype(np.int32) for x in (doc, term, count))
        self.term_weight = idf * (1 + label_contrast(doc, term, label, len(vocabulary)))
        weight = self._build()
        self.knots, self.values = np.zeros(1), np.full(1, prior)
        if len(label):
            # Calibrated on the examples, each left out of its own neighbours, weighted back to the labels' prior.
            cosine, who, _ = self.index.nearest(doc, term, weight, len(label), settings.k, np.arange(len(label)))
            share = label.mean()
            balance = np.where(label == 1, prior / max(share, 1e-9), (1 - prior) / max(1 - share, 1e-9))
            self.knots, self.values = isotonic(votes(cosine, who, label), label.astype(float), balance)

    def _build(self) -> np.ndarray:
        doc, term, count = (x.astype(np.int64) for x in self.entries)
        weight = unit_weights(doc, term, count, self.term_weight, len(self.label))
        self.index = BlockMaxIndex(doc, term, weight, len(self.label), len(self.vocabulary), self.settings.block, self.settings.dense)
        return weight

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "index"}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._build()

    def score(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated scores, cosines and example numbers."""
        docs = len(offsets) - 1
        doc, term, count = term_counts(data, offsets)
        spot = term_ids(term, self.vocabulary)
        known = spot >= 0
        doc, spot = doc[known], spot[known]
        cosine, who, _ = self.index.nearest(doc, spot, unit_weights(doc, spot, count[known], self.term_weight, docs), docs, self.settings.k)
        vote = votes(cosine, who, self.label)
        # Votes break the ties of the calibration's steps, so that the order of the votes stays.
        return np.clip(0.98 * np.interp(vote, self.knots, self.values) + 0.02 * vote, 0.0, 1.0), cosine, who


def _examples(plain: DataFrame, labels: DataFrame, settings: NeighbourSettings) -> tuple[list, float]:
    """(doc_id, toxic, terms, counts) of the examples in order of doc_id, and the share of toxic labels."""
    size = {r[0]: r[1] for r in labels.groupBy("toxic").count().collect()}
    half = settings.examples // 2
    picked = []
    for value in (0, 1):
        quota = max(half, settings.examples - size.get(1 - value, 0))
        picked += least_hashed(labels.where(F.col("toxic") == value), quota, 17, "doc_id").collect()
    kind = plain.schema["doc_id"].dataType
    wanted = plain.sparkSession.createDataFrame([(r[0], int(r[1])) for r in picked], T.StructType([T.StructField("doc_id", kind), T.StructField("toxic", T.IntegerType())]))

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = ts.utf8(batch.column(1))
            for lo, hi in ts.chunks(offsets):
                doc, term, count = term_counts(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                at = np.searchsorted(doc, np.arange(hi - lo + 1))
                bodies = [pa.array([x[a:b].astype(kind).tobytes() for a, b in zip(at, at[1:])], pa.binary()) for x, kind in ((term, "<u8"), (count, "<u4"))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array(np.diff(at)), *bodies], names=["doc_id", "toxic", "n", "terms", "counts"])

    found = plain.join(F.broadcast(wanted), "doc_id").select("doc_id", "text", "toxic").mapInArrow(terms, f"doc_id {kind.simpleString()}, toxic int, n long, terms binary, counts binary")
    # Of several rows of one id the one of least bytes stands for it.
    found = written(found.groupBy("doc_id", "toxic").agg(F.min(F.struct("terms", "counts", "n")).alias("x")).select("doc_id", "toxic", "x.n", "x.terms", "x.counts"))
    turn = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = found.join(F.broadcast(found.select("doc_id", "n").withColumn("upto", F.sum("n").over(turn)).select("doc_id", "upto")), "doc_id").where(F.col("upto") <= settings.entries)
    return sorted(rows.select("doc_id", "toxic", "terms", "counts").collect(), key=lambda r: r["doc_id"]), size.get(1, 0) / max(1, size.get(0, 0) + size.get(1, 0))


def _document_frequencies(texts: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many of all texts each term occurs, and the number of texts."""
    known = texts.sparkSession.sparkContext.broadcast(vocabulary)
    schema = "slice int, n long, counts binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(known.value), np.int64), 0
        for batch in batches:
            data, offsets = ts.utf8(batch.column(0))
            for lo, hi in ts.chunks(offsets):
                spot = term_ids(term_counts(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])[1], known.value)
                total += np.bincount(spot[spot >= 0], minlength=len(total))
            n += batch.num_rows
        bodies = [zlib.compress(total[a : a + _SLICE].astype("<i8").tobytes(), 1) for a in range(0, max(1, len(total)), _SLICE)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(bodies)), pa.int32()), pa.array([n] * len(bodies), pa.int64()), pa.array(bodies, pa.binary())], names=["slice", "n", "counts"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(zlib.decompress(b), "<i8") for b in group["counts"].to_pylist())
        return pa.table({"slice": group["slice"][:1], "n": pa.array([sum(group["n"].to_pylist())], pa.int64()), "counts": pa.array([total.tobytes()], pa.binary())})

    rows = sorted(texts.mapInArrow(count, schema).groupBy("slice").applyInArrow(add, schema).collect())
    return (np.concatenate([np.frombuffer(r["counts"], "<i8") for r in rows]), rows[0]["n"]) if rows else (np.zeros(len(vocabulary), np.int64), 0)


def score_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, settings: NeighbourSettings = NeighbourSettings(), text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Adds ``score`` (0 to 1), ``predicted`` (int), and the evidence ``neighbours`` to every document.

    ``labels`` has ``doc_id`` and ``toxic``; ``learn`` says by doc_id which labels may be learned from.  The
    examples are the labelled rows of least hash, up to the settings' bounds, with the terms of their whole
    texts; a query's cosine is over all these terms, and their document frequencies count all documents.
    ``neighbours`` is an array of (doc_id, similarity, toxic), nearest first, of all that vote.  A text without
    known terms, empty and null ones too, has no neighbours and the least score.  Null labels and ids are not
    learned from; of several labels of one document the largest counts, and of several texts of an example the
    one of least terms; without both labels every score is the same.  Rows stand alone, repeated ones too; an
    empty table gives an empty result; columns named like a result are replaced.  Nothing is shuffled but the
    examples' terms and, for each task, the frequencies.
    """
    spark = docs.sparkSession
    made = ["score", "predicted", "neighbours"]
    own = kept_columns(docs, carry, made)
    labels = labels.where(learn & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    plain = docs.select("doc_id", named(text).alias("text"))
    rows, prior = _examples(plain, labels, settings)
    term = np.frombuffer(b"".join(r["terms"] for r in rows), "<u8")
    count = np.frombuffer(b"".join(r["counts"] for r in rows), "<u4").astype(np.int64)
    doc = np.repeat(np.arange(len(rows)), [len(r["terms"]) // 8 for r in rows])
    label = np.array([r["toxic"] for r in rows], np.int64)
    vocabulary, term = np.unique(term, return_inverse=True)
    seen, total = _document_frequencies(plain.select("text"), vocabulary)
    idf = np.log((total + 1) / (seen + 0.5))
    model = spark.sparkContext.broadcast(NeighbourModel(doc, term, count, label, vocabulary, idf, prior, settings))
    kind = docs.schema["doc_id"].dataType
    ids = spark.sparkContext.broadcast(pa.array([r["doc_id"] for r in rows], to_arrow(kind)))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            data, offsets = ts.utf8(batch.column(len(own)))
            for lo, hi in ts.chunks(offsets):
                score, cosine, who = m.score(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                some = who >= 0
                near = pa.StructArray.from_arrays([ids.value.take(pa.array(who[some])), pa.array(cosine[some]), pa.array(np.r_[m.label, 0][who[some]].astype(np.int32))], ["doc_id", "similarity", "toxic"])
                near = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(some.sum(axis=1))].astype(np.int32)), near)
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(len(own))), pa.array(score), pa.array((score >= m.settings.sure).astype(np.int32)), near], names=schema.names)

    given = neutral(docs, own, body=text)
    evidence = T.ArrayType(T.StructType([T.StructField("doc_id", kind), T.StructField("similarity", T.DoubleType()), T.StructField("toxic", T.IntegerType())]))
    schema = T.StructType([*given.schema.fields[:-1], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("neighbours", evidence)])
    return given.mapInArrow(judge, schema).toDF(*own, *made)
