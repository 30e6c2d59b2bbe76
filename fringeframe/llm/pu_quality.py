"""Quality classifier from trusted positives and unlabelled text, by the non-negative unbiased risk.

Risk of a model g with class prior p: p * R+(positives) + max(0, R-(unlabelled) - p * R-(positives)).
Negative labels are never used; the prior is estimated from positives and unlabelled text as well.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textscan as ts
from .frames import kept_columns, least_hashed, named, neutral
from .storage import written

#: Byte classes: blank, newline, lower, upper, digit, full stop and comma, ! and ?, symbols, brackets and quotes, other ASCII, beyond ASCII.
_CLASS = np.full(256, 9, np.int64)
_CLASS[[9, 11, 12, 13, 32]] = 0
_CLASS[10] = 1
_CLASS[97:123] = 2
_CLASS[65:91] = 3
_CLASS[48:58] = 4
_CLASS[list(b".,;:")] = 5
_CLASS[list(b"!?")] = 6
_CLASS[list(b"#*$%&|<>@^~+=_\\")] = 7
_CLASS[list(b"()[]{}'\"`-/")] = 8
_CLASS[128:] = 10
_CLASSES = 11
_NEWLINE = np.zeros(256, bool)
_NEWLINE[10] = True
FEATURES = _CLASSES + _CLASSES**2 + 6


@dataclass(frozen=True)
class PuSettings:
    """``positives`` and ``unlabelled``: bounds of the rows that the gradient runs over; ``steps`` of gradient descent at
    ``rate`` with weight decay ``decay``; ``sure`` is the score that predicts 1, and the bias is raised until
    at most ``lost`` of the trusted positives learned from score less."""

    positives: int = 8192
    unlabelled: int = 8192
    steps: int = 300
    rate: float = 0.05
    decay: float = 1e-3
    sure: float = 0.3
    lost: float = 0.001


def _class_shares(data: np.ndarray, offsets: np.ndarray, out: np.ndarray) -> None:
    """Counts byte classes and pairs of neighbouring ones of each document, a piece of the text at a time."""
    docs, total = len(offsets) - 1, np.zeros(out.shape, np.int64)
    for lo in range(0, len(data), ts.CHUNK_BYTES):
        # A piece holds the next one's first byte, for the pair across the edge.
        size, hi = min(len(data) - lo, ts.CHUNK_BYTES), min(len(data), lo + ts.CHUNK_BYTES + 1)
        a, b = np.searchsorted(offsets, lo, side="right") - 1, np.searchsorted(offsets, hi, side="left")
        kind, owner = _CLASS[data[lo:hi]], np.repeat(np.arange(b - a), np.diff(np.clip(offsets[a : b + 1], lo, hi)))
        one = owner[:size] * _CLASSES + kind[:size]
        total[a:b, :_CLASSES] += np.bincount(one, minlength=(b - a) * _CLASSES).reshape(-1, _CLASSES)
        pair = np.flatnonzero(owner[1:] == owner[:-1])
        key = (owner[pair] * _CLASSES + kind[pair]) * _CLASSES + kind[pair + 1]
        total[a:b, _CLASSES:] += np.bincount(key, minlength=(b - a) * _CLASSES**2).reshape(-1, _CLASSES**2)
    out[:] = total / np.maximum(np.diff(offsets), 1)[:, None]


def style_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Features of each whole text: shares of byte classes and of class pairs, and how much of it repeats."""
    docs = len(offsets) - 1
    out = np.zeros((docs, FEATURES), np.float32)
    _class_shares(data, offsets, out[:, : _CLASSES + _CLASSES**2])
    starts, ends, first = ts.spans(data, offsets)
    words = np.diff(first)
    each = np.repeat(np.arange(docs), words)
    h = ts.span_hashes(data, starts, ends)
    at, triple = ts.window_hashes(h, first, 3)
    lines, line_ends, line_first = ts.spans(data, offsets, _NEWLINE)
    line_owner = np.repeat(np.arange(docs), np.diff(line_first))

    def distinct(owner: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Share of distinct values among a document's."""
        by = np.lexsort((h, owner))
        lead = np.r_[True, (np.diff(owner[by]) != 0) | (np.diff(h[by]) != 0)][: len(by)]
        return np.bincount(owner[by][lead], minlength=docs) / np.maximum(np.bincount(owner, minlength=docs), 1)

    extra = [np.log1p(words), np.bincount(each, weights=ends - starts, minlength=docs) / np.maximum(words, 1) / 10, distinct(each, h), distinct(each[at], triple), distinct(line_owner, ts.span_hashes(data, lines, line_ends)), np.log1p(np.diff(line_first))]
    out[:, -6:] = np.stack(extra, axis=1)
    return out


def _prior_from_tails(p: np.ndarray, u: np.ndarray, positives: int, unlabelled: int) -> float:
    """The least ratio of the two upper tails, each held off by its sampling error."""
    if not positives or not unlabelled:
        return 0.5
    error = np.sqrt(np.log(20) / 2 / positives) + np.sqrt(np.log(20) / 2 / unlabelled)
    best = int(np.argmin((u + error) / np.maximum(p, 1e-9)))
    return float(np.clip(u[best] / max(p[best], 1e-9), 0.05, 0.98))


def estimate_prior(positive: np.ndarray, tail) -> float:
    """Share of positives among the unlabelled, from scores; right where the highest scores are positives' alone.

    ``tail``: scores of the unlabelled, or a function of score edges that returns how many reach each, and of how many.
    """
    if not callable(tail):
        ordered = np.sort(tail)
        return estimate_prior(positive, lambda edges: (len(ordered) - np.searchsorted(ordered, edges), len(ordered)))
    if not len(positive):
        return 0.5
    edges = np.unique(np.quantile(positive, np.linspace(0.02, 0.98, 97)))
    above, n = tail(edges)
    return _prior_from_tails(1 - np.searchsorted(np.sort(positive), edges) / len(positive), above / max(n, 1), len(positive), n)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class PuModel:
    """Linear logistic model over standardised features, learned by full-batch gradient steps (Adam).

    ``moments``: mean and deviation of the features, of all rows given by default; ``tail``: what the prior is
    estimated from, a function of the model and score edges, by default every other one of ``unlabelled``."""

    def __init__(self, positive: np.ndarray, unlabelled: np.ndarray, settings: PuSettings, moments: tuple[np.ndarray, np.ndarray] | None = None, tail=None):
        self.settings = settings
        both = np.concatenate([positive, unlabelled]).astype(np.float64)
        if moments is None:
            moments = (both.mean(axis=0), both.std(axis=0)) if len(both) else (np.zeros(FEATURES), np.ones(FEATURES))
        self.centre, self.scale = moments[0], 1 / (moments[1] + 1e-3)
        p, u = self._inputs(positive), self._inputs(unlabelled)
        self.weights, self.prior = np.zeros(FEATURES + 1), 0.5
        if len(p) and len(u):
            # A plain separation of every other row ranks the rest, which so yield the prior.
            a, b = p[::2], u[::2]
            self.weights = self._descend(lambda w: (-(1 - _sigmoid(a @ w)) @ a / len(a) + _sigmoid(b @ w) @ b / len(b)) / 2)
            self.prior = estimate_prior(p[1::2] @ self.weights, u[1::2] @ self.weights if tail is None else lambda edges: tail(self, edges))
            self.weights = self._descend(lambda w: self._risk_gradient(p, u, w))
            self.weights[-1] += max(0.0, np.log(settings.sure / (1 - settings.sure)) - np.quantile(p @ self.weights, settings.lost))

    def _inputs(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x.astype(np.float64) - self.centre) * self.scale, -6, 6)
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)

    def _risk_gradient(self, p: np.ndarray, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        at_p, at_u = p @ w, u @ w
        as_positive = -(1 - _sigmoid(at_p)) @ p / len(p)
        negative = np.logaddexp(0, at_u).mean() - self.prior * np.logaddexp(0, at_p).mean()
        slope = _sigmoid(at_u) @ u / len(u) - self.prior * _sigmoid(at_p) @ p / len(p)
        # A negative part under zero only comes of overfitting: step back from it.
        return self.prior * as_positive + slope if negative >= 0 else -slope

    def _descend(self, gradient) -> np.ndarray:
        w, m, v = np.zeros(FEATURES + 1), np.zeros(FEATURES + 1), np.zeros(FEATURES + 1)
        for k in range(1, self.settings.steps + 1):
            g = gradient(w) + self.settings.decay * np.r_[w[:-1], 0]
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            w = w - self.settings.rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
        return w

    def margin(self, features: np.ndarray) -> np.ndarray:
        return self._inputs(features) @ self.weights

    def score(self, features: np.ndarray) -> np.ndarray:
        return _sigmoid(self.margin(features))


def _feature_table(plain: DataFrame) -> DataFrame:
    """(row, doc_id, x) of a table (doc_id, text): each row's number and features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 32
        for batch in batches:
            data, offsets = ts.utf8(batch.column(1))
            for lo, hi in ts.chunks(offsets):
                x = style_features(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(at, at + len(x))), batch.column(0).slice(lo, hi - lo), pa.array([r.tobytes() for r in x], pa.binary())], names=["row", "doc_id", "x"])
                at += len(x)

    return written(plain.mapInArrow(run, T.StructType([T.StructField("row", T.LongType()), plain.schema["doc_id"], T.StructField("x", T.BinaryType())])))


def _matrix(bodies: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(bodies), np.float32).reshape(-1, FEATURES)


def _sums(table: DataFrame, each) -> np.ndarray:
    """The sum of ``each(rows, features)``, a vector of one length, over all batches of a feature table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                total = total + each(part.column(0).to_numpy(), _matrix(part.column(1).to_pylist()))
        if not np.isscalar(total):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["k", "v"])

    rows = table.select("row", "x").mapInArrow(run, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
    return np.array([r["v"] for r in sorted(rows)])


def _moments(table: DataFrame) -> tuple[np.ndarray, np.ndarray] | None:
    """Mean and deviation of the features over all documents."""
    sums = _sums(table, lambda rows, x: np.r_[len(x), x.sum(axis=0, dtype=np.float64), np.square(x, dtype=np.float64).sum(axis=0)])
    if not len(sums):
        return None
    mean = sums[1 : FEATURES + 1] / sums[0]
    return mean, np.sqrt(np.maximum(sums[FEATURES + 1 :] / sums[0] - mean**2, 0))


def score_quality(docs: DataFrame, labels: DataFrame, learn: Column, settings: PuSettings = PuSettings(), text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Adds ``score`` (0 to 1, higher: rather of quality) and ``predicted`` (int) to every document.

    ``labels`` has ``doc_id`` and ``quality``; ``learn`` says by doc_id which labels may be learned from, and
    of those only positives are read.  The gradient runs over at most ``positives`` of them and ``unlabelled``
    documents, those of least hash of their row; the features' mean and deviation, and the score tails that
    give the class prior, are taken over all documents (those the ranking was learned from apart).  Every
    document is scored by its whole text.  Null and empty texts have all-zero features and their score; null
    ids are not learned from; a document with both labels counts as positive, and of several texts of one id
    that of least features; without positives or documents every score is 0.5.  Rows stand alone, repeated
    ones too; columns named like a result are replaced.  ``carry``: input columns to return, all by default.
    Features, some 600 bytes a document, are written once; nothing is shuffled but the rows learned from.
    """
    spark = docs.sparkSession
    own = kept_columns(docs, carry, ["score", "predicted"])
    table = _feature_table(docs.select("doc_id", named(text).alias("text")))
    trusted = labels.where(learn & (F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    picked = least_hashed(trusted, settings.positives, 17, "doc_id").collect()
    wanted = spark.createDataFrame([(r[0],) for r in picked], T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType)]))
    positive = table.join(F.broadcast(wanted), "doc_id").groupBy("doc_id").agg(F.min("x").alias("x")).orderBy("doc_id").collect()
    unlabelled = least_hashed(table.select("row", "x"), settings.unlabelled, 29, "row").collect() if positive else []
    ranked = np.array([r["row"] for r in unlabelled[::2]], np.int64)

    def tail(model: PuModel, edges: np.ndarray) -> tuple[np.ndarray, int]:
        def above(rows: np.ndarray, x: np.ndarray) -> np.ndarray:
            at = np.sort(model.margin(x)[~np.isin(rows, ranked)])
            return np.r_[len(at) - np.searchsorted(at, edges), len(at)].astype(float)

        sums = _sums(table, above)
        return sums[:-1], int(sums[-1])

    model = PuModel(_matrix([r["x"] for r in positive]), _matrix([r["x"] for r in unlabelled]), settings, _moments(table), tail)
    model = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = ts.utf8(batch.column(len(own)))
            for lo, hi in ts.chunks(offsets):
                score = model.value.score(style_features(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]))
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(len(own))), pa.array(score), pa.array((score >= settings.sure).astype(np.int32))], names=schema.names)

    given = neutral(docs, own, body=text)
    schema = T.StructType([*given.schema.fields[:-1], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return given.mapInArrow(run, schema).toDF(*own, "score", "predicted")
