import numpy as np
import pytest
from docs import documents, frame, sentence
from pyspark.sql import functions as F

from fringeframe.llm.pu_quality import FEATURES, PuModel, PuSettings, estimate_prior, score_quality
from fringeframe.llm.toxic_neighbours import BlockMaxIndex, NeighbourSettings, isotonic, score_toxicity, unit_weights, votes

import random


def sparse(rng, rows, terms, most):
    doc, term = [], []
    for d in range(rows):
        mine = sorted(rng.choice(terms, rng.integers(0, most), replace=False).tolist())
        doc += [d] * len(mine)
        term += mine
    return np.array(doc, np.int64), np.array(term, np.int64), rng.integers(1, 5, len(doc))


@pytest.mark.parametrize("block", [1, 7, 64])
def test_block_max_search_is_exact(block):
    rng = np.random.default_rng(block)
    idf = rng.uniform(0.1, 4, 50)
    d, t, c = sparse(rng, 300, 50, 8)
    w = unit_weights(d, t, c, idf, 300)
    index = BlockMaxIndex(d, t, w, 300, 50, block)
    dense = np.zeros((300, 50))
    dense[d, t] = w
    qd, qt, qc = sparse(rng, 90, 50, 6)
    qw = unit_weights(qd, qt, qc, idf, 90)
    query = np.zeros((90, 50))
    query[qd, qt] = qw
    cosine, who, scored = index.nearest(qd, qt, qw, 90, 10)
    true = np.round(query @ dense.T, 12)
    want = -np.sort(-true, axis=1)[:, :10]
    assert np.allclose(cosine, want)
    for q in range(90):
        for x, k in zip(cosine[q], who[q]):
            assert (k == -1) == (x <= 0) and (k < 0 or abs(true[q, k] - x) < 1e-9)
    if block == 7:
        assert scored < 90 * index.blocks / 2
    again, others, _ = index.nearest(d, t, w, 300, 3, np.arange(300))
    assert all(k not in row for k, row in enumerate(others.tolist()))
    left = np.round(dense @ dense.T, 12)
    np.fill_diagonal(left, 0)
    assert np.allclose(again, -np.sort(-left, axis=1)[:, :3])


def test_isotonic_is_the_least_squares_monotone_fit():
    x, y = isotonic(np.array([1.0, 2, 2, 3, 4]), np.array([0.0, 1, 0, 0, 1]), np.ones(5))
    assert x.tolist() == [1, 2, 3, 4] and np.allclose(y, [0, 1 / 3, 1 / 3, 1])


def test_votes_weigh_near_neighbours_more():
    v = votes(np.array([[1.0, 0.5], [0.5, 0.0]]), np.array([[0, 1], [1, -1]]), np.array([1, 0]))
    assert v[0] > 0.9 and v[1] == 0


def corpus(n=600):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        text = sentence(rng, rng.randint(20, 60))
        toxic, good = i % 4 == 0, i % 5 != 0
        if toxic:
            text += " " + rng.choice(["idiot", "scum", "moron"]) + ". " + sentence(rng, 5)
        if not good:
            text = " ".join(w.upper() + "!!! ***" for w in text.split())
        rows.append((i, text, "en", "x"))
        labels.append((i, int(toxic), int(good)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = corpus()
    extra = documents()
    learned = spark.createDataFrame(labels + [(None, 1, 1), (1, None, None)], "doc_id int, toxic int, quality int")
    docs = frame(spark, rows + [(10_000 + k, r[1], r[2], r[3]) for k, r in enumerate(extra)])
    got = {r["doc_id"]: r for r in score_toxicity(docs, learned, F.col("doc_id") % 3 != 1, carry=["doc_id", "shard"]).collect()}
    assert len(got) == len(rows) + len(extra)
    held = [(got[i]["predicted"], t) for i, t, _ in labels if i % 3 == 1]
    assert sum(p == t for p, t in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got.values())
    assert all(n["doc_id"] % 3 != 1 for r in got.values() for n in r["neighbours"])
    assert got[10_010]["neighbours"] == [] and got[10_012]["score"] == got[10_011]["score"]


def test_evidence_holds_every_voter(spark):
    rows, labels = corpus()
    learned = spark.createDataFrame(labels, "doc_id int, toxic int, quality int")
    got = score_toxicity(frame(spark, rows), learned, F.col("doc_id") % 3 != 1, carry=["doc_id"]).collect()
    assert max(len(r["neighbours"]) for r in got) == NeighbourSettings().k
    weigh = lambda n: 1 / (1.05 - min(n["similarity"], 1))
    vote = np.array([sum(weigh(n) * n["toxic"] for n in r["neighbours"]) / max(sum(map(weigh, r["neighbours"])), 1e-300) for r in got])
    assert (np.diff(np.array([r["score"] for r in got])[np.argsort(vote)]) >= -1e-9).all()


def test_toxicity_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = score_toxicity(frame(spark), none, F.lit(True)).collect()
    assert len(got) == len(documents()) and len({r["score"] for r in got}) == 1
    assert score_toxicity(frame(spark, []), none, F.lit(True)).collect() == []


def test_quality_on_held_out_rows(spark):
    rows, labels = corpus()
    learned = spark.createDataFrame(labels + [(None, 1, 1), (1, None, None)], "doc_id int, toxic int, quality int")
    settings = PuSettings(steps=200)
    got = {r["doc_id"]: r for r in score_quality(frame(spark, rows + documents()[10:13]), learned, F.col("doc_id") % 5 != 1, settings).collect() if r["doc_id"] not in (10, 11, 12)}
    held = [(got[i]["predicted"], q) for i, _, q in labels if i % 5 == 1 and i in got]
    both = [(got[i]["predicted"], q) for i, _, q in labels if i in got]
    assert sum(p == q for p, q in held) >= 0.97 * len(held)
    assert sum(p == q for p, q in both) >= 0.97 * len(both)


def test_quality_without_positives_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = score_quality(frame(spark), none, F.lit(True)).collect()
    assert len(got) == len(documents()) and {r["score"] for r in got} == {0.5}
    assert score_quality(frame(spark, []), none, F.lit(True)).collect() == []


def test_prior_and_non_negative_risk():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(0, 1, (3000, FEATURES)), rng.normal(0, 1, (900, FEATURES))
    bad[:, 0] += 6
    unlabelled = np.concatenate([good[1000:], bad])
    model = PuModel(good[:1000], unlabelled, PuSettings())
    assert abs(model.prior - 2000 / 2900) < 0.08
    assert (model.score(good) >= 0.3).mean() > 0.97
    assert (model.score(good)[None, ::10] > model.score(bad)[:, None]).mean() > 0.9
    assert estimate_prior(np.zeros(0), np.zeros(3)) == 0.5
