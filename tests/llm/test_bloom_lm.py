import math
import re
from collections import Counter

import numpy as np
from docs import documents, frame
from pyspark.sql import functions as F

from fringeframe.llm import textscan as ts
from fringeframe.llm.bloom_lm import LmSettings, LogFrequencyFilter, levels, score_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) + [""]


def brute(rows, learn, settings):
    """Scores as a filter that invents nothing gives them."""
    c = Counter(w for r in rows if learn(r) for w in tokens(r[1]))
    n, v = sum(c.values()), len(c)
    scale = n + 0.5 * (v + 1)
    pairs = Counter()
    for r in rows:
        if learn(r):
            t = [""] + tokens(r[1])
            pairs.update(zip(t, t[1:]))
    out = []
    for r in rows:
        t = tokens(r[1])
        base = sum(math.log10((c[w] + 0.5) / scale) for w in t)
        score = 0.0
        for a, b in zip([""] + t, t):
            q = math.floor(math.log(pairs[a, b]) / math.log(settings.log_base) + 1e-9) if pairs[a, b] else None
            c2 = 0.0 if q is None else settings.log_base**q
            score += math.log10((min(c2, c[a]) + settings.mu * (c[b] + 0.5) / scale) / (c[a] + settings.mu))
        out.append((r[0], len(t), sum(c[w] > 0 for w in t), n, round(base, 6), round(score, 6)))
    return sorted(out, key=str)


def scored(spark, rows, settings, learn="doc_id % 3 != 1"):
    got = score_documents(frame(spark, rows), F.expr(learn), settings, carry=["doc_id", "lang"]).collect()
    return sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6)) for r in got), key=str)


def test_matches_brute_force(spark):
    rows = [(i, t * 2, "en", "s") for i, t in enumerate(["a" * 700 + " b c " * 3, "b " + "é" * 50 + " c ", "b c a"])] + documents()
    # Wide entries make false positives of the filter very rare.
    settings = LmSettings(bits_per_entry=120, mu=5.0)
    got, want = scored(spark, rows, settings), brute(rows, lambda r: r[0] is not None and r[0] % 3 != 1, settings)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4:] for g in got], [w[4:] for w in want], atol=1e-5)


def thue_morse(a, b, n):
    return "".join(b if bin(k).count("1") % 2 else a for k in range(n))


def test_words_that_differ_by_a_complement_are_two(spark):
    x, y = thue_morse("a", "b", 2048), thue_morse("b", "a", 2048)
    got = scored(spark, [(0, x, "en", "s"), (1, y, "en", "s")], LmSettings())
    assert [g[2] for g in got] == [2, 1]


def test_empty_tables(spark):
    assert score_documents(frame(spark, []), F.lit(True)).collect() == []
    got = score_documents(frame(spark), F.lit(False)).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and abs(r["base_score"]) < 1e-9 for r in got)


def test_filter_never_forgets_and_seldom_invents():
    rng = np.random.default_rng(2)
    keys = np.unique(ts.mix(rng.integers(0, 1 << 60, 20000).astype(np.uint64)))
    level = levels(rng.integers(0, 5000, len(keys)), 1.5)
    got = LogFrequencyFilter(keys, level, 12).levels(keys)
    assert (got >= level).all() and (got > level).mean() < 0.02
    other = np.setdiff1d(ts.mix(rng.integers(1 << 61, 1 << 62, 20000).astype(np.uint64)), keys)
    assert (LogFrequencyFilter(keys, level, 12).levels(other) > 0).mean() < 0.02


def test_bigrams_seen_once_count_and_the_filter_grows(spark):
    rows = [(0, "a b c", "en", "s"), (1, "d e", "en", "s"), (2, "e d", "en", "s")]
    got = {g[0]: g[5] for g in scored(spark, rows, LmSettings(bits_per_entry=120, mu=5.0), "doc_id < 2")}
    assert got[1] > got[2] + 0.1
    keys = np.arange(1, 100001, dtype=np.uint64)
    small, large = (LogFrequencyFilter(ts.mix(keys[:n]), np.ones(n, np.int64), 12) for n in (1000, 100000))
    assert large.size >= 64 * small.size
