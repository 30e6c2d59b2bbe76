import hashlib
import random

import numpy as np
import pytest
from docs import documents, frame, sentence
from pyspark.sql import functions as F

from fringeframe.llm.bpe import bpe_round_trip, load_word_bpe, tokenizer_file
from fringeframe.llm.shard_shuffle import CommunicationMatrix, _large, draw_counts, shuffle_into_shards


def test_matrix_has_exact_margins_and_one_answer():
    rng = np.random.default_rng(0)
    sources = rng.integers(0, 50, 13)
    targets = np.full(7, sources.sum() // 7)
    targets[: sources.sum() % 7] += 1
    a = CommunicationMatrix(sources, targets, 5)
    rows = np.array([a.row(p) for p in range(13)])
    assert (rows.sum(axis=0) == targets).all() and (rows.sum(axis=1) == sources).all() and (rows >= 0).all()
    again = CommunicationMatrix(sources, targets, 5)
    assert all((again.row(p) == rows[p]).all() for p in (12, 3))


def test_matrix_follows_the_hypergeometric_law():
    sources, targets = np.array([4, 6, 5]), np.array([7, 8])
    draws = np.array([CommunicationMatrix(sources, targets, s).row(0)[0] for s in range(4000)])
    from math import comb

    want = np.array([comb(7, k) * comb(8, 4 - k) / comb(15, 4) for k in range(5)])
    got = np.bincount(draws, minlength=5) / 4000
    assert np.abs(got - want).max() < 0.03


def test_large_populations():
    rng = np.random.default_rng(1)
    small = np.array([_large(rng, 30, 50, 25) for _ in range(4000)])
    exact = rng.hypergeometric(30, 50, 25, 4000)
    assert abs(small.mean() - 25 * 30 / 80) < 0.15 and abs(small.std() - exact.std()) < 0.15
    n = 10**12
    big = np.array([_large(rng, n, 3 * n, 10**9) for _ in range(300)])
    assert abs(big.mean() / 2.5e8 - 1) < 1e-5 and 0.8 < big.std() / np.sqrt(1e9 * 0.25 * 0.75) < 1.2
    counts = draw_counts(rng, np.array([n, n, 5 * n, 0]), 3 * n)
    assert counts.sum() == 3 * n and (counts <= [n, n, 5 * n, 0]).all()


def placed(spark, df, **more):
    got = shuffle_into_shards(df, shards=4, **more).toPandas()
    size = got.groupby("shard").size()
    for s, n in size.items():
        assert sorted(got[got["shard"] == s]["slot"]) == list(range(n))
    assert not len(got) or size.max() - size.reindex(range(4), fill_value=0).min() <= 1
    return got


def test_shards_are_exact_and_carry_every_row(spark, tmp_path):
    path = str(tmp_path / "docs")
    frame(spark).write.parquet(path)
    for source in (spark.read.parquet(path), frame(spark).where("doc_id is null or doc_id <> 2")):
        got = placed(spark, source, chunk_rows=3, block_rows=7)
        want = source.drop("shard").toPandas()
        assert sorted(map(str, got[["doc_id", "text", "lang"]].values.tolist())) == sorted(map(str, want[["doc_id", "text", "lang"]].values.tolist()))


def test_place_depends_on_the_file_only(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.range(5000).select("id", F.lit("x").alias("slot")).coalesce(2).write.parquet(path)
    one = placed(spark, spark.read.parquet(path), block_rows=500, chunk_rows=200).set_index("id")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    two = placed(spark, spark.read.parquet(path), block_rows=500, chunk_rows=200).set_index("id")
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert one.sort_index().equals(two.sort_index())
    other = placed(spark, spark.read.parquet(path), block_rows=500, chunk_rows=200, seed=18).set_index("id").sort_index()
    one = one.sort_index()
    assert abs((one["shard"] == other["shard"]).mean() - 0.25) < 0.03
    # Neighbours of the input are no neighbours of the output.
    assert abs(np.corrcoef(one.index, one["slot"])[0, 1]) < 0.06


def test_empty_table(spark):
    assert len(placed(spark, frame(spark, []))) == 0


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    public = pytest.importorskip("public_tokenizers")
    t = tokenizers.Tokenizer.from_file(str(public.path("word_bpe_49k.json")))
    t.no_truncation()
    t.no_padding()
    return t


def test_round_trip_equals_the_library(spark, library):
    rng = random.Random(3)
    letters = "aabbeinthoslé ’'1.!-Σς日本İﬁ😀e\u0301\t\n\x1c\x85 \u3000ÅǅK𞤀\u1c89"
    rows = documents() + [(1000 + i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 80))), "x", "y") for i in range(300)]
    rows += [(2000, "x<|endoftext|>Y <|startoftext|>", "", ""), (2001, "DON'T we'LL 's", "", ""), (2002, "a" * 3000, "", ""), (2003, "the " * 2000, "", "")]
    got = {}
    for r in bpe_round_trip(frame(spark, rows), tokenizer_file(spark), cache_bytes=50000).collect():
        got.setdefault((r["doc_id"], r["text"]), r)
    digests = {(r["doc_id"], r["text"]): r for r in bpe_round_trip(frame(spark, rows), tokenizer_file(spark), digests=True).collect()}
    for doc_id, text, _, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        r, d = got[doc_id, text], digests[doc_id, text]
        assert r["ids"] == ids and r["n_tokens"] == len(ids) == d["n_tokens"], text
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r["decoded"] == decoded and r["shard"] is not None or doc_id is None
        assert d["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert d["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_compatible_pairs_are_those_that_merging_leaves_alone(library):
    import public_tokenizers

    bpe = load_word_bpe(public_tokenizers.path("word_bpe_49k.json"))
    rng = np.random.default_rng(0)
    inner = np.array([i for s, i in bpe.vocab.items() if not s.endswith("</w>")])
    a, b = rng.choice(inner, 4000), rng.choice(len(bpe.vocab), 4000)
    got = bpe.compatible(a, b)
    want = [bpe.merge(bpe._units(bpe.text[x]) + bpe._units(bpe.text[y])) == [x, y] for x, y in zip(a, b)]
    assert got.tolist() == want and 0 < sum(want) < 4000


def test_speculation_is_often_right(library):
    import public_tokenizers

    bpe = load_word_bpe(public_tokenizers.path("word_bpe_49k.json"))
    words = "the quick brown fox jumps over the lazy dog while several people watched from across street".split()
    proposed = [bpe.propose(w) for w in words]
    exact = bpe.encode_words(words)
    assert sum(p == e for p, e in zip(proposed, exact)) >= len(words) * 0.8


def test_empty_texts(spark, library):
    assert bpe_round_trip(frame(spark, []), tokenizer_file(spark)).collect() == []
    assert sentence(random.Random(0), 0) == ""
