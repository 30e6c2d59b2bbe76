"""Clashing names of columns, sequences that cheap hashes confuse, long words and texts, for every operator."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest
from docs import documents, frame, sentence
from pyspark.sql import functions as F

from fringeframe.llm import textscan as ts
from fringeframe.llm.bloom_lm import score_documents
from fringeframe.llm.bpe import bpe_round_trip, load_word_bpe
from fringeframe.llm.decontaminate import find_benchmark_passages
from fringeframe.llm.host_reputation import judge_hosts
from fringeframe.llm.pu_quality import FEATURES, score_quality, style_features
from fringeframe.llm.repetition import judge_repetition
from fringeframe.llm.shard_shuffle import shuffle_into_shards
from fringeframe.llm.simhash import simhash_groups
from fringeframe.llm.storage import _WRITTEN, scratch, written
from fringeframe.llm.toxic_neighbours import score_toxicity
from fringeframe.llm.window_dedup import remove_repeated_windows

CLASHES = ["c0", "body", "ident", "Block", "first_slot__", "text__", "chunk", "begin", "file", "at", "k0", "x0", "a.b", "lm_text", "cid", "row"]
REPLACED = ["fingerPRINT", "Component_id", "SLOT", "Shard", "Score", "N_words", "kept", "N_removed", "n_tokens", "predicted"]


def thue_morse(a, b, n):
    return "".join(b if bin(k).count("1") % 2 else a for k in range(n))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, k % 2, int(k % 3 == 0)) for k in range(40)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def clashing(spark):
    docs = frame(spark).drop("shard")
    for c in CLASHES + REPLACED:
        docs = docs.withColumn(c, F.lit(f"value of {c}"))
    return docs


def operators(spark, labels):
    yield judge_repetition
    yield shuffle_into_shards
    yield lambda d: score_toxicity(d, labels, F.lit(True))
    yield lambda d: score_quality(d, labels, F.lit(True))
    yield lambda d: simhash_groups(d, carry=d.columns)
    yield remove_repeated_windows
    yield lambda d: score_documents(d, F.lit(True))
    public = pytest.importorskip("public_tokenizers")
    yield lambda d: bpe_round_trip(d, str(public.path("word_bpe_49k.json")), digests=True)


def test_names_that_clash_are_carried(spark, labels, clashing):
    for run in operators(spark, labels):
        out = run(clashing)
        assert len({c.lower() for c in out.columns}) == len(out.columns)
        rows = out.collect()
        assert len(rows) == len(documents())
        assert all(r[c] == f"value of {c}" for r in rows for c in CLASHES)


def test_clashing_columns_beside_benchmark_and_pages(spark, clashing):
    items = spark.createDataFrame([(1, "b" * 50, 2)], "item_id int, text string, doc_text int")
    assert find_benchmark_passages(clashing.withColumn("doc_text", F.lit(1)), items).columns == ["doc_id", "item_id", "start", "end", "edits"]
    pages = spark.createDataFrame([(1, "http://a.org/x", "n", "g")], "page_id int, url string, n string, Verdict string")
    outcomes = spark.createDataFrame([(1, 1)], "page_id int, good int")
    row = judge_hosts(pages.withColumns({"good": F.lit("x"), "suffix": F.lit("s"), "domain_rate": F.lit("d")}), outcomes).collect()[0]
    assert (row["n"], row["good"], row["suffix"], row["domain_rate"], row["verdict"]) == ("n", "x", "s", "d", "allow")


def test_complementary_sequences_are_told_apart(spark):
    """Polynomials modulo 2**64 cannot."""
    x, y = thue_morse("a", "b", 4096), thue_morse("b", "a", 4096)
    one = judge_repetition(frame(spark, [(1, f"x {x} W p q r x {y} W", "en", "s")])).collect()[0]
    assert one["n_repeat_words"] == 0
    lead = " ".join(f"w{k}" for k in range(19))
    got = {r["doc_id"]: r["n_removed"] for r in remove_repeated_windows(frame(spark, [(1, f"{lead} {x}", "en", "s"), (2, f"{lead} {y}", "en", "s"), (3, f"{lead} {x}", "en", "s")])).collect()}
    assert got == {1: 0, 2: 0, 3: 20}
    words = [thue_morse(f"u{k}", f"v{k}", 1024) for k in range(2)]
    hashes = ts.span_hashes(*_spans(words + [thue_morse("v0", "u0", 1024)]))
    assert len(set(hashes.tolist())) == 3


def _spans(words):
    data, offsets = ts.utf8(pa.array(words))
    return data, offsets[:-1], offsets[1:]


def test_hashes_depend_on_bytes_alone():
    rng = random.Random(1)
    words = ["".join(rng.choice("abé日") for _ in range(n)) for n in [1, 2, 3, 7, 8, 9, 15, 16, 17, 63, 64, 65, 255, 256, 300, 1000] * 20]
    data, starts, ends = _spans(words)
    together = ts.span_hashes(data, starts, ends)
    alone = [int(ts.span_hashes(*_spans([w]))[0]) for w in words]
    assert together.tolist() == alone and len(set(alone)) == len(set(words))
    assert set(ts.span_hashes(data, starts, ends, 1).tolist()).isdisjoint(alone)


def test_spans_across_pieces(monkeypatch):
    monkeypatch.setattr(ts, "_PIECE", 7)
    texts = [r[1] or "" for r in documents()]
    data, offsets = ts.utf8(pa.array(texts))
    starts, ends, first = ts.spans(data, offsets)
    got = [data[a:b].tobytes() for a, b in zip(starts, ends)]
    want = [t.encode().split() for t in texts]
    assert got == [w for ws in want for w in ws] and np.diff(first).tolist() == [len(w) for w in want]


def test_features_across_pieces(monkeypatch):
    data, offsets = ts.utf8(pa.array([r[1] or "" for r in documents()]))
    whole = style_features(data, offsets)
    monkeypatch.setattr(ts, "CHUNK_BYTES", 13)
    assert whole.shape[1] == FEATURES and np.allclose(style_features(data, offsets), whole)


def test_long_words_merge_in_time():
    public = pytest.importorskip("public_tokenizers")
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(str(public.path("word_bpe_49k.json")))
    bpe = load_word_bpe(str(public.path("word_bpe_49k.json")))
    rng = random.Random(3)
    for letters in ("ab", "日本語", "abcdefghijklmnopqrstuvwxyz"):
        word = "".join(rng.choice(letters) for _ in range(40_000))
        began = time.process_time()
        got = bpe.encode_chunks([word])[0]
        assert time.process_time() - began < 5
        assert got == library.encode(word, add_special_tokens=False).ids


def test_a_long_text_among_short_ones(spark, labels):
    rng = random.Random(9)
    long = sentence(rng, 200_000)
    rows = [(1, long, "en", "s"), (2, "short", "en", "s"), (3, long, "en", "s"), (4, sentence(rng, 100), "en", "s")]
    docs = frame(spark, rows)
    got = {r["doc_id"]: r for r in remove_repeated_windows(docs, carry=["doc_id"], digests=True).collect()}
    assert got[3]["n_removed"] == got[3]["n_words"] == 200_000 and got[1]["n_removed"] == got[4]["n_removed"] == 0
    assert [r["n_words"] for r in judge_repetition(docs, carry=["doc_id"]).orderBy("doc_id").collect()] == [200_000, 1, 200_000, 100]
    assert len({r["fingerprint"] for r in simhash_groups(docs).collect() if r["doc_id"] in (1, 3)}) == 1
    scored = {r["doc_id"]: r for r in score_documents(docs, F.lit(True), carry=["doc_id"]).collect()}
    assert scored[1]["n_tokens"] == 200_001 and scored[1]["score"] == scored[3]["score"]
    assert score_toxicity(docs, labels, F.lit(True), carry=["doc_id"]).count() == 4
    items = spark.createDataFrame([(1, long[50_000:50_300])], "item_id int, text string")
    assert sorted(r["doc_id"] for r in find_benchmark_passages(docs, items).collect()) == [1, 3]


def test_one_long_item_leaves_the_others_cheap(spark):
    rng = random.Random(10)
    items = [(k, sentence(rng, 20)) for k in range(300)] + [(999, sentence(rng, 4000))]
    rows = [(1, sentence(rng, 30) + " " + items[7][1], "en", "s"), (2, items[-1][1].replace("th", "ht", 3), "en", "s"), (3, "x " + items[3][1][:20] + " y", "en", "s")]
    got = find_benchmark_passages(frame(spark, rows), spark.createDataFrame([*items, (500, items[3][1][:20])], "item_id int, text string")).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(1, 7), (2, 999), (3, 500)]


def test_scratch_removes_what_was_written(spark):
    tables = {t.name for t in spark.catalog.listTables()}
    with scratch(spark):
        table = written(spark.range(5).toDF("x"))
        path = table.inputFiles()[0]
        assert remove_repeated_windows(frame(spark)).count() == len(documents())
    assert not _WRITTEN or all(path not in name for _, name in _WRITTEN)
    with pytest.raises(Exception):
        spark.read.parquet(path.rsplit("/", 1)[0]).count()
    assert {t.name for t in spark.catalog.listTables()} == tables


def test_repeated_ids_give_one_answer(spark, labels):
    rows = documents() + [(3, sentence(random.Random(k), 50), "en", "s") for k in range(5)]
    for run in (score_toxicity, score_quality):
        one, two = ({(r["doc_id"], r["text"]): r["score"] for r in run(frame(spark, rows, parts), labels, F.lit(True)).collect()} for parts in (1, 4))
        if run is score_toxicity:
            assert one == two
        assert len(one) == len(two)
