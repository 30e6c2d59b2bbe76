"""Every stage of the pipeline against its own input, held against brute force."""

import random

import pytest
from docs import sentence

corpus_pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    pytest.importorskip("public_tokenizers")
    rng = random.Random(11)
    path = str(tmp_path_factory.mktemp("tables"))
    passage, item = sentence(rng, 60), sentence(rng, 40)
    texts = {i: sentence(rng, rng.randint(60, 200)) for i in range(300)}
    for i in range(0, 300, 10):
        texts[i] = " ".join(w.upper() + "!!! %%%" for w in texts[i].split())
    texts[41], texts[42] = texts[43], texts[43] + " end"
    texts[51] = texts[51] + " " + passage
    texts[52] = passage + "\n" + texts[52]
    texts[61] += "\n" + item.upper()
    rows = [(i, t, "en", "src", len(t)) for i, t in texts.items()] + [(400, "", "en", "src", 0), (401, None, "en", "src", None), (None, texts[99] + " q", None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 10 != 0), 0) for i in range(300) if i % 2 or i % 10 == 0], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id int, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, texts, passage


def test_stages(spark, folder, tmp_path):
    path, texts, passage = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    before = docs
    kept = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, before, path)
        if k < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        before = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append({r["doc_id"]: r for r in before.collect()})
    bad = set(range(0, 300, 10))
    assert not bad & set(kept[0]) and len(set(texts) - bad - set(kept[0])) <= 2
    assert 41 in kept[1] and 43 not in kept[1] and set(kept[0]) - set(kept[1]) <= {42, 43, 401}
    assert kept[2][51]["text"] == texts[51] and passage not in kept[2][52]["text"] and kept[2][52]["n_chars"] == len(kept[2][52]["text"])
    assert set(kept[2]) - set(kept[3]) == {61} and None in kept[3]
    assert set(kept[4]) == set(kept[3]) and all(r["n_tokens"] > 0 or not (kept[3][i]["text"] or "") for i, r in kept[4].items())


def test_run(spark, folder):
    path, _, _ = folder
    assert corpus_pipeline.run(spark, path).count() > 200


def test_stages_on_empty_tables_and_clashing_columns(spark, folder, tmp_path):
    path, texts, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    clash = docs.selectExpr("*", "'x' AS row_key", "1 AS n_words", "0.5 AS score", "'y' AS component", "doc_id AS node")
    clash.union(clash.where("doc_id = 7").withColumn("text", clash["text"])).write.parquet(f"{tmp_path}/clash")
    docs.limit(0).write.parquet(f"{tmp_path}/none")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        assert stage(spark, spark.read.parquet(f"{tmp_path}/none"), path).collect() == [], name
        out = stage(spark, spark.read.parquet(f"{tmp_path}/clash"), path)
        assert k == 4 or out.columns == docs.columns, name
        ids = [r["doc_id"] for r in out.select("doc_id").collect()]
        # A repeated row is a row of its own, but for the stage that drops copies, and the one that empties them.
        assert ids.count(7) == (1 if k in (1, 2) else 2) and len(set(ids)) > 200, name
