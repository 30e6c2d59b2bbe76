import random

import corpus_pipeline
import numpy as np
from docs import documents, sentence

from fringeframe.llm import near_copies
from fringeframe.llm.near_copies import near_copy_groups, row_keys


def plain_set(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ")
    words = [w for w in words if w]
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def plain_groups(texts):
    sets, label = [plain_set(t) for t in texts], list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or 9 * len(a & b) >= 4 * (len(a) + len(b)) and a & b:
                x, y = label[i], label[j]
                label = [min(x, y) if k in (x, y) else k for k in label]
    return label


def changed(rng, text, n):
    words = text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = sentence(rng, 1) + "x"
    return " ".join(words)


def texts():
    rng = random.Random(4)
    out = [r[1] for r in documents()]
    line = sentence(rng, 12)
    for n in (12, 40, 100, 300):
        base = sentence(rng, n)
        out += [base, base + " end", line + " " + base] + [changed(rng, base, k) for k in (1, 1, 2, 3, 4, 6, 8) for _ in range(3)]
    chain = sentence(rng, 100)
    for _ in range(8):
        out.append(chain)
        chain = changed(rng, chain, 2)
    return out


def test_groups_match_brute_force(spark):
    every = texts()
    rows = spark.createDataFrame(list(enumerate(every)), "row_key long, text string").repartition(3)
    got = [r[1] for r in sorted(near_copy_groups(rows).collect())]
    want = plain_groups(every)
    assert len(got) == len(every)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_a_large_group_of_near_copies_makes_few_pairs(spark, monkeypatch):
    """Copies of one text that is not among them, most of them too far from each other to be linked."""
    rng = random.Random(12)
    base = sentence(rng, 150)
    every = [changed(rng, base, rng.choice([1, 2, 3, 3, 4])) for _ in range(400)]
    compared, alike = [], near_copies._alike

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return alike(pairs, *rest)

    monkeypatch.setattr(near_copies, "_alike", counted)
    rows = spark.createDataFrame(list(enumerate(every)), "row_key long, text string").repartition(3)
    got = [r[1] for r in sorted(near_copy_groups(rows).collect())]
    want = plain_groups(every)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want)) > 5
    assert sum(compared) < 40 * len(every)


def test_parities_differ_by_no_more_than_the_sets():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    sets = [np.unique(rng.choice(pool, rng.integers(1, 250))) for _ in range(40)]
    got = near_copies._parities(np.repeat(np.arange(40), [len(x) for x in sets]), np.concatenate(sets)).view(np.uint64)
    apart = [(int(np.bitwise_count(got[i] ^ got[j]).sum()), len(np.setxor1d(sets[i], sets[j]))) for i in range(40) for j in range(40)]
    assert all(p <= d and (d - p) % 2 == 0 for p, d in apart) and any(p > 60 for p, d in apart)


def table(spark, path, rows):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(2).write.parquet(path)
    return spark.read.parquet(path)


def test_stage_joins_rows_of_close_fingerprints(spark, tmp_path):
    """Texts of one line over and over, with other ends: alike in all but some of their shingles, but not as sets."""
    rng = random.Random(9)
    line, other = sentence(rng, 9), sentence(rng, 120)
    a, b = (" ".join([line] * 200 + [sentence(rng, 20)]) for _ in range(2))
    assert 9 * len(plain_set(a) & plain_set(b)) < 4 * (len(plain_set(a)) + len(plain_set(b)))
    docs = table(spark, f"{tmp_path}/a", [(41, a, "en", "s", 1), (42, b, "en", "s", 1), (43, b + " end", "en", "s", 1), (44, other, "en", "s", 1), (45, " \n", "en", "s", 1), (46, None, "en", "s", 1)])
    assert sorted(r[0] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == [41, 44, 45]


def test_joined_rows_join_what_is_similar_to_either(spark):
    rng = random.Random(10)
    a, b, c = (sentence(rng, 80) for _ in range(3))
    rows = spark.createDataFrame([(1, a), (2, a + " end"), (3, b), (4, b + " end"), (5, c)], "row_key long, text string")
    joined = spark.createDataFrame([(4, 2)], "row_key long, other long")
    assert sorted(tuple(r) for r in near_copy_groups(rows, joined=joined).collect()) == [(1, 1), (2, 1), (3, 1), (4, 1), (5, 5)]


def test_stage_drops_a_copy_one_word_longer(spark, tmp_path):
    rng = random.Random(6)
    base, other = sentence(rng, 120), sentence(rng, 120)
    docs = table(spark, f"{tmp_path}/a", [(41, base, "en", "s", 1), (42, base + " end", "en", "s", 1), (43, changed(rng, base, 1), "en", "s", 1), (44, other, "en", "s", 1)])
    assert sorted(r[0] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == [41, 44]


def test_stage_on_null_and_repeated_ids(spark, tmp_path):
    rng = random.Random(7)
    a, b, c = (sentence(rng, 80) for _ in range(3))
    docs = table(spark, f"{tmp_path}/a", [(1, a, "en", "s", 1), (1, b, "en", "s", 1), (None, c, "en", "s", 1), (None, c + " end", "en", "s", 1), (None, c, "en", "s", 1)])
    got = corpus_pipeline.near_dedup(spark, docs, "").collect()
    assert sorted(r["text"] for r in got if r["doc_id"] == 1) == sorted([a, b])
    assert len([r for r in got if r["doc_id"] is None]) == 1
    assert row_keys(docs).select("row_key").distinct().count() == 5


def test_empty_table(spark, tmp_path):
    assert corpus_pipeline.near_dedup(spark, table(spark, f"{tmp_path}/a", []), "").collect() == []


def test_decontamination_on_null_and_repeated_ids(spark, tmp_path):
    rng = random.Random(8)
    item, a, b, c = (sentence(rng, 60) for _ in range(4))
    spark.createDataFrame([(1, item)], "item_id int, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = table(spark, f"{tmp_path}/a", [(1, a, "en", "s", 1), (1, b + " " + item, "en", "s", 1), (None, item + " " + c, "en", "s", 1), (None, c, "en", "s", 1)])
    got = corpus_pipeline.decontaminate(spark, docs, str(tmp_path)).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in got) == sorted([("1", a), ("None", c)])
