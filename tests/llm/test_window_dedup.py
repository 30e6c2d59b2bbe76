import re

from docs import documents, frame

from fringeframe.llm import window_dedup
from fringeframe.llm.window_dedup import remove_repeated_windows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, width):
    seen, out = set(), []
    for _, row in sorted(enumerate(rows), key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[1][1] is not None, (x[1][1] or "").encode())):
        words = WORD.findall(row[1] or "")
        gone = set()
        for i in range(len(words) - width + 1):
            w = tuple(words[i : i + width])
            if w in seen:
                gone |= set(range(i, i + width))
            seen.add(w)
        out.append((row[0], len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(map(str, out))


def run(spark, rows, **more):
    got = remove_repeated_windows(frame(spark, rows), carry=["doc_id", "shard"], **more)
    return sorted(str((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"])) for r in got.collect())


def test_matches_brute_force(spark):
    rows = documents()
    # Equal rows of one id, and of null ids: text order decides, and one of equal rows keeps its words.
    assert run(spark, rows, width=20, block_bytes=9000) == plain(rows, 20)
    assert run(spark, rows, width=3, block_bytes=3000, digests_per_slice=100, cells_per_window=1) == plain(rows, 3)


def test_sketch_of_any_width_loses_nothing(spark):
    rows = documents(40, 7)
    assert run(spark, rows, width=5, depth=1, block_bytes=5000) == plain(rows, 5)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_each_pass_lets_go_of_its_shuffles(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(window_dedup, "free_shuffles", asked.append)
    remove_repeated_windows(frame(spark, documents()), block_bytes=9000)
    assert len(asked) == 3
