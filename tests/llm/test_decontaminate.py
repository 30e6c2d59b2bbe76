import random

from docs import frame, sentence

from fringeframe.llm.decontaminate import find_benchmark_passages

BLANK = " \t\n\r\x0b\x0c"


def plain(text):
    text = "".join(" " if c in BLANK else c.lower() if len(c.lower()) == 1 else c for c in text or "")
    while "  " in text:
        text = text.replace("  ", " ")
    return text


def fewest_edits(item, text):
    """Sellers' algorithm: edits of the whole item against any substring."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def brute(rows, items, q=8, rate=0.1, least=40):
    out = []
    for r in rows:
        for k, t in items:
            n = plain((t or "").strip(BLANK))
            e = min(int(rate * len(n)), max(0, (len(n) - q) // q)) if len(n) >= least else 0
            if t is not None and len(n) >= q and (got := fewest_edits(n, plain(r[1]))) <= e:
                out.append((r[0], k, got))
    return sorted(out, key=str)


def edited(rng, text, n):
    chars = list(text)
    for _ in range(n):
        k = rng.randrange(len(chars))
        chars[k : k + 1] = rng.choice([[], [chars[k], "x"], ["z"]])
    return "".join(chars)


def case():
    rng = random.Random(5)
    items = [(k, sentence(rng, rng.choice([9, 15, 30]))) for k in range(8)] + [(8, None), (9, "short"), (10, "A B\n c " * 20)]
    items.append((11, items[2][1]))
    rows = [(i, sentence(rng, rng.choice([0, 5, 40])), "en", "x") for i in range(10)] + [(None, None, None, None), (10, "", "en", "x")]
    for i in range(11, 35):
        t = items[i % 8][1]
        rows.append((i, sentence(rng, rng.randint(0, 30)) + rng.choice(["", " ", "\n\n"]) + edited(rng, t.upper() if i % 3 else t, rng.randint(0, len(t) // 8)) + sentence(rng, rng.randint(0, 9)), "en", "x"))
    rows.append((35, " ".join(t for _, t in items[:4]), "en", "x"))
    rows += [rows[-1], (36, "a b c " * 100, "en", "x")]
    return rows, items


def test_matches_brute_force(spark):
    rows, items = case()
    want = brute(rows, items)
    assert len(want) > 15
    for block in (1 << 20, 200):
        got = find_benchmark_passages(frame(spark, rows), spark.createDataFrame(items, "item_id int, text string"), block_chars=block).collect()
        assert sorted(((r["doc_id"], r["item_id"], r["edits"]) for r in got), key=str) == want


def test_reported_span_has_the_reported_edits(spark):
    rows, items = case()
    texts = {r[0]: plain(r[1]) for r in rows}
    names = dict(items)
    for r in find_benchmark_passages(frame(spark, rows), spark.createDataFrame(items, "item_id int, text string")).collect():
        piece = texts[r["doc_id"]][r["start"] : r["end"]]
        assert fewest_edits(plain(names[r["item_id"]].strip(BLANK)), piece) == r["edits"]


def test_empty_sides(spark):
    items = spark.createDataFrame([(1, "x" * 60)], "item_id int, text string")
    assert find_benchmark_passages(frame(spark, []), items).collect() == []
    assert find_benchmark_passages(frame(spark), items.limit(0)).collect() == []
