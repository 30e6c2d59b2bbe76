"""Small fixtures with every awkward case: nulls, empty and long texts, ties, repeats, clashing columns."""

import random

SYLLABLES = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "é", "ß", "日"]


def word(rng):
    return "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))


def sentence(rng, n):
    return " ".join(word(rng) for _ in range(n))


def documents(n=60, seed=1):
    """Rows (doc_id, text, lang, shard) with copies, near copies and shared passages."""
    rng = random.Random(seed)
    passage = sentence(rng, 30)
    texts = [sentence(rng, rng.choice([1, 3, 20, 60, 150])) for _ in range(n)]
    texts[3] = texts[4] = texts[5]
    texts[7] = sentence(rng, 40) + "\n" + passage + "\t" + sentence(rng, 10)
    texts[8] = passage + " " + passage
    texts[9] = texts[20] + " extra"
    texts[10], texts[11], texts[12] = "", " \n\t ", None
    texts[13] = "a " * 500
    texts[14] = sentence(rng, 4000)
    texts[15] = "A\x0bB\x0cC\rD é F \x1f x"
    rows = [(i, t, "en", "clash") for i, t in enumerate(texts)]
    rows += [(5, texts[5], "en", "clash"), (None, texts[6], None, None), (None, texts[6], None, None), (16, "another text of a repeated id", "en", "clash")]
    return rows


def frame(spark, rows=None, parts=3):
    rows = documents() if rows is None else rows
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, shard string").repartition(parts)
