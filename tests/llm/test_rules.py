import re
from collections import Counter

import numpy as np
from docs import documents, frame

from fringeframe.llm.host_reputation import UrlRule, judge_hosts
from fringeframe.llm.repetition import RepetitionRule, judge_repetition, longest_repeats, neighbour_lcp, suffix_array

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_longest(ids):
    n = len(ids)
    out = []
    for i in range(n):
        best = 0
        for j in range(n):
            k = 0
            while i != j and max(i, j) + k < n and ids[i + k] == ids[j + k]:
                k += 1
            best = max(best, k)
        out.append(best)
    return out


def test_suffix_array_and_lcp():
    rng = np.random.default_rng(0)
    for n, kinds in ((1, 1), (2, 1), (40, 1), (60, 2), (80, 4), (50, 50)):
        ids = rng.integers(0, kinds, n)
        array, levels = suffix_array(ids)
        assert array.tolist() == sorted(range(n), key=lambda i: ids[i:].tolist())
        lcp = neighbour_lcp(array, levels)
        for p in range(n - 1):
            a, b = ids[array[p] :], ids[array[p + 1] :]
            k = 0
            while k < min(len(a), len(b)) and a[k] == b[k]:
                k += 1
            assert lcp[p] == k
        assert longest_repeats(ids).tolist() == brute_longest(ids.tolist())
    assert longest_repeats(np.zeros(0, np.int64)).tolist() == []


def windows(words, k):
    seen = Counter(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    gone = {p for i in range(len(words) - k + 1) if seen[tuple(words[i : i + k])] > 1 for p in range(i, i + k)}
    return len(gone)


def test_counts_and_verdicts_match_brute_force(spark):
    rule = RepetitionRule(min_words=4, max_percent=30, max_longest=12, base_words=10)
    rows = documents()
    want = []
    for r in rows:
        text = r[1] or ""
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        repeat, covered = windows(words, 3), windows(words, 4)
        longest = max(brute_longest(words), default=0) if len(words) < 700 else (499 if set(words) == {"a"} else None)
        failed = len(words) < 10 or 100 * repeat > 50 * len(words)
        kept = None if longest is None else not failed and 100 * covered <= 30 * len(words) and longest <= 12
        want.append((r[0], len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeat, covered, longest, failed, kept))
    got = judge_repetition(frame(spark), rule).collect()
    assert set(got[0].asDict()) >= {"shard", "lang", "text"}
    key = lambda x: tuple(map(str, x[:7]))
    have = sorted(((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["n_covered_words"], r["longest_repeat"], r["base_failed"], r["kept"]) for r in got), key=key)
    for h, w in zip(have, sorted(want, key=key), strict=True):
        assert all(b is None and k in (7, 9) or a == b for k, (a, b) in enumerate(zip(h, w))), (h, w)


def test_empty_tables(spark):
    assert judge_repetition(frame(spark, [])).collect() == []


RULES = (UrlRule("block", "net", "/"), UrlRule("allow", "example.net", "/en/"), UrlRule("block", "b.co.uk", "/x"))


def judged(spark, pages, outcomes, **more):
    p = spark.createDataFrame(pages, "page_id long, url string, html string, rule int")
    o = spark.createDataFrame(outcomes, "page_id long, good int")
    return {(r["page_id"], r["url"]): r for r in judge_hosts(p, o, RULES, **more).collect()}


def test_url_parts_and_rules(spark):
    urls = {
        "HTTP://A.Example.NET/en/q?x#y": ("a.example.net", "/en/q", "example.net/en/", "allow"),
        "x://example.net/EN/": ("example.net", "/EN/", "net/", "block"),
        "x://net/": ("net", "/", "net/", "block"),
        "x://planet/": ("planet", "/", None, "allow"),
        "x://net": ("net", "", None, "allow"),
        "x://h?a/b://c": ("h", "", None, "allow"),
        "x://h#f": ("h", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "a://b://c/d": ("b:", "//c/d", None, "allow"),
        "x://É.B.co.uk/xyz\nq?": ("É.b.co.uk", "/xyz\nq", "b.co.uk/x", "block"),
        None: ("", "", None, "allow"),
    }
    got = judged(spark, [(k, u, None, 7) for k, u in enumerate(urls)] + [(None, None, "", None)], [])
    for k, (u, want) in enumerate(urls.items()):
        r = got[k, u]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == want, u
    assert len(got) == 13


def test_bad_hosts_are_blocked_and_unsure_ones_are_not(spark):
    pages = [(k, f"x://bad.site.org/{k}", None, 0) for k in range(40)] + [(100 + k, f"x://good{k % 5}.site.org/", None, 0) for k in range(100)]
    pages += [(300, "x://once.site.org/", None, 0), (400, "x://never.other.com/", None, 0), (0, "x://bad.site.org/0", None, 0)]
    outcomes = [(k, 0) for k in range(40)] + [(100 + k, 1) for k in range(100)] + [(300, 0), (None, 0), (400, None)]
    got = judged(spark, pages, outcomes)
    assert all(r["verdict"] == ("block" if r["host"] == "bad.site.org" else "allow") for r in got.values())
    assert got[300, "x://once.site.org/"]["host_labelled"] == 1 and got[400, "x://never.other.com/"]["host_labelled"] == 0


def test_empty_pages(spark):
    assert judged(spark, [], [(1, 1)]) == {}
