import re

import numpy as np
import xxhash
import pytest
from docs import documents, frame

from fringeframe.llm import simhash
from fringeframe.llm.components import component_roots, stars
from fringeframe.llm.simhash import VantageTree, local_links, simhash_groups

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_print(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints, radius):
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(prints))]


def test_groups_match_brute_force(spark):
    rows = documents()
    got = sorted(simhash_groups(frame(spark), carry=["doc_id", "lang"]).collect(), key=str)
    prints = [plain_print(r[1]) for r in rows]
    roots = plain_components(prints, 2)
    least = {}
    for r, k in zip(rows, roots):
        if r[0] is not None:
            least[k] = min(least.get(k, r[0]), r[0])
    want = sorted([(r[0], r[2], f"{p:016x}", least.get(k)) for r, p, k in zip(rows, prints, roots)], key=lambda x: str(x))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_empty_table(spark):
    assert simhash_groups(frame(spark, [])).collect() == []


def clustered(n, seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**64, n, dtype=np.uint64)
    near = base[: n // 3].copy()
    for _ in range(2):
        near ^= np.uint64(1) << rng.integers(0, 64, len(near)).astype(np.uint64)
    return np.unique(np.concatenate([base, near]))


def test_local_links_connect_what_brute_force_connects():
    prints = clustered(900, 3)
    pairs = local_links(prints, 2, bucket=16)
    close = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2
    want = plain_components([int(x) for x in prints], 2)
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        assert a != b
        parent[max(root(a), root(b))] = min(root(a), root(b))
    assert [root(i) for i in range(len(prints))] == want
    assert close.sum() > len(prints)


def test_route_brings_every_near_pair_together():
    prints = clustered(3000, 4)
    index, shard = VantageTree(prints[::7], 5, 2).route(prints)
    homes = {}
    for i, s in zip(index.tolist(), shard.tolist()):
        homes.setdefault(i, set()).add(s)
    a, b = np.nonzero(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2)
    assert all(homes[i] & homes[j] for i, j in zip(a.tolist(), b.tolist()))
    assert len(set(shard.tolist())) > 8


def test_component_roots_on_path_star_and_cycle(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 540)]
    cycle = [(700 + i, 700 + (i + 1) % 7) for i in range(7)]
    got = dict(component_roots(spark.createDataFrame(path + star + cycle + [(5, 5)], "u long, v long")).collect())
    want = {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 540)} | {i: 700 for i in range(700, 707)}
    assert got == want


def random_links(seed):
    rng = np.random.default_rng(seed)
    path = [(i, i + 1) for i in rng.permutation(500).tolist()]
    loose = [tuple(x) for x in rng.integers(1000, 1700, (400, 2)).tolist()]
    hub = [(5000 - i % 2, 3000 + i) for i in range(300)]
    far = [(-(2**63), 2**63 - 1), (7, 7)]
    return path + loose + hub + far


def plain_roots(links):
    near = {}
    for u, v in links:
        if u != v:
            near.setdefault(u, set()).add(v)
            near.setdefault(v, set()).add(u)
    root = {}
    for node in sorted(near):
        todo = [] if node in root else [node]
        while todo:
            at = todo.pop()
            if at not in root:
                root[at] = node
                todo += near[at]
    return root


def test_stars_are_the_components():
    for seed in range(5):
        links = random_links(seed)
        node, root = stars(*np.array(links, np.int64).T)
        want = {k: v for k, v in plain_roots(links).items() if k != v}
        assert dict(zip(node.tolist(), root.tolist())) == want and len(node) == len(want)


@pytest.mark.parametrize("together", [16, 400, 1 << 17])
def test_component_roots_with_few_and_many_links_at_once(spark, together):
    links = random_links(9)
    got = component_roots(spark.createDataFrame(links, "u long, v long").repartition(3), together).collect()
    assert dict(got) == plain_roots(links) and len(got) == len(plain_roots(links))


def test_few_links_take_few_jobs(spark):
    """Each job's plans, classes and broadcasts are the driver's memory."""
    links = spark.createDataFrame(random_links(3), "u long, v long")
    spark.sparkContext.setJobGroup("roots", "roots")
    try:
        got = component_roots(links)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("roots")) <= 6
    assert dict(got.collect()) == plain_roots(random_links(3))


def test_trees_and_components_do_not_share_a_stage(spark, monkeypatch):
    plans = []

    def seen(links):
        plans.append(links._jdf.queryExecution().toString())
        return component_roots(links)

    monkeypatch.setattr(simhash, "component_roots", seen)
    simhash_groups(frame(spark)).collect()
    assert len(plans) == 1 and "InPandas" not in plans[0]
