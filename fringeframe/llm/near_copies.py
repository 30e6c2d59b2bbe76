"""Near copies by exact Jaccard similarity of word shingles.

Every set's shingles are put in one order, the rare ones first.  Two sets of similarity t share one of their
first n - ceil(t * n) + 1 shingles (n: a set's size), whatever the order, so the sets that share one of those
are the only candidates, and their whole texts decide.  The order follows each shingle's number of sets, which
chunks and slices work out as in a count sketch of one row (a cell of several shingles counts them together,
which moves them back in the order and loses nothing).  A shingle of one set finds nobody, so a set with enough
of these takes no further part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import textscan as ts
from .chunks import from_message, from_planes, packed, slice_edges, sorted_message, to_planes, unpacked
from .components import component_roots
from .storage import free_shuffles, written

#: Neighbours by size, among the sets that share a shingle, that a set is compared with before all others.
_NEIGHBOURS = 8
#: Bytes of text a chunk, and of all chunks a slice of cells.
_CHUNK, _SLICE = 2 << 20, 16 << 20
#: Sets of a shingle that its other sets are compared with, those of the fewest rare shingles: copies cluster around them.
_TYPICAL = 8
#: 64-bit words of a set's parities, which bound from below by how many shingles two sets differ.
_PARITIES = 4
#: Cells a shingle.
_WIDE = 16
#: Sets of one shingle, as a power of two, that are put in order together; more are dealt to several groups.
_TOGETHER = 12


def row_keys(docs: DataFrame, name: str = "row_key") -> DataFrame:
    """Adds a number of its own to every row of a table read from files: the file's, then the row's place in it."""
    files = sorted(r[0] for r in docs.select(F.col("_metadata.file_path").alias("f")).distinct().collect())
    numbers = docs.sparkSession.createDataFrame(list(zip(files, range(len(files)))), "file__ string, number__ long")
    given = docs.select("*", F.col("_metadata.file_path").alias("file__"), F.col("_metadata.row_index").alias("at__"))
    key = F.shiftleft("number__", 40) + F.col("at__")
    return given.join(F.broadcast(numbers), "file__").select(*docs.columns, key.alias(name))


def shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, shingle), by document and shingle, each once; all words of a shorter text are one shingle."""
    low = ts.LOWER[data]
    starts, ends, first = ts.spans(low, offsets)
    words = ts.span_hashes(low, starts, ends)
    owner, size = np.repeat(np.arange(len(offsets) - 1), np.diff(first)), np.diff(first)
    found = []
    for w in range(1, width + 1):
        at, h = ts.window_hashes(words, first, w, w)
        whole = np.ones(len(at), bool) if w == width else size[owner[at]] == w
        found.append((owner[at[whole]], h[whole]))
    owner, h = (np.concatenate(x) for x in zip(*found))
    by = np.lexsort((h, owner))
    owner, h = owner[by], h[by]
    lead = np.r_[True, (np.diff(owner) != 0) | (np.diff(h) != 0)][: len(h)]
    return owner[lead], h[lead]


def _parts(batch: pa.RecordBatch, at: int, width: int):
    """First row, number of rows, and shingles of each chunk of a batch."""
    data, offsets = ts.utf8(batch.column(at))
    for lo, hi in ts.chunks(offsets):
        yield lo, hi - lo, *shingles(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], width)


def _parities(owner: np.ndarray, h: np.ndarray) -> np.ndarray:
    """(set, word): for each bit whether an odd number of the set's shingles falls on it; sets of ``owner``, in order."""
    mixed = ts.mix(h ^ np.uint64(0xA0761D6478BD642F))
    bit, word = np.uint64(1) << (mixed & np.uint64(63)), (mixed >> np.uint64(6)) % np.uint64(_PARITIES)
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]][: len(owner)])
    words = [np.bitwise_xor.reduceat(np.where(word == w, bit, np.uint64(0)), first) if len(first) else bit for w in range(_PARITIES)]
    return np.stack(words, axis=1).view(np.int64)


def _digests(rows: DataFrame, width: int) -> DataFrame:
    """(row_key, d1, d2, n): a 128-bit digest of the row's set and its size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, rows, owner, h in _parts(batch, 1, width):
                first = np.searchsorted(owner, np.arange(rows + 1))
                sums = []
                for salt in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03):
                    total = np.zeros(len(h) + 1, np.uint64)
                    np.cumsum(ts.mix(h ^ np.uint64(salt)), out=total[1:])
                    sums.append(pa.array((total[first[1:]] - total[first[:-1]]).view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, rows), *sums, pa.array(np.diff(first))], names=["row_key", "d1", "d2", "n"])

    return rows.select("row_key", "text").mapInArrow(run, "row_key long, d1 long, d2 long, n long")


def _active(texts: DataFrame, width: int, tenths: int) -> DataFrame:
    """(node, n, text, parities, tokens, places, groups) of the sets (node, text) that may have partners: the shingles
    by which these can be found, their places in the order, and which of a frequent shingle's groups the set is in."""
    chunks = packed(texts.select("node", "text"), 1, _CHUNK)
    size = chunks.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    slices = 1 << max(0, math.ceil(math.log2(max(1, size / _SLICE))))
    cell_bits = max(slices.bit_length(), math.ceil(math.log2(max(2, size / 6 * _WIDE))))

    def cells_of(part: pa.RecordBatch):
        owner, h = shingles(*ts.utf8(part.column(1)), width)
        cells, back = np.unique(h >> np.uint64(64 - cell_bits), return_inverse=True)
        return owner, h, cells, back, slice_edges((cells >> np.uint64(cell_bits - slices.bit_length() + 1)).astype(np.int64))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cid, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                _, _, cells, back, edges = cells_of(unpacked(body))
                count = np.bincount(back, minlength=len(cells)).astype("<u4")
                rows = [(s, cid, b - a, sorted_message(cells[a:b]), to_planes(count[a:b])) for s, a, b in edges]
                cols = list(zip(*rows)) if rows else [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()))], names=["slice", "cid", "n", "cells", "counts"])

    def answer(group: pa.Table) -> pa.Table:
        number = group["n"].to_pylist()
        cells = np.concatenate([from_message(b, n) for b, n in zip(group["cells"].to_pylist(), number)])
        counts = np.concatenate([from_planes(b, n, "<u4") for b, n in zip(group["counts"].to_pylist(), number)])
        got, back = np.unique(cells, return_inverse=True)
        level = np.ceil(np.log2(np.bincount(back, weights=counts, minlength=len(got)))).astype(np.uint8)[back]
        edge = np.r_[0, np.cumsum(number)]
        bodies = [to_planes(level[a:b]) for a, b in zip(edge, edge[1:])]
        return pa.table({"cid": group["cid"], "slice": group["slice"], "n": group["n"], "levels": pa.array(bodies, pa.binary())})

    def choose(chunk: pa.Table, replies: pa.Table) -> pa.Table:
        part = unpacked(chunk["body"][0].as_py())
        owner, h, cells, back, _ = cells_of(part)
        told = [from_planes(b, n, "u1") for _, n, b in sorted(zip(*(replies[c].to_pylist() for c in ("slice", "n", "levels"))))]
        level = (np.concatenate(told) if told else np.zeros(0, np.uint8))[back]
        by = np.lexsort((h, level, owner))
        owner, h, level = owner[by], h[by], level[by]
        n = np.bincount(owner, minlength=part.num_rows)
        pos = np.arange(len(h)) - (np.cumsum(n) - n)[owner]
        # Places count the shingles of one set alone as well, but only the others are sent.
        use = (pos < (n + (-tenths * n // 10) + 1)[owner]) & (level > 0)
        some = np.flatnonzero(np.bincount(owner[use], minlength=part.num_rows))
        edge = np.searchsorted(owner[use], np.r_[some, part.num_rows]).astype(np.int32)
        salt = ts.mix(part.column(0).to_numpy().astype(np.uint64))[owner[use]] & ((np.uint64(1) << np.maximum(level[use].astype(np.int64) - _TOGETHER, 0).astype(np.uint64)) - np.uint64(1))
        lists = [pa.ListArray.from_arrays(pa.array(edge), pa.array(x)) for x in (h[use].view(np.int64), pos[use].astype(np.int32), salt.astype(np.int32))]
        at, mine = pa.array(some), np.isin(owner, some)
        parities = pa.FixedSizeListArray.from_arrays(pa.array(_parities(owner[mine], h[mine]).ravel()), _PARITIES).cast(pa.list_(pa.int64()))
        return pa.table({"node": part.column(0).take(at), "n": pa.array(n[some].astype(np.int32)), "text": part.column(1).take(at), "parities": parities, "tokens": lists[0], "places": lists[1], "groups": lists[2]})

    asked = chunks.select("cid", "body").mapInArrow(send, "slice int, cid long, n int, cells binary, counts binary")
    answers = written(asked.groupBy("slice").applyInArrow(answer, "cid long, slice int, n int, levels binary"))
    chosen = chunks.select("cid", "body").groupBy("cid").cogroup(answers.groupBy("cid")).applyInArrow(choose, "node long, n int, text string, parities array<long>, tokens array<long>, places array<int>, groups array<int>")
    return written(chosen)


def _alike(pairs: DataFrame, texts: DataFrame, width: int, tenths: int, limit: int = 8 << 20) -> DataFrame:
    """The pairs (u, v) whose whole texts reach the similarity; some ``limit`` bytes are compared at once."""

    def compare(batch: pa.RecordBatch) -> pa.RecordBatch:
        size, seen = np.zeros((2, batch.num_rows), np.int64), []
        for side in (0, 1):
            for lo, rows, owner, h in _parts(batch, 2 + side, width):
                size[side, lo : lo + rows] = np.bincount(owner, minlength=rows)
                seen.append((owner + lo, h))
        owner, h = (np.concatenate(x) for x in zip(*seen))
        by = np.lexsort((h, owner))
        owner, h = owner[by], h[by]
        both = np.flatnonzero((np.diff(owner) == 0) & (np.diff(h) == 0))
        shared = np.bincount(owner[both], minlength=batch.num_rows)
        fine = (10 + tenths) * shared >= tenths * size.sum(axis=0)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(fine & (shared > 0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in ts.chunks(sum(ts.utf8(batch.column(2 + side))[1] for side in (0, 1)), limit):
                yield compare(batch.slice(lo, hi - lo))

    a, b = texts.select(F.col("node").alias("u"), F.col("text").alias("text_u")), texts.select(F.col("node").alias("v"), F.col("text").alias("text_v"))
    return written(pairs.join(a, "u").join(b, "v").select("u", "v", "text_u", "text_v").mapInArrow(run, "u long, v long"))


def _possible(na: Column, pa_: Column, nb: Column, pb: Column, tenths: int) -> Column:
    """Whether sets of these sizes that share first the shingles at these places can reach the similarity."""
    return (10 + tenths) * F.least(na - pa_, nb - pb) >= tenths * (na + nb)


def _with_neighbours(tokens: DataFrame, keys: list[str]) -> DataFrame:
    """Adds the sets before each in order of size, and whether one comes after."""
    by_size = Window.partitionBy(*keys).orderBy("n", "node")
    before = F.collect_list(F.struct("node", "n", "pos")).over(by_size.rowsBetween(-_NEIGHBOURS, -1))
    return tokens.select("*", before.alias("before"), F.lead("node").over(by_size).alias("after"))


def _neighbour_pairs(tokens: DataFrame, tenths: int) -> DataFrame:
    """(a, b) of sets and their neighbours that can reach the similarity."""
    can = _possible(F.col("n"), F.col("pos"), F.col("other.n"), F.col("other.pos"), tenths)
    return tokens.select("node", "n", "pos", F.explode("before").alias("other")).where(can).select(F.col("node").alias("a"), F.col("other.node").alias("b"))


def _typical_pairs(tokens: DataFrame, tenths: int) -> DataFrame:
    """(a, b) of sets and the typical sets, of other components, of a shingle they share, that can reach the similarity."""
    part = F.pmod(F.xxhash64("node"), F.lit(_TYPICAL))
    typical = tokens.groupBy("token", part.alias("part")).agg(F.min(F.struct("pos", "n", "node", "root")).alias("x"))
    typical = typical.groupBy("token").agg(F.collect_list("x").alias("typical"))
    can = lambda x: (x["root"] != F.col("root")) & _possible(F.col("n"), F.col("pos"), x["n"], x["pos"], tenths)
    found = tokens.join(typical, "token").select("node", F.explode(F.filter("typical", can)).alias("x"))
    return found.select(F.col("node").alias("a"), F.col("x.node").alias("b"))


def _close(tenths: int) -> Column:
    """Whether the parities of two sets leave the similarity possible: sets differ by as many shingles as parities at least."""
    apart = sum((F.bit_count(F.col("parities_a")[w].bitwiseXOR(F.col("parities_b")[w])) for w in range(_PARITIES)), F.lit(0))
    return (10 + tenths) * apart <= (10 - tenths) * (F.col("n_a") + F.col("n_b"))


def _ordered(pairs: DataFrame) -> DataFrame:
    """(u, v) of different nodes, the lesser first, each once."""
    return pairs.where("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()


def _of_two_components(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (u, v) whose nodes are not in one component yet."""
    a, b = roots.select(F.col("node").alias("u"), F.col("root").alias("a")), roots.select(F.col("node").alias("v"), F.col("root").alias("b"))
    return pairs.join(a, "u", "left").join(b, "v", "left").where(F.coalesce("a", "u") != F.coalesce("b", "v")).select("u", "v")


def _with_more_links(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) of the components once more links are added: only these, between roots, are walked."""
    free_shuffles(roots.sparkSession)
    a, b = roots.select(F.col("node").alias("u"), F.col("root").alias("a")), roots.select(F.col("node").alias("v"), F.col("root").alias("b"))
    between = links.join(a, "u", "left").join(b, "v", "left").select(F.coalesce("a", "u").alias("a"), F.coalesce("b", "v").alias("b"))
    between = written(_ordered(between))
    if between.isEmpty():
        return roots
    top = component_roots(between)
    moved = roots.join(top.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return written(moved.union(top.join(roots.select("node"), "node", "left_anti")))


def _of_mixed_tokens(tokens: DataFrame, roots: DataFrame) -> DataFrame:
    """The tokens, with their sets' components, that sets of more than one component have."""
    mine = tokens.join(roots, "node", "left").select("token", "node", "n", "pos", F.coalesce("root", "node").alias("root"))
    mixed = mine.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("token")
    return written(mine.join(mixed, "token", "left_semi"))


def near_copy_groups(rows: DataFrame, width: int = 5, tenths: int = 8, joined: DataFrame | None = None) -> DataFrame:
    """(row_key, component) for every row of (row_key, text): rows share a component if links join them, and a
    link is a Jaccard similarity of at least ``tenths`` / 10 of the sets of ``width``-word shingles.

    Words are runs of other characters than space and \\x09-\\x0D, A-Z lower-cased; a shorter text is one shingle;
    texts without words, null ones too, are copies of each other.  Shingles are 64-bit hashes.  Rows of equal
    sets are one node.  ``joined`` (row_key, other): links that another method has found, such as that of close
    fingerprints; they count like those of the similarity, and what they join is not compared again.  Sets that
    share a shingle are compared first with their neighbours by size, then with the shingle's typical sets and one
    by one with the ends of other components, and then with the sets of other components only, so that a large
    group of near copies makes few pairs.
    """
    prints = written(_digests(rows, width))
    least = written(prints.groupBy("d1", "d2", "n").agg(F.min("row_key").alias("node")))
    texts = rows.join(least.where("n > 0").select(F.col("node").alias("row_key")), "row_key", "left_semi").select(F.col("row_key").alias("node"), "text")
    active = _active(texts, width, tenths)
    known = active.select("node", "text")
    zipped = F.arrays_zip(F.col("tokens").alias("token"), F.col("places").alias("pos"), F.col("groups").alias("group"))
    tokens = active.select("node", "n", F.explode(zipped).alias("x")).select("node", "n", "x.token", "x.pos", "x.group")
    tokens = _with_neighbours(tokens, ["token", "group"])
    tokens = written(tokens.where("size(before) > 0 OR after IS NOT NULL OR group > 0").drop("after", "group"))
    links = rows.sparkSession.createDataFrame([], "u long, v long")
    if joined is not None:
        node = prints.join(least, ["d1", "d2", "n"]).select("row_key", "node")
        a, b = node.select("row_key", F.col("node").alias("a")), node.select(F.col("row_key").alias("other"), F.col("node").alias("b"))
        links = _ordered(joined.join(a, "row_key").join(b, "other").select("a", "b"))
    roots = component_roots(links)
    seen = written(_of_two_components(_ordered(_neighbour_pairs(tokens, tenths)), roots))
    roots = _with_more_links(roots, _alike(seen, known, width, tenths))
    tokens = tokens.drop("before")
    # Then all sets with the typical ones of a shingle, as near copies of one text join where they are closest to it,
    # and the least and the largest set that each component has of a shingle with those of other components.
    mine = _of_mixed_tokens(tokens, roots)
    place = F.struct("n", "node", "pos")
    ends = mine.groupBy("token", "root").agg(F.min(place).alias("lo"), F.max(place).alias("hi"))
    ends = ends.select("token", "root", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("x")).select("token", "root", "x.*")
    more = _typical_pairs(mine, tenths).union(_neighbour_pairs(_with_neighbours(ends, ["token"]), tenths))
    more = written(_ordered(more).join(seen, ["u", "v"], "left_anti"))
    roots = _with_more_links(roots, _alike(more, known, width, tenths))
    seen = seen.union(more)
    # What is left are pairs of different components that share a shingle, and all of them are compared whose
    # parities do not rule them out.
    mine = _of_mixed_tokens(tokens, roots).join(active.select("node", "parities"), "node")
    a, b = (mine.select("token", *(F.col(c).alias(f"{c}_{s}") for c in ("node", "n", "pos", "root", "parities"))) for s in "ab")
    can = _possible(F.col("n_a"), F.col("pos_a"), F.col("n_b"), F.col("pos_b"), tenths)
    rest = a.join(b, "token").where(F.col("root_a") < F.col("root_b")).where(can & _close(tenths))
    rest = _ordered(rest.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))).join(seen, ["u", "v"], "left_anti")
    roots = _with_more_links(roots, _alike(written(rest), known, width, tenths))
    nodes = least.join(roots, "node", "left").select("d1", "d2", "n", F.coalesce("root", "node").alias("component"))
    return prints.join(nodes, ["d1", "d2", "n"]).select("row_key", "component")
