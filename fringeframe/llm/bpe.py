"""Byte-pair encoding by speculation: propose by greedy longest match, verify adjacent pairs, merge the rest.

A token sequence is what merging would have made exactly if every adjacent pair of its tokens is: merges
across a seam involve only the nodes on the right spine of the left token's merge tree and the left spine
of the right token's.  The check walks both spines in merge order, for all pairs of a batch at once.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .frames import kept_columns, neutral

_NONE = 1 << 40
#: What a worker process knows of chunks (number of tokens, ids, decoded text), by the tokenizer file's digest, with
#: its rough size in bytes; bounded, so it may outlive a task.
_KNOWN: dict[str, tuple[dict[bytes, tuple[int, bytes, bytes]], list[int]]] = {}
#: Words of more units are merged by a heap, chunks of more bytes are not remembered.
_LONG = 64
_UNMERGED = (1 << 40, -1)
_SIGMA = str.maketrans({"Σ": "σ"})


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte: itself if it prints, else the next free one from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain}
    letters |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in letters)}
    return letters


class WordBpe:
    """The model of a ``tokenizers`` file: byte-level BPE over words, ended by a suffix."""

    def __init__(self, spec: dict):
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.lower, self.odd, self.odd_pattern = dict(_SIGMA), None, None
        self.letters = {chr(b): c for b, c in _byte_letters().items()}
        self.translation = str.maketrans(self.letters)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {(self.vocab[a], self.vocab[b]): (i, self.vocab[a + b]) for i, (a, b) in enumerate(merges)}
        self.result = [node for _, node in sorted(self.rank.values())]
        size = max(max(self.vocab.values()), *self.special.values(), 0) + 1
        self.text = [""] * size
        for s, i in [*self.vocab.items(), *self.special.items()]:
            self.text[i] = s
        self.id_text = list(map(str, range(size)))
        #: Units of a word's bytes: inside, and at its end.
        self.units = [self.vocab.get(self.letters[chr(b)], -1) for b in range(256)]
        self.last_units = [self.vocab.get(self.letters[chr(b)] + self.suffix, -1) for b in range(256)]
        self._prepare_spines(size)
        keys = np.array([a * size + b for a, b in self.rank], np.int64)
        by = np.argsort(keys)
        self.pair_keys, self.pair_ranks, self.size = keys[by], np.array([r for r, _ in self.rank.values()], np.int64)[by], size
        self.piece: dict[str, int] = {}
        for s, i in self.vocab.items():
            if self.whole[i]:
                self.piece[s[: -len(self.suffix)] + "\n" if self.suffix and s.endswith(self.suffix) else s] = i
        #: Longest piece by its first four letters.
        self.reach: dict[str, int] = {}
        for s in self.piece:
            self.reach[s[:4]] = max(self.reach.get(s[:4], 0), len(s))

    def _units(self, token: str) -> list[int] | None:
        end = bool(self.suffix) and token.endswith(self.suffix) and len(token) > len(self.suffix)
        letters = list(token[: -len(self.suffix)] if end else token)
        if end:
            letters[-1] += self.suffix
        return [self.vocab[x] for x in letters] if all(x in self.vocab for x in letters) else None

    def _prepare_spines(self, size: int) -> None:
        """Left and right spines of each token's merge tree, leaf first, with the rank that forms each node."""
        left, right = [[] for _ in range(size)], [[] for _ in range(size)]
        self.whole = np.zeros(size, bool)
        for s, i in self.vocab.items():
            units = self._units(s)
            made: dict[int, tuple[int, int, int]] = {}
            if units is None or self.merge(units, made) != [i]:
                continue
            self.whole[i] = True
            for spine, side in ((left[i], 0), (right[i], 1)):
                node = i
                while node in made:
                    spine.append((node, made[node][2]))
                    node = made[node][side]
                spine.append((node, -1))
                spine.reverse()
        depth = max(max(map(len, left)), max(map(len, right)), 1)
        self.left, self.left_rank = np.full((size, depth + 1), -1, np.int64), np.full((size, depth + 1), _NONE, np.int64)
        self.right, self.right_rank = self.left.copy(), self.left_rank.copy()
        for nodes, ranks, spines in ((self.left, self.left_rank, left), (self.right, self.right_rank, right)):
            for i, spine in enumerate(spines):
                for k, (node, rank) in enumerate(spine):
                    nodes[i, k], ranks[i, k] = node, rank

    def merge(self, units: list[int], made: dict | None = None) -> list[int]:
        """Exact merging: again and again the pair of lowest rank, leftmost first."""
        if len(units) > _LONG:
            return self._merge_long(units)
        units, pair = list(units), self.rank.get
        ranks = [pair(p, _UNMERGED)[0] for p in zip(units, units[1:])]
        while ranks and (best := min(ranks)) < _NONE:
            k = ranks.index(best)
            node = self.result[best]
            if made is not None:
                made[node] = (units[k], units[k + 1], best)
            units[k : k + 2] = [node]
            del ranks[k]
            if k:
                ranks[k - 1] = pair((units[k - 1], node), _UNMERGED)[0]
            if k < len(ranks):
                ranks[k] = pair((node, units[k + 1]), _UNMERGED)[0]
        return units

    def _merge_long(self, units: list[int]) -> list[int]:
        """The same for long words: pairs wait in a heap by rank and place, neighbours are linked."""
        units, pair, n = list(units), self.rank.get, len(units)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(pair(p, _UNMERGED)[0], k) for k, p in enumerate(zip(units, units[1:]))]
        heap = [x for x in heap if x[0] < _NONE]
        heapq.heapify(heap)
        while heap:
            rank, k = heapq.heappop(heap)
            right = after[k]
            # A pair that has changed since it was pushed has another rank, or none.
            if units[k] < 0 or right >= n or pair((units[k], units[right]), _UNMERGED)[0] != rank:
                continue
            units[k], units[right], after[k] = self.result[rank], -1, after[right]
            if after[k] < n:
                before[after[k]] = k
            for left in (before[k], k):
                if left >= 0 and after[left] < n and (got := pair((units[left], units[after[left]]))):
                    heapq.heappush(heap, (got[0], left))
        return [u for u in units if u >= 0]

    def propose(self, word: str) -> list[int] | None:
        """Greedy longest match over the word's letters and the mark of its end; None if it gets stuck."""
        letters = (word if word.isascii() else word.encode("utf-8").decode("latin-1").translate(self.translation)) + "\n" * bool(self.suffix)
        n, at, out, piece, reach = len(letters), 0, [], self.piece, self.reach
        mark = n - 1 if self.suffix else n + 1
        while at < n:
            for end in range(min(n, at + max(3, reach.get(letters[at : at + 4], 3))), at, -1):
                if end != mark and (i := piece.get(letters[at:end])) is not None:
                    out.append(i)
                    at = end
                    break
            else:
                return None
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the letters of tokens a and b side by side gives a and b again, for all pairs."""
        i, j = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        good = np.ones(len(a), bool)
        live = np.arange(len(a))
        while len(live):
            la, lb, li, lj = a[live], b[live], i[live], j[live]
            key = self.right[la, li] * self.size + self.left[lb, lj]
            spot = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            across = np.where(self.pair_keys[spot] == key, self.pair_ranks[spot], _NONE)
            up_a, up_b = self.right_rank[la, li + 1], self.left_rank[lb, lj + 1]
            broken = (across < _NONE) & (across < up_a) & (across <= up_b)
            good[live[broken]] = False
            more = ~broken & ((up_a < _NONE) | (up_b < _NONE))
            i[live] += more & (up_a <= up_b)
            j[live] += more & (up_a > up_b)
            live = live[more]
        return good

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Token ids of each word: speculate, verify all seams at once, merge only the words that fail."""
        out = [self.propose(w) for w in words]
        flat = np.array([t for p in out if p for t in p], np.int64)
        owner = np.repeat(np.arange(len(out)), [len(p) if p else 0 for p in out])
        if len(flat) > 1:
            seam = np.flatnonzero(owner[1:] == owner[:-1])
            key, back = np.unique(flat[seam] * self.size + flat[seam + 1], return_inverse=True)
            bad = ~self.compatible(key // self.size, key % self.size)[back]
            for k in set(owner[seam[bad]].tolist()):
                out[k] = None
        for k, p in enumerate(out):
            if p is None:
                raw = words[k].encode("utf-8")
                out[k] = self.merge([*map(self.units.__getitem__, raw[:-1]), self.last_units[raw[-1]]])
        return out

    def follow_library(self, path: str) -> None:
        """Takes over the library's view of letters that only the newest Unicode tables know.

        Its tables and those of ``regex`` may differ in age; only code points that Python's own tables do not
        know yet can be told apart, and those are asked of the library once, on the driver.
        """
        try:
            from tokenizers import Tokenizer
        except ImportError:
            return
        library, odd = Tokenizer.from_file(path), []
        newest = [c for m in regex.finditer(r"[\p{L}\p{N}]+", "".join(map(chr, [*range(128, 0xD800), *range(0xE000, 0x110000)]))) for c in m[0] if unicodedata.category(c) == "Cn"]
        for c in newest:
            if len(library.pre_tokenizer.pre_tokenize_str(f"a{c}a")) != len(self.pattern.findall(f"a{c}a")):
                odd.append(c)
            if (low := library.normalizer.normalize_str(c)) != c.lower():
                self.lower[ord(c)] = low
        if odd:
            self.odd = frozenset(odd)
            self.odd_pattern = regex.compile(self.pattern.pattern.replace(r"\p{L}", f"[\\p{{L}}--[{''.join(odd)}]]"), regex.V1)

    def _split(self, text: str) -> list[str]:
        text = unicodedata.normalize("NFC", text).translate(self.lower).lower()
        return (self.pattern if self.odd is None or self.odd.isdisjoint(text) else self.odd_pattern).findall(text)

    def words(self, chunk: str) -> list[str]:
        """Words of a chunk without blanks, after normalisation; a special token's string stays one item."""
        if chunk.isascii() and chunk.isalpha():
            return [chunk.lower()]
        if chunk.isascii() and not any(s in chunk for s in self.special):
            return self.pattern.findall(chunk.lower())
        out = []
        for k, part in enumerate(self.special_split.split(chunk) if self.special_split else [chunk]):
            out += [part] if k % 2 else self._split(part)
        return out

    def encode_chunks(self, chunks: list[str]) -> list[list[int]]:
        """Token ids of each chunk; no word crosses a blank, so a text is encoded chunk by chunk."""
        split = [self.words(c) for c in chunks]
        distinct = list({w for ws in split for w in ws if w not in self.special})
        ids = dict(zip(distinct, self.encode_words(distinct))) | {s: [i] for s, i in self.special.items()}
        return [ids[ws[0]] if len(ws) == 1 else [i for w in ws for i in ids[w]] for ws in split]


@lru_cache(maxsize=2)
def load_word_bpe(path: str) -> WordBpe:
    """The model of a tokenizers JSON file, read on the driver."""
    with open(path, "rb") as f:
        raw = f.read()
    model = WordBpe(json.loads(raw))
    model.digest = hashlib.sha256(raw).hexdigest()
    model.follow_library(path)
    return model


_ENCODED = ["n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256"]


def bpe_round_trip(docs: DataFrame, tokenizer_path: str, text: str = "text", carry: list[str] | None = None, digests: bool = False, cache_bytes: int = 48 << 20) -> DataFrame:
    """Encodes every whole text and decodes it again.

    Adds ``n_tokens`` (long), ``ids`` (array of int) and ``decoded`` (string), or with ``digests`` their
    SHA-256 instead: ``ids_sha256`` of the decimal ids joined by one space, ``decoded_sha256`` of the
    UTF-8 bytes.  ``carry``: input columns to return, all by default; columns named like a result are
    replaced.  A null or empty text has no tokens and decodes to "".  Special tokens' strings in a text
    become their ids.  Rows are handled one by one, in any number of copies; no shuffle.  The broadcast
    model is as large as its file; a worker remembers some ``cache_bytes`` of words' encodings at most and
    works the others out again in each batch.
    """
    model = docs.sparkSession.sparkContext.broadcast(load_word_bpe(tokenizer_path))
    own = kept_columns(docs, carry, _ENCODED)
    given = neutral(docs, own, body=text)
    kinds = {"n_tokens": T.LongType(), "ids": T.ArrayType(T.IntegerType()), "decoded": T.StringType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType()}
    made = ["n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["n_tokens", "ids", "decoded"]
    schema = T.StructType([*given.schema.fields[:-1], *(T.StructField(c, kinds[c]) for c in made)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model.value
        known, size = _KNOWN.setdefault(bpe.digest, ({}, [0]))
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                # Bytes split at the very blanks at which no word goes on.
                texts = [t.split() if t else [] for t in part.column(len(own)).cast(pa.binary()).to_pylist()]
                fresh = list(set().union(*texts).difference(known))
                new = {}
                for c, ids in zip(fresh, bpe.encode_chunks([c.decode("utf-8") for c in fresh])):
                    new[c] = (len(ids), " ".join([bpe.id_text[i] for i in ids]).encode(), " ".join([bpe.text[i] for i in ids]).encode("utf-8"))
                if size[0] < cache_bytes:
                    short = {c: x for c, x in new.items() if len(c) <= _LONG}
                    size[0] += sum([300 + len(c) + len(x[1]) + len(x[2]) for c, x in short.items()])
                    known |= short
                counts, ids, decoded = [], [], []
                for cs in texts:
                    got = [known.get(c) or new[c] for c in cs]
                    each = tuple(zip(*got)) or ((), (), ())
                    if 0 in each[0]:
                        each = tuple(zip(*(g for g in got if g[0]))) or ((), (), ())
                    counts.append(sum(each[0]))
                    ids.append(b" ".join(each[1]))
                    decoded.append(b" ".join(each[2]))
                if digests:
                    out = [[hashlib.sha256(x).hexdigest() for x in xs] for xs in (ids, decoded)]
                    cols = [pa.array(counts, pa.int64()), *(pa.array(x, pa.string()) for x in out)]
                else:
                    cols = [pa.array(counts, pa.int64()), pa.array([[int(i) for i in x.split()] for x in ids], pa.list_(pa.int32())), pa.array(decoded, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(len(own))), *cols], names=schema.names)

    return given.mapInArrow(run, schema).toDF(*own, *made)


def tokenizer_file(spark: SparkSession, name: str = "word_bpe_49k.json") -> str:
    """Path of a public tokenizer file: ``spark.fringeframe.tokenizer`` if set, else the installed copy."""
    path = spark.conf.get("spark.fringeframe.tokenizer", None)
    if path:
        return path
    import public_tokenizers

    return str(public_tokenizers.path(name))
