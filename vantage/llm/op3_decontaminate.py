"""Benchmark decontamination: SimHash of item-sized windows, a multi-index Hamming search, exact verification.

A benchmark item of m words is compared with every window of m words of a
document that shares at least one of its 5-word shingles (a window that shares
none has similarity 0). Each such window gets a 64-bit SimHash of its shingles
(each as often as it occurs). Fingerprints are cut into `BLOCKS` blocks: if two
differ in at most `radius` bits, some block differs in at most radius // BLOCKS
bits, so looking up each block's value in a table of all values that close
finds every item within the radius. At similarity 0.8 fingerprints differ in
9.7 bits on average; the default radius of 23 is 4.6 standard deviations more.
Candidates are verified by the exact weighted Jaccard similarity of the
shingles, weighted by their number of occurrences.

Documents are never shuffled. The benchmark is gone through in blocks of
bounded size; each block is collected and broadcast.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.llm.common import kept, text_slices
from vantage.llm.textops import U64, Words, mix64, shingles

K = 5                     # words of a shingle
BLOCKS = 8                # blocks of a fingerprint, 8 bits each
BLOCK_ITEMS = 20_000      # benchmark items broadcast at a time
BLOCK_BYTES = 16 << 20    # and bytes of text


@dataclass(frozen=True)
class Items:
    ids: list
    texts: list[str]
    radius: int
    threshold: float
    uid: str = field(default_factory=lambda: uuid.uuid4().hex)


def fingerprints(bits: np.ndarray) -> np.ndarray:
    """64-bit values of rows of 64 sums: bit j is set where sum j is positive."""
    return np.packbits(bits > 0, axis=1, bitorder="little").view(np.uint64).ravel()


def signs(h: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of the 64 bits of each hash."""
    h = mix64(h)
    return np.unpackbits(np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(
        np.int32) * 2 - 1


def grams(words: Words, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of m (fewer than K) words as `shingles` hashes a text of m words, and its first word."""
    at = np.flatnonzero(words.offsets[1:][words.doc] - np.arange(len(words.doc)) >= m)
    h = np.zeros(len(at), U64)
    with np.errstate(over="ignore"):
        for j in range(K):
            h = h * U64(0x9E3779B97F4A7C15) + (words.hash[at + j] if j < m else U64(j + 1))
    return mix64(h), at


class Index:
    """Shingles, fingerprints and Hamming tables of a block of items."""

    def __init__(self, items: Items):
        words = Words(pa.array(items.texts, pa.string()))
        h, offs = shingles(words, K)
        self.n = np.diff(offs)                       # shingles of each item
        self.words = np.diff(words.offsets)
        self.shingles = [h[s:e] for s, e in zip(offs, offs[1:])]
        self.counts = [Counter(x.tolist()) for x in self.shingles]
        owner = np.repeat(np.arange(len(self.n)), self.n)
        order = np.lexsort((owner, h))
        h, owner = h[order], owner[order]
        self.keys, first = np.unique(h, return_index=True)
        self.owner, self.first = owner, np.append(first, len(h))
        self.sieve = np.zeros(1 << 22, bool)
        self.sieve[(self.keys & U64((1 << 22) - 1)).astype(np.int64)] = True
        near = np.array([bin(x).count("1") for x in range(256)]) <= items.radius // BLOCKS
        self.by_size = {}
        for n in np.unique(self.n[self.n > 0]).tolist():
            own = np.flatnonzero(self.n == n)
            prints = fingerprints(np.array([signs(self.shingles[i]).sum(0) for i in own]))
            block = prints.view(np.uint8).reshape(-1, BLOCKS)
            table = np.stack([near[np.arange(256)[:, None] ^ block[:, b][None, :]] for b in range(BLOCKS)])
            self.by_size[n] = (own, prints, table)
        self.short = sorted(set(self.words[(self.words > 0) & (self.words < K)].tolist()))

    def hits(self, h: np.ndarray) -> np.ndarray:
        """Positions in h of shingles of any item."""
        at = np.flatnonzero(self.sieve[(h & U64((1 << 22) - 1)).astype(np.int64)])
        if not len(at) or not len(self.keys):
            return at[:0]
        return at[self.keys[np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)] == h[at]]

    def owners(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, index into h) of every item that has the shingle."""
        k = np.searchsorted(self.keys, h)
        size = self.first[k + 1] - self.first[k]
        which = np.repeat(np.arange(len(h)), size)
        at = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.first[k], size)
        return self.owner[at], which


def search_text(index: Index, h: np.ndarray, hit: np.ndarray, radius: int, threshold: float) -> dict:
    """item -> (similarity, first shingle) of the best window of one text (shingles h, of any item at `hit`)."""
    best: dict[int, tuple[float, int]] = {}
    item, which = index.owners(h[hit])
    sizes = index.n[item]
    for n in np.unique(sizes).tolist():
        size = min(n, len(h))  # a text shorter than the item is a single window
        at = hit[which[sizes == n]]
        starts = np.unique((at[:, None] - np.arange(size)[None, :]).ravel())
        starts = starts[(starts >= 0) & (starts + size <= len(h))]
        low = starts[0]
        sums = np.zeros((starts[-1] + size - low + 1, 64), np.int32)
        np.cumsum(signs(h[low:starts[-1] + size]), axis=0, out=sums[1:])
        prints = fingerprints(sums[starts - low + size] - sums[starts - low])
        own, theirs, table = index.by_size[n]
        block = prints.view(np.uint8).reshape(-1, BLOCKS)
        found = np.zeros((len(starts), len(own)), bool)
        for b in range(BLOCKS):
            found |= table[b][block[:, b]]
        w, i = np.nonzero(found)
        near = np.bitwise_count(prints[w] ^ theirs[i]) <= radius
        for w, i in zip(w[near].tolist(), i[near].tolist()):
            s, it = int(starts[w]), int(own[i])
            window = Counter(h[s:s + size].tolist())
            shared = (window & index.counts[it]).total()
            similarity = shared / (size + n - shared)
            if similarity >= threshold and similarity > best.get(it, (0.0, 0))[0]:
                best[it] = (similarity, s)
    return best


_INDEX: dict[str, Index] = kept()


def _index(items: Items) -> Index:
    if items.uid not in _INDEX:  # once for each Python worker and block
        _INDEX.clear()
        _INDEX[items.uid] = Index(items)
    return _INDEX[items.uid]


def matches(column: pa.Array, items: Items) -> Iterator[tuple[int, int, float, int, int]]:
    """(text, item, similarity, first word, words) of the texts' best windows."""
    index = _index(items)
    words = Words(column)
    h, offs = shingles(words, K)
    hit = index.hits(h)
    doc = np.searchsorted(offs, hit, "right") - 1
    for d in np.unique(doc).tolist():
        own = hit[doc == d] - offs[d]
        for it, (s, at) in search_text(index, h[offs[d]:offs[d + 1]], own, items.radius, items.threshold).items():
            yield d, it, s, at, int(index.words[it])
    for m in index.short:  # items of fewer than K words: their only shingle is all of them
        h, at = grams(words, m)
        hit = index.hits(h)
        item, which = index.owners(h[hit])
        seen = set()
        for it, a in zip(item.tolist(), at[hit[which]].tolist()):
            d = int(words.doc[a])
            if index.words[it] == m and (d, it) not in seen:
                seen.add((d, it))
                if words.offsets[d + 1] - words.offsets[d] >= K:  # shorter texts were met above
                    yield d, it, 1.0, int(a - words.offsets[d]), m


def blocks(benchmark: DataFrame, radius: int, threshold: float) -> Iterator[Items]:
    """The items in blocks of bounded number and size; those without text are left out."""
    rows = benchmark.where(F.col("text").isNotNull()).select("item_id", "text")
    size = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    n = max(1, -(-size["n"] // BLOCK_ITEMS), -(-(size["bytes"] or 0) // BLOCK_BYTES))
    for i in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        got = sorted(((r["item_id"], r["text"]) for r in part.collect()), key=lambda x: (x[0] is not None, x))
        yield Items([x for x, _ in got], [x for _, x in got], radius, threshold)


def _scan(docs: DataFrame, items: Items, task: Callable, schema) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)
    return docs.mapInArrow(lambda batches: task(batches, shared.value), schema)


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, radius: int = 23) -> DataFrame:
    """doc_id, item_id, similarity, start_word, n_words: the best window of each item in each document that has one.

    Texts and items are compared by their words, without case and punctuation.
    Null and empty texts and items match nothing; an item of fewer than 5 words
    matches where all its words occur in a row. Rows that repeat a doc_id (or
    items an item_id) give one row with the best window. Empty tables give an
    empty result; other columns are not read."""
    ids = [docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()]

    def task(batches, items):
        for part in text_slices(batches, "text", 2 << 20):
            got = list(matches(part.column("text"), items))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array([x[0] for x in got], pa.int64())),
                 pa.array([items.ids[x[1]] for x in got], id_type),
                 pa.array([x[2] for x in got], pa.float64()), pa.array([x[3] for x in got], pa.int32()),
                 pa.array([x[4] for x in got], pa.int32())],
                names=["doc_id", "item_id", "similarity", "start_word", "n_words"])

    id_type = pa.string() if ids[1] == "string" else pa.int32() if ids[1] == "int" else pa.int64()
    out = None
    for items in blocks(benchmark, radius, threshold):
        rows = _scan(docs.select("doc_id", "text"), items, task,
                     f"doc_id {ids[0]}, item_id {ids[1]}, similarity double, start_word int, n_words int")
        out = rows if out is None else out.unionAll(rows)
    return out.groupBy("doc_id", "item_id").agg(
        F.max(F.struct("similarity", (-F.col("start_word")).alias("back"), "n_words")).alias("b")).select(
        "doc_id", "item_id", "b.similarity", (-F.col("b.back")).alias("start_word"), "b.n_words")


def remove_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, radius: int = 23) -> DataFrame:
    """The rows of `docs` in which no window is similar to any item; the columns stay."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    text = names[docs.columns.index("text")]

    def task(batches, items):
        for part in text_slices(batches, text, 2 << 20):
            keep = np.ones(part.num_rows, bool)
            keep[[x[0] for x in matches(part.column(text), items)]] = False
            yield part.filter(pa.array(keep))

    out = docs.toDF(*names)
    for items in blocks(benchmark, radius, threshold):
        out = _scan(out, items, task, out.schema)
    return out.toDF(*docs.columns)
