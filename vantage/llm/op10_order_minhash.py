"""Near-duplicates by Order MinHash, verified by banded alignment.

A text is the sequence of its 5-word shingles, each labelled with the number of
equal shingles before it. Each of `bands` hash functions picks the `picks`
labelled shingles with the smallest values and keeps them in text order; two
texts that agree on one such list are candidates. As order counts, agreement
follows edit similarity and not only the shared vocabulary. With similarity J
a list agrees with a chance of about J**picks: at J = 0.8, 3 picks and 16 bands
a pair is missed with a chance of about 1e-5.

Texts with the same words are one class from the start. Between classes,
candidates are verified by a banded alignment of their shingle sequences:
m aligned shingles of a and b give similarity m / (a + b - m). Drift beyond the
band cannot reach the threshold, so the band loses nothing. Links form
connected components, and a component's smallest doc_id names it.

A list that many classes share is never paired in full. First every class of a
list meets one leader, the class that shares most lists with others: in a group
of copies that is the text they were made from, or one close to it. From then on
only lists whose classes do not all lead to one root (along links to leaders)
matter, and only pairs with different roots are compared: all of them in lists of
up to `small` classes; in larger ones with 8 leaders of the list, then all of them in
lists of up to 512 classes and 512 leaders in larger ones, then 32,768, and so on,
until the largest list is done or all its classes have one root. So a comparison is
skipped only if both classes are known to be connected, or
if the counts of shingles and their odd bits (see `odd_bits`) rule the threshold
out.
"""

from __future__ import annotations

from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.llm.common import materialize, text_slices
from vantage.llm.components import components
from vantage.llm.textops import Words, mix64, shingles

SEEDS = 0xC2B2AE3D27D4EB4F
ODD_BITS = 1024


def _fold(h: np.ndarray, offs: np.ndarray, factor: int) -> np.ndarray:
    """Polynomial hash of each run of values (order matters)."""
    out = np.zeros(len(offs) - 1, np.uint64)
    full = np.flatnonzero(np.diff(offs))
    if len(full):
        place = (np.arange(len(h)) - np.repeat(offs[:-1], np.diff(offs))).astype(np.uint64)
        out[full] = np.add.reduceat(mix64(h + place * np.uint64(factor)), offs[full])
    return mix64(out + np.diff(offs).astype(np.uint64))


def _labelled(h: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Shingle hashes with their occurrence number inside the text mixed in."""
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    order = np.argsort(mix64(h + (doc.astype(np.uint64) << np.uint64(32))), kind="stable")
    same = np.zeros(len(h), bool)
    same[1:] = (h[order][1:] == h[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    run = np.arange(len(h))
    first = np.maximum.accumulate(np.where(same, 0, run))
    nth = np.zeros(len(h), np.uint64)
    nth[order] = run - first
    return mix64(h + nth * np.uint64(SEEDS))


def odd_bits(labelled: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """For each of `ODD_BITS` parts of the labelled shingles, whether the text holds an odd number: (texts, longs).

    A shingle that only one of two texts holds turns one bit, so the bits in
    which two texts differ are no more than the shingles in which they differ."""
    owner = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    part = (labelled & np.uint64(ODD_BITS - 1)).astype(np.int64)
    odd = np.bincount(owner * ODD_BITS + part, minlength=(len(offs) - 1) * ODD_BITS).astype(np.uint8) & 1
    return np.packbits(odd.reshape(-1, ODD_BITS), axis=1).view(np.int64)


def sketch(labelled: np.ndarray, offs: np.ndarray, bands: int, picks: int) -> np.ndarray:
    """Order MinHash lists of non-empty runs, each folded into one value: (texts, bands)."""
    n = np.diff(offs)
    out = np.zeros((len(n), bands), np.uint64)
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    for b in range(bands):
        v = mix64(labelled ^ np.uint64((SEEDS * (2 * b + 1)) & 0xFFFFFFFFFFFFFFFF))
        where = []
        for _ in range(picks):
            least = np.minimum.reduceat(v, offs[:-1])
            hit = np.flatnonzero(v == np.repeat(least, n))
            at = np.full(len(n), len(labelled))
            at[np.searchsorted(offs, hit, "right")[::-1] - 1] = hit[::-1]
            v[at] = top
            where.append(at)
        spots = np.sort(np.array(where), axis=0)  # text order
        for at in spots:  # texts with fewer shingles repeat a spot: it stays the same list
            out[:, b] = mix64(out[:, b] * np.uint64(0x9E3779B97F4A7C15) + labelled[at])
    return out


def _keys(words: Words) -> list[bytes | None]:
    """16 bytes that name each text's word sequence; None without words."""
    key = np.empty((len(words.offsets) - 1, 2), ">u8")
    key[:, 0] = _fold(words.hash, words.offsets, 0x632BE59BD9B4E019)
    key[:, 1] = _fold(words.hash, words.offsets, 0xA0761D6478BD642F)
    return [x.tobytes() if m else None for x, m in zip(key, np.diff(words.offsets))]


def signatures(docs: DataFrame, bands: int, picks: int, k: int) -> DataFrame:
    """doc_id, tag (a hash of the text), key (16 bytes: its words; null without any word), n (shingles), lists, odd."""

    def sign(batches):
        for part in text_slices(batches, "text", 2 << 20):
            words = Words(part.column("text"))
            h, offs = shingles(words, k)
            n = np.diff(offs)
            full = np.flatnonzero(n)
            lists, odd = np.zeros((len(n), bands), np.uint64), np.zeros((len(n), ODD_BITS // 64), np.int64)
            if len(full):
                ends = np.concatenate([[0], np.cumsum(n[full])])
                labelled = _labelled(h, ends)
                lists[full], odd[full] = sketch(labelled, ends, bands, picks), odd_bits(labelled, ends)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("tag"), pa.array(_keys(words), pa.binary()), pa.array(n.astype(np.int32)),
                 *(pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * x.shape[1]),
                                            pa.array(x.ravel().view(np.int64))) for x in (lists, odd))],
                names=["doc_id", "tag", "key", "n", "lists", "odd"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", F.xxhash64("text").alias("tag")).mapInArrow(
        sign, f"doc_id {kind}, tag long, key binary, n int, lists array<long>, odd array<long>")


def aligned(a: np.ndarray, b: np.ndarray, threshold: float) -> int:
    """Shingles that a banded alignment matches, or -1 if the threshold is out of reach."""
    need = int(np.ceil(threshold / (1 + threshold) * (len(a) + len(b)) - 1e-9))
    least = min(len(a), len(b))
    if least < need:
        return -1
    differ = np.flatnonzero(a[:least] != b[:least])
    head = int(differ[0]) if len(differ) else least
    ra, rb, left = a[::-1], b[::-1], least - head
    differ = np.flatnonzero(ra[:left] != rb[:left])
    tail = int(differ[0]) if len(differ) else left
    a, b = a[head:len(a) - tail], b[head:len(b) - tail]
    if head + tail + min(len(a), len(b)) < need:
        return -1
    if not len(a) or not len(b):
        return head + tail
    values, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    ia, ib = where[:len(a)], where[len(a):]
    common = np.minimum(np.bincount(ia, minlength=len(values)), np.bincount(ib, minlength=len(values))).sum()
    if head + tail + common < need:
        return -1
    drift = head + tail + len(a) + head + tail + len(b) - 2 * need  # unmatched shingles that the threshold allows
    at: dict[int, list[int]] = {}
    for j, s in enumerate(ib.tolist()):
        at.setdefault(s, []).append(j)
    # Bit-parallel alignment: bit j of `row` is 0 where the row's best count steps up at column low + j.
    width = 2 * drift + 1
    ones = (1 << width) - 1
    row, low, found = ones, -drift, 0
    for s in ia.tolist():
        mask = 0
        for j in at.get(s, ()):
            if low <= j < low + width:
                mask |= 1 << (j - low)
        if mask:
            u = row & mask
            row = ((row + u) | (row - u)) & ones
        found += not row & 1
        row = (row >> 1) | (1 << (width - 1))
        low += 1
    return head + tail + found + (ones & ~row).bit_count()


def _tokens(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """key, seq (32 bits of each word's hash, in text order) of the classes in `wanted` (w_id, w_tag, key)."""

    def cut(batches):
        done = set()  # of a row that repeats a task passes on one copy
        for part in text_slices(batches, "text", 2 << 20):
            words = Words(part.column("text"))
            raw = (words.hash >> np.uint64(32)).astype(np.uint32).tobytes()
            keys, seqs = [], []
            for key, s, e in zip(part.column("key").to_pylist(), words.offsets, words.offsets[1:]):
                if key not in done:
                    done.add(key)
                    keys.append(key)
                    seqs.append(raw[4 * s:4 * e])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(seqs, pa.binary())],
                                             names=["key", "seq"])

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("tag"))
    same = F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("tag") == F.col("w_tag"))
    return rows.join(wanted, same).select("text", "key").mapInArrow(cut, "key binary, seq binary")


def _runs(seq, k: int) -> np.ndarray:
    """Values of the runs of k words (one of all words, if there are fewer)."""
    w = np.frombuffer(seq, np.uint32).astype(np.uint64)
    k = min(k, len(w))
    h = np.zeros(len(w) - k + 1, np.uint64)
    for j in range(k):
        h = mix64(h + w[j:len(w) - k + 1 + j] + np.uint64(1))
    return h


def similarity(x: np.ndarray, y: np.ndarray, threshold: float) -> float:
    """Aligned shingles over all shingles of both; 0 if it is below the threshold."""
    m = aligned(x, y, threshold)
    return m / (len(x) + len(y) - m) if m >= 0 and m >= threshold * (len(x) + len(y) - m) - 1e-9 else 0.0


def _verify(pairs: DataFrame, tokens: DataFrame, threshold: float, k: int) -> DataFrame:
    """The pairs (key, leader, w), each with `good`: whether its alignment reaches the threshold."""

    def check(batches):
        for part in batches:
            good = [similarity(_runs(x.as_buffer(), k), _runs(y.as_buffer(), k), threshold) > 0
                    for x, y in zip(part.column("a"), part.column("b"))]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("key", "leader", "w")), pa.array(good, pa.bool_())],
                                             names=["key", "leader", "w", "good"])

    a = tokens.select("key", F.col("seq").alias("a"))
    b = tokens.select(F.col("key").alias("leader"), F.col("seq").alias("b"))
    return pairs.join(a, "key").join(b, "leader").select("key", "leader", "w", "a", "b").mapInArrow(
        check, "key binary, leader binary, w long, good boolean")


def _near(threshold: float):
    """Whether two classes can reach the threshold at all, by their shingle counts n and m and their odd bits.

    Similarity t leaves (n + m) (1 - t) / (1 + t) shingles that only one of them has, at most."""
    differ = reduce(add, (F.bit_count(F.col("odd")[i].bitwiseXOR(F.col("far_odd")[i])) for i in range(ODD_BITS // 64)))
    return (F.least("n", "m") >= F.greatest("n", "m") * threshold - 1e-9) & (
        differ <= (F.col("n") + F.col("m")) * ((1 - threshold) / (1 + threshold)) + 1e-9)


def _pairs(members: DataFrame, cap: int, slots: int, threshold: float) -> DataFrame:
    """(key, leader, w) across roots: all pairs of lists of up to `cap` classes; in larger ones each class
    with one leader for each of `slots` parts of the list. The heavier class of a pair is its leader."""
    own = ("weight", "key", "n", "root", "odd")
    slot = F.pmod(F.xxhash64("key", F.lit(slots)), F.lit(slots))
    led = members.where(F.col("size") > cap).groupBy("band", "list", slot.alias("slot")).agg(F.max(F.struct(*own)).alias("lead"))
    leaders = led.select("band", "list", "lead.*").unionAll(members.where(F.col("size") <= cap).select("band", "list", *own)).toDF(
        "band", "list", "w", "leader", "m", "far", "far_odd")
    up = (F.col("w") > F.col("weight")) | ((F.col("w") == F.col("weight")) & (F.col("leader") > F.col("key")))
    return members.join(leaders, ["band", "list"]).where(
        (F.col("far") != F.col("root")) & (up | (F.col("size") > cap)) & _near(threshold)).select(
        F.when(up, F.col("key")).otherwise(F.col("leader")).alias("key"),
        F.when(up, F.col("leader")).otherwise(F.col("key")).alias("leader"), F.greatest("w", "weight").alias("w"))


def _roots(links: DataFrame) -> DataFrame:
    """(key, root): where up to three steps lead from each linked class, each to its heaviest leader.

    Classes with one root are connected; connected ones may still have two."""
    up = links.groupBy("key").agg(F.max(F.struct("w", "leader")).alias("up")).select("key", F.col("up.leader").alias("root"))
    on = up.select(F.col("key").alias("root"), F.col("root").alias("next"))
    for _ in range(2):
        up = up.join(on, "root", "left").select("key", F.coalesce("next", "root").alias("root"))
    return up


def _members(sharing: DataFrame, cap: int) -> DataFrame:
    """A row for each class and each of its lists of more than `cap` classes."""
    return sharing.select(*(c for c in sharing.columns if c != "lists"), F.inline("lists")).where(F.col("size") > cap)


def near_duplicates(docs: DataFrame, threshold: float = 0.8, k: int = 5, bands: int = 16, picks: int = 3,
                    small: int = 16) -> tuple[DataFrame, DataFrame]:
    """(membership, links): doc_id, tag, class_id, kept of every row; verified links between classes (key, leader).

    class_id is the smallest doc_id of the class. Texts with the same words
    share a class from the start. A text without words (null, empty) is never a
    duplicate: its class is its own doc_id. A text of fewer than k words has
    one shingle of all its words. `kept` marks the row that stands for its
    class; rows that repeat both doc_id and text of that row are marked too.
    Rows that repeat a doc_id with another text are told apart by `tag`, a hash
    of the text. A null doc_id is smaller than any other. Other columns of
    `docs` are not read."""
    signed = materialize(signatures(docs, bands, picks, k), "signed")
    one = F.min(F.struct("doc_id", "tag"))
    classes = materialize(signed.where(F.col("key").isNotNull()).groupBy("key").agg(
        one.alias("rep"), F.first("n").alias("n"), F.first("lists").alias("lists"), F.first("odd").alias("odd")), "classes")
    lists = classes.select("key", F.posexplode("lists").alias("band", "list"))
    shared = lists.groupBy("band", "list").agg(F.count("*").alias("size")).where("size > 1")
    met = lists.join(shared, ["band", "list"]).groupBy("key").agg(
        F.sum("size").alias("weight"), F.collect_list(F.struct("band", "list", "size")).alias("lists"))
    sharing = materialize(classes.drop("lists").join(met, "key"), "sharing")  # a row for each class that shares a list
    tokens = materialize(_tokens(docs, sharing.select(
        F.col("rep.doc_id").alias("w_id"), F.col("rep.tag").alias("w_tag"), "key")), "tokens")
    sharing = sharing.drop("rep")
    largest = sharing.agg(F.max(F.array_max(F.transform("lists", lambda x: x["size"])))).first()[0] or 0
    members = _members(sharing.withColumn("root", F.col("key")), 1)
    tried, cap, slots = None, 1, 1
    while True:
        pairs = _pairs(members, cap, slots, threshold)
        if tried is None:
            fresh = pairs.distinct()
        else:  # a pair always has the same leader: the one with more weight
            fresh = pairs.withColumn("old", F.lit(False)).unionAll(
                tried.select("key", "leader", "w", F.lit(True).alias("old"))).groupBy("key", "leader", "w").agg(
                F.max("old").alias("old")).where(~F.col("old")).drop("old")
        checked = materialize(_verify(fresh, tokens, threshold, k), "checked")
        tried = checked if tried is None else tried.unionAll(checked)
        links = tried.where("good").drop("good")
        if slots > 1 and cap >= largest:
            break
        rest = 1 if slots == 1 else cap  # lists of up to so many classes are done
        cap, slots = (small, 8) if slots == 1 else (slots * 64, slots * 64)
        led = sharing.join(_roots(links), "key", "left").withColumn("root", F.coalesce("root", "key"))
        now = _members(led, rest)
        open_ = now.groupBy("band", "list").agg(F.min("root").alias("_a"), F.max("root").alias("_z")).where("_a != _z")
        members = materialize(now.join(open_.select("band", "list"), ["band", "list"]), "members")
        if members.limit(1).count() == 0:
            break
    roots = components(links, "key", "leader")
    named = classes.select("key", "rep").join(roots.withColumnRenamed("node", "key"), "key", "left").select(
        "key", "rep", F.coalesce("root", "key").alias("root"))
    names = named.groupBy("root").agg(F.min("rep").alias("best"))
    by_key = materialize(named.join(names, "root").select("key", "best"), "class-names")
    own = F.struct("doc_id", "tag")
    member = signed.select("doc_id", "tag", "key").join(by_key, "key", "left").select(
        "doc_id", "tag", F.when(F.col("best").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("class_id"),
        (F.col("best").isNull() | own.eqNullSafe(F.col("best"))).alias("kept"))
    return member, links


def classes(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """doc_id, class_id and kept (see `near_duplicates`) of every row of `docs`."""
    return near_duplicates(docs, threshold)[0].select("doc_id", "class_id", "kept")


def keep_representatives(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """One row of `docs` for each near-duplicate class; the columns stay.

    The row that `near_duplicates` marks stays, once if it repeats. Texts
    without words are no duplicates: they stay, once for each doc_id."""
    names = [f"_c{i}" for i in range(len(docs.columns))]  # no column can clash
    doc_id, text = (names[docs.columns.index(c)] for c in ("doc_id", "text"))
    stay = near_duplicates(docs, threshold)[0].where("kept").select(F.col("doc_id").alias("_id"), F.col("tag").alias("_tag"))
    rows = docs.toDF(*names).withColumn("_own", F.xxhash64(text))
    same = F.col(doc_id).eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_tag"))
    return rows.join(stay.distinct(), same, "left_semi").dropDuplicates([doc_id, "_own"]).drop("_own").toDF(*docs.columns)
