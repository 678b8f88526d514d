"""Suffix-array dedup: remove every byte covered by a string of `length` bytes that starts earlier too.

Sorting all suffixes of a corpus would shuffle each byte many times over, so
suffixes are sorted in buckets that are found first:

1. Every window of `length` bytes has an anchor: the leftmost of its
   `gram`-byte grams with the least hash. Equal windows have equal anchor
   grams at equal offsets. Neighbouring windows share an anchor, so a text has
   one *region* (the bytes of all windows of an anchor) for each 30 to 35 bytes.
2. Regions meet by the hash of their anchor gram. A region equal to an earlier
   one is removed whole; tasks settle such copies among their own regions
   first, so that a group of copies sends one row for each task. What remains
   are anchors with several different regions: the ends of repeated passages.
3. The bytes of the first region of each kind are fetched. Their suffixes (one
   for each window) are sorted within (gram, offset) buckets by a mergesort
   whose comparisons find the common extension of two suffixes by binary
   search over prefix polynomial hashes; neighbours that share `length` bytes
   are verified byte by byte, and all but the earliest are removed. Every
   group of regions goes this way: it is dealt by hash over parts of about
   `hot` different regions, so that no task sorts a hot group whole, and the first window
   of each kind in a part then meets those of the group's other parts by its
   bytes (a group of one part has no others).

A region is named by two independent 64-bit hashes (its gram's and its own).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vantage.llm.common import materialize, text_slices
from vantage.llm.textops import U64, PrefixHash, mix64, utf8

NO_ID = -(1 << 63)               # stands for a null doc_id: it comes first
RANGE = (1 << 14) - 1            # low bits of `at` in rows that are settled ranges
POS_BITS = 28
FLUSH = 1_000_000                # regions that a task settles among themselves at a time
np.seterr(over="ignore")         # hashes wrap on purpose


def identified(docs: DataFrame) -> DataFrame:
    """doc (NO_ID for null), tag (64-bit hash of the text: tells apart texts that share a doc_id), text ('' for null)."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
                       F.xxhash64("text").alias("tag"), F.coalesce("text", F.lit("")).alias("text"))


def pack(low, to_anchor, more):
    """First window's start, anchor's offset from it, further windows: in one long that sorts by start."""
    return (low << 14) | (to_anchor << 7) | more


def regions(data: np.ndarray, offs: np.ndarray, length: int, gram: int):
    """(text index, first window, anchor, last window, gram hash, region hash) of each region."""
    n, width = len(data), length - gram + 1
    if n < length:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.astype(U64), none.astype(U64)
    if n >> POS_BITS:
        raise ValueError("a text is longer than 256 MB")
    first = PrefixHash(data, 1)
    g = mix64((first.prefix[gram:] - first.prefix[:-gram]) * first.inv[:n - gram + 1])
    least = (g >> U64(POS_BITS) << U64(POS_BITS)) | np.arange(len(g), dtype=U64)  # ties: the leftmost
    span = 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[:len(least) - (width - span)], least[width - span:])
    anchor = (least & U64((1 << POS_BITS) - 1)).astype(np.int64)
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(offs))[:len(anchor)]
    end = offs[1:][doc] - length
    opens = np.ones(len(anchor), bool)
    opens[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    low = np.flatnonzero(opens & (np.arange(len(anchor)) <= end))
    nxt = np.append(np.flatnonzero(opens), len(anchor))
    high = np.minimum(nxt[np.searchsorted(nxt, low, "right")] - 1, end[low])
    own = mix64(PrefixHash(data, 2).of(low, high + length)
                + (((anchor[low] - low).astype(U64) << U64(8)) | (high - low).astype(U64)) * U64(0x9E3779B97F4A7C15))
    return doc[low], low, anchor[low], high, g[anchor[low]], own


def _merge_ranges(doc, tag, start, end):
    """Join ranges that overlap or touch: arrays of doc, tag, start, end."""
    order = np.lexsort((start, tag, doc))
    doc, tag, start, end = doc[order], tag[order], start[order], end[order]
    if not len(doc):
        return doc, tag, start, end
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])
    base = (np.cumsum(new) - 1).astype(np.int64) << 32
    reach = np.maximum.accumulate(base + end)
    new[1:] |= (base + start)[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return doc[at], tag[at], start[at], (reach - base)[np.append(at[1:], len(doc)) - 1]


ROW = "gh long, rh long, doc long, tag long, at long"


def _rows(gh, rh, doc, tag, at):
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x).view(np.int64)) for x in (gh, rh, doc, tag, at)],
                                      names=["gh", "rh", "doc", "tag", "at"])


def _range_rows(doc, tag, start, end):
    """Settled ranges in the layout of region rows: rh holds the bytes covered, gh spreads them."""
    return _rows(mix64(doc.astype(U64) * U64(31) + tag.astype(U64) + start.astype(U64)), end - start, doc, tag,
                 pack(start, 0, RANGE))


def _settle(found: list, length: int):
    """Of equal regions the earliest goes on; the others become settled ranges."""
    gh, rh, doc, tag, at = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((at, tag, doc, rh, gh))
    gh, rh, doc, tag, at = gh[order], rh[order], doc[order], tag[order], at[order]
    same = np.zeros(len(gh), bool)
    same[1:] = (gh[1:] == gh[:-1]) & (rh[1:] == rh[:-1])
    again = same.copy()  # the same region of a row that repeats: neither earlier nor later
    again[1:] &= (doc[1:] == doc[:-1]) & (tag[1:] == tag[:-1]) & (at[1:] == at[:-1])
    yield _rows(gh[~same], rh[~same], doc[~same], tag[~same], at[~same])
    later = same & ~again
    doc, tag, at = doc[later], tag[later], at[later]
    start = at >> 14
    yield _range_rows(*_merge_ranges(doc, tag, start, start + (at & 127) + length))


def _region_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def find(batches):
        found, held = [], 0
        for part in text_slices(batches, "text", 2 << 20):
            data, offs = utf8(part.column("text"))
            ids, tags = part.column("doc").to_numpy(), part.column("tag").to_numpy()
            i, low, anchor, high, gh, rh = regions(data, offs, length, gram)
            at = pack(low - offs[i], anchor - low, high - low)
            found.append((gh, rh, ids[i], tags[i], at))
            held += len(gh)
            if held > FLUSH:
                yield from _settle(found, length)
                found, held = [], 0
        if found:
            yield from _settle(found, length)

    return docs.mapInArrow(find, ROW)


# ---- the suffix sort ---------------------------------------------------------

def _extension(h: PrefixHash, x: np.ndarray, y: np.ndarray, most: int) -> np.ndarray:
    """Length of the common extension of the suffixes at x and y, `most` at most: binary search over prefix hashes."""
    low, high = np.zeros(len(x), np.int64), np.full(len(x), most)
    for _ in range(int(most).bit_length()):
        mid = (low + high + 1) >> 1
        same = h.of(x, x + mid) == h.of(y, y + mid)
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    return low


def suffix_sort(data: np.ndarray, h: PrefixHash, start: np.ndarray, bucket: np.ndarray, most: int) -> np.ndarray:
    """Order of the suffixes at `start` (by their first `most` bytes) within runs of equal `bucket` (ascending).

    A bottom-up mergesort of all buckets in step: each suffix finds its rank in
    the neighbouring run by binary search, and each comparison finds the common
    extension by binary search, so both are logarithmic."""
    n = len(start)
    order = np.arange(n)
    opens = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if n else np.zeros(0, np.int64)
    size = np.diff(np.append(opens, n))
    base, room = np.repeat(opens, size), np.repeat(size, size)
    place = np.arange(n) - base
    run = 1
    while n and run < size.max():
        side = place // run
        sib = (side ^ 1) * run
        act = np.flatnonzero((room > run) & (sib < room))
        own, left = start[order[act]], side[act] % 2 == 0
        low = np.zeros(len(act), np.int64)
        high = np.minimum(run, room[act] - sib[act])
        sib_at = base[act] + sib[act]
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            mid = (low[open_] + high[open_]) >> 1
            x, y = own[open_], start[order[sib_at[open_] + mid]]
            ext = _extension(h, x, y, most)
            cut = ext >= most
            bx, by = data[np.where(cut, 0, x + ext)], data[np.where(cut, 0, y + ext)]
            before = np.where(cut, ~left[open_], by < bx)  # the other one comes before this one (ties: left first)
            low[open_] = np.where(before, mid + 1, low[open_])
            high[open_] = np.where(before, high[open_], mid)
        target = np.arange(n)
        target[act] = base[act] + np.minimum(side[act], side[act] ^ 1) * run + place[act] % run + low
        moved = np.empty(n, order.dtype)
        moved[target] = order
        order = moved
        run *= 2
    return order


def repeated_windows(ctx: list[bytes], group: np.ndarray, doc: np.ndarray, tag: np.ndarray, at: np.ndarray,
                     length: int, parted: np.ndarray | None = None):
    """Ranges (doc, tag, start, end) of the windows of the regions `ctx` that an earlier region of their group has too,
    and (region, start in its text, bytes) of the first window of each kind in the regions that are `parted`."""
    sizes = np.array([len(c) for c in ctx])
    data = np.frombuffer(b"".join(ctx), np.uint8)
    first = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    low, to_anchor, wins = at >> 14, (at >> 7) & 127, (at & 127) + 1
    rep = np.repeat(np.arange(len(at)), wins)
    p = np.arange(len(rep)) - np.repeat(np.cumsum(wins) - wins, wins)
    bucket = (np.unique(group, return_inverse=True)[1][rep].astype(np.int64) << 7) | (to_anchor[rep] - p)
    by = np.argsort(bucket, kind="stable")
    counts = np.bincount(np.unique(bucket, return_inverse=True)[1])
    alone = np.repeat(counts, counts) == 1  # a window alone in its bucket has no equal here
    single, by = by[alone], by[~alone]
    single = (rep[single], p[single])
    rep, p, bucket = rep[by], p[by], bucket[by]
    start = first[rep] + p
    for seed in range(3, 99):  # another seed if two different windows ever share a hash
        h = PrefixHash(data, seed)
        order = suffix_sort(data, h, start, bucket, length)
        s, b = start[order], bucket[order]
        same = np.zeros(len(s), bool)
        same[1:] = (b[1:] == b[:-1]) & (h.of(s[1:], s[1:] + length) == h.of(s[:-1], s[:-1] + length))
        hit = np.flatnonzero(same)
        if all((data[s[q][:, None] + np.arange(length)] == data[s[q - 1][:, None] + np.arange(length)]).all()
               for q in np.array_split(hit, len(hit) // 65536 + 1)):
            break
    rep, p = rep[order], p[order]
    rank = np.lexsort((tag, doc))
    fresh = np.ones(len(rank), np.int64)
    fresh[1:] = (doc[rank][1:] != doc[rank][:-1]) | (tag[rank][1:] != tag[rank][:-1])
    place = np.empty(len(rank), np.int64)
    place[rank] = np.cumsum(fresh)
    key = (place[rep] << 32) | (low[rep] + p)
    opens = np.flatnonzero(~same)
    later = np.zeros(len(key), bool)
    if len(key):
        least = np.repeat(np.minimum.reduceat(key, opens), np.diff(np.append(opens, len(key))))
        later = key > least
    r, q = rep[later], low[rep[later]] + p[later]
    found = _merge_ranges(doc[r], tag[r], q, q + length)
    if parted is None or not parted.any():
        return found, (np.zeros(0, np.int64), np.zeros(0, np.int64), [])
    r, q = np.concatenate([rep[~later], single[0]]), np.concatenate([p[~later], single[1]])
    r, q = r[parted[r]], q[parted[r]]
    raw = data.tobytes()
    return found, (r, low[r] + q, [raw[x:x + length] for x in (first[r] + q).tolist()])


# ---- the Spark plan ----------------------------------------------------------

def _one_of_each(rows: DataFrame) -> DataFrame:
    """doc, tag, text, copies: rows that repeat doc_id and text are one, so that no id or text is hot in a join."""
    return rows.groupBy("doc", "tag").agg(F.first("text").alias("text"), F.count("*").alias("copies"))


def _contexts(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """gh, doc, tag, at, parts, ctx (the region's bytes) of the wanted regions (gh, doc, tag, at, parts)."""

    def cut(batches):
        for part in text_slices(batches, "text", 2 << 20):
            data, offs = utf8(part.column("text"))
            raw, lists = data.tobytes(), part.column("wanted")
            owner = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
            values = lists.flatten()
            at = values.field("at").to_numpy()
            low = offs[owner] + (at >> 14)
            high = low + (at & 127) + length
            yield pa.RecordBatch.from_arrays(
                [values.field("gh"), part.column("doc").take(pa.array(owner)), part.column("tag").take(pa.array(owner)),
                 pa.array(at), values.field("parts"),
                 pa.array([raw[s:e] for s, e in zip(low.tolist(), high.tolist())], pa.binary())],
                names=["gh", "doc", "tag", "at", "parts", "ctx"])

    listed = wanted.groupBy("doc", "tag").agg(F.collect_list(F.struct("gh", "at", "parts")).alias("wanted"))
    return _one_of_each(docs).join(listed, ["doc", "tag"]).select("doc", "tag", "text", "wanted").mapInArrow(
        cut, "gh long, doc long, tag long, at long, parts long, ctx binary")


def _by_suffix_sort(ctx: DataFrame, length: int) -> DataFrame:
    """Settled ranges of the regions that share an anchor gram, and with their bytes (`win`) the first windows of each
    kind of groups that have several parts. The partitions hold whole parts of groups in order."""

    def solve(batches):
        def done(rows):
            group, part, parts, doc, tag, at = (np.array(x, np.int64) for x in zip(*[r[:6] for r in rows]))
            new = np.ones(len(rows), np.int64)
            new[1:] = (group[1:] != group[:-1]) | (part[1:] != part[:-1])
            found, (r, at_byte, raw) = repeated_windows([r[6] for r in rows], np.cumsum(new), doc, tag, at, length,
                                                        parts > 1)
            for out, win in ((_range_rows(*found), None),
                             (_rows(group[r], np.zeros(len(r), np.int64), doc[r], tag[r], pack(at_byte, 0, 0)), raw)):
                win = pa.nulls(out.num_rows, pa.binary()) if win is None else pa.array(win, pa.binary())
                yield pa.RecordBatch.from_arrays([*out.columns, win], names=[*out.schema.names, "win"])

        rows: list = []
        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("gh", "part", "parts", "doc", "tag", "at", "ctx"))):
                if len(rows) >= 8_192 and r[:2] != rows[-1][:2]:
                    yield from done(rows)
                    rows = []
                rows.append(r)
        if rows:
            yield from done(rows)

    dealt = ctx.withColumn("part", F.pmod(F.xxhash64("doc", "tag", "at"), F.col("parts")))
    return (dealt.select("gh", "part", "parts", "doc", "tag", "at", "ctx").repartition("gh", "part")
            .sortWithinPartitions("gh", "part").mapInArrow(solve, ROW + ", win binary"))


def _between_parts(firsts: DataFrame) -> DataFrame:
    """Windows that an earlier part's first window equals, byte by byte; a kind has one row for each part at most."""
    by = Window.partitionBy("gh", "win").orderBy("doc", "tag", "at")
    return firsts.withColumn("_nth", F.row_number().over(by)).where("_nth > 1").select("gh", "rh", "doc", "tag", "at")


def find_repeats(docs: DataFrame, length: int = 100, gram: int = 32, hot: int = 8_192) -> DataFrame:
    """doc, tag, at, span: ranges of bytes to remove (they may overlap) of rows (doc, tag, text)."""
    rows = _region_rows(docs, length, gram)
    by = Window.partitionBy("gh").orderBy("rh", "doc", "tag", "at")
    whole = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    settled = F.col("at").bitwiseAND(F.lit(RANGE)) == RANGE
    was = F.lag(F.struct("rh", "doc", "tag", "at")).over(by)
    kinds = (rows.withColumns({"_was": was, "_n": F.count("*").over(whole), "_least": F.first("rh").over(whole),
                               "_most": F.last("rh").over(whole)})
             .where(settled | (F.col("_n") > 1))
             .where(settled | F.col("_was").isNull() | (F.col("_was") != F.struct("rh", "doc", "tag", "at")))
             .withColumn("later", settled | F.coalesce(F.col("_was.rh") == F.col("rh"), F.lit(False)))
             .where(F.col("later") | (F.col("_least") != F.col("_most")))
             .withColumn("_kinds", F.count(F.when(~F.col("later"), 1)).over(Window.partitionBy("gh")))
             .select("gh", "rh", "doc", "tag", "at", "later", F.ceil(F.col("_kinds") / hot).alias("parts")))
    kinds = materialize(kinds, "regions")
    wanted = kinds.where("not later").select("gh", "doc", "tag", "at", "parts")
    ctx = materialize(_contexts(docs, wanted, length), "contexts")
    sorted_ = materialize(_by_suffix_sort(ctx, length), "sorted")
    found = (kinds.where("later").select("gh", "rh", "doc", "tag", "at")
             .unionAll(sorted_.where("win is null").select("gh", "rh", "doc", "tag", "at"))
             .unionAll(_between_parts(sorted_.where("win is not null"))))
    covered = F.when(F.col("at").bitwiseAND(F.lit(RANGE)) == RANGE, F.col("rh")).otherwise(
        F.col("at").bitwiseAND(F.lit(127)) + length)
    return found.select("doc", "tag", "at", covered.alias("span"))


def _cut(rows: DataFrame, spans: DataFrame, with_text: bool) -> DataFrame:
    """What is left of every row of `rows`; `_nth` counts the rows that repeat doc_id and text."""

    def cut(batches):
        for part in text_slices(batches, "text", 4 << 20):
            data, offs = utf8(part.column("text"))
            lists = part.column("spans")
            owner = np.repeat(np.arange(part.num_rows), pc.fill_null(lists.value_lengths(), 0).to_numpy(
                zero_copy_only=False))
            values = lists.flatten()
            at = values.field("at").to_numpy()
            low = offs[owner] + (at >> 14)
            edge = np.zeros(len(data) + 1, np.int64)
            np.add.at(edge, low, 1)
            np.add.at(edge, low + values.field("span").to_numpy(), -1)
            gone = np.cumsum(edge[:-1]) > 0
            opens = gone.copy()
            opens[1:] &= ~gone[:-1]
            first = offs[:-1][np.diff(offs) > 0]
            opens[first] = gone[first]
            n_gone, n_open = (np.concatenate([[0], np.cumsum(x)])[offs] for x in (gone, opens))
            kept = [data[s:e][~gone[s:e]].tobytes() for s, e in zip(offs, offs[1:])]
            columns = [part.column("doc"), part.column("copies"), pa.array(np.diff(offs)), pa.array(np.diff(n_gone)),
                       pa.array(np.diff(n_open)), pa.array([hashlib.sha256(x).hexdigest() for x in kept])]
            names = ["doc", "copies", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                columns, names = [*columns, pa.array(kept, pa.binary())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    # a set: each task that holds a copy of a row settles the same ranges
    listed = spans.groupBy("doc", "tag").agg(F.collect_set(F.struct("at", "span")).alias("spans"))
    cuts = _one_of_each(rows).join(listed, ["doc", "tag"], "left").select("doc", "copies", "text", "spans").mapInArrow(
        cut, "doc long, copies long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
        + ", kept binary" * with_text)
    return cuts.withColumn("_nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copies")


def remove_repeats(docs: DataFrame, length: int = 100, gram: int = 32, hot: int = 8_192,
                   with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and the kept bytes) of every row of `docs` (doc_id, text).

    A null text is empty; a null doc_id comes before all others. Of rows that
    repeat doc_id and text the first keeps its bytes, and the others lose all
    (texts shorter than `length` lose nothing). Texts that share a doc_id are
    told apart and ordered by a 64-bit hash of the text. Texts are limited to 256 MB each. Other
    columns are not read; an empty table gives an empty result."""
    if not gram <= length <= gram + 126:
        raise ValueError("length must be from gram to gram + 126")
    rows = identified(docs)
    cut = _cut(rows, find_repeats(rows, length, gram, hot), with_text)
    again = (F.col("_nth") > 1) & (F.col("n_bytes") >= length)
    rest = {"n_removed": F.when(again, F.col("n_bytes")).otherwise(F.col("n_removed")),
            "n_spans": F.when(again, F.lit(1).cast("long")).otherwise(F.col("n_spans")),
            "kept_sha256": F.when(again, hashlib.sha256(b"").hexdigest()).otherwise(F.col("kept_sha256"))}
    if with_text:
        rest["kept"] = F.when(again, F.lit(b"")).otherwise(F.col("kept"))
    out = cut.withColumns(rest)
    return out.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "n_bytes", *rest)
