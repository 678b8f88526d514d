"""Substring dedup by sliding sentence spans.

Every run of `run` consecutive sentences is hashed (its words, without case
and punctuation) and met globally; sentences covered by a run that occurred
earlier are removed. Runs shorter than `min_words` words are extended by
further sentences until they have as many, so that exclamations of a word or
two do not count as passages. Sentences of more than `piece` words are cut at
content-defined words: at each word whose hash is the least of some group of
3/4 `piece` words in a row (the leftmost, if equal) inside the sentence. Equal
words are cut alike whatever stands before them, no piece is longer than the
group, and so of 3 * `piece` equal words without a full stop all but a group at
either end is found, at any offset. A passage that starts within a sentence of
at most `piece` words is found from the next sentence on.
Repeats are judged on the input, within and across documents, in order of
doc_id and position.

A task settles copies among its own runs first and passes on one row for each
run that it met; a run that a third of all documents contain costs one row for
each task in the shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vantage.llm.common import text_slices
from vantage.llm.op5_suffix_dedup import NO_ID, POS_BITS, RANGE, _cut, _merge_ranges, identified, pack
from vantage.llm.textops import U64, Words, mix64, run_hash, wide_characters

ENDS = np.zeros(256, bool)
ENDS[[ord(c) for c in ".!?\n"]] = True
WIDE_ENDS = [ord(c) for c in "\u3002\uff01\uff0e\uff1f\uff61\u2026\u061f\u06d4\u0964\u0965\u0589\u1362\u104b\u17d4"]
ROW = "h1 long, h2 long, doc long, tag long, at long, span long"
FLUSH = 1_000_000


def content_cuts(h: np.ndarray, opens: np.ndarray, piece: int) -> np.ndarray:
    """Words (hashes h; sentences start at `opens`) at which sentences of more than `piece` words are cut."""
    n, width = len(h), max(1, piece * 3 // 4)
    cuts = np.zeros(n, bool)
    if n <= piece:
        return cuts
    least = (h >> U64(POS_BITS) << U64(POS_BITS)) | np.arange(n, dtype=U64)  # ties: the leftmost
    span = 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[:len(least) - (width - span)], least[width - span:])
    sentence = np.cumsum(opens) - 1
    long = np.bincount(sentence)[sentence] > piece
    own = long[:len(least)] & (sentence[:len(least)] == sentence[width - 1:])
    cuts[(least[own] & U64((1 << POS_BITS) - 1)).astype(np.int64)] = True
    return cuts


def grid_cuts(h: np.ndarray, opens: np.ndarray, piece: int) -> np.ndarray:
    """Every `piece`-th word of each sentence: the former rule, which misses passages at other offsets."""
    at = np.arange(len(h))
    return (at - np.maximum.accumulate(np.where(opens, at, 0))) % piece == 0


CUTS = {"content": content_cuts, "grid": grid_cuts}


def sentence_runs(words: Words, run: int, min_words: int, piece: int, cuts: str):
    """(text index, first byte, end byte, hash, second hash) of every run of sentences."""
    n = len(words.start)
    stop = ENDS[words.data]
    lead, code, _ = wide_characters(words.data)
    stop[lead[np.isin(code, WIDE_ENDS)]] = True
    ends = np.concatenate([[0], np.cumsum(stop)])
    opens = np.ones(n, bool)
    opens[1:] = (words.doc[1:] != words.doc[:-1]) | (ends[words.start[1:]] > ends[words.end[:-1]])
    opens |= CUTS[cuts](words.hash, opens, piece)
    first = np.flatnonzero(opens)                       # first word of each sentence
    last = np.append(first[1:], n)                      # word after it
    doc = words.doc[first]
    i = np.arange(len(first))
    j = np.maximum(i + run - 1, np.searchsorted(last, first + min_words))
    ok = j < len(first)
    ok[ok] = doc[j[ok]] == doc[i[ok]]
    i, j = i[ok], j[ok]
    doc = doc[i]
    text_start, text_end = words.text_offsets[:-1][doc], words.text_offsets[1:][doc]
    start = np.where(first[i] == words.offsets[:-1][doc], text_start, words.start[first[i]])
    closes = last[j] == words.offsets[1:][doc]
    end = np.where(closes, text_end, words.start[np.minimum(last[j], n - 1)])
    return (doc, start - text_start, end - text_start,
            run_hash(words.hash, first[i], last[j], 1), run_hash(words.hash, first[i], last[j], 2))


def _rows(h1, h2, doc, tag, at, span):
    return pa.RecordBatch.from_arrays(
        [pa.array(np.ascontiguousarray(x).view(np.int64)) for x in (h1, h2, doc, tag, at, span)],
        names=["h1", "h2", "doc", "tag", "at", "span"])


def _settle(found: list):
    """Of equal runs the earliest goes on; the bytes of the others become settled ranges (`at` ends in RANGE)."""
    h1, h2, doc, tag, at, span = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((at, tag, doc, h2, h1))
    h1, h2, doc, tag, at, span = h1[order], h2[order], doc[order], tag[order], at[order], span[order]
    same = np.zeros(len(h1), bool)
    same[1:] = (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1])
    yield _rows(h1[~same], h2[~same], doc[~same], tag[~same], at[~same], span[~same])
    lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(h1))))
    later = same & ((doc != doc[lead]) | (tag != tag[lead]) | (at != at[lead]))
    # a row that repeats is not later than itself
    start = at[later] >> 14
    doc, tag, start, end = _merge_ranges(doc[later], tag[later], start, start + span[later])
    yield _rows(mix64(doc.astype(np.uint64) * np.uint64(31) + tag.astype(np.uint64) + start.astype(np.uint64)), start,
                doc, tag, pack(start, 0, RANGE), end - start)


def find_repeats(rows: DataFrame, run: int, min_words: int, piece: int, cuts: str) -> DataFrame:
    """doc, tag, at, span: ranges of bytes to remove (they may overlap) of rows (doc, tag, text)."""

    def find(batches):
        found, held = [], 0
        for part in text_slices(batches, "text", 2 << 20):
            words = Words(part.column("text"), in_place=True)
            ids, tags = part.column("doc").to_numpy(), part.column("tag").to_numpy()
            doc, start, end, h1, h2 = sentence_runs(words, run, min_words, piece, cuts)
            found.append((h1, h2, ids[doc], tags[doc], pack(start, 0, 0), end - start))
            held += len(doc)
            if held > FLUSH:
                yield from _settle(found)
                found, held = [], 0
        if found:
            yield from _settle(found)

    by = Window.partitionBy("h1", "h2").orderBy("doc", "tag", "at")
    settled = F.col("at").bitwiseAND(F.lit(RANGE)) == RANGE
    return (rows.mapInArrow(find, ROW).withColumn("_first", F.first(F.struct("doc", "tag", "at")).over(by))
            .where(settled | (F.col("_first") < F.struct("doc", "tag", "at"))).select("doc", "tag", "at", "span"))


def remove_spans(docs: DataFrame, run: int = 3, min_words: int = 12, piece: int = 16,
                 with_text: bool = False, cuts: str = "grid") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and the kept bytes) of every row of `docs` (doc_id, text).

    Long sentences are cut by `cuts`: "content" (see above; the registered query
    uses it) or "grid" (after every `piece` words of the sentence, which finds a
    passage only where it starts at the same offset).

    A removed sentence goes with the white space and punctuation after it. A
    null text is empty; texts without words keep all. A null doc_id comes
    before all others. Rows that repeat doc_id and text are one document and
    get the same result; texts that share a doc_id are told apart and ordered by
    a 64-bit hash.
    Other columns are not read; an empty table gives an empty result."""
    rows = identified(docs)
    out = _cut(rows, find_repeats(rows, run, min_words, piece, cuts), with_text)
    return out.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "n_bytes", "n_removed", "n_spans",
                      "kept_sha256", *["kept"] * with_text)
