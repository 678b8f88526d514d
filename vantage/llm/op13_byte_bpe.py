"""Byte-level BPE by ranks, encoding and decoding, with a two-tier look-up.

A text is cut into pieces by the tokenizer's pattern. First tier: a minimal
perfect hash over the vocabulary's byte strings resolves every piece that is a
token as a whole, for all pieces of a slice of texts at once; a slot's bytes
are compared, so another string never passes for a token. Second tier: the
other pieces, once for each distinct one, are merged by a heap of adjacent
pairs over a linked list of bytes, least rank first and leftmost among equals.
Decoding gathers the tokens' bytes.

Texts are encoded where they lie: no shuffle, and a lost task is simply run
again. A worker keeps the ids of rare pieces up to a stated number of bytes.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.llm.common import begin_task, kept, text_slices
from vantage.llm.perfect_hash import MinimalHash
from vantage.llm.textops import utf8
from vantage.llm.tokens import SPACE, UNKNOWN, ByteBpe

KEEP_BYTES = 2 << 20     # bytes of rare pieces whose ids a worker keeps (about 40 MB); then it starts anew
SLICE_BYTES = 1 << 20    # bytes of text encoded at a time (a longer text is a slice of its own)
SLICE_IDS = 1 << 18      # ids decoded at a time (likewise)


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank by token of a file with one `base64 rank` pair a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Cutter(ByteBpe):
    """Cuts texts by the tokenizer's pattern. The class of a character is asked from
    the tiktoken library the first time it turns up: a vocabulary whose only pairs
    begin with a letter, a digit or a sign shows whether both stand in one piece."""

    def __init__(self, pattern: str):
        import tiktoken

        pairs = [bytes([i]) for i in range(256)] + [bytes([a, b]) for a in b"a1#" for b in range(256)]
        self.probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(pairs)},
                                       special_tokens={})
        self.classes = np.full(0x110000, UNKNOWN, np.uint8)
        self.special = None

    def _classify(self, codes: np.ndarray) -> None:
        for c in codes.tolist():
            joins = [self.probe.encode_ordinary(before + chr(c))[0] >= 256 for before in "a1#"]
            self.classes[c] = joins.index(True) if True in joins else SPACE


def pair_ranks(ranks: dict[bytes, int]) -> dict[int, int]:
    """Rank by left id << 32 | right id of every two tokens that make a third one."""
    out = {}
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            left, right = ranks.get(token[:i]), ranks.get(token[i:])
            if left is not None and right is not None:
                out[left << 32 | right] = rank
    return out


def merge(ids: list[int], rank_of) -> list[int]:
    """Ids of one piece, given the ids of its bytes: the pair of least rank is
    merged until no pair has a rank. `rank_of(left << 32 | right)` is None for a pair without one."""
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n))
    pair = [rank_of(a << 32 | b) for a, b in zip(ids, ids[1:])]   # rank of the pair that starts here
    pair.append(None)
    heap = [r << 32 | i for i, r in enumerate(pair) if r is not None]
    heapify(heap)
    while heap:
        top = heappop(heap)
        r, i = top >> 32, top & 0xFFFFFFFF
        if pair[i] != r:    # one of the two has been merged meanwhile
            continue
        gone = after[i]
        end = after[i] = after[gone]
        ids[i] = r
        pair[gone] = pair[i] = None
        if end < n:
            before[end] = i
            new = pair[i] = rank_of(r << 32 | ids[end])
            if new is not None:
                heappush(heap, new << 32 | i)
        left = before[i]
        if left >= 0:
            new = pair[left] = rank_of(ids[left] << 32 | r)
            if new is not None:
                heappush(heap, new << 32 | left)
    out, i = [], 0
    while i < n:
        out.append(ids[i])
        i = after[i]
    return out


class Decoder:
    """Bytes of ids, by the tokens of one vocabulary."""

    def __init__(self, tokens: list[bytes], ids: list[int]):
        size = np.array([len(t) for t in tokens], np.int64)
        self.size = np.zeros(max(ids) + 1, np.int64)      # by id; ids without a token have no bytes
        self.start = np.zeros_like(self.size)
        self.size[ids], self.start[ids] = size, np.cumsum(size) - size
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all ids one after the other, offset of each id's bytes and the end)."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.size) or not self.size[ids].all()):
            raise ValueError("an id has no token in this vocabulary")
        size = self.size[ids]
        offs = np.concatenate([[0], np.cumsum(size)])
        return self.bytes[np.repeat(self.start[ids] - offs[:-1], size) + np.arange(offs[-1])], offs


class Bpe:
    """Both tiers for one vocabulary."""

    def __init__(self, tokens: list[bytes], ids: list[int], pattern: str):
        self.ranks = dict(zip(tokens, ids))
        missing = [i for i in range(256) if bytes([i]) not in self.ranks]
        if missing:
            raise ValueError(f"the vocabulary has no token for bytes {missing}")
        self.whole, self.cutter = MinimalHash(tokens), Cutter(pattern)
        self.pairs, self.byte = pair_ranks(self.ranks), [self.ranks[bytes([i])] for i in range(256)]
        self.ids = np.array(ids, np.int32)
        self._forget()

    def _forget(self) -> None:
        self.rare: dict[bytes, int] = {}
        self.flat, self.ends, self.held = array("i"), array("q", [0]), 0

    def _merged(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first id of each piece, ids of each piece); rows of the kept table."""
        if self.held > KEEP_BYTES:
            self._forget()
        get, byte, rank_of = self.rare.get, self.byte.__getitem__, self.pairs.get
        rows = [get(p, -1) for p in pieces]
        for k, row in enumerate(rows):
            if row < 0:
                p = pieces[k]
                rows[k] = self.rare[p] = len(self.ends) - 1
                self.flat.extend(merge(list(map(byte, p)), rank_of))
                self.ends.append(len(self.flat))
                self.held += len(p)
        rows, ends = np.array(rows), np.frombuffer(self.ends, np.int64)
        out = np.frombuffer(self.flat, np.int32), ends[rows], ends[rows + 1] - ends[rows]
        return out

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, offsets of each text's ids)."""
        data, offs = utf8(column)
        at = self.cutter.pieces(data, offs)
        if not len(at):
            return np.zeros(0, np.int32), np.zeros(len(offs), np.int64)
        bounds = np.append(at, len(data))
        found = self.whole.find(data, at, np.diff(bounds))
        ids, count = self.ids[found], np.ones(len(at), np.int64)
        rest = np.flatnonzero(found < 0)
        if len(rest):
            every = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at),
                                                     [None, pa.py_buffer(bounds), pa.py_buffer(data)])
            coded = every.take(pa.array(rest)).dictionary_encode()
            (flat, base, size), which = self._merged(coded.dictionary.to_pylist()), coded.indices.to_numpy()
            count[rest] = size[which]
            ends = np.cumsum(count)
            whole, ids = ids, np.empty(int(ends[-1]), np.int32)
            hit = found >= 0
            ids[(ends - 1)[hit]] = whole[hit]
            own = size[which]
            step = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
            ids[np.repeat(ends[rest] - own, own) + step] = flat[np.repeat(base[which], own) + step]
        total = np.concatenate([[0], np.cumsum(count)])
        return ids, total[np.searchsorted(at, offs)]


_LOADED: dict[str, Bpe] = kept()    # of the last vocabulary only


class Vocabulary:
    """What tasks get: tokens and ids, read once on the driver. A worker builds the
    tables for encoding when a task first needs them, and keeps them."""

    def __init__(self, path: str, pattern: str):
        ranks = read_ranks(path)
        self.tokens, self.ids, self.pattern = list(ranks), list(ranks.values()), pattern
        self.key = hashlib.sha256(repr((sorted(ranks.items()), pattern)).encode()).hexdigest()

    def bpe(self) -> Bpe:
        if self.key not in _LOADED:
            _LOADED.clear()
            _LOADED[self.key] = Bpe(self.tokens, self.ids, self.pattern)
        return _LOADED[self.key]

    def decoder(self) -> Decoder:
        return Decoder(self.tokens, self.ids)


def _with(batch: pa.RecordBatch, names: list[str], out: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [values], names=[*names, out])


def _schema(df: DataFrame, names: list[str], out: str, kind: str) -> str:
    types = dict(df.dtypes)
    return ", ".join([f"`{n}` {types[n]}" for n in names] + [f"`{out}` {kind}"])


def _lists(values: np.ndarray, offs: np.ndarray, binary: bool) -> pa.Array:
    if binary:    # little-endian unsigned 32-bit integers, as in a token file
        return _binary(values.astype("<i4"), 4 * offs)
    return pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(values, pa.int32()))


def _binary(data: np.ndarray, offs: np.ndarray) -> pa.Array:
    return pa.BinaryArray.from_buffers(pa.binary(), len(offs) - 1, [None, pa.py_buffer(offs.astype(np.int32)), pa.py_buffer(data)])


def encode(docs: DataFrame, vocabulary: Vocabulary, keep: list[str] | None = None, text: str = "text",
           out: str = "ids", binary: bool = False) -> DataFrame:
    """The columns `keep` (all but the text, if not given) of each row, and `out`: the ids of its whole text, as
    array<int> or, if `binary`, as the bytes of little-endian unsigned 32-bit integers.

    A null text has no ids, like an empty one. Rows stay as they are: repeated
    rows, equal texts and null keys each give a row of their own. A column that
    is named like `out` gives way to it. A text is held whole in one task, about
    100 bytes for each of its bytes; a single piece (a run of letters, say) takes
    as much again while it is merged. An empty table gives an empty one."""
    names = [c for c in (keep if keep is not None else docs.columns) if c not in (text, out)]

    def run(batches):
        begin_task()
        bpe = vocabulary.bpe()
        for batch in text_slices(batches, text, SLICE_BYTES):
            yield _with(batch, names, out, _lists(*bpe.encode(batch.column(text)), binary))

    return docs.select(*names, text).mapInArrow(run, _schema(docs, names, out, "binary" if binary else "array<int>"))


def decode(encoded: DataFrame, vocabulary: Vocabulary, keep: list[str] | None = None, ids: str = "ids",
           out: str = "decoded") -> DataFrame:
    """The columns `keep` (all, if not given) of each row, and `out`: the bytes of its ids (array<int>), as binary.

    Null ids have no bytes; a null among the ids, or one without a token, is an
    error. Bytes need not be valid UTF-8, as ids may be cut anywhere."""
    names = [c for c in (keep if keep is not None else encoded.columns) if c != out]

    def slices(batches):
        for batch in batches:
            ends = np.cumsum(pa.compute.list_value_length(batch.column(ids)).fill_null(0).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_IDS, "right")))
                yield batch.slice(at, upto - at)
                at = upto

    def run(batches):
        decoder = vocabulary.decoder()
        for batch in slices(batches):
            lists = batch.column(ids)
            flat = lists.flatten()
            if flat.null_count:
                raise ValueError("a null among the ids")
            size = pa.compute.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
            data, offs = decoder.decode(flat.to_numpy(zero_copy_only=False))
            yield _with(batch, names, out, _binary(data, offs[np.concatenate([[0], np.cumsum(size)])]))

    return encoded.select(*dict.fromkeys([*names, ids])).mapInArrow(run, _schema(encoded, names, out, "binary"))


def round_trip(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, ids (as bytes, see `encode`) and decoded of every document: its text
    is encoded and its ids are decoded in the same task, by what `encode` and `decode` use."""
    def run(batches):
        begin_task()
        bpe, decoder = vocabulary.bpe(), vocabulary.decoder()
        for batch in text_slices(batches, "text", SLICE_BYTES):
            ids, offs = bpe.encode(batch.column("text"))
            data, own = decoder.decode(ids)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), _lists(ids, offs, True), _binary(data, own[offs])], names=["doc_id", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary, decoded binary")


def digests(coded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, and the sha256 of the ids (as bytes) and of the decoded bytes."""
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
