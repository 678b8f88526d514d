"""Vectorised text primitives on Arrow string columns (numpy inside Spark tasks)."""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from vantage.llm.common import kept

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_STEP = 0xD6E8FEB86659FD93

# Characters by Unicode class: words are letters, numbers and marks; all others separate them. A letter of a script
# that is written without blanks is a word of its own, with the marks after it.
OTHER, WORD, MARK, LONE, UNKNOWN = range(5)
NO_BLANKS = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x1B00, 0x1B7F),
             (0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3021, 0x3029), (0x3031, 0x312F), (0x31A0, 0x31FF), (0x3400, 0x4DBF),
             (0x4E00, 0x9FFF), (0xA980, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F),
             (0x16FE0, 0x18DFF), (0x1AFF0, 0x1B2FF), (0x20000, 0x3FFFD))
KIND = np.full(0x110000, UNKNOWN, np.uint8)  # by code point, filled in as they turn up
BYTE_KIND = np.zeros(256, np.uint8)          # of ASCII
for _lo, _hi in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
    BYTE_KIND[_lo:_hi] = WORD


def wide_characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, code point, number of bytes) of the characters beyond ASCII in UTF-8 bytes."""
    lead = np.flatnonzero(data >= 0xC0)
    padded = np.append(data, np.zeros(3, np.uint8))
    first, *rest = (padded[lead + j].astype(np.int32) for j in range(4))
    two, three, four = (x & 0x3F for x in rest)
    size = 2 + (first >= 0xE0) + (first >= 0xF0)
    code = np.select([size == 2, size == 3],
                     [(first & 0x1F) << 6 | two, (first & 0x0F) << 12 | two << 6 | three],
                     (first & 0x07) << 18 | two << 12 | three << 6 | four)
    return lead, np.minimum(code, 0x10FFFF), size


def _kind(code: np.ndarray) -> np.ndarray:
    kind = KIND[code]
    if (kind == UNKNOWN).any():
        for c in np.unique(code[kind == UNKNOWN]).tolist():
            group = unicodedata.category(chr(c))
            lone = (group[0] == "L" or group == "Nl" or c == 0x3007) and any(a <= c <= b for a, b in NO_BLANKS)
            KIND[c] = LONE if lone else MARK if group[0] == "M" else WORD if group[0] in "LN" else OTHER
        kind = KIND[code]
    return kind


def word_starts(data: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte, whether it belongs to a word and whether a word starts there (texts start at `heads`)."""
    byte = BYTE_KIND[data]
    lead, code, size = wide_characters(data)
    kind = _kind(code)
    if len(lead):
        kind[(kind == MARK) & np.isin(lead, heads)] = WORD  # no letter before it
        for j in range(4):
            own = size > j
            at = lead[own] + j
            byte[at[at < len(data)]] = kind[own][at < len(data)]
    word = byte > 0
    start = word.copy()
    start[1:] &= ~word[:-1]
    start[heads] = word[heads]
    if (kind == LONE).any():
        start[lead[kind == LONE]] = True
        letter = byte[np.maximum.accumulate(np.where(byte != MARK, np.arange(len(byte)), 0))]  # what a mark goes with
        start[1:] |= (byte[1:] == WORD) & ((data[1:] & 0xC0) != 0x80) & (letter[:-1] == LONE)
    return word, start


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def byte_values(seed: int) -> np.ndarray:
    """A pseudo-random odd 64-bit value for each byte."""
    with np.errstate(over="ignore"):
        return mix64(np.arange(1, 257, dtype=U64) * U64(_STEP) + U64(seed)) | U64(1)


_POW: dict[int, np.ndarray] = kept()


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base**0 .. base**n (mod 2**64), kept between calls and grown on demand."""
    have = _POW.get(base)
    if have is None or len(have) <= n:
        with np.errstate(over="ignore"):
            seq = np.full(max(n, 1 << 18) + 1, U64(base))
            seq[0] = 1
            have = _POW[base] = np.cumprod(seq, dtype=U64)
    return have


class PrefixHash:
    """Prefix polynomial hashes of a byte buffer: any substring's hash in O(1)."""

    def __init__(self, data: np.ndarray, seed: int = 1):
        n = len(data)
        self.prefix = np.zeros(n + 1, U64)
        with np.errstate(over="ignore"):
            np.cumsum(byte_values(seed)[data] * powers(n)[:n], out=self.prefix[1:])
        self.inv = powers(n, _BASE_INV)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.prefix[end] - self.prefix[start]) * self.inv[start]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    return raw_bytes(pc.fill_null(column, ""))


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    off = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off.astype(np.int64) - int(off[0])


def fold_case(data: np.ndarray) -> np.ndarray:
    """Lower-case ASCII and Latin-1 letters of UTF-8 bytes; no text changes its length."""
    out = data + np.where((data >= 0x41) & (data <= 0x5A), np.uint8(0x20), np.uint8(0))
    second = np.zeros(len(data), bool)
    second[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    out[second] += np.uint8(0x20)
    return out


def run_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """Hash of values[start:end] for many runs, by prefix sums."""
    with np.errstate(over="ignore"):
        own = mix64(values ^ U64(_STEP * (2 * seed + 1) & 0xFFFFFFFFFFFFFFFF))
        prefix = np.concatenate([np.zeros(1, U64), np.cumsum(own * powers(len(values))[:len(values)])])
        h = (prefix[end] - prefix[start]) * powers(len(values), _BASE_INV)[start]
        return mix64(h + (end - start).astype(U64))


class Words:
    """Words of each text: `start`/`end` byte positions, `doc` index, `offsets` by doc, 64-bit `hash`."""

    def __init__(self, column: pa.Array, seed: int = 1, in_place: bool = False):
        """in_place: byte positions are those of the column's own text (see `fold_case`)."""
        data, offs = utf8(column if in_place else pc.utf8_lower(column))
        if in_place:
            data = fold_case(data)
        self.data, self.text_offsets = data, offs
        heads = offs[:-1][offs[:-1] < offs[1:]]
        w, opens = word_starts(data, heads)
        nxt = np.empty_like(w)
        nxt[:-1] = w[1:] & ~opens[1:]
        nxt[offs[1:][offs[:-1] < offs[1:]] - 1] = False
        self.start = np.flatnonzero(opens)
        self.end = np.flatnonzero(w & ~nxt) + 1
        self.offsets = np.searchsorted(self.start, offs)
        self.doc = np.repeat(np.arange(len(offs) - 1), np.diff(self.offsets))
        self.hash = mix64(PrefixHash(data, seed).of(self.start, self.end))


def shingles(words: Words, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every run of `k` words, offsets by text). A text of one to k-1
    words has a single shingle of all its words; a text without words has none."""
    n = np.diff(words.offsets)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(n.dtype))
    offs = np.concatenate([[0], np.cumsum(count)])
    with np.errstate(over="ignore"):
        padded = np.concatenate([words.hash, np.zeros(k, U64)])
        pos = np.arange(offs[-1]) - np.repeat(offs[:-1], count) + np.repeat(words.offsets[:-1], count)
        left = np.repeat(words.offsets[1:], count) - pos
        h = np.zeros(len(pos), U64)
        for j in range(k):
            h = h * U64(_BASE) + np.where(left > j, padded[pos + j], U64(j + 1))
        return mix64(h), offs
