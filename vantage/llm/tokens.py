"""Byte-level BPE ids of whole texts: vectorised cutting, the tokenizers library for every distinct piece.

A byte-level BPE tokenizer first cuts a text into pieces (words with their
blank, numbers, signs, white space) and then encodes each piece alone. Texts
are cut here with numpy by the same rule; the classes of characters (letter,
number, space, other) are asked from the tokenizer's own pre-tokenizer, one
character at a time as they turn up. Distinct pieces are encoded once by the
library and kept. A special token's string in a text is that token, as the
library takes it by default: it is a piece of its own and cuts the text there.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

from vantage.llm.common import kept
from vantage.llm.textops import utf8

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

LETTER, NUMBER, OTHER, SPACE, UNKNOWN = range(5)
KEEP_PIECES = 300_000    # pieces a worker keeps; then it starts anew
SHORT = [b"s", b"t", b"m", b"d"]          # endings that an apostrophe takes along
LONG = [b"re", b"ve", b"ll"]


class ByteBpe:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = self._special_strings()
        self.classes = np.full(0x110000, UNKNOWN, np.uint8)
        self._forget()

    def _special_strings(self) -> re.Pattern | None:
        added = self.library.get_added_tokens_decoder().values()
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added):
            raise ValueError("special tokens that take blanks along, need word ends or are normalized are not supported")
        words = sorted((t.content.encode("utf-8") for t in added), key=lambda w: (-len(w), w))
        return re.compile(b"|".join(map(re.escape, words))) if words else None

    def _special_bounds(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte positions at which special strings start and end; none reaches over two texts."""
        starts, ends, raw, at = [], [], memoryview(data), 0
        while self.special and (m := self.special.search(raw, at)):
            limit = offs[np.searchsorted(offs, m.start(), "right")]
            if m.end() <= limit:
                starts.append(m.start())
                ends.append(m.end())
                at = m.end()
            elif m := self.special.search(raw, m.start(), int(limit)):  # a shorter one may end inside this text
                starts.append(m.start())
                ends.append(m.end())
                at = m.end()
            else:
                at = int(limit)
        return np.array(starts, np.int64), np.array(ends, np.int64)

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 16, np.int64)
        self.sizes = np.zeros(1 << 16, np.int64)
        self.used = 0

    def _classify(self, codes: np.ndarray) -> None:
        cut = self.library.pre_tokenizer.pre_tokenize_str
        for c in codes.tolist():
            joins = [len(cut(before + chr(c))) == 1 for before in ("a", "1", "#")]
            self.classes[c] = joins.index(True) if True in joins else SPACE

    def pieces(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Byte positions at which a piece starts, in UTF-8 texts that lie at `offs`."""
        lead = np.flatnonzero((data & 0xC0) != 0x80)  # first byte of each character
        if not len(lead):
            return lead
        code = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        kind = self.classes[code]
        if (kind == UNKNOWN).any():
            self._classify(np.unique(code[kind == UNKNOWN]))
            kind = self.classes[code]
        head = np.zeros(len(code) + 1, bool)  # first character of a text
        head[np.searchsorted(lead, offs)] = True
        began, ended = (np.searchsorted(lead, x) for x in self._special_bounds(data, offs))
        head[began] = head[ended] = True     # what stands before and after a special string is cut on its own
        last = head[1:].copy()
        last[-1] = True
        head = head[:-1]
        head[0] = True
        space = kind == SPACE
        start = head.copy()
        start[1:] |= kind[1:] != kind[:-1]
        after_space = np.zeros(len(code), bool)
        after_space[1:] = space[:-1]
        after_space &= ~head
        before_word = np.zeros(len(code), bool)   # a space whose next character is another kind of the same text
        before_word[:-1] = space[:-1] & ~space[1:]
        before_word &= ~last
        start |= before_word                      # the last of several spaces stands apart from them ...
        blank = np.zeros(len(code), bool)
        blank[1:] = code[:-1] == 32
        start &= ~(after_space & blank & ~space)  # ... and a blank goes with the word after it
        quote = np.flatnonzero(start & (code == 39))
        if len(quote):
            padded = np.concatenate([code, np.zeros(3, np.uint32)])
            ends = np.concatenate([last, np.ones(3, bool)])
            quote = quote[~ends[quote]]
            one, two = padded[quote + 1], padded[quote + 2]
            short = np.isin(one, [x[0] for x in SHORT])
            long = ~ends[quote + 1] & np.any([(one == x[0]) & (two == x[1]) for x in LONG], axis=0) & ~short
            for own, n in ((quote[short], 2), (quote[long], 3)):
                start[own + 1] = False
                nxt = own + n
                start[nxt[nxt < len(code)]] = True
        for a, b in zip(began.tolist(), ended.tolist()):
            start[a + 1:b] = False
        return lead[start]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, ids of each text)."""
        data, offs = utf8(column)
        at = self.pieces(data, offs)
        if not len(at):
            return np.zeros(0, np.uint32), np.zeros(len(offs) - 1, np.int64)
        bounds = np.append(at, len(data))
        coded = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(bounds), pa.py_buffer(data)).dictionary_encode()
        row = self._rows(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        size = self.sizes[row]
        ends = np.cumsum(size)
        ids = self.ids[np.repeat(self.starts[row] - ends + size, size) + np.arange(ends[-1])]
        total = np.concatenate([[0], ends])
        return ids, np.diff(total[np.searchsorted(at, offs)])

    def _rows(self, words: list[str]) -> np.ndarray:
        if len(self.known) + len(words) > KEEP_PIECES:
            self._forget()
        get = self.known.get
        rows = [get(w, -1) for w in words]
        new = [i for i, r in enumerate(rows) if r < 0]
        got = [e.ids for e in self.library.encode_batch_fast([words[i] for i in new], add_special_tokens=False)]
        if got:
            n, size = len(self.known), np.array([len(x) for x in got])
            flat = np.fromiter((t for x in got for t in x), np.uint32, int(size.sum()))
            self._room(n + len(got), self.used + len(flat))
            self.ids[self.used:self.used + len(flat)] = flat
            self.sizes[n:n + len(got)] = size
            self.starts[n:n + len(got)] = self.used + np.cumsum(size) - size
            self.used += len(flat)
            for k, i in enumerate(new):
                rows[i] = self.known[words[i]] = n + k
        return np.array(rows, np.int64)

    def _room(self, pieces: int, ids: int) -> None:
        if pieces > len(self.sizes):
            self.sizes, self.starts = (np.concatenate([x, np.zeros(pieces, np.int64)]) for x in (self.sizes, self.starts))
        if ids > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(ids, np.uint32)])


_LOADED: dict[str, ByteBpe] = kept()


def tokenizer(path: str) -> ByteBpe:
    """One tokenizer for each path and Python worker."""
    if path not in _LOADED:
        _LOADED[path] = ByteBpe(path)
    return _LOADED[path]
