"""An adaptive context-mixing range coder for token ids, run on many blocks in step.

A block starts from a fixed state, so blocks can be decoded apart. For each id
order 2 (the two ids before it) and order 1 (the id before it) predict one id
each, with a confidence of 0 to 3; order 0 gives every id a share from the
block's own counts of high and low bytes. The mixture's weights are learned: in
each context (both confidences, and whether the predictions agree) the coder
counts which order was right, and these counts are the weights. A weight and,
where order 0 is taken, the two bytes' shares narrow a carry-less 64-bit range.

All blocks of a call advance by one id at a time: numpy arrays hold one entry
for each block, so Python's cost is paid once for thousands of ids.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
TOP, BOTTOM = U64(1 << 48), U64(1 << 40)
MIX_BITS, BYTE_BITS = 12, 13               # 12 + 13 + 13 bits fit what BOTTOM leaves of the range
SLOT_BITS = 9                              # an order remembers 512 predictions in a block
REBUILD = {1 << i for i in range(4, 30)}   # after 16, 32, 64, ... ids order 0 is brought up to date
RATE = 4                                   # a mixture weight moves by 1/16 of its distance
LANES = 1024                               # blocks that are run in step: their state fits a core's cache
_SURE, _FAINT = 3840, 32                   # what the weight of an order tends to while it is right, or wrong
np.seterr(over="ignore")


class _Model:
    """What encoder and decoder know about each block so far."""

    def __init__(self, lanes: int):
        # row 0 is order 2, row 1 order 1; an entry is predicted id << 2 | confidence
        self.base = (np.arange(2 * lanes, dtype=np.int64) << SLOT_BITS).reshape(2, lanes)
        self.table = np.zeros(2 * lanes << SLOT_BITS, np.uint32)
        self.mix_base = np.arange(lanes, dtype=np.int64) * 32
        hopes = np.array([64, 900, 2000, 3000])
        c2, c1, agree = np.meshgrid(range(4), range(4), range(2), indexing="ij")
        second = np.where(agree == 1, _FAINT, hopes[c1] * (_SURE - hopes[c2]) // 4096)
        self.mix = np.tile(np.stack([hopes[c2], second]).reshape(2, 32), (1, lanes)).astype(np.int32)
        self.bytes = np.ones((lanes, 2, 256), np.int32)  # counts of high bytes, and of low bytes
        self.bytes[:, 0] += 8 // (1 + np.arange(256, dtype=np.int32) // 16)
        self.byte_base = np.arange(lanes, dtype=np.int64) * 512
        self.rebuild()

    def rebuild(self) -> None:
        """Shares of the bytes: 2 ** BYTE_BITS in all, 1 for each value at least; start << 16 | width."""
        total = np.cumsum(self.bytes, axis=-1, dtype=np.int32)
        room = (1 << BYTE_BITS) - 256
        ends = (total * (room / total[..., -1:])).astype(np.int32) + np.arange(1, 257, dtype=np.int32)
        ends[..., 255] = 1 << BYTE_BITS
        starts = np.zeros_like(ends)
        starts[..., 1:] = ends[..., :-1]
        self.starts = starts.ravel()
        self.shares = ((starts << 16) | (ends - starts)).ravel()

    def predict(self, one: np.ndarray, two: np.ndarray):
        """(slots, entries, mixture row, weights of both orders) for blocks whose last ids are one, two."""
        n = len(one)
        h = np.empty((2, n), np.uint32)
        np.multiply(one, np.uint32(0x9E3779B1), out=h[1])
        np.multiply(h[1] ^ (two * np.uint32(0x85EBCA6B)), np.uint32(0xC2B2AE35), out=h[0])
        slots = self.base[:, :n] + (h >> np.uint32(32 - SLOT_BITS))
        entries = self.table[slots]
        sure = entries & np.uint32(3)
        guess = entries >> np.uint32(2)
        row = self.mix_base[:n] + ((sure[0] << np.uint32(3)) | (sure[1] << np.uint32(1)) | (guess[0] == guess[1]))
        return slots, entries, sure, guess, row, self.mix[:, row]

    def update(self, slots, entries, sure, hit, row, weights, by, ids, missed, lost) -> None:
        goal = np.full(weights.shape, _FAINT, np.int32)
        goal[0][by == 0] = _SURE
        goal[1][by == 1] = _SURE
        self.mix[:, row] = weights + ((goal - weights) >> RATE)
        kept = entries + np.where(hit, sure < 3, np.uint32(0xFFFFFFFF)).astype(np.uint32)
        self.table[slots] = np.where(hit | (sure > 1), kept, (ids << np.uint32(2)) | np.uint32(1))
        flat = self.bytes.reshape(-1)
        spot = self.byte_base[missed]
        flat[spot + (lost >> 8)] += 12
        flat[spot + 256 + (lost & 255)] += 12


def _narrow(low, size, at, width, bits):
    step = size >> U64(bits)
    return low + step * at.astype(U64), step * width.astype(U64)


def _mixture(by, weights):
    """(start, width) of the chosen order's share: order 2, then 1, then 0."""
    both = weights[0] + weights[1]
    at = np.where(by == 0, 0, np.where(by == 1, weights[0], both))
    return at, np.where(by == 0, weights[0], np.where(by == 1, weights[1], (1 << MIX_BITS) - both))


def _settle(a, b, emit) -> None:
    """Shift out the words that can no longer change, and keep each range from getting too small."""
    go = np.flatnonzero(((a ^ (a + b)) < TOP) | (b < BOTTOM))
    while len(go):
        p, q = a[go], b[go]
        q = np.where((p ^ (p + q)) < TOP, q, (U64(0) - p) & (BOTTOM - U64(1)))
        emit(go, p)
        p, q = p << U64(16), q << U64(16)
        a[go], b[go] = p, q
        go = go[((p ^ (p + q)) < TOP) | (q < BOTTOM)]


def _in_step(lengths: np.ndarray):
    """Groups of blocks, long ones first: those still open at any step are a prefix of their group."""
    order = np.argsort(-lengths, kind="stable")
    return [order[i:i + LANES] for i in range(0, len(order), LANES)]


def _open(size: np.ndarray, t: int) -> int:
    return int(np.searchsorted(-size, -t, "left"))


def encode(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(16-bit words of all blocks one after the other, words of each block) of ids cut into blocks of `lengths`."""
    ids = np.asarray(ids, np.uint32)
    if len(ids) and ids.max() >> 16:
        raise ValueError("ids must be below 65,536")
    first = np.cumsum(lengths) - lengths
    parts: list = [None] * len(lengths)
    for own in _in_step(lengths):
        words, filled = _encode_group(ids, first[own], lengths[own])
        for lane, block in enumerate(own.tolist()):
            parts[block] = words[lane, :filled[lane]]
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint16)), np.array([len(x) for x in parts], np.int64)


def _encode_group(ids: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lanes, steps = len(size), int(size.max(initial=0))
    model = _Model(lanes)
    low, width = np.zeros(lanes, U64), np.full(lanes, (1 << 64) - 1, U64)
    words = np.zeros((lanes, steps * 3 + 8), np.uint16)
    flat, spot = words.reshape(-1), np.arange(lanes, dtype=np.int64) * words.shape[1]
    begun = spot.copy()
    one = two = np.zeros(lanes, np.uint32)

    def emit(go, p):
        flat[spot[go]] = (p >> U64(48)).astype(np.uint16)
        spot[go] += 1

    for t in range(steps):
        if t in REBUILD:
            model.rebuild()
        n = _open(size, t)
        x = ids[first[:n] + t]
        one, two = one[:n], two[:n]
        slots, entries, sure, guess, row, weights = model.predict(one, two)
        hit = guess == x
        by = np.where(hit[0], 0, 2 - hit[1])
        a, b = _narrow(low[:n], width[:n], *_mixture(by, weights), MIX_BITS)
        missed = np.flatnonzero(by == 2)
        lost = x[missed].astype(np.int64)
        at = model.byte_base[missed]
        c, d = a[missed], b[missed]
        for value in (lost >> 8, 256 + (lost & 255)):
            share = model.shares[at + value]
            c, d = _narrow(c, d, share >> 16, share & 0xFFFF, BYTE_BITS)
        a[missed], b[missed] = c, d
        _settle(a, b, emit)
        low[:n], width[:n] = a, b
        model.update(slots, entries, sure, hit, row, weights, by, x, missed, lost)
        one, two = x, one
    for i in range(4):
        flat[spot + i] = (low >> U64(48 - 16 * i)).astype(np.uint16)
    return words, spot + 4 - begun


def _find(starts: np.ndarray, base: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The byte whose share holds `value`: binary search."""
    at = base.copy()
    for step in (128, 64, 32, 16, 8, 4, 2, 1):
        at += step * (starts[at + step] <= value)
    return at - base


def decode(words: np.ndarray, counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ids of blocks of `lengths` ids, coded in `counts` words each."""
    out = np.zeros(int(lengths.sum()), np.uint32)
    words = np.concatenate([np.asarray(words, np.uint16), np.zeros(4, np.uint16)])
    first, get = np.cumsum(lengths) - lengths, np.cumsum(counts) - counts
    for own in _in_step(lengths):
        _decode_group(words, get[own], out, first[own], lengths[own])
    return out


def _decode_group(words, get, out, put, size) -> None:
    lanes, steps = len(size), int(size.max(initial=0))
    model = _Model(lanes)
    low, width, code = np.zeros(lanes, U64), np.full(lanes, (1 << 64) - 1, U64), np.zeros(lanes, U64)
    end = len(words) - 1
    for i in range(4):
        code = (code << U64(16)) | words[get + i].astype(U64)
    get = get + 4
    one = two = np.zeros(lanes, np.uint32)

    def take(go, _):
        code[go] = (code[go] << U64(16)) | words[np.minimum(get[go], end)].astype(U64)
        get[go] += 1

    for t in range(steps):
        if t in REBUILD:
            model.rebuild()
        n = _open(size, t)
        one, two = one[:n], two[:n]
        slots, entries, sure, guess, row, weights = model.predict(one, two)
        a, b, v = low[:n], width[:n], code[:n]
        value = ((v - a) // (b >> U64(MIX_BITS))).astype(np.int64)
        by = (value >= weights[0]).astype(np.int64) + (value >= weights[0] + weights[1])
        a, b = _narrow(a, b, *_mixture(by, weights), MIX_BITS)
        x = np.where(by == 0, guess[0], guess[1])
        missed = np.flatnonzero(by == 2)
        at = model.byte_base[missed]
        c, d, e = a[missed], b[missed], v[missed]
        found = []
        for base in (at, at + 256):
            value = ((e - c) // (d >> U64(BYTE_BITS))).astype(np.int32)
            found.append(_find(model.starts, base, value))
            share = model.shares[base + found[-1]]
            c, d = _narrow(c, d, share >> 16, share & 0xFFFF, BYTE_BITS)
        a[missed], b[missed] = c, d
        lost = (found[0] << 8) | found[1]
        x[missed] = lost.astype(np.uint32)
        _settle(a, b, take)
        low[:n], width[:n] = a, b
        model.update(slots, entries, sure, guess == x, row, weights, by, x, missed, lost)
        out[put[:n] + t] = x
        one, two = x, one
