"""A minimal perfect hash over byte strings: n keys, n slots, no two keys in one slot.

Keys fall into buckets by one part of their hash. Buckets of several keys are
placed first, the largest before the others: each gets the first displacement
that puts all its keys on free slots. A key alone in its bucket takes a slot
that is left over, which the table names directly (as a negative number), so
every slot is taken in the end. A look-up is two gathers and a comparison of
the key's bytes, for whole arrays of strings at once.
"""

from __future__ import annotations

import numpy as np

from vantage.llm.textops import mix64

U64 = np.uint64
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=object).astype(U64)
TRIES = 64    # displacements that are tried at a time


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """For each byte position the eight bytes from there on as one number (zeros after the end)."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def byte_hash(words: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each string words[start:start+size] (`words` from `eight_bytes`)."""
    with np.errstate(over="ignore"):
        h = mix64(size.astype(U64) * U64(0xD6E8FEB86659FD93))
        h = mix64(h ^ (words[start] & _MASKS[np.minimum(size, 8)]))
        live, at = np.flatnonzero(size > 8), 8
        while len(live):
            left = size[live] - at
            h[live] = mix64(h[live] ^ (words[start[live] + at] & _MASKS[np.minimum(left, 8)]))
            at += 8
            live = live[left > 8]
    return h


class MinimalHash:
    """Slots 0 to n-1 for n distinct non-empty keys; `find` gives a key's position in the list of keys, or -1."""

    def __init__(self, keys: list[bytes]):
        self.n, self.longest = len(keys), max(map(len, keys))
        data = np.frombuffer(b"".join(keys), np.uint8)
        size = np.array([len(k) for k in keys], np.int64)
        start = np.cumsum(size) - size
        words = eight_bytes(data)
        bucket, one, two = self._parts(byte_hash(words, start, size))
        self.shift = np.zeros(self.n, np.int64)
        slot = self._place(bucket, one, two)
        self.key = np.empty(self.n, np.int64)      # the key in each slot
        self.key[slot] = np.arange(self.n)
        self.size = size[self.key]
        self.words = np.zeros((self.n, -(-self.longest // 8)), U64)  # the bytes of the key in each slot
        for k in range(self.words.shape[1]):
            live = np.flatnonzero(self.size > 8 * k)
            own = self.key[live]
            self.words[live, k] = words[start[own] + 8 * k] & _MASKS[np.minimum(size[own] - 8 * k, 8)]

    def _parts(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bucket, first slot and step (not 0) of each hash."""
        n = U64(self.n)
        return ((h >> U64(32)) % n).astype(np.int64), ((h & U64(0xFFFFFFFF)) % n).astype(np.int64), \
            (mix64(h) % U64(max(self.n - 1, 1))).astype(np.int64) + 1

    def _place(self, bucket: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        slot, taken = np.full(self.n, -1, np.int64), np.zeros(self.n, bool)
        order = np.argsort(bucket, kind="stable")
        count = np.bincount(bucket, minlength=self.n)
        first = np.cumsum(count) - count
        for b in np.argsort(-count, kind="stable"):
            if count[b] < 2:
                break
            own = order[first[b]:first[b] + count[b]]
            for tries in range(0, 1 << 20, TRIES):
                at = (one[own] + np.arange(tries, tries + TRIES)[:, None] * two[own]) % self.n
                apart = np.sort(at, axis=1)
                free = ~taken[at].any(1) & (apart[:, 1:] != apart[:, :-1]).all(1)
                if free.any():
                    k = int(free.argmax())
                    self.shift[b], slot[own] = tries + k, at[k]
                    taken[at[k]] = True
                    break
            else:
                raise ValueError("two keys have the same hash")
        alone = order[first[count == 1]]
        slot[alone] = np.flatnonzero(~taken)
        self.shift[bucket[alone]] = -slot[alone] - 1
        return slot

    def find(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Position in the list of keys of each string data[start:start+size], -1 where it is no key."""
        out = np.full(len(start), -1, np.int64)
        fits = np.flatnonzero(size <= self.longest)
        if not len(fits):
            return out
        start, size, words = start[fits], size[fits], eight_bytes(data)
        bucket, one, two = self._parts(byte_hash(words, start, size))
        shift = self.shift[bucket]
        slot = np.where(shift < 0, -shift - 1, (one + np.maximum(shift, 0) * two) % self.n)
        same = (self.size[slot] == size) & (self.words[slot, 0] == (words[start] & _MASKS[np.minimum(size, 8)]))
        live, at = np.flatnonzero(same & (size > 8)), 8
        while len(live):
            left = size[live] - at
            good = self.words[slot[live], at // 8] == (words[start[live] + at] & _MASKS[np.minimum(left, 8)])
            same[live[~good]] = False
            at += 8
            live = live[good & (left > 8)]
        out[fits[same]] = self.key[slot[same]]
        return out
