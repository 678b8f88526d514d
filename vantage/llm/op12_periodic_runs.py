"""Periodic runs in the words of a text, by string synchronising sets.

A run is a stretch of words with smallest period q, at least three times as
long as q, that can't be extended keeping that period. Periods up to `DIRECT`
are found by comparing each word with the word q later. Longer ones are found
at dyadic scales with a half step between (windows of t = 6, 8, 12, 16, 24, ...
words), each responsible for its own range of periods:

1. Highly periodic windows (period at most t/3) are known from the runs of
   smaller periods, which are found before; they take no part.
2. The synchronising set of a scale holds the positions whose window, or the
   window t words later, has the least hash of the t+1 windows in between. What
   is selected depends on the 2t words from there on only, so equal contexts
   are selected alike; among any t positions one is selected, unless 3t-1 words
   there are highly periodic.
3. Two selected positions with equal 2t words propose their distance as period.
   A run of period q with (3t-1)/2 <= q <= 3t-1-t/3 has a selected position in
   its first t words and another one q later, so its period is proposed.
4. A proposal is extended both ways by binary search over prefix hashes. Every
   run is then compared word by word; where two hashes agreed by chance, the
   extension is taken again without hashes.

Selecting by hash decides only which positions are looked at; no run depends on
a hash being free of collisions. All texts of a slice are worked on at once;
texts never leave their task, so there is no shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vantage.llm.common import text_slices
from vantage.llm.textops import mix64, utf8

U64 = np.uint64
_MOST = U64(0xFFFFFFFFFFFFFFFF)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
DIRECT = 8     # periods found by direct comparison
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True


def scales(longest: int):
    """(window, least period, largest period) of each scale, for periods above DIRECT and up to `longest`."""
    t, low = 6, DIRECT + 1
    while low <= longest:
        high = 3 * t - 1 - t // 3
        yield t, low, min(high, longest)
        low, t = high + 1, t * 4 // 3 if t % 3 == 0 else t * 3 // 2


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, U64(base))
    out[:1] = 1
    return np.cumprod(out, dtype=U64)


class Sequence:
    """Words (as numbers) of several texts one after the other, the longest text first, with hashes of any stretch."""

    def __init__(self, code: np.ndarray, bounds: np.ndarray, bits: int = 64):
        """bits: width of the hashes, below 64 only to test what collisions do."""
        self.code, self.bounds = code, bounds
        self.end = np.repeat(bounds[1:], np.diff(bounds))     # where each word's text ends
        self.mask = U64((1 << bits) - 1)
        with np.errstate(over="ignore"):
            value = mix64(code.astype(U64) + U64(0x632BE59BD9B4E019))
            self.prefix = np.concatenate([np.zeros(1, U64), np.cumsum(value * _powers(len(code), _BASE), dtype=U64)])
            self.inverse = _powers(len(code) + 1, _INVERSE)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix64((self.prefix[end] - self.prefix[start]) * self.inverse[start]) & self.mask

    def windows(self, t: int, m: int) -> np.ndarray:
        """Hash of the t words from each of the first m - t + 1 positions on."""
        with np.errstate(over="ignore"):
            return mix64((self.prefix[t:m + 1] - self.prefix[:m + 1 - t]) * self.inverse[:m + 1 - t]) & self.mask

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, way: int) -> np.ndarray:
        """Words on which the stretches from a and from b on (way 1) or up to them (way -1) agree, `most` at most."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            ends = (a, a + middle, b, b + middle) if way > 0 else (a - middle, a, b - middle, b)
            same = self.hash(ends[0], ends[1]) == self.hash(ends[2], ends[3])
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All positions of the stretches start .. start+size-1."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - ends + size, size)


def _distinct(runs: np.ndarray) -> np.ndarray:
    """Rows (start, end, period), one for each stretch: its smallest period."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)
    return runs[first]


def _short_periods(seq: Sequence) -> list[np.ndarray]:
    out = []
    at = np.arange(len(seq.code))
    for q in range(1, min(DIRECT, len(seq.code) - 1) + 1):
        same = np.zeros(len(seq.code) + 2 - q, np.int8)
        same[1:-1] = (seq.code[:-q] == seq.code[q:]) & (at[:-q] + q < seq.end[:-q])
        edge = np.diff(same)
        b, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        long = e - b >= 2 * q
        out.append(np.stack([b[long], e[long] + q, np.full(int(long.sum()), q)], 1))
    return out


def synchronising_set(seq: Sequence, t: int, m: int, runs: np.ndarray) -> np.ndarray:
    """Selected positions of window t among the first m words; `runs` holds all runs of periods up to t/3."""
    n = m - t + 1                              # windows
    if n <= t:
        return np.zeros(0, np.int64)
    value = np.minimum(seq.windows(t, m), _MOST - U64(1))
    own = runs[(3 * runs[:, 2] <= t) & (runs[:, 1] - runs[:, 0] >= t) & (runs[:, 1] <= m)]
    if len(own):
        edge = np.zeros(n + 1, np.int32)
        np.add.at(edge, own[:, 0], 1)
        np.add.at(edge, own[:, 1] - t + 1, -1)
        value[np.cumsum(edge[:-1]) > 0] = _MOST
    least, width = value, 1                    # least of the windows i .. i+t, by doubling
    while 2 * width <= t + 1:
        least = np.minimum(least[:len(least) - width], least[width:])
        width *= 2
    rest = t + 1 - width
    least = np.minimum(least[:n - t], least[rest:rest + n - t])
    chosen = ((value[:n - t] == least) | (value[t:] == least)) & (least != _MOST)
    chosen &= np.arange(n - t) + 2 * t <= seq.end[:n - t]
    return np.flatnonzero(chosen)


def _proposals(seq: Sequence, t: int, low: int, high: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, period) for selected positions of equal context at a distance of low to high."""
    context = seq.hash(at, at + 2 * t)
    by = np.argsort(context, kind="stable")
    at, context, end = at[by], context[by], seq.end[at[by]]
    left, right, step = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 1
    live = np.arange(len(at))
    while True:   # equal contexts by distance; a context that isn't highly periodic comes again after t/3 words at the earliest
        live = live[live + step < len(at)]
        live = live[context[live] == context[live + step]]
        gap = at[live + step] - at[live]
        live, gap = live[gap <= high], gap[gap <= high]
        if not len(live):
            break
        good = (gap >= low) & (end[live] == end[live + step])
        left.append(at[live[good]])
        right.append(gap[good])
        step += 1
    return np.concatenate(left), np.concatenate(right)


def _agreeing(seq: Sequence, runs: np.ndarray) -> np.ndarray:
    """Whether each run really keeps its period, word by word."""
    size = runs[:, 1] - runs[:, 0] - runs[:, 2]
    at = _spread(runs[:, 0], size)
    bad = seq.code[at] != seq.code[at + np.repeat(runs[:, 2], size)]
    return np.bincount(np.repeat(np.arange(len(runs)), size)[bad], minlength=len(runs)) == 0


def _plainly(seq: Sequence, s: int, q: int) -> tuple[int, int, int]:
    """The stretch around s that keeps period q, without hashes."""
    text = int(np.searchsorted(seq.bounds, s, "right")) - 1
    first, end = int(seq.bounds[text]), int(seq.bounds[text + 1])
    right = seq.code[s:end - q] != seq.code[s + q:end]
    left = seq.code[first:s] != seq.code[first + q:s + q]
    b = first + int(np.flatnonzero(left)[-1]) + 1 if left.any() else first
    return b, (s + q + int(right.argmax()) if right.any() else end), q


def find_runs(code: np.ndarray, sizes: np.ndarray, least: int = 24, exponent: int = 3, bits: int = 64):
    """(text, start, length, period) of all runs of length >= max(least, exponent * period), for texts of `sizes` words
    that follow each other in `code`; by text, start and period. exponent: 3 at least."""
    if exponent < 3:
        raise ValueError("synchronising sets find runs of three periods or more")
    none = np.zeros((0, 3), np.int64)
    order = np.argsort(-sizes, kind="stable")
    first = np.cumsum(sizes) - sizes
    own = sizes[order]
    seq = Sequence(code[_spread(first[order], own)], np.concatenate([[0], np.cumsum(own)]), bits)
    runs = _distinct(np.concatenate([none, *_short_periods(seq)]))
    for t, low, high in scales(int(sizes.max() // 3) if len(sizes) else 0):
        m = int(seq.bounds[np.searchsorted(-own, -3 * low, "right")])   # texts that can hold such a run come first
        at = synchronising_set(seq, t, m, runs)
        if not len(at):
            continue
        s, q = _proposals(seq, t, low, high, at)
        if not len(s):
            continue
        text = np.searchsorted(seq.bounds, s, "right") - 1
        b = s - seq.common(s, s + q, s - seq.bounds[text], -1)
        e = s + q + seq.common(s, s + q, seq.end[s] - s - q, 1)
        new, which = np.unique(np.stack([b, e, q], 1), axis=0, return_index=True)
        s = s[which]
        long = new[:, 1] - new[:, 0] >= 3 * new[:, 2]
        new, s = new[long], s[long]
        wrong = np.flatnonzero(~_agreeing(seq, new))
        for k in wrong:
            new[k] = _plainly(seq, int(s[k]), int(new[k, 2]))
        runs = _distinct(np.concatenate([runs, new[new[:, 1] - new[:, 0] >= 3 * new[:, 2]]]))
    runs = runs[runs[:, 1] - runs[:, 0] >= np.maximum(least, exponent * runs[:, 2])]
    text = np.searchsorted(seq.bounds, runs[:, 0], "right") - 1
    out = np.stack([order[text], runs[:, 0] - seq.bounds[text], runs[:, 1] - runs[:, 0], runs[:, 2]], 1)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


class Cut:
    """The words of a column of texts: stretches without blank, tab or line end (ASCII)."""

    def __init__(self, column: pa.Array):
        self.data, self.offs = utf8(column)
        self.inside = ~SEPARATOR[self.data]
        heads = self.offs[:-1][self.offs[:-1] < self.offs[1:]]
        edge = np.ones(len(self.data) + 1, bool)      # no word goes on from here
        edge[:-1] = ~self.inside
        edge[heads] = True
        before = np.ones(len(self.data), bool)
        before[1:] = ~self.inside[:-1]
        before[heads] = True
        self.start = np.flatnonzero(self.inside & before)
        self.end = np.flatnonzero(self.inside & edge[1:]) + 1
        self.bounds = np.searchsorted(self.start, self.offs)

    def codes(self) -> np.ndarray:
        """Equal words have equal numbers, others not."""
        if not len(self.start):
            return np.zeros(0, np.int64)
        # a word and the separators after it lie between two starts: separators are cut out first
        bounds = np.concatenate([[0], np.cumsum(self.end - self.start)])
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self.start),
                                                 [None, pa.py_buffer(bounds), pa.py_buffer(self.data[self.inside])])
        return words.dictionary_encode().indices.to_numpy().astype(np.int64)

    def joined(self, keep: np.ndarray) -> pa.Array:
        """Each text's kept words with one blank between."""
        size = self.end - self.start
        byte = np.zeros(len(self.data), bool)
        byte[self.inside] = np.repeat(keep, size)
        kept = np.flatnonzero(keep)
        text = np.searchsorted(self.bounds, kept, "right") - 1
        later = np.zeros(len(kept), bool)
        later[1:] = text[1:] == text[:-1]
        blank = self.start[kept[later]] - 1
        byte[blank] = True
        data = self.data.copy()
        data[blank] = 0x20
        n = len(self.offs) - 1
        own = np.bincount(text, size[kept], n).astype(np.int64) + np.bincount(text[later], minlength=n)
        offs = np.concatenate([[0], np.cumsum(own)])
        return pa.LargeStringArray.from_buffers(n, pa.py_buffer(offs), pa.py_buffer(data[byte]))


RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def periodic_runs(docs: DataFrame, keep: list[str], least: int = 24, exponent: int = 3, text: str = "text") -> DataFrame:
    """The columns `keep` of each row, `n_words`, `runs` (by start, then period) and `collapsed`: the words that no run
    holds after its first period, joined by one blank.

    Words are numbered from 0. A null text, like an empty one or one without a
    word, has no words, no runs and an empty `collapsed`. Rows stay as they are:
    repeated rows and null keys each give a row of their own, equal texts equal
    results. Columns of `keep` named like a new column give way to it. A text is
    worked on whole in one task, with about 150 bytes for each of its words and
    10 for each byte. An empty table gives an empty one."""
    new = ["n_words", "runs", "collapsed"]
    names = [c for c in keep if c not in new]
    kinds = dict(docs.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in names] + ["n_words bigint", f"runs {RUNS}", "collapsed string"])

    def run(batches):
        for batch in text_slices(batches, text):
            cut = Cut(batch.column(text))
            sizes = np.diff(cut.bounds)
            runs = find_runs(cut.codes(), sizes, least, exponent)
            edge = np.zeros(len(cut.start) + 1, np.int32)
            at = cut.bounds[runs[:, 0]] + runs[:, 1]
            np.add.at(edge, at + runs[:, 3], 1)
            np.add.at(edge, at + runs[:, 2], -1)
            offs = np.searchsorted(runs[:, 0], np.arange(len(sizes) + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offs), pa.StructArray.from_arrays(
                [pa.array(np.ascontiguousarray(runs[:, k])) for k in (1, 2, 3)], ["start", "length", "period"]))
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sizes, pa.int64()), lists, cut.joined(np.cumsum(edge[:-1]) == 0).cast(pa.string())],
                names=[*names, *new])

    return docs.select(*dict.fromkeys([*names, text])).mapInArrow(run, schema)


def with_planted_period(text: Column, key: Column) -> Column:
    """The contract's input: with h the crc32 of the decimal key and g = h / 10, a text of n words whose h is divisible
    by 10 repeats, from word a = g % n on, its next 1 + (n - a) / (3 + g % 8) words up to its end. Others, and null keys, stay."""
    h = F.crc32(key.cast("string"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (F.floor((n - a) / (F.lit(3) + g % 8)) + 1).cast("int")
        tail = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(tail, F.lit(1), n - a)), " ")

    # a lambda's variable holds the words: they are cut out of the text once
    words = F.array(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    planted = F.get(F.transform(words, lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(text)), F.lit(0))
    return F.when((h % 10 == 0) & text.isNotNull(), planted).otherwise(text)


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of greatest length / period, and digests of all runs and of the collapsed text."""
    better = lambda x, y: F.when(  # noqa: E731  exact: by cross multiplication, then smaller start, then smaller period
        x["length"] * y["period"] != y["length"] * x["period"], x["length"] * y["period"] > y["length"] * x["period"]
    ).when(x["start"] != y["start"], x["start"] < y["start"]).otherwise(x["period"] < y["period"])
    best = F.aggregate(F.col("runs"), F.get(F.col("runs"), F.lit(0)), lambda m, r: F.when(better(r, m), r).otherwise(m))
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                              r["period"].cast("string"), F.lit("\n"))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
