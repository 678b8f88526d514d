"""Language ID: prediction by partial matching with frozen statistics.

Each language has a byte context tree of depth 3: for every context of up to
three bytes, how often each byte followed it in the training texts. A byte's
code length is -log2 of its share in the longest context that the language
knows, or the escape cost of that context plus the code length one order lower
(method C escapes: with T events of D kinds a kind with c events costs
-log2(c / (T + D)), an escape -log2(D / (T + D)); order -1 is uniform). A text
goes to the language that codes it in the fewest bits; the score is that
language's posterior share under equal priors.

Training counts come from a bounded, documented sample: about `sample_docs`
different texts of each language, chosen by a hash of the text. Scoring reads
every byte of every text. The counts (a few 10,000 four-byte grams) are the
only thing that is broadcast; each worker expands them into lookup tables.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.llm.common import begin_task, kept, text_slices
from vantage.llm.textops import utf8

UNDETERMINED = "und"
MAX_LANGUAGES = 256
COUNT_TASKS = 8


@dataclass(frozen=True)
class Counts:
    """Four-byte grams (big-endian in an int64) by language index: the context trees' leaves."""

    languages: tuple[str, ...]
    gram: np.ndarray
    language: np.ndarray
    count: np.ndarray
    min_context: int
    uid: str = field(default_factory=lambda: uuid.uuid4().hex)  # names the tables built from them


def _padded(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case bytes with three zero bytes before each text; the texts' positions in it; offsets."""
    data, offs = utf8(pc.utf8_lower(column))
    at = np.arange(len(data)) + 3 * (np.repeat(np.arange(1, len(offs)), np.diff(offs)))
    buf = np.zeros(len(data) + 3 * (len(offs) - 1), np.uint8)
    buf[at] = data
    return buf, at, offs


def _context(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    wide = buf.astype(np.int32)
    return ((wide[:-3] << 16) | (wide[1:-2] << 8) | wide[2:-1])[at - 3]


def training_sample(docs: DataFrame, text: str, label: str, sample_docs: int) -> DataFrame:
    """About `sample_docs` different texts of each label (all, if there are fewer)."""
    known = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.col(label).alias("_label"), F.col(text).alias("_text"))
    h = F.xxhash64("_text")
    # the share counts different texts: copies would only make it smaller
    sizes = (known.select("_label", h.alias("_h")).distinct().groupBy("_label").count()
             .limit(MAX_LANGUAGES + 1).collect())
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} values of {label}")
    pairs = [F.lit(v) for r in sizes for v in (r["_label"], min(1.0, sample_docs / r["count"]))]
    share = F.element_at(F.create_map(*pairs), F.col("_label")) if pairs else F.lit(0.0)
    unit = F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53))
    return (known.where(unit < share).groupBy("_label", h.alias("_h")).agg(F.first("_text").alias("_text"))
            .select("_label", "_text"))


def fit(docs: DataFrame, text: str = "text", label: str = "lang", sample_docs: int = 400,
        min_context: int = 2) -> Counts:
    """Count the sample's grams. Contexts of two or three bytes that occur fewer
    than `min_context` times in all languages together stay out of the tree."""

    def grams(batches):
        held: dict[str, tuple] = {}  # one row for each gram that the task met
        for part in text_slices(batches, "_text"):
            labels = part.column("_label").to_pylist()
            buf, at, offs = _padded(part.column("_text"))
            if not len(at):
                continue
            gram = (_context(buf, at).astype(np.int64) << 8) | buf[at]
            names = sorted(set(labels))
            which = np.repeat(np.array([names.index(x) for x in labels]), np.diff(offs))
            for i, name in enumerate(names):
                u, c = np.unique(gram[which == i], return_counts=True)
                if name in held:
                    both, c = np.concatenate([held[name][0], u]), np.concatenate([held[name][1], c])
                    u, inv = np.unique(both, return_inverse=True)
                    c = np.bincount(inv, weights=c).astype(np.int64)
                held[name] = u, c
        for name, (u, c) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(u), pa.string()), pa.array(u), pa.array(c)],
                                             names=["label", "gram", "n"])

    # the sample is bounded, so a fixed number of tasks counts it
    rows = (training_sample(docs, text, label, sample_docs).coalesce(COUNT_TASKS)
            .mapInArrow(grams, "label string, gram long, n long")
            .groupBy("label", "gram").agg(F.sum("n").alias("n")).toArrow())
    names = sorted(set(rows.column("label").to_pylist()))
    which = pc.index_in(rows.column("label"), pa.array(names, pa.string())).to_numpy()
    return Counts(tuple(names), rows.column("gram").to_numpy(), which, rows.column("n").to_numpy(), min_context)


class Model:
    """Lookup tables: bytes -> state of the longest known context -> cost of the next byte by language."""

    def __init__(self, c: Counts):
        self.languages, n_lang = c.languages, len(c.languages)
        seen = np.unique(c.gram & 0xFF)
        self.symbol = np.zeros(256, np.int32)  # 0: a byte never seen in training
        self.symbol[seen] = np.arange(1, len(seen) + 1)
        width = len(seen) + 1
        self.width, sym = width, self.symbol[c.gram & 0xFF]
        table = np.zeros((0, width, n_lang))
        states = np.zeros(1, np.int32)  # row of `table` of the longest kept suffix of each context
        for order in range(4):
            keys, inv = np.unique((c.gram >> 8) & ((1 << 8 * order) - 1), return_inverse=True)
            keep = np.bincount(inv, weights=c.count) >= (c.min_context if order > 1 else 1)
            counts = np.zeros((int(keep.sum()), width, n_lang))
            use = keep[inv]
            np.add.at(counts, ((np.cumsum(keep) - 1)[inv][use], sym[use], c.language[use]), c.count[use])
            keys = keys[keep]
            below = table[states[keys & ((1 << 8 * (order - 1)) - 1)]] if order else 8.0
            total, kinds = counts.sum(1, keepdims=True), (counts > 0).sum(1, keepdims=True)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
                cost = np.where(counts > 0, -np.log2(counts / (total + kinds)), escape + below)
            states = np.tile(states, 256 if order else 1)
            states[keys] = len(table) + np.arange(len(keys), dtype=np.int32)
            table = np.concatenate([table, cost])
        self.state = states
        self.cost = table.reshape(-1, n_lang).astype(np.float32)

    def bits(self, column: pa.Array) -> np.ndarray:
        """Code length of each text in each language."""
        buf, at, offs = _padded(column)
        out = np.zeros((len(offs) - 1, len(self.languages)))
        full = np.flatnonzero(np.diff(offs))
        if len(full):
            row = self.state[_context(buf, at)] * self.width + self.symbol[buf[at]]
            out[full] = np.add.reduceat(self.cost[row], offs[full], axis=0, dtype=np.float64)
        return out


_MODELS: dict[str, Model] = kept()


def predict(docs: DataFrame, counts: Counts, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns `keep`, then lang_pred, score (0 to 1), bits_per_byte.

    A null text, a text without any letter, and every text if there is no
    language to choose from give `und` with score 0 and no bits. Languages that
    tie are taken in alphabetical order. No other column is read."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    frame = docs.select(*keep, F.col(text).alias("_text"))
    kept = [f for f in frame.schema if f.name != "_text"]

    def score(batches):
        begin_task()
        counts = shared.value
        if counts.languages and counts.uid not in _MODELS:  # once for each Python worker
            _MODELS.clear()
            _MODELS[counts.uid] = Model(counts)
        names = np.array(counts.languages + (UNDETERMINED,), object)
        for part in text_slices(batches, "_text", 2 << 20):
            texts = part.column("_text")
            letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            n = np.maximum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), 1)
            if counts.languages:
                bits = _MODELS[counts.uid].bits(texts)
                best = bits.argmin(1)
                least = bits[np.arange(len(best)), best]
                share = 1.0 / np.exp2(np.minimum(least[:, None] - bits, 0.0)).sum(1)
            else:
                letters, best = np.zeros(len(texts), bool), np.zeros(len(texts), int)
                least = share = np.zeros(len(texts))
            best = np.where(letters, best, len(names) - 1)
            yield pa.RecordBatch.from_arrays(
                [part.column(f.name) for f in kept] + [
                    pa.array(names[best], pa.string()), pa.array(np.where(letters, share, 0.0)),
                    pa.array(np.where(letters, least / n, np.nan), mask=~letters)],
                names=[f.name for f in kept] + ["lang_pred", "score", "bits_per_byte"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
                       + ["lang_pred string", "score double", "bits_per_byte double"])
    return frame.mapInArrow(score, schema)


def held_out() -> F.Column:
    """Rows that the classifier never learns from: crc32 of the id's text, mod 4, is 2 (a null id: not held out)."""
    return F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, sample_docs: int = 400) -> DataFrame:
    """doc_id, held_out, lang_pred, score, bits_per_byte for every row of `docs`."""
    own = docs.select("doc_id", "text", "lang").withColumn("held_out", held_out())
    counts = fit(own.where(~F.col("held_out")), sample_docs=sample_docs)
    return predict(own, counts, keep=("doc_id", "held_out"))


def keep_identified(docs: DataFrame, min_score: float = 0.5, sample_docs: int = 400) -> DataFrame:
    """Rows of `docs` whose language is determined with at least `min_score`; the columns stay."""
    names = [f"_c{i}" for i in range(len(docs.columns))]  # no column can clash with the prediction's
    counts = fit(docs.select("text", "lang", held_out().alias("_held")).where("not _held"), sample_docs=sample_docs)
    text = names[docs.columns.index("text")]
    marked = predict(docs.toDF(*names), counts, text=text, keep=tuple(names))
    return marked.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= min_score)).select(
        *[F.col(n).alias(c) for n, c in zip(names, docs.columns)])
