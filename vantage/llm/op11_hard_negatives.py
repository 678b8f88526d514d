"""Hard-negative mining by Kronecker-packed products, exact in integers.

A vector's components become floor(scale * x). For inner products with many
candidates at once, components are biased to be non-negative, and one component
of several candidates lies in separate fields of one wide integer. The anchor's
component, biased too, is multiplied once with that integer; the sum over all
components holds each candidate's biased inner product in its own field, as a
field is wide enough for the largest sum. Taking the biases off again gives the
exact scores. Fields of up to 26 bits are packed in the 53 bits that a double
holds exactly, so that the products and sums of a tile are one matrix product;
fields of up to 32 bits are packed in 64-bit words; for larger components the
same is done with Python's unbounded integers.

Anchors meet candidates in blocks: a task holds one shard of candidates and one
block of anchors. A first pass finds each anchor's positives, a second one the
negatives within each positive's band; each shard only passes on its best.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vantage.llm.common import materialize

ANCHOR_BLOCK = 8_192
SHARD = 16_384          # candidates of a shard, about
TILE = 1 << 20          # scores that a task holds at a time
DOUBLE_BITS = 53        # whole numbers below 2^53 are exact in a double
WIDE_FIELDS = 16        # candidates in one unbounded integer


class Packed:
    """Candidates' components in fields of wide integers."""

    def __init__(self, candidates: np.ndarray, anchor_low: int, anchor_high: int):
        """candidates: an integer matrix; anchors' components lie between anchor_low and anchor_high."""
        self.n, self.dim = candidates.shape
        self.bias, self.anchor_bias = -int(candidates.min()), -anchor_low
        largest = self.dim * (int(candidates.max()) + self.bias) * (anchor_high + self.anchor_bias)
        self.bits = max(1, largest.bit_length())
        # biased sums and the biases' own sums must fit the words they are taken in
        extent = self.dim * max(abs(int(candidates.min())), abs(int(candidates.max())), 1) * max(
            abs(anchor_low), abs(anchor_high), 1)
        self.small = 2 * self.bits <= 64 and 4 * extent < 1 << 62
        self.double = self.small and 2 * self.bits <= DOUBLE_BITS   # every sum of products is a whole number below 2^53
        self.fields = (DOUBLE_BITS if self.double else 64) // self.bits if self.small else WIDE_FIELDS
        self.kind = np.uint64 if self.small else object
        rows = -(-self.n // self.fields)
        lifted = np.zeros((rows * self.fields, self.dim), self.kind)
        exact = candidates.astype(np.int64 if self.small else object)
        lifted[:self.n] = (exact + self.bias).astype(self.kind)
        self.words = np.zeros((rows, self.dim), self.kind)
        for f in range(self.fields):
            self.words += lifted[f::self.fields] << self._number(f * self.bits)
        if self.double:
            self.words = self.words.astype(np.float64)
        self.sums = exact.sum(1)

    def _number(self, x: int):
        return np.uint64(x) if self.small else x

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Inner products [anchor, candidate]."""
        exact = anchors.astype(np.int64 if self.small else object)
        lifted = (exact + self.anchor_bias).astype(self.kind)
        if self.double:
            total = (lifted.astype(np.float64) @ self.words.T).astype(np.uint64)
        else:
            total = np.zeros((len(anchors), len(self.words)), self.kind)
            for d in range(self.dim):    # one product for each component and word
                total += lifted[:, d, None] * self.words[:, d]
        field = self._number((1 << self.bits) - 1)
        out = np.empty((len(anchors), len(self.words) * self.fields), np.int64 if self.small else object)
        for f in range(self.fields):
            out[:, f::self.fields] = (total >> self._number(f * self.bits)) & field
        # sum (a+A)(c+B) = sum ac + B sum a + A sum c + dim A B
        shift = self.bias * exact.sum(1)[:, None] + self.anchor_bias * self.sums + self.dim * self.anchor_bias * self.bias
        return out[:, :self.n] - shift


def best(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k highest allowed scores of each row; among equals the columns from the left."""
    k = min(k, scores.shape[1])
    if scores.dtype == object or 1 << 62 < (int(np.abs(scores).max(initial=0)) + 1) * 2 * scores.shape[1]:
        order = np.argsort(-scores, axis=1, kind="stable")
        ok = np.take_along_axis(allowed, order, 1)
        ok &= np.cumsum(ok, 1) <= k
        row, place = np.nonzero(ok)
        return row, order[row, place]
    least = -np.iinfo(np.int64).max
    key = np.where(allowed, scores * scores.shape[1] - np.arange(scores.shape[1]), least)
    column = np.argpartition(-key, k - 1, axis=1)[:, :k] if k < scores.shape[1] else np.broadcast_to(np.arange(k), key.shape)
    ok = np.take_along_axis(key, column, 1) != least
    row, place = np.nonzero(ok)
    return row, column[row, place]


def _ordered(scores: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """(keys, number of columns that aren't allowed) of each row, the keys ascending, those not allowed first: one key
    for each column, higher for a higher score and, among equals, further left. None if they don't fit 64 bits."""
    n = scores.shape[1]
    if scores.dtype == object or 1 << 62 < (int(np.abs(scores).max(initial=0)) + 1) * 2 * n:
        return None
    keys = np.where(allowed, scores * n + (n - 1 - np.arange(n)), np.iinfo(np.int64).min)
    keys.sort(axis=1)
    return keys, n - allowed.sum(1)


def _best_within(keys: np.ndarray, shut: int, n: int, least: np.ndarray, most: np.ndarray, k: int):
    """(band, column, score) of the k highest scores of a row's keys within each band least..most."""
    # a score lies in least..most if its key lies in least * n .. (most + 1) * n - 1; bands beyond all scores are cut to them
    low, high = (keys[shut] // n, keys[-1] // n) if shut < n else (0, -1)
    first = np.maximum(np.searchsorted(keys, np.clip(least, low, high + 1) * n), shut)
    past = np.searchsorted(keys, (np.clip(most, low - 1, high) + 1) * n)
    place = past[:, None] - 1 - np.arange(k)
    band, at = np.nonzero(place >= first[:, None])
    key = keys[place[band, at]]
    return band, n - 1 - key % n, key // n


def _matrix(column, exact) -> np.ndarray:
    flat = column.combine_chunks().flatten()
    values = [int(x) for x in flat.to_pylist()] if exact else flat.to_numpy(zero_copy_only=False)
    return np.array(values, object if exact else np.int64).reshape(len(column), -1)


def _tiles(anchors: np.ndarray, candidates: int):
    step = max(1, TILE // max(candidates, 1))
    for k in range(0, len(anchors), step):
        yield slice(k, k + step)


def _shard(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, labels and components of a shard, by ascending id."""
    table = table.sort_by("vec_id")
    return table["vec_id"].to_numpy(), table["label"].to_numpy(), _matrix(table["c"], pa.types.is_string(table["c"].type.value_type))


def components(vectors: DataFrame, label: Column, scale: int) -> DataFrame:
    """vec_id, label, c (the integer components) and dim of the rows that take part; see `mine`."""
    v = F.col("embedding")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = lambda x: F.floor(x.cast("double") * F.lit(float(scale)))
    rows = vectors.where(F.col("vec_id").isNotNull() & v.isNotNull() & label.isNotNull()).where(sound & (F.size(v) > 0))
    return (rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
                        F.transform(v, lambda x: x.cast("double")).alias("v"))
            .groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r"))
            .select("vec_id", "r.label", F.transform("r.v", whole).alias("c"), F.size("r.v").alias("dim")))


def mine(vectors: DataFrame, is_anchor: Column, label: Column | None = None, scale: int = 256, positives: int = 5,
         negatives: int = 3, low: int = 50, high: int = 95, shard_size: int = SHARD) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    An anchor (`is_anchor`, an expression of vec_id) has as positives the first
    `positives` other rows of its label, by score (highest first), then vec_id.
    For each of them, the first `negatives` rows of other labels whose score is
    low to high per cent of the positive's (both included) are returned; a
    positive with a negative score has none, nor has a pair without such a row.

    Scores are integer inner products of components floor(scale * x), x taken
    as double. Rows with a null vec_id, label or vector, an empty vector, or a
    null or non-finite component take no part. Vectors only meet those of the
    same length. Of rows that share a vec_id the least (label, vector) counts.
    Other columns aren't read. An empty table gives an empty result. Components
    beyond 2^62 / scale don't fit Spark's long and are an error there."""
    rows = materialize(components(vectors, F.col("label") if label is None else label, scale), "negatives-rows")
    size = rows.agg(F.count("*").alias("n"), F.count_if(is_anchor).alias("anchors")).first()
    shards, blocks = max(1, -(-size["n"] // shard_size)), max(1, -(-size["anchors"] // ANCHOR_BLOCK))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    place = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int")
    keys = ["dim", "shard", "block"]
    candidates = rows.select("vec_id", "label", "c", "dim", place(shards, 5).alias("shard"), every(blocks).alias("block"))

    def meet(anchors: DataFrame, search, schema: str) -> DataFrame:
        dealt = anchors.withColumns({"block": place(blocks, 9)}).withColumn("shard", every(shards))

        def task(left: pa.Table, right: pa.Table) -> pa.Table:
            found = search(*_shard(left), right) if left.num_rows and right.num_rows else None
            return pa.table(found) if found else pa.table({n: pa.array([], pa.int64()) for n in names})

        names = [x.split()[0] for x in schema.split(", ")]
        return candidates.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(task, schema)

    def find_positives(ids, labels, c, right):
        own, own_labels, a = right["vec_id"].to_numpy(), right["label"].to_numpy(), _matrix(right["c"], False)
        packed, out = Packed(c, int(a.min()), int(a.max())), []
        for t in _tiles(a, len(ids)):
            s = packed.scores(a[t])
            r, k = best(s, (labels == own_labels[t, None]) & (ids != own[t, None]), positives)
            out.append((own[t][r], ids[k], s[r, k].astype(np.int64)))
        return dict(zip(("anchor_id", "positive_id", "positive_score"), map(np.concatenate, zip(*out))))

    def find_negatives(ids, labels, c, right):
        own, own_labels, a = right["vec_id"].to_numpy(), right["label"].to_numpy(), _matrix(right["c"], False)
        pairs = right["pairs"].combine_chunks()
        count = np.diff(pairs.offsets.to_numpy())
        offs = np.cumsum(count) - count
        ids_of, score_of = (pairs.flatten().field(k).to_numpy() for k in ("positive_id", "positive_score"))
        packed, out = Packed(c, int(a.min()), int(a.max())), []
        # the bands in whole scores: ceil(low p / 100) .. floor(high p / 100)
        least, most = -(-low * score_of // 100), high * score_of // 100
        for t in _tiles(a, len(ids)):
            s, apart = packed.scores(a[t]), labels != own_labels[t, None]
            ordered = _ordered(s, apart)
            for i in range(len(s)):      # an anchor's scores are put in order once, for all its bands
                p = offs[t][i] + np.arange(count[t][i])
                if ordered:
                    band, k, score = _best_within(ordered[0][i], ordered[1][i], len(ids), least[p], most[p], negatives)
                else:
                    row = s[i][None].repeat(len(p), 0)
                    band, k = best(row, apart[i] & (row >= least[p, None]) & (row <= most[p, None]), negatives)
                    score = s[i][k].astype(np.int64)
                out.append((np.full(len(band), own[t][i]), ids_of[p[band]], ids[k], score_of[p[band]], score))
        names = ("anchor_id", "positive_id", "negative_id", "positive_score", "negative_score")
        return dict(zip(names, map(np.concatenate, zip(*out))))

    first = lambda by, order, k: F.row_number().over(Window.partitionBy(*by).orderBy(*order)) <= k
    anchors = rows.where(is_anchor)
    near = meet(anchors, find_positives, "anchor_id long, positive_id long, positive_score long")
    near = (near.withColumn("_first", first(["anchor_id"], [F.desc("positive_score"), F.asc("positive_id")], positives))
            .where("_first").groupBy(F.col("anchor_id").alias("vec_id"))
            .agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("pairs")))   # `positives` at most
    wanted = materialize(anchors.join(near, "vec_id"), "negatives-anchors")
    found = meet(wanted, find_negatives, "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long")
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def oracle(positives: int = 5, negatives: int = 3) -> str:
    """The contract in DuckDB SQL, every anchor against every row."""
    return f"""
WITH sound AS (
  SELECT CAST(vec_id AS BIGINT) AS vec_id, CAST(if(vec_id % 7 = 0, (label + 1) % 10, label) AS BIGINT) AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other, a.label = r.label AS same,
         CAST(list_sum(list_transform(list_zip(a.c, r.c), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM sound a JOIN sound r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id AND len(a.c) = len(r.c)),
positive AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM pair WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= {positives})
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other) AS INTEGER) AS rank,
       n.other AS negative_id, p.positive_score, n.score AS negative_score
FROM positive p JOIN pair n ON n.anchor_id = p.anchor_id AND NOT n.same
 AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
QUALIFY rank <= {negatives}"""
