"""Sharding [native]: a Feistel permutation with cycle walking over global row numbers.

Rows are numbered from 0 in (doc_id, text hash) order; a keyed permutation of
0..N-1 gives each row a place p, and shard = p mod S, slot = p div S. The law
is `rows`: shard sizes differ by one at most, and slots have no gaps. Anyone
who knows N, S and the seed can compute shard and slot of a row number.
Only DataFrame expressions are used.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vantage.llm.common import materialize

PRIME = 2_147_483_647      # round function: squares modulo this prime
MULTIPLIER = 48_271
ROUNDS = 6
MAX_WALK = 64              # see `permute`


def round_keys(seed: int) -> list[int]:
    return [int.from_bytes(hashlib.sha256(f"{seed}:{i}".encode()).digest()[:4], "big") % PRIME
            for i in range(ROUNDS)]


def permute_int(x: int, n: int, keys: list[int]) -> int:
    """The permutation for one Python integer: what `permute` states as an expression."""
    a = math.isqrt(n - 1) + 1

    def once(v: int) -> int:
        left, right = divmod(v, a)
        for k in keys:
            t = (right * MULTIPLIER + k) % PRIME
            left, right = right, (left + t * t % PRIME) % a
        return left * a + right

    v = once(x)
    while v >= n:
        v = once(v)
    return v


def permute(x: Column, n: Column, a: Column, keys: list[int]) -> Column:
    """Balanced Feistel network on pairs below `a` (a*a >= n, the smallest such),
    walked along its cycle until the value is below n.

    a*a - n < 2a + 1 values lie outside, each met at most once in a walk: up to
    n = 1,024 at most 64 of them, so `MAX_WALK` steps always suffice; beyond,
    a step stays outside with a chance below 1/16, so 64 steps fail with a
    chance below 1e-77 (and `raise_error` would then stop the job).
    """
    ks = F.array(*[F.lit(k).cast("long") for k in keys])

    def once(v: Column) -> Column:
        def turn(s: Column, k: Column) -> Column:
            t = (s["r"] * F.lit(MULTIPLIER) + k) % F.lit(PRIME)
            return F.struct(s["r"].alias("l"), ((s["l"] + (t * t) % F.lit(PRIME)) % a).alias("r"))
        start = F.struct(F.floor(v / a).cast("long").alias("l"), (v % a).alias("r"))
        return F.aggregate(ks, start, turn, lambda s: s["l"] * a + s["r"])

    first = once(x)
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(MAX_WALK)), first,
                         lambda v, _: F.when(v < n, v).otherwise(once(v)))
    return F.when(first < n, first).otherwise(walked)


def number_rows(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add `row_no` (0..N-1 in `order`) and `n_rows` without a single-task window:
    range partitions are sorted apart, and each adds the rows of those before it.

    The sorted rows are written once, so that counting and numbering see the
    same partitions even if an executor is lost between the two."""
    placed = (rows.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_at", F.monotonically_increasing_id()))
    placed = materialize(placed, "numbered").withColumn("_part", F.shiftright("_at", 33))
    parts = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    # one row for each range partition: as many as spark.sql.shuffle.partitions at most
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                           F.sum("_n").over(Window.partitionBy()).alias("n_rows"))
    return (placed.join(F.broadcast(offsets), "_part")
            .withColumn("row_no", F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("_part", "_at", "_before"))


def shard_rows(rows: DataFrame, order: list[str], shards: int = 8, seed: int = 17) -> DataFrame:
    """Number `rows` in `order` and add `shard` (int) and `slot` (long).

    Rows equal in all of `order` may take each other's place. An empty table
    gives an empty result."""
    numbered = number_rows(rows, order)
    root = F.ceil(F.sqrt(F.col("n_rows").cast("double"))).cast("long")
    root = F.when((root - 1) * (root - 1) >= F.col("n_rows"), root - 1).when(
        root * root < F.col("n_rows"), root + 1).otherwise(root)
    numbered = numbered.withColumn("_root", root)
    place = permute(F.col("row_no"), F.col("n_rows"), F.col("_root"), round_keys(seed))
    return (numbered.withColumn("place", place)
            .withColumn("shard", (F.col("place") % shards).cast("int"))
            .withColumn("slot", F.floor(F.col("place") / F.lit(shards)).cast("long"))
            .drop("_root"))


def shard_documents(docs: DataFrame, shards: int = 8, seed: int = 17) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null: the law is `rows`).

    size is the text's UTF-8 bytes plus 1 (a null text has no bytes and a null
    crc). Null doc_ids come first; rows with equal doc_id and text are told
    apart only by their place, so any of them may hold either slot. Other
    columns of `docs` are not read."""
    text = F.col("text")
    rows = docs.select("doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.xxhash64(text).alias("_tie"))
    return shard_rows(rows, ["doc_id", "_tie"], shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
