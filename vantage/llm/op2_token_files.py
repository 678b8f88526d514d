"""Token-ID output: ids of whole texts, in ascending doc_id order, coded by an adaptive context-mixing range coder.

Documents are range-partitioned by doc_id; each partition is a part of the
output. A part holds segments of whole documents (at least `SEGMENT_IDS` ids, but for the last), a
segment holds blocks of `block_ids` ids, and each block is coded from a reset
state (`range_coder`) with its number of coded words and the crc32 of its ids.
Any segment can be read alone, and a damaged block is found by its checksum.

The container is Parquet, written by Spark's committer to any path that Spark
reaches, so a lost executor leaves nothing half-written: one row for each
segment, with columns

    format      "vantage-ids-1"
    part        number of the part; parts ascend in doc_id
    segment     number of the segment inside its part
    first_id    ids of the part before this segment
    doc_ids     ids of its documents, in order (a null doc_id stays null)
    doc_sizes   number of ids of each document, with the end id
    block_ids   ids in each block but the last
    block_words 16-bit words that each block takes
    block_crcs  crc32 of each block's ids as little-endian unsigned 32-bit integers
    payload     the blocks' words, little-endian, one block after the other
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vantage.llm import range_coder
from vantage.llm.common import begin_task, scratch, text_slices
from vantage.llm.tokens import tokenizer

FORMAT = "vantage-ids-1"
END_ID = 0
SEGMENT_IDS = 1_000_000
CODE_IDS = 2_000_000      # ids that a task codes or decodes in one go: two segments fill the coder's lanes once
SCHEMA = ("format string, part int, segment int, first_id long, doc_ids array<long>, doc_sizes array<long>, "
          "block_ids int, block_words array<int>, block_crcs array<long>, payload binary")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _blocks(n: int, block_ids: int) -> list[int]:
    return [block_ids] * (n // block_ids) + [n % block_ids] * (n % block_ids > 0)


def _little(ids: np.ndarray) -> bytes:
    return ids.astype("<u4", copy=False).tobytes()


def pack_segments(segments: list, part: int, block_ids: int) -> pa.RecordBatch:
    """Rows of segments (number, ids before it, doc ids, doc sizes, ids)."""
    cuts = [_blocks(len(s[4]), block_ids) for s in segments]
    sizes = np.array([n for c in cuts for n in c], np.int64)
    ids = np.concatenate([s[4] for s in segments])
    words, counts = range_coder.encode(ids, sizes)
    data, ends = _little(ids), np.cumsum(sizes)
    crcs = [zlib.crc32(data[4 * (e - n):4 * e]) for n, e in zip(sizes.tolist(), ends.tolist())]
    block, word, rows = 0, 0, []
    for (number, before, docs, doc_sizes, _), cut in zip(segments, cuts):
        own = counts[block:block + len(cut)]
        taken = int(own.sum())
        rows.append({"format": FORMAT, "part": part, "segment": number, "first_id": before, "doc_ids": docs,
                     "doc_sizes": doc_sizes, "block_ids": block_ids, "block_words": own.tolist(),
                     "block_crcs": crcs[block:block + len(cut)],
                     "payload": words[word:word + taken].astype("<u2").tobytes()})
        block, word = block + len(cut), word + taken
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema([
        ("format", pa.string()), ("part", pa.int32()), ("segment", pa.int32()), ("first_id", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())), ("doc_sizes", pa.list_(pa.int64())), ("block_ids", pa.int32()),
        ("block_words", pa.list_(pa.int32())), ("block_crcs", pa.list_(pa.int64())), ("payload", pa.binary())]))


def unpack_segments(rows: list[dict]) -> list[np.ndarray]:
    """The ids of each row; raises ValueError if a block does not have its checksum."""
    cuts = [_blocks(sum(r["doc_sizes"]), r["block_ids"]) for r in rows]
    if any(r["format"] != FORMAT or len(c) != len(r["block_words"]) for r, c in zip(rows, cuts)):
        raise ValueError("not a segment of this format")
    sizes = np.array([n for c in cuts for n in c], np.int64)
    counts = np.array([n for r in rows for n in r["block_words"]], np.int64)
    words = np.concatenate([np.frombuffer(r["payload"], "<u2") for r in rows])
    if len(words) != counts.sum():
        raise ValueError("a segment is cut short")
    ids = range_coder.decode(words, counts, sizes)
    data, ends = _little(ids), np.cumsum(sizes)
    for i, (n, e, crc) in enumerate(zip(sizes.tolist(), ends.tolist(), (c for r in rows for c in r["block_crcs"]))):
        if zlib.crc32(data[4 * (e - n):4 * e]) != crc:
            raise ValueError(f"block {i} is damaged")
    return np.split(ids, np.cumsum([sum(c) for c in cuts])[:-1])


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str | None = None, block_ids: int = 2048) -> None:
    """Write the ids of every row of `docs` (doc_id, text) to `path`.

    A special token's string in a text is that token, as the library takes it by
    default. A null text is empty; every document ends with id 0, so an empty one has a
    single id. Null doc_ids come first; rows that share a doc_id follow each
    other in order of a hash of the text. Other columns are not read; an empty
    table gives no segment."""
    source = tokenizer_path or default_tokenizer()

    def code(batches):
        held, waiting, number, before = [], 0, 0, 0
        docs_, sizes_, ids_, n = [], [], [], 0
        part = 0
        begin_task()
        bpe = tokenizer(source)
        for piece in text_slices(batches, "text", 2 << 20):
            part = piece.column("part")[0].as_py()
            ids, sizes = bpe.encode(piece.column("text"))
            ends = np.cumsum(sizes)
            ids = np.insert(ids, ends, END_ID)
            ends = ends + np.arange(1, len(ends) + 1)
            begin = 0
            for d, e in zip(piece.column("doc_id").to_pylist(), ends.tolist()):
                docs_.append(d)
                sizes_.append(e - begin)
                ids_.append(ids[begin:e])
                n, begin = n + e - begin, e
                if n >= SEGMENT_IDS:
                    held.append((number, before, docs_, sizes_, np.concatenate(ids_)))
                    number, before, waiting = number + 1, before + n, waiting + n
                    docs_, sizes_, ids_, n = [], [], [], 0
                    if waiting >= CODE_IDS:
                        yield pack_segments(held, part, block_ids)
                        held, waiting = [], 0
        if n:
            held.append((number, before, docs_, sizes_, np.concatenate(ids_)))
        if held:
            yield pack_segments(held, part, block_ids)

    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                        F.xxhash64("text").alias("_tie"))
            .repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")
            .select("doc_id", "text", F.spark_partition_id().alias("part")))
    rows.mapInArrow(code, SCHEMA).write.parquet(path)


def read_documents(files: DataFrame, with_ids: bool = False) -> DataFrame:
    """part, doc_id, part_start (ids of the part before the document), n_tokens, ids_crc32 (and ids) of the files' rows."""

    def read(batches):
        held, n = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                held.append(row)
                n += sum(row["doc_sizes"])
                if n >= CODE_IDS:
                    yield out(held)
                    held, n = [], 0
        if held:
            yield out(held)

    def out(rows):
        columns = [[], [], [], [], [], []]
        for row, ids in zip(rows, unpack_segments(rows)):
            data, at = _little(ids), 0
            for d, size in zip(row["doc_ids"], row["doc_sizes"]):
                values = (row["part"], d, row["first_id"] + at, size, zlib.crc32(data[4 * at:4 * (at + size)]),
                          ids[at:at + size] if with_ids else None)
                for column, v in zip(columns, values):
                    column.append(v)
                at += size
        arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int32(), *[pa.int64()] * 4))]
        names = ["part", "doc_id", "part_start", "n_tokens", "ids_crc32"]
        if with_ids:
            arrays, names = [*arrays, pa.array(columns[5], pa.list_(pa.int64()))], [*names, "ids"]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    return files.mapInArrow(read, "part int, doc_id long, part_start long, n_tokens long, ids_crc32 long"
                            + ", ids array<long>" * with_ids)


def index(files: DataFrame, with_ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (and ids), read back from the files."""
    # one row for each part: as many as there were shuffle partitions, whatever the corpus
    sizes = files.select("part", F.aggregate("doc_sizes", F.lit(0).cast("long"), lambda s, n: s + n).alias("n")).groupBy(
        "part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return read_documents(files, with_ids).join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("before") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def token_index(docs: DataFrame, path: str | None = None, tokenizer_path: str | None = None,
                block_ids: int = 2048) -> DataFrame:
    """Write the files (to a new folder of the shared scratch, if no path is given) and read them back."""
    spark = docs.sparkSession
    path = path or scratch(spark, "token-files")
    write_token_files(docs, path, tokenizer_path, block_ids)
    return index(spark.read.schema(SCHEMA).parquet(path))
