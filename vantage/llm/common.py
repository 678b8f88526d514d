"""Helpers shared by the operators: the shared scratch folder, table reads, chunked text."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from vantage.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (``spark.checkpoint.dir``)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/vantage-llm/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts the lineage, so that
    a lost executor costs a re-read and not a recomputation."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_TABLES: list[dict] = []        # what modules keep between the tasks of a worker
_STAGE: list[int | None] = [None]


def kept() -> dict:
    """A table that a module keeps between the tasks of a stage. Workers are
    reused by later stages: there it starts empty."""
    _TABLES.append({})
    return _TABLES[-1]


def give_back() -> None:
    """Freed memory of this worker goes back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def begin_task() -> None:
    """Drop what a reused worker has kept from tasks of another stage."""
    task = TaskContext.get()
    stage = task.stageId() if task else None
    if stage != _STAGE[0]:
        _STAGE[0] = stage
        for t in _TABLES:
            t.clear()
        give_back()


def text_slices(batches, column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into row slices of at most `max_bytes` of text (a longer
    single text is a slice of its own), so that the arrays that numpy makes from
    a slice stay small whatever the batch size is. What a task has freed by its
    end goes back to the system."""
    begin_task()
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, n in enumerate(sizes):
            if i > start and total + n > max_bytes:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(n)
        if start < batch.num_rows:
            yield batch.slice(start)
    give_back()
