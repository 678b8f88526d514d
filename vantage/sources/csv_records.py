"""Records of CSV files with quoted line breaks, read by many tasks a file (S-1).

Whether a line break stands inside quotes depends on all quotes before it, so
such files are usually read by one task each. Here Spark reads plain lines, each
split on its own; a line with an odd number of quotes opens or closes a quoted
break. Their count before a line is a prefix sum in three levels (file, split,
chunk of 4,096 lines), and a line belongs to a longer record if that count is
odd or the line itself opens one. Lines of chunks without any quoted break,
usually nearly all, pass on without a shuffle where the list of the other chunks
is small enough for Spark to broadcast by its own measure; the others are
shuffled by chunk, and only the lines of longer records are grouped.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CHUNK_BITS = 12    # a chunk is 2^12 lines at most
PLACE = ["file", "split", "chunk"]


def _odd(line: Column, escape: str) -> Column:
    """1 if the line has an odd number of quotes; a quote after a backslash, if that escapes, is a character."""
    bare = F.regexp_replace(line, r"\\.", "") if escape == "\\" else line
    return F.length(F.regexp_replace(bare, '[^"]', "")) % 2


def lines(spark: SparkSession, path: str, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """(file, split, chunk, at, value): lines with their place; `at` ascends with them inside a split."""
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                    F.monotonically_increasing_id().alias("at"), "value")
            .withColumn("chunk", F.shiftright("at", chunk_bits)))


def broken_chunks(rows: DataFrame, escape: str = "\\") -> DataFrame:
    """(file, split, chunk, before): chunks that a quoted line break touches, with the odd lines of the file before them.

    A file whose last quote stays open is an error."""
    chunks = rows.groupBy(*PLACE).agg(F.sum(_odd(F.col("value"), escape)).alias("n"))
    splits = chunks.groupBy("file", "split").agg(F.sum("n").alias("in_split"))
    upto = F.sum("in_split").over(Window.partitionBy("file").orderBy("split"))
    total = F.sum("in_split").over(Window.partitionBy("file"))
    splits = splits.select("file", "split", (upto - F.col("in_split")).alias("base"), (total % 2 == 1).alias("open"))
    inside = F.sum("n").over(Window.partitionBy("file", "split").orderBy("chunk")) - F.col("n")
    out = chunks.withColumn("inside", inside).join(splits, ["file", "split"])
    checked = F.when(F.col("open"), F.raise_error(F.concat(F.lit("a quote stays open in "), F.col("file")))
                     .cast("bigint")).otherwise(F.col("base") + F.col("inside"))
    return out.withColumn("before", checked).where((F.col("before") % 2 == 1) | (F.col("n") > 0)).select(*PLACE, "before")


def records(spark: SparkSession, path: str, escape: str = "\\", chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """(file, split, at, record): every record's text, quoted line breaks inside, empty lines left out."""
    rows = lines(spark, path, chunk_bits)
    broken = broken_chunks(rows, escape)
    whole = rows.join(broken, PLACE, "left_anti").select("file", "split", "at", F.col("value").alias("record"))
    odd = _odd(F.col("value"), escape)
    before = F.col("before") + F.sum("odd").over(Window.partitionBy(*PLACE).orderBy("at")) - F.col("odd")
    near = rows.join(broken, PLACE).withColumn("odd", odd).withColumn("before", before)
    longer = (F.col("before") % 2 == 1) | (F.col("odd") == 1)
    alone = near.where(~longer).select("file", "split", "at", F.col("value").alias("record"))
    joined = (near.where(longer)
              .groupBy("file", F.shiftright("before", 1).alias("number"))
              .agg(F.sort_array(F.collect_list(F.struct("split", "at", "value"))).alias("parts"))
              .select("file", F.col("parts")[0]["split"].alias("split"), F.col("parts")[0]["at"].alias("at"),
                      F.array_join(F.col("parts.value"), "\n").alias("record")))
    out = reduce(DataFrame.unionByName, [whole, alone, joined])
    return out.withColumn("record", F.regexp_replace("record", r"\r\z", "")).where(F.trim("record") != "")


def read_csv_records(spark: SparkSession, path: str, schema: StructType, date_format: str = "yyyy-MM-dd",
                     escape: str = "\\", chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """Typed rows of CSV files with one header each; the header must hold the schema's names in order.

    Malformed rows, other headers and quotes that stay open are errors when the rows
    are read. A quote inside a quoted field is escaped by `escape`: a backslash, as
    Spark writes it, or a second quote. Fields that are not quoted hold no quote."""
    names, found = [f.name for f in schema], records(spark, path, escape, chunk_bits)
    first = (lines(spark, path, chunk_bits).where((F.col("split") == 0) & (F.btrim("value", F.lit(" \r")) != ""))
             .groupBy("file").agg(F.min("at").alias("at")).withColumns({"split": F.lit(0).cast("bigint"), "header": F.lit(True)}))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    # every field of the header is taken as text: one that is not there, or one too many, is malformed
    head = F.from_csv("record", ", ".join(f"`{n}` string" for n in names), {"mode": "FAILFAST"})
    same = F.lower(F.array_join(F.array(*[F.trim(head[n]) for n in names]), ",", "")) == ",".join(names).lower()
    foreign = F.raise_error(F.concat(F.lit("the header is not that of the schema in "), F.col("file"))).cast("boolean")
    rows = found.join(first, ["file", "split", "at"], "left").where(
        F.when(F.col("header").isNull(), True).when(same, False).otherwise(foreign))
    options = {"mode": "FAILFAST", "dateFormat": date_format, "multiLine": "true", "escape": escape}
    return rows.select(F.from_csv("record", ddl, options).alias("r")).select("r.*")
