"""Typed scans and sinks (S-1, S-3..S-7, S-9, S-10, S-12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.sources.csv_records import read_csv_records
from vantage.sources.schemas import SCHEMAS

TABLES = tuple(SCHEMAS)


def read_csv_typed(spark: SparkSession, path: str, table: str, multi_line: bool = True, escape: str = "\\") -> DataFrame:
    """One header row, explicit types, fail fast on malformed rows (no inference).

    The header's names must be the schema's in its order, else loading fails:
    columns are never taken by position alone. Large files are split either way;
    quoted line breaks need `multi_line`, which looks at the quotes of each line
    first. `escape` is what stands before a quote in a field (Spark writes a
    backslash, most others a second quote)."""
    if multi_line:
        return read_csv_records(spark, path, SCHEMAS[table], escape=escape)
    return (spark.read.schema(SCHEMAS[table]).option("header", True).option("escape", escape)
            .option("enforceSchema", False)
            .option("mode", "FAILFAST").option("dateFormat", "yyyy-MM-dd").csv(path))


def load_csv_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """S-7: the six raw tables as `{root}/{table}.csv`."""
    return {t: read_csv_typed(spark, f"{root}/{t}.csv", t) for t in TABLES}


def load_parquet_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{root}/{t}") for t in TABLES}


def write_csv(df: DataFrame, path: str) -> None:
    """S-6: CSV with header and ISO dates (replace on write)."""
    df.write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """S-3 / S-4: replace-on-write Parquet, optionally partitioned."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def write_raw_facts(df: DataFrame, path: str, date_col: str) -> None:
    """S-4 for the two large facts: partition by month (not by day, which
    would create hundreds of tiny directories)."""
    write_months(df, path, date_col)


def write_months(df: DataFrame, path: str, date_col: str, only_given: bool = False) -> None:
    """A table by day, partitioned by month; with `only_given` only the months that have rows are replaced."""
    rows = df.withColumn("month", F.trunc(date_col, "month"))
    (rows.repartition("month", F.pmod(F.xxhash64(*df.columns), F.lit(8))).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic" if only_given else "static").partitionBy("month").parquet(path))


def write_mart(df: DataFrame, path: str, only_given: bool = True) -> None:
    """S-9: mart partitioned by snapshot_date, a few files for each snapshot.

    With `only_given` re-running some snapshots replaces only the partitions
    that have rows; else the whole mart is replaced (and marked by _SUCCESS)."""
    rows = df.repartition("snapshot_date", F.pmod(F.xxhash64(*df.columns[:2]), F.lit(4)))
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if only_given else "static")
     .partitionBy("snapshot_date").parquet(path))


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def file_state(spark: SparkSession, paths: list[str]) -> tuple[int, int, int]:
    """Digest of name, bytes and modification time of every file below `paths`, on whatever store they are.

    Spark lists them (many folders by tasks) and one aggregate returns files, bytes and a
    sum of 64-bit hashes; no file is opened. A path that isn't there is an error."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
             .select("path", "length", "modificationTime"))
    row = files.agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
                    F.coalesce(F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")), F.lit(0)).alias("digest"))
    return tuple(int(x) for x in row.first())


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def remove_partitions(spark: SparkSession, path: str, column: str, values: list) -> None:
    """Delete the partitions column=value of a written table."""
    for v in values:
        fs, p = _file_system(spark, f"{path.rstrip('/')}/{column}={v}")
        if fs.exists(p):
            fs.delete(p, True)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """S-10: post-load row count per table as one frame (one job per table)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows")
             for t, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_results(df: DataFrame, path: str, fmt: str = "json") -> None:
    """S-12: a check or report results frame as JSON / Parquet."""
    df.write.mode("overwrite").format(fmt).save(path)
