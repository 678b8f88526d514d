"""Source / sink round trips (typed CSV scan, CSV sink, partitioned mart)."""

import csv
import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from vantage.sources.csv_records import lines, read_csv_records
from vantage.sources.io import (file_state, read_csv_typed, row_counts, write_csv, write_mart, write_raw_facts, write_results,
                                write_table)
from vantage.sources.schemas import SCHEMAS


def test_csv_round_trip_keeps_types_and_nulls(spark):
    d = tempfile.mkdtemp(prefix="vantage-csv-")
    rows = [("T1", "A1", dt.date(2001, 1, 2), None, 1, "Area-1", "Open"),
            ("T2", "A1", dt.date(2001, 1, 3), dt.date(2001, 1, 9), 3, "multi\nline", "Closed")]
    df = spark.createDataFrame(rows, "ticket_id string, account_id string, opened_date date, closed_date date, "
                                     "severity long, product_area string, status string")
    write_csv(df, f"{d}/t")
    back = read_csv_typed(spark, f"{d}/t", "support_tickets")
    assert dict(back.dtypes)["opened_date"] == "date" and dict(back.dtypes)["severity"] == "bigint"
    assert sorted(back.collect()) == sorted(df.collect())


def test_mart_partition_overwrite_replaces_only_given_snapshots(spark):
    d = tempfile.mkdtemp(prefix="vantage-mart-")
    a = spark.createDataFrame([(dt.date(2001, 1, 31), 1, 10.0), (dt.date(2001, 2, 28), 1, 20.0)],
                              "snapshot_date date, account_id long, avr_score double")
    write_mart(a, f"{d}/m")
    write_mart(spark.createDataFrame([(dt.date(2001, 2, 28), 1, 25.0)],
                                     "snapshot_date date, account_id long, avr_score double"), f"{d}/m")
    got = {r["snapshot_date"]: r["avr_score"] for r in spark.read.parquet(f"{d}/m").collect()}
    assert got == {dt.date(2001, 1, 31): 10.0, dt.date(2001, 2, 28): 25.0}


def test_adapters_read_every_row(spark):
    from vantage.sources.adapters import load_inputs
    root = "/root/testdata/sf0.001"
    f = load_inputs(spark, root)
    n = {t: spark.read.parquet(f"{root}/{t}.parquet").count() for t in ("customer", "orders", "lineitem", "nation")}
    assert f["accounts"].count() == n["customer"]
    assert f["contracts"].count() == n["orders"]
    assert f["daily_usage_logs"].count() == f["support_tickets"].count() == n["lineitem"]
    assert f["csm_reps"].count() == n["nation"]
    assert f["daily_usage_logs"].agg(F.countDistinct("log_id")).first()[0] == n["lineitem"]


def test_swapped_csv_header_fails_at_load(spark):
    d = tempfile.mkdtemp(prefix="vantage-csv-")
    spark.createDataFrame([("A1", "R1")], "rep_id string, account_id string").write.option("header", True).csv(f"{d}/t")
    with pytest.raises(Exception):
        read_csv_typed(spark, f"{d}/t", "accounts").collect()


def test_results_are_written_by_many_tasks(spark):
    d = tempfile.mkdtemp(prefix="vantage-res-")
    write_results(spark.range(100).repartition(4), f"{d}/r", "parquet")
    assert spark.read.parquet(f"{d}/r").count() == 100


def test_month_partitioned_facts(spark):
    d = tempfile.mkdtemp(prefix="vantage-fact-")
    df = spark.createDataFrame([(i, dt.date(2001, 1 + i % 3, 5)) for i in range(30)], "id long, date date")
    write_raw_facts(df, f"{d}/f", "date")
    assert spark.read.parquet(f"{d}/f").select("id", "date").exceptAll(df).count() == 0
    write_table(df, f"{d}/t")
    assert row_counts({"t": spark.read.parquet(f"{d}/t")}).collect()[0]["n_rows"] == 30


TICKETS = SCHEMAS["support_tickets"]


def _one_task(spark, path):
    return (spark.read.schema(TICKETS).option("header", True).option("multiLine", True).option("escape", '"')
            .option("mode", "FAILFAST").option("enforceSchema", False).csv(path))


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_quoted_line_breaks_are_read_by_many_tasks(spark, small_splits):
    d, rnd = tempfile.mkdtemp(prefix="vantage-csv-"), random.Random(1)
    for part in "ab":
        with open(f"{d}/{part}.csv", "w", newline="") as f:
            out = csv.writer(f, lineterminator="\n")
            out.writerow(TICKETS.names)
            for i in range(3000):
                n = 400 if i % 900 == 5 else 1 if i < 1000 else rnd.randint(1, 4)   # some longer than a split
                area = "\n".join(rnd.choice(["", "x", 'say "a"', "b, c" * (30 if n == 400 else 1)]) for _ in range(n))
                out.writerow([f"{part}{i}", "A,1", "2001-01-02", None if i % 3 else "2001-02-03", i % 4 + 1, area or "z", "Open"])
    assert lines(spark, d).rdd.getNumPartitions() >= 8 > _one_task(spark, d).rdd.getNumPartitions()
    for bits in (5, 12):
        got = read_csv_records(spark, d, TICKETS, escape='"', chunk_bits=bits)
        assert got.dtypes == _one_task(spark, d).dtypes and got.count() == 6000
        assert got.exceptAll(_one_task(spark, d)).count() == 0


@pytest.mark.parametrize("body", ['T1,A,2001-01-02,,1,"open,Open\nT2,A\n',       # a quote stays open
                                  "T1,A,2001-01-02,,1\n",                         # a field too few
                                  "T1,A,2001-01-02,,1,a,b,c\n",                   # a field too many
                                  "T1,A,2001-01-02,,x,a,b\n"])                    # not a number
def test_malformed_records_fail(spark, body):
    d = tempfile.mkdtemp(prefix="vantage-csv-")
    with open(f"{d}/t.csv", "w") as f:
        f.write(",".join(TICKETS.names) + "\n" + body)
    with pytest.raises(Exception):
        read_csv_typed(spark, d, "support_tickets").collect()


def test_carriage_returns_blank_lines_and_empty_files(spark):
    d = tempfile.mkdtemp(prefix="vantage-csv-")
    with open(f"{d}/t.csv", "w", newline="") as f:
        f.write("\r\n" + ",".join(TICKETS.names) + '\r\n\r\nT1,A,2001-01-02,,1,"a ""b""\nc",Open\r\n\nT2,A,2001-01-02,,2,"x\n\ny",""')
    open(f"{d}/u.csv", "w").close()
    got = sorted(read_csv_typed(spark, d, "support_tickets", escape='"').collect())
    assert [(r.ticket_id, r.severity, r.product_area) for r in got] == [("T1", 1, 'a "b"\nc'), ("T2", 2, "x\n\ny")]


def test_file_state_tells_changes(spark):
    d = tempfile.mkdtemp(prefix="vantage-state-")
    spark.range(10).repartition(3).write.parquet(f"{d}/t")
    before = file_state(spark, [f"{d}/t"])
    assert before == file_state(spark, [f"{d}/t"]) and before[0] >= 3
    spark.range(1).write.mode("append").parquet(f"{d}/t")
    after = file_state(spark, [f"{d}/t"])
    assert after[0] > before[0] and after[2] != before[2]
    with pytest.raises(Exception):
        file_state(spark, [f"{d}/gone"])
