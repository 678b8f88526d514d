"""Written marts follow their inputs; refresh; checks that report faults instead of dying of them."""

import datetime as dt
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from test_edge_cases import CFG, D, frames
from vantage.functions.filters import tenure_predicate
from vantage.operators.contracts import contract_timeline_clip, overlapping_contracts
from vantage.operators.staging import stg_contracts
from vantage.plans.marts import build_marts
from vantage.plans.quality import Check, model_tables, run_generic, singular_checks
from vantage.plans.registry import all_queries, materialized_marts
from vantage.sources.io import write_mart
from vantage.streaming.refresh import refresh

SMOKE = "/root/testdata/sf0.001"
CONTRACTS = [(1, 1, D(2000, 6, 1), D(2001, 5, 31), 100000, 1000, "New"),
             (2, 2, D(2001, 1, 1), D(2001, 12, 31), 50000, 500, "New")]


def test_marts_follow_a_changed_input_under_a_uri(spark):
    d = tempfile.mkdtemp(prefix="vantage-root-")
    for t in ("region", "nation", "customer", "supplier", "orders", "lineitem"):
        shutil.copy(f"{SMOKE}/{t}.parquet", f"{d}/{t}.parquet")
    root = f"file://{d}"
    trend = all_queries()["company_trend"]
    total = trend(spark, root).agg(F.sum("total_book_arr")).first()[0]
    dearer = spark.read.parquet(f"{SMOKE}/orders.parquet").withColumn("o_totalprice", F.col("o_totalprice") * 10)
    dearer.write.mode("overwrite").parquet(f"{d}/new")
    spark.read.parquet(f"{d}/new").coalesce(1).write.mode("overwrite").parquet(f"{d}/orders.parquet.dir")
    shutil.move(f"{d}/orders.parquet", f"{d}/old")
    shutil.move(f"{d}/orders.parquet.dir", f"{d}/orders.parquet")
    assert trend(spark, root).agg(F.sum("total_book_arr")).first()[0] > 9 * total


def test_marts_are_built_once_for_each_input(spark):
    first, _ = materialized_marts(spark, SMOKE)
    again, _ = materialized_marts(spark, SMOKE)
    assert first.inputFiles() == again.inputFiles()


def test_refresh_drops_what_has_vanished(spark):
    d = tempfile.mkdtemp(prefix="vantage-refresh-")
    f = frames(spark, CONTRACTS)
    am, cm = build_marts(f, CFG)
    write_mart(am, f"{d}/a")
    write_mart(cm, f"{d}/c")
    left = frames(spark, [CONTRACTS[0]], accounts=[1, 2])
    refresh(left, CFG, f"{d}/a", f"{d}/c", [D(2001, 5, 31), D(2001, 6, 30)])
    got = {(r["snapshot_date"], r["account_id"]) for r in spark.read.parquet(f"{d}/a").collect()}
    assert (D(2001, 4, 30), 2) in got and (D(2001, 5, 31), 1) in got
    assert not {k for k in got if k[0] == D(2001, 6, 30)} and (D(2001, 5, 31), 2) not in got
    reps = {r["snapshot_date"]: r["n_accounts"] for r in spark.read.parquet(f"{d}/c").collect()}
    assert reps[D(2001, 5, 31)] == 1 and reps[D(2001, 6, 30)] == 0


def test_inverted_and_touching_contracts(spark):
    rows = [(1, 1, D(2001, 3, 1), D(2000, 12, 1), 1, 1, "New"), (2, 1, D(2001, 3, 1), D(2001, 9, 1), 1, 1, "New"),
            (3, 1, D(2001, 3, 1), D(2001, 9, 1), 1, 1, "New")]
    f = frames(spark, rows)
    assert {(r["contract_a"], r["contract_b"]) for r in overlapping_contracts(f["contracts"]).collect()} >= {(2, 3)}
    clipped = contract_timeline_clip(f["contracts"]).collect()
    assert [r["contract_id"] for r in clipped] == [3]
    checks = {r["check_id"]: r["n_failing"] for r in singular_checks(model_tables(f, CFG), CFG).collect()}
    assert checks["contract_start_before_end"] == 1


def test_unique_skips_nulls_of_a_single_column(spark):
    t = spark.createDataFrame([(None, 1), (None, 1), (2, 1), (2, 2), (3, 1)], "a int, b int")
    got = {r["check_id"]: r["n_failing"] for r in run_generic(
        {"t": t}, (Check("t", "unique", ("a",)), Check("t", "unique", ("a", "b")), Check("t", "not_null", ("a",)))).collect()}
    assert got == {"unique:t.a": 1, "unique:t.a+b": 1, "not_null:t.a": 2}


@pytest.mark.parametrize("established,ramp,expected", [(True, True, {1, 2, 3}), (True, False, {2, 3}), (False, True, {1}),
                                                       (False, False, set())])
def test_tenure_states(spark, established, ramp, expected):
    t = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, is_ramp_period boolean")
    p = tenure_predicate(established, ramp)
    assert {r["id"] for r in (t if p is None else t.where(p)).collect()} == expected


def test_orphans_and_accounts_without_usage(spark):
    from vantage.operators.contracts import orphan_usage, out_of_window_usage
    f = frames(spark, CONTRACTS, usage=[("a", 1, D(2000, 7, 1), 5), ("b", 99, D(2000, 7, 1), 5), ("c", 2, D(1999, 1, 1), 5)])
    assert [r["log_id"] for r in orphan_usage(f["daily_usage_logs"], f["accounts"]).collect()] == ["b"]
    assert [r["log_id"] for r in out_of_window_usage(f["daily_usage_logs"], f["accounts"], f["contracts"]).collect()] == ["c"]
    rows = {r["account_id"]: r for r in build_marts(f, CFG)[0].where(F.col("snapshot_date") == dt.date(2001, 5, 31)).collect()}
    assert rows[2]["d_score"] == rows[2]["c_score"] == rows[2]["b_score"] == 0
