"""Report operators beyond what the oracles show: order, long lists, empty sides, hot names, refresh by months."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from test_edge_cases import CFG, D, frames
from vantage.config import FilterSet
from vantage.functions.dates import rep_label
from vantage.functions.filters import MOST_LITERALS, account_filter, filtered
from vantage.operators.calendar import compared, with_prior
from vantage.plans import reports as R
from vantage.plans.marts import build_marts
from vantage.sources.io import write_mart
from vantage.streaming.refresh import reached_snapshots, refresh_months, write_usage_state

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def marts(spark):
    from vantage.plans.registry import materialized_marts
    return materialized_marts(spark, SMOKE)


def test_whole_results_are_in_order(spark):
    rows = E.queries()["avr_point_in_time_v1"](spark, SMOKE).collect()
    keys = [(r.avr_score, r.account_id) for r in rows]
    assert len(keys) > 50 and keys == sorted(keys)
    board = E.queries()["csm_leaderboard"](spark, SMOKE).collect()
    keys = [(r.avg_avr is None, -(r.avg_avr or 0), r.csm_id) for r in board]
    assert keys == sorted(keys) and board[0].is_leader and {r.is_leader for r in board} == {True, False}
    gaps = [(-abs(r.gap), r.csm_id) for r in E.queries()["csm_gap_details"](spark, SMOKE).collect()]
    assert gaps and gaps == sorted(gaps)


def test_a_hundred_thousand_ids(spark, marts):
    am, cm = marts
    own = [r[0] for r in am.select("account_id").distinct().collect()]
    ids = tuple(range(10_000_000, 10_100_000)) + tuple(own[:40])
    fs = FilterSet(snapshot_date=R.REPORT_SNAPSHOT, account_ids=ids)
    rows = filtered(am, fs)
    want = am.where((F.col("snapshot_date") == F.lit(R.REPORT_SNAPSHOT)) & F.col("account_id").isin(own[:40]))
    assert rows.count() == want.count() > 0 and rows.columns == am.columns
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "10000500" not in plan
    assert R.csm_leaderboard(cm, fs, am).count() == want.select("rep_id").distinct().count()
    assert {r.account_id for r in R.account_active_ranges(am, ids).collect()} == set(own[:40])
    assert {r.account_id for r in R.filter_diagnosis(am, fs).collect()} == set(own[:40])
    short = FilterSet(snapshot_date=R.REPORT_SNAPSHOT, account_ids=tuple(own[:40]))
    assert len(short.account_ids) <= MOST_LITERALS
    assert "Join" not in filtered(am, short)._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(filtered(am, short).collect()) == sorted(am.where(account_filter(short)).collect())


def test_rollup_gives_the_kpis_of_the_mart(spark, marts):
    am, _ = marts
    days = [dt.date(2000, 2, 29), R.REPORT_SNAPSHOT]
    for fs in (R.default_filter(), FilterSet(regions=("ASIA",), segments=("Enterprise",)), FilterSet(csm_ids=(3, 5)),
               FilterSet(regions=("nowhere",)), FilterSet(include_established=False)):
        a, b = (sorted(R.kpis(x, fs, days).collect()) for x in (am, R.kpi_rollup(am)))
        assert a == b and len(a) == 2


def test_prior_snapshot_comes_from_the_calendar(spark, marts):
    am, _ = marts
    calendar = am.select("snapshot_date").distinct()
    pairs = {r.snapshot_date: r.prior_snapshot for r in with_prior(calendar).collect()}
    assert pairs[dt.date(2000, 1, 31)] is None and pairs[dt.date(2000, 3, 31)] == dt.date(2000, 2, 29)
    gap = calendar.where(F.col("snapshot_date") != dt.date(2000, 12, 31))
    assert {(r.snapshot_date, r.is_current) for r in compared(gap, R.REPORT_SNAPSHOT).collect()} == {
        (R.REPORT_SNAPSHOT, True), (dt.date(2000, 11, 30), False)}
    first = R.kpi_deltas(am, R.default_filter(dt.date(2000, 1, 31)), calendar).first()
    assert first.avg_avr_prior is None and first.avg_avr_delta is None
    later = R.kpi_deltas(am, R.default_filter(), calendar).first()
    assert later.pct_red_delta == later.pct_red_current - later.pct_red_prior


def test_labels(spark):
    rows = [(dt.date(2001, 1, 31), i, "Hot" if i < 300 else None if i < 302 else f"Co{i}") for i in range(310)]
    mart = spark.createDataFrame(rows * 2, "snapshot_date date, account_id long, company_name string")
    got = {r.account_id: r.display_label for r in R.account_labels(mart).collect()}
    assert len(got) == 310 and got[5] == "Hot (5)" and got[309] == "Co309" and got[300] is None
    ids = spark.createDataFrame([("CSM-0042",), ("X-CSM-1",), (None,)], "c string")
    assert [r[0] for r in ids.select(rep_label(F.col("c"))).collect()] == ["0042", "X-CSM-1", None]


def test_a_hot_account_in_the_monthly_series(spark):
    use = [(f"l{i}", 1 if i % 3 else 2, D(2001, 1 + i % 6, 1 + i % 27), 2) for i in range(600)]
    f = frames(spark, [(1, 1, D(2000, 6, 1), D(2001, 12, 31), 100000, 1000, "New"),
                       (2, 2, D(2000, 6, 1), D(2001, 12, 31), 50000, 500, "New")], usage=use)
    am, _ = build_marts(f, CFG)
    from vantage.operators.usage import usage_days
    fs = FilterSet(snapshot_date=D(2001, 6, 30), account_ids=(1,))
    got = {r.month_end: (r.purchased_credits, r.consumed_credits) for r in R.purchased_vs_consumed(
        am, usage_days(f["daily_usage_logs"]), fs, CFG).collect()}
    want = {}
    for _, a, d, x in use:
        if a == 1:
            want[d.month] = want.get(d.month, 0) + x
    assert {k.month: v for k, v in got.items()} == {m: (1000, want.get(m, 0)) for m in range(1, 7)}
    weeks = R.weekly_usage(usage_days(f["daily_usage_logs"]), f["accounts"]).collect()
    assert sum(r.total_credits_consumed for r in weeks) == 1200 and max(r.active_accounts for r in weeks) == 2


def test_a_changed_month_rewrites_only_what_it_reaches(spark):
    d = tempfile.mkdtemp(prefix="vantage-months-")
    contracts = [(1, 1, D(2000, 6, 1), D(2001, 5, 31), 100000, 1000, "New"), (2, 2, D(2001, 4, 1), D(2001, 12, 31), 50000, 500, "New"),
                 (3, 1, D(2001, 4, 20), D(2001, 12, 31), 70000, 700, "Renewal")]
    use = [(f"l{i}", 1 + i % 2, D(2001, 1 + i % 6, 1 + i % 27), 3 + i % 5) for i in range(300)]
    old = frames(spark, contracts, usage=use)
    am, cm = build_marts(old, CFG)
    write_mart(am, f"{d}/a", only_given=False)
    write_mart(cm, f"{d}/c", only_given=False)
    write_usage_state(old["daily_usage_logs"], f"{d}/s")
    stamp = lambda: {f: t for f, t in ((f.path, f.modificationTime) for f in spark.read.format("binaryFile").option(
        "recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(f"{d}/a").select("path", "modificationTime").collect())}
    before = stamp()
    # March loses its logs but one, and one account's logs of February double
    changed = [x for x in use if x[2].month != 3] + [("new", 1, D(2001, 3, 9), 50)] + [
        (x[0] + "b", *x[1:]) for x in use if x[2].month == 2 and x[1] == 1]
    new = frames(spark, contracts, usage=changed)
    done = refresh_months(new, CFG, [D(2001, 2, 1), D(2001, 3, 1)], f"{d}/s", f"{d}/a", f"{d}/c")
    # from April 30 on both accounts' active contracts began after March
    assert done == [D(2001, 2, 28), D(2001, 3, 31)] == reached_snapshots(new["contracts"], [D(2001, 2, 1), D(2001, 3, 1)], CFG)
    touched = {f for f, t in stamp().items() if before.get(f) != t}
    assert touched and all("2001-02-28" in f or "2001-03-31" in f for f in touched)
    full_a, full_c = build_marts(new, CFG)
    key = lambda df: sorted(map(repr, df.collect()))
    assert key(spark.read.parquet(f"{d}/a").select(*full_a.columns).where("snapshot_date <= '2001-03-31'")) == key(
        full_a.where("snapshot_date <= '2001-03-31'"))
    got, want = spark.read.parquet(f"{d}/c").select(*full_c.columns), full_c
    assert key(got.where("snapshot_date <= '2001-03-31'")) == key(want.where("snapshot_date <= '2001-03-31'"))
    assert refresh_months(new, CFG, [D(1999, 1, 1)], f"{d}/s", f"{d}/a", f"{d}/c") == []
