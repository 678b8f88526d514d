"""Contract and usage operators with one hot account, against plain Python."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from vantage.config import MetricConfig
from vantage.operators.contracts import (adjacent_overlap_accounts, contract_active, contract_timeline_clip,
                                         count_overlapping_contracts, covered_days, orphan_usage, out_of_window_usage,
                                         overlapping_contracts, usage_in_contract)
from vantage.operators.usage import days_of, running_totals, usage_days, usage_stats

D0 = dt.date(2000, 1, 1)
SCHEMA = ("contract_id long, account_id long, start_date date, end_date date, annual_commit_dollars long, "
          "included_monthly_compute_credits long, contract_type string")


def day(n):
    return D0 + dt.timedelta(days=n)


def contracts(n, seed, inverted=0, twice=0, spread=500, length=120):
    """n contracts, two thirds of them of account 1; some inverted, some rows of an id that is there already."""
    rnd, rows = random.Random(seed), []
    for i in range(n):
        start = rnd.randrange(spread)
        rows.append((i, 1 if rnd.random() < .66 else rnd.randrange(2, 6), day(start), day(start + rnd.randrange(length)),
                     rnd.randrange(9), rnd.randrange(9), rnd.choice(["New", "Renewal"])))
    for k in range(inverted):
        i, a, s, *rest = rows[k]
        rows[k] = (i, a, s, s - dt.timedelta(days=1 + rnd.randrange(80)), *rest[1:])
    return rows + [(rows[k + 9][0], rows[k][1], *rows[k][2:]) for k in range(twice)]


def pairs(rows, same_type=True):
    out = 0
    for a, b in itertools.combinations(rows, 2):
        out += (a[1] == b[1] and a[0] != b[0] and (a[6] == b[6] or not same_type) and a[2] <= b[3] and b[2] <= a[3])
    return out


@pytest.mark.parametrize("inverted,twice", [(0, 0), (25, 0), (12, 8)])
def test_overlaps_are_counted_without_being_listed(spark, inverted, twice):
    rows = contracts(400, 3 + inverted, inverted, twice)
    df = spark.createDataFrame(rows, SCHEMA)
    for same in (True, False):
        want = pairs(rows, same)
        assert want > 1000
        assert count_overlapping_contracts(df, same).first()[0] == want
        assert overlapping_contracts(df, same).count() == want


def test_ten_thousand_contracts_of_one_account(spark):
    rnd = random.Random(1)
    rows = [(i, 7, day(s := rnd.randrange(700)), day(s + rnd.randrange(300)), 1, 1, "New") for i in range(10_000)]
    ends, starts, apart = sorted(r[3] for r in rows), sorted(r[2] for r in rows), 0
    k = 0
    for s in starts:
        while k < len(ends) and ends[k] < s:
            k += 1
        apart += k
    got = count_overlapping_contracts(spark.createDataFrame(rows, SCHEMA))
    assert got.first()[0] == 10_000 * 9_999 // 2 - apart
    assert "Join" not in count_overlapping_contracts(spark.createDataFrame(rows[:5], SCHEMA))._jdf.queryExecution() \
        .optimizedPlan().toString().split("Window")[0]
    assert count_overlapping_contracts(spark.createDataFrame([], SCHEMA)).first()[0] == 0


def test_clipping_and_adjacent_overlaps(spark):
    rows = contracts(300, 5, inverted=10)
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    kept, touching = [], set()
    for _, own in itertools.groupby(sorted(rows, key=lambda r: (r[1], r[2], r[0])), key=lambda r: r[1]):
        own = list(own)
        for r, nxt in zip(own, own[1:] + [None]):
            end = min(r[3], nxt[2] - dt.timedelta(days=1)) if nxt else r[3]
            if end >= r[2]:
                kept.append((*r[:3], end, *r[4:]))
            if nxt and nxt[2] <= r[3]:
                touching.add(r[1])
    clipped = contract_timeline_clip(df)
    assert clipped.columns == df.columns
    assert sorted(map(tuple, clipped.collect())) == sorted(kept)
    assert {r[0] for r in adjacent_overlap_accounts(df).collect()} == touching
    one = spark.createDataFrame([(1, 1, day(0), day(5), 1, 1, "New"), (2, 1, day(0), day(0), 1, 1, "New"),
                                 (3, 2, day(0), day(5), 1, 1, "New"), (4, 2, day(6), day(9), 1, 1, "New"),
                                 (5, 3, day(3), day(1), 1, 1, "New"), (6, 3, day(3), day(4), 1, 1, "New"),
                                 (7, 4, None, day(4), 1, 1, "New")], SCHEMA)
    assert {r[0] for r in adjacent_overlap_accounts(one).collect()} == {1}


def usage(n, seed):
    rnd = random.Random(seed)
    return [(f"l{i}", rnd.choice([1, 1, 2, 3, 4, 77, None]), day(rnd.randrange(-40, 700)), rnd.randrange(50)) for i in range(n)]


U = "log_id string, account_id long, date date, compute_credits_consumed long"
A = [(1,), (2,), (3,), (4,), (5,)]


def test_coverage_orphans_and_logs_out_of_window(spark):
    rows = [r for r in contracts(60, 8, inverted=6, length=70) if r[1] != 4]
    logs = usage(900, 9)
    con, use = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(logs, U)
    acc = spark.createDataFrame(A, "account_id long")
    covered = lambda a, d: any(r[1] == a and r[2] <= d <= r[3] for r in rows)
    for days in (None, usage_days(use)):
        ids = lambda df: {r["log_id"] for r in df.collect()}
        assert ids(usage_in_contract(use, acc, con, days)) == {x for x, a, d, _ in logs if (a,) in A and covered(a, d)}
        assert ids(orphan_usage(use, acc, days)) == {x for x, a, _, _ in logs if (a,) not in A}
        assert ids(out_of_window_usage(use, acc, con, days)) == {
            x for x, a, d, _ in logs if (a,) in A and any(r[1] == a for r in rows) and not covered(a, d)}
    months = covered_days(con).collect()
    assert len(months) == len({(r.account_id, r.month) for r in months})
    total = sum(bin(r.days).count("1") for r in months)
    assert total == len({(r[1], r[2] + dt.timedelta(days=k)) for r in rows for k in range((r[3] - r[2]).days + 1)})


def test_no_log_is_shuffled_by_its_account_alone(spark):
    use, acc = spark.createDataFrame(usage(50, 1), U), spark.createDataFrame(A, "account_id long")
    con = spark.createDataFrame(contracts(9, 1), SCHEMA)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for df in (orphan_usage(use, acc), out_of_window_usage(use, acc, con), usage_in_contract(use, acc, con)):
            plan = df._jdf.queryExecution().sparkPlan().toString()
            for line in plan.splitlines():   # joins on the account alone stand above a reduction by account and day
                if "Join [account_id" in line and "date" not in line.split("Left")[0] and "month" not in line:
                    assert "Semi" in line or "Anti" in line
            assert "HashAggregate(keys=[account_id" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_windows_are_differences_of_running_totals(spark):
    cfg = MetricConfig(snapshot_start=dt.date(2000, 3, 31), snapshot_end=dt.date(2001, 8, 31))
    rows, logs = contracts(40, 11, length=400), [x for x in usage(2500, 12) if x[1] is not None]
    con = spark.createDataFrame(rows, SCHEMA)
    active = contract_active(con, cfg)
    days = days_of({"daily_usage_logs": spark.createDataFrame(logs, U)})
    got = {(r.snapshot_date, r.account_id): r for r in usage_stats(active, days, cfg).collect()}
    want = active.collect()
    assert set(got) == {(r.snapshot_date, r.account_id) for r in want} and len(want) > 40
    for r in want:
        own = [(d, x) for _, a, d, x in logs if a == r.account_id and r.start_date <= d <= r.snapshot_date]
        last = [x for d, x in own if (d.year * 12 + d.month) == r.snapshot_date.year * 12 + r.snapshot_date.month - 1]
        near = [x for d, x in own if (r.snapshot_date - d).days <= cfg.cv_window_days]
        g = got[r.snapshot_date, r.account_id]
        assert (g.credits_last_month, g.n_days_90d, g.credits_last_3mo, g.credits_ytd_contract) == (
            sum(last), len(near), sum(near), sum(x for _, x in own))
        assert g.mean_90d == (sum(near) / len(near) if near else None)
        if len(near) > 1:
            m = sum(near) / len(near)
            assert g.sd_90d == pytest.approx((sum((x - m) ** 2 for x in near) / (len(near) - 1)) ** .5, abs=1e-9)
        else:
            assert g.sd_90d is None


def test_running_totals_of_a_probe_before_the_first_day(spark):
    days = usage_days(spark.createDataFrame([("a", 1, day(3), 5), ("b", 1, day(3), 6), ("c", 1, day(9), None)], U))
    probes = spark.createDataFrame([(1, day(2), "x"), (1, day(3), "y"), (1, day(20), "z"), (2, day(5), "w")],
                                   "account_id long, date date, tag string")
    got = {r.tag: (r.n, r.sx) for r in running_totals(days, probes).collect()}
    assert got == {"x": (None, None), "y": (2, 11), "z": (2, 11), "w": (None, None)}
    assert days.where(F.col("n_logs") == 1).first().n == 0

def test_exploded_contracts_are_never_broadcast(spark):
    """Their size is estimated without the explosion: at 0.1 GB a side of 2 GB was broadcast."""
    from vantage.plans.quality import monthly_vs_allotment
    df = spark.createDataFrame(contracts(50, 9), SCHEMA)
    usage = spark.createDataFrame([("a", 1, day(3), 5)], "log_id string, account_id long, date date, compute_credits_consumed long")
    for out in (overlapping_contracts(df), monthly_vs_allotment({"contracts": df, "daily_usage_logs": usage})):
        out.collect()
        assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()


def test_days_before_any_window_stay_out_and_change_nothing(spark):
    """Only the days from the earliest start of a contract that reaches the calendar meet accounts."""
    from test_edge_cases import CFG, D, frames
    from vantage.operators.contracts import contract_active
    from vantage.operators.staging import stg_contracts
    from vantage.operators.usage import days_in_reach, snapshot_usage, usage_days
    contracts = [(1, 1, D(2000, 6, 1), D(2001, 5, 31), 100000, 1000, "New"), (2, 2, D(2001, 1, 1), D(2001, 12, 31), 50000, 500, "New"),
                 (3, 1, D(1990, 1, 1), D(1990, 12, 31), 1, 1, "New"), (4, 1, D(2003, 1, 1), D(2003, 12, 31), 1, 1, "New")]
    usage = [("a", 1, D(1990, 7, 1), 7), ("b", 1, D(2000, 5, 31), 3), ("c", 1, D(2000, 6, 1), 4), ("d", 1, D(2001, 1, 5), None),
             ("e", 2, D(2000, 6, 2), 9), ("f", 2, D(2001, 2, 1), 5), ("g", 2, None, 5)]
    f = frames(spark, contracts, usage=usage)
    days = usage_days(f["daily_usage_logs"])
    assert {r.date for r in days_in_reach(days, f["contracts"], CFG).collect()} == {
        D(2000, 6, 1), D(2001, 1, 5), D(2000, 6, 2), D(2001, 2, 1)}
    active = contract_active(stg_contracts(f["contracts"]), CFG)
    rows = [sorted(map(repr, snapshot_usage(active, f["daily_usage_logs"], f["accounts"], CFG, days, c).collect()))
            for c in (None, f["contracts"])]
    assert rows[0] == rows[1] != []
    assert days_in_reach(days, f["contracts"].limit(0), CFG).count() == 0
    for row in ((5, 1, None, D(2001, 5, 31), 1, 1, "New"), (5, 1, D(1985, 1, 1), None, 1, 1, "New")):    # any day may be theirs
        more = f["contracts"].unionByName(spark.createDataFrame([row], f["contracts"].schema))
        assert days_in_reach(days, more, CFG).count() == days.where("date IS NOT NULL").count()


def test_contracts_of_accounts_without_a_log_hold_no_month(spark):
    """F1 dq_summary, F2 dq_generic: every month that any contract covers was shuffled and held in the hash table of months."""
    from vantage.operators.contracts import log_windows
    rows, logs = contracts(80, 21, inverted=5), [x for x in usage(300, 22) if x[1] in (1, 3, 77, None)]
    con, use, acc = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(logs, U), spark.createDataFrame(A, "account_id long")
    days = usage_days(use)
    joins = lambda df: df._jdf.queryExecution().optimizedPlan().toString().split("Generate")[1].count("LeftSemi")
    with_days, without = log_windows(use, acc, con, days), log_windows(use, acc, con)
    assert joins(with_days) == joins(without) + 1
    got = [sorted(map(repr, df.collect())) for df in (with_days, without)]
    assert got[0] == got[1] and len(got[0]) == sum(a in (1, 3) for _, a, _, _ in logs)
