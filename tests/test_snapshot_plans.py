"""Coverage, active contracts and colours: what is held or sorted before a shuffle, and results against plain Python."""

import datetime as dt
import random

import pytest

from vantage.config import MetricConfig
from vantage.operators.contracts import contract_active, covered_days, out_of_window_usage, usage_in_contract
from vantage.operators.health import health_at, latest_color, snapshot_health

D0 = dt.date(2000, 1, 1)
CFG = MetricConfig(snapshot_start=dt.date(2000, 3, 31), snapshot_end=dt.date(2001, 8, 31))
CONTRACTS = ("contract_id long, account_id long, start_date date, end_date date, annual_commit_dollars long, "
             "included_monthly_compute_credits long, contract_type string")


def day(n):
    return D0 + dt.timedelta(days=n)


def plan(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def contracts(n, seed):
    rnd, rows = random.Random(seed), []
    for i in range(n):
        start = rnd.randrange(600)
        rows.append((i, rnd.choice([1, 1, 1, 2, 3, None]), day(start), day(start + rnd.choice([-3, 5, 40, 300])), i, i, "New"))
    return rows


def test_contracts_become_covered_months_only_after_they_are_joined_to_spans(spark):
    """F22 usage_in_contract, F20 out_of_window_usage: each contract became its months before the reduction."""
    rows = contracts(200, 4)
    df = spark.createDataFrame(rows, CONTRACTS)
    covered = covered_days(df)
    lines = plan(covered).splitlines()
    assert min(i for i, x in enumerate(lines) if "Generate" in x) < min(i for i, x in enumerate(lines) if "Window" in x)
    got = {(r.account_id, r.month + dt.timedelta(days=b)) for r in covered.collect() for b in range(31) if r.days >> b & 1}
    assert got == {(r[1], r[2] + dt.timedelta(days=k)) for r in rows for k in range((r[3] - r[2]).days + 1)}
    logs = spark.createDataFrame([("a", 1, day(3), 5)], "log_id string, account_id long, date date, compute_credits_consumed long")
    acc = spark.createDataFrame([(1,)], "account_id long")
    for out in (usage_in_contract(logs, acc, df), out_of_window_usage(logs, acc, df)):
        assert "ShuffledHashJoin [account_id" in plan(out) and ", date#" not in plan(out).split("ShuffledHashJoin")[1][:60]


def test_no_contract_is_exploded_before_its_account_knows_its_newest(spark):
    """The marts' queries: exploded contracts were sorted on the map side."""
    rows = contracts(150, 5)
    active = contract_active(spark.createDataFrame(rows, CONTRACTS), CFG)
    lines = plan(active).splitlines()
    aggregates = [i for i, x in enumerate(lines) if "Aggregate" in x]
    assert min(i for i, x in enumerate(lines) if "Generate" in x) < min(aggregates)
    want, s = {}, CFG.snapshot_start
    while s <= CFG.snapshot_end:
        for r in rows:
            if r[2] <= s <= r[3]:
                want[s, r[1]] = max(want.get((s, r[1]), (D0, -1)), (r[2], r[0]))
        s = (s + dt.timedelta(days=32)).replace(day=1) - dt.timedelta(days=1)
    got = active.collect()
    assert {(r.snapshot_date, r.account_id): (r.start_date, r.contract_id) for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("seed", [1, 2])
def test_colours_are_not_sorted_before_the_shuffle(spark, seed):
    """F23 segment_band_crosstab and the marts' queries: a maximum by date of strings is a sort of each task's records."""
    rnd = random.Random(seed)
    rows = [(a, day(k), rnd.choice(["Green", "Red", "odd", None])) for a in (1, 2, 3) for k in rnd.sample(range(700), 60)]
    health = spark.createDataFrame([*rows, (4, None, "Red")], "account_id long, date date, health_color string")
    latest = latest_color(health, CFG)
    assert "HashAggregate(keys=[account_id" in plan(latest) and "SortAggregate" not in plan(latest)
    want, s = {}, CFG.snapshot_start
    while s <= CFG.snapshot_end:
        for a in (1, 2, 3):
            own = [(d, c) for b, d, c in rows if b == a and d <= s]
            if own:
                want[s, a] = max(own, key=lambda x: x[0])[1]
        want[s, 4] = None
        s = (s + dt.timedelta(days=32)).replace(day=1) - dt.timedelta(days=1)
    assert {(r.snapshot_date, r.account_id): r.latest_color for r in latest.collect()} == want
    at = health_at(health, day(400), 30)
    assert "HashAggregate(keys=[account_id" in plan(at) and "Join" not in plan(at)
    got = {r.account_id: (r.latest_color, r.had_red_30d) for r in at.collect()}
    for a in (1, 2, 3):
        own = sorted((d, c) for b, d, c in rows if b == a and d <= day(400))
        near = [c for d, c in own if d >= day(370) and c is not None]
        assert got[a] == (own[-1][1], ("Red" in near) if near else None)
    assert set(got) == {1, 2, 3}


def test_health_rows_are_read_once_for_colour_and_red_weeks(spark):
    """F1 dq_summary, F2 dq_generic: the weekly rows were read once for the colour and again for the Red flag."""
    rnd = random.Random(7)
    rows = [(a, day(k), rnd.choice(["Green", "Green", "Red", "odd", None])) for a in (1, 2, 3, 9) for k in rnd.sample(range(700), 40)]
    rows += [(4, None, "Red"), (4, day(300), "Green"), (5, None, "Green"), (5, day(200), "Red"), (None, day(300), "Red"), (6, day(900), "Red")]
    got = snapshot_health(spark.createDataFrame(rows, "account_id long, date date, health_color string"), CFG)
    assert "Join" not in plan(got) and got._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1
    want, s = {}, CFG.snapshot_start
    while s <= CFG.snapshot_end:
        for a in (1, 2, 3, 4, 5, 9, None):
            own = sorted(((d or dt.date.min, c if d else None) for b, d, c in rows if b == a and (d is None or d <= s)), key=lambda x: x[0])
            if own:   # a Red row without a date counts everywhere, one without an account nowhere
                red = any(c == "Red" and (d is None or s - dt.timedelta(days=30) <= d <= s) for b, d, c in rows if b == a)
                want[s, a] = (own[-1][1], red and a is not None)
        s = (s + dt.timedelta(days=32)).replace(day=1) - dt.timedelta(days=1)
    found = got.collect()
    assert {(r.snapshot_date, r.account_id): (r.latest_color, r.had_red_last_30d) for r in found} == want and len(found) == len(want)
    assert len({v for v in want.values()}) > 4


def test_the_mart_of_written_models_is_the_mart(spark):
    """F1 dq_summary, F2 dq_generic: the mart derived its models again, beside those written for the checks."""
    from test_edge_cases import CFG as cfg, D, frames
    from vantage.plans import marts
    from vantage.plans.quality import model_tables
    two = [(1, 1, D(2000, 6, 1), D(2001, 5, 31), 100000, 1000, "New"), (2, 2, D(2001, 1, 1), D(2001, 12, 31), 50000, 500, "New"),
           (3, None, D(2001, 1, 1), D(2001, 12, 31), 50000, 500, "New"), (4, 77, D(2001, 1, 1), D(2001, 12, 31), 50000, 500, "New")]
    f = frames(spark, two, accounts=[1, 2], usage=[("a", 1, D(2001, 2, 1), 5), ("b", 2, D(2001, 2, 1), 50), ("c", None, D(2001, 2, 1), 5)],
               tickets=[("t", 1, D(2001, 1, 5), None, 1, "A", "Open")])
    models = {k: spark.createDataFrame(v.collect(), v.schema) for k, v in model_tables(f, cfg).items()
              if k in ("contract_active", "snapshot_usage", "snapshot_tickets", "snapshot_health")}
    own, read = marts.account_mart(f, cfg), marts.account_mart(f, cfg, marts.stages(f, cfg, models.get))
    assert sorted(map(repr, own.collect())) == sorted(map(repr, read.collect())) != [] and own.schema == read.schema
    assert "Window" in plan(own) and "Window" not in plan(read)
