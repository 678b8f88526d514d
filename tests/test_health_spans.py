"""The newest covering contract by spans of Sundays, against plain Python."""

import datetime as dt
import random

import pytest

from pyspark.sql import functions as F

from vantage.config import MetricConfig
from vantage.operators.health import covering_spans, derive_health

D0 = dt.date(2000, 1, 1)
SCHEMA = "contract_id long, account_id long, start_date date, end_date date, included_monthly_compute_credits long"


def day(n):
    return D0 + dt.timedelta(days=n)


def exploded(spans):
    return spans.select("account_id", "newness", F.col("included_monthly_compute_credits").alias("allot"),
                        F.explode(F.expr("sequence(first, last, INTERVAL 7 DAYS)")).alias("sunday"))


def test_newest_contract_of_every_sunday(spark):
    rnd, rows = random.Random(4), []
    for i in range(400):   # nested, touching, inverted, without a date, and of one id twice
        start, length = rnd.randrange(500), rnd.choice([3, 30, 90, 365])
        rows.append((rnd.randrange(380), rnd.choice([1, 1, 1, 2, 3, None]), day(start) if rnd.random() < .97 else None,
                     day(start + rnd.randrange(-5, length)) if rnd.random() < .97 else None,
                     rnd.choice([None, *range(1, 9)])))
    cfg = MetricConfig()
    want = {}
    for cid, a, s, e, x in rows:
        for n in range(((e or cfg.health_end) - s).days + 1 if s else 0):   # without an end it covers all to the last week
            if day((s - D0).days + n).weekday() == 6 and day((s - D0).days + n) <= cfg.health_end:
                key, c = (a, day((s - D0).days + n)), (s, cid, -1 if x is None else x)
                want[key] = max(want.get(key, c), c)
    got = (exploded(covering_spans(spark.createDataFrame(rows, SCHEMA), cfg)).groupBy("account_id", "sunday")
           .agg(F.max_by(F.coalesce("allot", F.lit(-1)), "newness").alias("x"), F.count("*").alias("n")).collect())
    assert {(r.account_id, r.sunday): r.x for r in got} == {k: c[2] for k, c in want.items()} and len(got) == len(want) > 150


def test_contracts_are_cut_before_they_are_exploded(spark):
    """Ten thousand contracts of a year were half a million rows; they are one for each Sunday."""
    rows = [(i, 7, day(i % 300), day(i % 300 + 365), i % 50) for i in range(10_000)]
    assert exploded(covering_spans(spark.createDataFrame(rows, SCHEMA), MetricConfig())).count() < 100


@pytest.mark.parametrize("lengths,health_start", [([3, 30, 90, 365], None), ([70], None), ([70], day(100)), ([3, 90], day(200))])
def test_changes_meet_in_one_sorted_pass(spark, lengths, health_start):
    """F1 dq_summary, F2 dq_generic: every week of every account was aggregated by week and sorted; now only changes are."""
    rnd = random.Random(12)
    contracts = [(i, rnd.choice([1, 2, 3, 4, None]), day(s := rnd.randrange(500)), day(s + rnd.choice(lengths)), rnd.choice([None, 0, 9, 99, 999]))
                 for i in range(60)]
    logs = [(rnd.choice([1, 2, 5, None]), day(rnd.randrange(-30, 560)), rnd.choice([None, 1, 7, 30])) for _ in range(500)]
    tickets = [(rnd.choice([1, 2, 2, 2, None]), day(o := rnd.randrange(-20, 540)), rnd.choice([None, day(o + rnd.randrange(-2, 40))]), rnd.choice([1, 2, 2, 3]))
               for _ in range(40)]
    cfg = MetricConfig(health_start=health_start)
    got = derive_health(spark.createDataFrame(contracts, SCHEMA),
                        spark.createDataFrame(logs, "account_id long, date date, compute_credits_consumed long"),
                        spark.createDataFrame(tickets, "account_id long, opened_date date, closed_date date, severity long"), cfg)
    top = got._jdf.queryExecution().sparkPlan().toString().split("Union")[0]
    assert "Window" in top and "Aggregate" not in top and top.index("Generate") < top.index("Window")
    want = {}
    for a in (1, 2, 3, 4, None):
        for n in range(900):
            sunday = day(n)
            own = [(s, cid, x) for cid, b, s, e, x in contracts if b == a and s <= sunday <= e]
            if sunday.weekday() != 6 or sunday > cfg.health_end or (health_start and sunday < cfg.health_first) or not own or (allot := max(own, key=lambda c: c[:2])[2]) is None:
                continue
            used = sum(x or 0 for b, d, x in logs if b == a and 0 <= (sunday - d).days < 7)
            opened = [(sev, d) for b, d, c, sev in tickets if b == a and sev < 3 and d <= sunday and (c is None or max(c, d) > sunday)]
            stale = any(sev == 1 and (sunday - d).days > 7 for sev, d in opened)
            share = used / (allot / 4.33) if allot else 0.0
            color = "Red" if share < .05 or len(opened) > 5 or stale else "Yellow" if share < .15 or len(opened) >= 3 else "Green"
            want[a, sunday] = (color, used)
    found = got.collect()
    assert {(r.account_id, r.date): (r.health_color, r.compute_credits_consumed) for r in found} == want and len(found) == len(want)
    assert {c for c, _ in want.values()} == {"Red", "Yellow", "Green"}
