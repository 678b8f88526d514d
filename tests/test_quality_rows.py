"""Every generic check and every singular assertion fails on a row that is made to fail it."""

import datetime as dt

import pytest

from test_edge_cases import CFG, D, frames
from vantage.plans.quality import (FK_CHECKS, GENERIC_CHECKS, Check, all_results, fk_fractions, model_tables, overall,
                                   row_assertions, run_checks, singular_checks, total_assertions)

CONTRACTS = [(1, 1, D(2000, 6, 1), D(2001, 5, 31), 100000, 1000, "New"),
             (2, 2, D(2001, 1, 1), D(2001, 12, 31), 50000, 500, "New")]


@pytest.fixture(scope="module")
def tables(spark):
    f = frames(spark, CONTRACTS, usage=[("a", 1, D(2000, 7, 1), 5), ("b", 2, D(2001, 2, 1), 5)],
               tickets=[("t", 1, D(2001, 1, 5), None, 2, "A", "Open")])
    return {k: spark.createDataFrame(v.collect(), v.schema) for k, v in model_tables(f, CFG).items()}


def changed(spark, df, rows):
    return spark.createDataFrame(rows, df.schema.fromJson({**df.schema.jsonValue(), "fields": [
        {**f, "nullable": True} for f in df.schema.jsonValue()["fields"]]}))


def broken(spark, tables, c):
    """The tables with one row that fails check c."""
    df = tables[c.table]
    rows = [r.asDict() for r in df.collect()]
    bad = dict(rows[0])
    if c.test == "unique":
        rows.append(bad)
    elif c.test == "not_null":
        bad[c.columns[0]] = None
        rows[0] = bad
    elif c.test == "accepted_values":
        bad[c.columns[0]] = 9 if isinstance(c.args[0], int) else "other"
        rows[0] = bad
    elif c.test == "expression":
        bad[c.columns[0]] = type(bad[c.columns[0]])(-1)
        rows[0] = bad
    else:
        bad[c.columns[0]] = 424242
        rows[0] = bad
    return tables | {c.table: changed(spark, df, rows)}


@pytest.mark.parametrize("test", ["unique", "not_null", "accepted_values", "relationships", "expression"])
def test_each_generic_check_fails_on_its_row(spark, tables, test):
    checks = [c for c in GENERIC_CHECKS if c.test == test]
    assert checks
    # one ledger for all cases: each case's tables and checks go under names of their own
    every, own = {}, []
    for k, c in enumerate(checks):
        case = broken(spark, tables, c)
        names = {c.table, *(c.args[:1] if test == "relationships" else ())}
        every |= {f"{n}#{k}": case[n] for n in names}
        args = (f"{c.args[0]}#{k}", c.args[1]) if test == "relationships" else c.args
        own.append(Check(f"{c.table}#{k}", test, c.columns, args))
    got = {r.check_id: r.n_failing for r in run_checks(every, own).collect()}
    assert got == {c.check_id: 1 for c in own}
    sound = {f"{n}#{k}": tables[n] for k, c in enumerate(checks) for n in {c.table, *(c.args[:1] if test == "relationships" else ())}}
    assert {r.n_failing for r in run_checks(sound, own).collect()} == {0}


SINGULAR = {
    "avr_score_range": ("account_mart", dict(avr_score=100.5, band="Green")),
    "band_matches_score": ("account_mart", dict(avr_score=80.0, band="Red", is_ramp_period=False)),
    "contract_start_before_end": ("stg_contracts", dict(end_date=D(2000, 6, 1))),
    "csm_rollup_band_counts": ("csm_mart", dict(n_red=77)),
    "csm_technical_health_range": ("csm_mart", dict(arr_weighted_technical_health=-0.1)),
    "negative_usage": ("daily_usage_logs", dict(compute_credits_consumed=-1)),
    "orphaned_usage": ("daily_usage_logs", dict(account_id=None)),
    "ramp_accounts_have_null_avr": ("account_mart", dict(is_ramp_period=True, avr_score=50.0)),
    "snapshot_dates_are_month_ends": ("snapshot_dates", dict(snapshot_date=D(2001, 2, 27))),
    "ticket_closed_after_opened": ("stg_support_tickets", dict(closed_date=D(2000, 1, 1))),
    "csm_weighted_avr_range": ("csm_mart", dict(arr_weighted_avr=101.0)),
    "csm_exists": ("csm_mart", dict(csm_id=55)),
    "csm_rollup_account_counts": ("csm_mart", dict(n_accounts=9)),
    "csm_book_arr_matches": ("csm_mart", dict(book_arr=1)),
    "out_of_window_usage": ("daily_usage_logs", dict(date=D(1999, 1, 1))),
    "overlapping_contracts_unexpected": ("stg_contracts", dict(account_id=2)),
}


def case_of(spark, tables, name):
    """The tables with the row that fails the assertion."""
    table, change = SINGULAR[name]
    df = tables[table]
    rows = [r.asDict() for r in df.collect()]
    k = next(i for i, r in enumerate(rows) if r["n_accounts"]) if table == "csm_mart" and name != "csm_exists" else 0
    rows[k] = {**rows[k], **change}
    return tables | {table: changed(spark, df, rows)}


def test_each_row_assertion_fails_on_its_row(spark, tables):
    every, own = {}, []
    for k, c in enumerate(row_assertions(CFG)):
        case = case_of(spark, tables, c.name)
        parents = c.args[:1] if c.test == "relationships" else ()
        every |= {f"{t}#{k}": case[t] for t in (c.table, *parents)}
        args = (f"{parents[0]}#{k}", *c.args[1:]) if parents else c.args
        own.append(Check(f"{c.table}#{k}", c.test, c.columns, args, c.severity, c.name))
    assert {r.check_id: r.n_failing for r in run_checks(every, own).collect()} == {c.name: 1 for c in own}


def test_each_total_assertion_fails_on_its_row(spark, tables):
    names = sorted(set(SINGULAR) - {c.name for c in row_assertions(CFG)})
    assert len(names) == 4
    for name in names:
        case = {t: df for t, df in case_of(spark, tables, name).items() if t != "usage_days"}   # reduced anew
        got = {r.check_id: r.n_failing for r in total_assertions(case).collect()}
        assert got[name] == 1, name


def test_sound_tables_pass(spark, tables):
    rows = singular_checks(tables, CFG).collect()
    assert {r.check_id for r in rows} == set(SINGULAR) and {r.status for r in rows} == {"PASS"}


def test_one_pass_gives_both_suites(spark, tables):
    rows = all_results(tables, CFG).collect()
    assert len(rows) == len(GENERIC_CHECKS) + 16 and {r.suite for r in rows} == {"generic", "singular"}
    generic = {r.check_id: r.n_failing for r in rows if r.suite == "generic"}
    assert generic == {r.check_id: r.n_failing for r in run_checks(tables, GENERIC_CHECKS).collect()}
    fails = [r.check_id for r in rows if r.status == "FAIL"]   # the fixture's region and the empty checks only
    assert all("region" in x or "accepted" in x for x in fails), fails
    assert overall(all_results(tables, CFG)).first().n_fail == len(fails)
    leaves = all_results(tables, CFG)._jdf.queryExecution().optimizedPlan().collectLeaves().size()
    assert leaves <= 2 * len(tables) + 30


def test_row_assertions_name_tables_that_exist(tables):
    for c in row_assertions(CFG):
        assert c.table in tables and set(c.columns) <= set(tables[c.table].columns)


def test_fk_fractions_weigh_hot_keys(spark, tables):
    f = {k: tables[k] for k in ("csm_reps", "accounts", "contracts", "account_health", "support_tickets")}
    logs = [(f"l{i}", 1 if i < 800 else 99 if i < 900 else None, dt.date(2001, 1, 1 + i % 28), 1) for i in range(1000)]
    f["daily_usage_logs"] = spark.createDataFrame(logs, tables["daily_usage_logs"].schema)
    got = {r.check_id: (r.valid_frac, r.status) for r in fk_fractions(f).collect()}
    assert got["RI-5"] == (0.8, "FAIL") and got["RI-2"] == (1.0, "PASS") and len(got) == len(FK_CHECKS)
    f["contracts"] = f["contracts"].limit(0)
    assert {r.check_id: (r.valid_frac, r.status) for r in fk_fractions(f).collect()}["RI-2"] == (None, "FAIL")


def test_unique_keys_are_counted_by_hash_and_compared_as_they_are(spark, monkeypatch):
    from vantage.plans import quality
    rows = [("a",), ("b",), ("b",), ("c",), ("c",), ("c",), (None,), (None,), ("d",)]
    t = {"t": spark.createDataFrame(rows, "k string"),
         "u": spark.createDataFrame([(1, None), (1, None), (None, 1), (2, 3)], "p int, q int")}
    own = [Check("t", "unique", ("k",)), Check("u", "unique", ("p", "q")), Check("t", "not_null", ("k",))]
    assert quality._ledger(t, own[:2]) is None      # no unique key goes through the ledger of strings
    got = lambda: [r.n_failing for r in sorted(run_checks(t, own).collect(), key=lambda r: [c.check_id for c in own].index(r.check_id))]
    assert got() == [2, 1, 2]
    monkeypatch.setattr(quality, "FEW_HASHES", 0)   # too many repeated hashes to send around: all keys as they are
    assert got() == [2, 1, 2]
    # one hash for all keys: what is repeated is still told by the keys
    monkeypatch.setattr(quality.F, "xxhash64", lambda *c: quality.F.lit(7).cast("bigint"))
    assert got() == [2, 1, 2]
    monkeypatch.setattr(quality, "FEW_HASHES", 100)
    assert got() == [2, 1, 2]


def test_a_rule_of_raw_and_staging_rows_is_settled_once(tables):
    from vantage.plans.quality import _distinct_checks
    own, numbers = _distinct_checks(tables, GENERIC_CHECKS)
    ids = [c.check_id for c in GENERIC_CHECKS]
    at = lambda i: numbers[ids.index(i)]
    assert at("unique:support_tickets.ticket_id") == at("unique:stg_support_tickets.ticket_id")
    assert at("relationships:account_health.account_id") == at("relationships:stg_account_health.account_id")
    assert at("unique:stg_accounts.account_id") != at("unique:stg_contracts.contract_id")
    assert len(own) < len(GENERIC_CHECKS) == len(numbers)


def test_logs_meet_their_windows_once_for_both_sides(spark):
    from vantage.operators.contracts import log_windows, out_of_window_usage, usage_in_contract
    usage = [("a", 1, D(2000, 7, 1), 5), ("b", 1, D(2002, 7, 1), 5), ("b", 1, D(2002, 7, 1), 5), ("c", 1, D(2001, 6, 1), None),
             ("d", 9, D(2000, 7, 1), 5), ("e", None, D(2000, 7, 1), 5), ("f", 2, None, 5), ("a", 1, D(2000, 7, 1), 5)]
    f = frames(spark, CONTRACTS, usage=usage)
    args = f["daily_usage_logs"], f["accounts"], f["contracts"]
    windows = log_windows(*args)
    for side in (usage_in_contract, out_of_window_usage):
        plain, shared = ([tuple(r) for r in df.collect()] for df in (side(*args), side(*args, windows=windows)))
        assert sorted(map(repr, plain)) == sorted(map(repr, shared)) != []


def test_rows_are_counted_by_their_key_before_they_become_ledger_rows(spark):
    """F1 dq_summary, F2 dq_generic: each row was copied for each check of its table, its key as a string."""
    from vantage.plans import quality
    logs = [(i % 3 if i % 5 else None, None if i % 7 == 0 else "x", i) for i in range(100)]
    t = {"logs": spark.createDataFrame(logs, "a int, v string, n int"), "accounts": spark.createDataFrame([(0,), (1,), (1,), (None,)], "id long")}
    own = [Check("logs", "not_null", ("v",)), Check("logs", "relationships", ("a",), ("accounts", "id")),
           Check("logs", "relationships", ("a",), ("accounts", "id", "nulls fail")), Check("logs", "relationships", ("n",), ("accounts", "id")),
           Check("logs", "accepted_values", ("n",), (1, 2, 3)), Check("accounts", "not_null", ("id",)), Check("accounts", "expression", ("id",), ("id < 9",))]
    got = [r.n_failing for r in sorted(run_checks(t, own).collect(), key=lambda r: [c.check_id for c in own].index(r.check_id))]
    two = sum(a == 2 for a, _, _ in logs)
    assert sorted(got) == sorted([sum(v is None for _, v, _ in logs), two, two + 20, 98, 97, 1, 0])
    lines = quality._ledger({k: v for k, v in t.items()}, own)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    above = [any("Aggregate" in y for y in lines[i + 1:i + 4]) for i, x in enumerate(lines) if "Generate stack" in x]
    assert len(above) == 4 and above.count(False) == 1    # only the parents' own keys are stacked as they are
