"""Hand-made fixtures through the whole pipeline (edge cases of the spec)."""

import datetime as dt

import pytest

from vantage.config import MetricConfig
from vantage.operators.health import derive_health
from vantage.plans.marts import build_marts

D = dt.date
CFG = MetricConfig(snapshot_start=D(2001, 1, 31), snapshot_end=D(2001, 6, 30),
                   health_start=D(2000, 10, 1))


def frames(spark, contracts, usage=(), tickets=(), accounts=None):
    accts = accounts or sorted({c[1] for c in contracts})
    f = {
        "csm_reps": spark.createDataFrame([(1, "Rep", "EMEA", "Enterprise", D(2000, 1, 1))],
                                          "csm_id long, name string, region string, segment string, hire_date date"),
        "accounts": spark.createDataFrame([(a, f"Co{a}", "Tech", 1, "Enterprise", D(2000, 1, 1)) for a in accts],
                                          "account_id long, company_name string, industry string, rep_id long, "
                                          "segment string, signup_date date"),
        "contracts": spark.createDataFrame(list(contracts),
                                           "contract_id long, account_id long, start_date date, end_date date, "
                                           "annual_commit_dollars long, included_monthly_compute_credits long, "
                                           "contract_type string"),
        "daily_usage_logs": spark.createDataFrame(list(usage) or [("x", -1, D(1990, 1, 1), 0)],
                                                  "log_id string, account_id long, date date, "
                                                  "compute_credits_consumed long"),
        "support_tickets": spark.createDataFrame(list(tickets) or [("t", -1, D(1990, 1, 1), None, 3, "A", "Closed")],
                                                 "ticket_id string, account_id long, opened_date date, "
                                                 "closed_date date, severity long, product_area string, status string"),
    }
    f["account_health"] = derive_health(f["contracts"], f["daily_usage_logs"], f["support_tickets"], CFG)
    return f


def mart_rows(spark, **kw):
    am, cm = build_marts(frames(spark, **kw), CFG)
    return {(r["snapshot_date"], r["account_id"]): r for r in am.collect()}, cm


def test_ramp_boundary_89_90(spark):
    # snapshot 2001-03-31: start 2001-01-01 -> day 90; start 2001-01-02 -> day 89
    rows, _ = mart_rows(spark, contracts=[(1, 1, D(2001, 1, 1), D(2001, 12, 31), 120000, 2000, "New"),
                                          (2, 2, D(2001, 1, 2), D(2001, 12, 31), 120000, 2000, "New")])
    assert rows[(D(2001, 3, 31), 1)]["days_in_contract"] == 90
    assert rows[(D(2001, 3, 31), 1)]["band"] != "Onboarding"
    assert rows[(D(2001, 3, 31), 2)]["band"] == "Onboarding"
    assert rows[(D(2001, 3, 31), 2)]["avr_score"] is None


def test_overlap_latest_start_wins_and_ramp_restarts(spark):
    rows, _ = mart_rows(spark, contracts=[(1, 1, D(2000, 6, 1), D(2001, 5, 31), 100000, 1000, "New"),
                                          (2, 1, D(2001, 3, 1), D(2002, 2, 28), 200000, 3000, "Expansion")])
    assert rows[(D(2001, 2, 28), 1)]["contract_id"] == 1
    r = rows[(D(2001, 3, 31), 1)]
    assert r["contract_id"] == 2 and r["included_monthly_compute_credits"] == 3000
    assert r["is_ramp_period"] is True


def test_shelfware_scores_low(spark):
    rows, _ = mart_rows(spark, contracts=[(1, 1, D(2000, 6, 1), D(2001, 5, 31), 100000, 1000, "New")])
    r = rows[(D(2001, 1, 31), 1)]
    assert r["d_score"] == 0 and r["c_score"] == 0 and r["b_score"] == 0
    assert r["avr_score"] <= 40 and r["band"] == "Red"


def test_trailing_window_is_91_days(spark):
    s = D(2001, 4, 30)
    usage = [("in", 1, s - dt.timedelta(days=90), 100), ("out", 1, s - dt.timedelta(days=91), 1000)]
    from vantage.operators.contracts import contract_active
    from vantage.operators.staging import stg_contracts
    from vantage.operators.usage import snapshot_usage
    f = frames(spark, contracts=[(1, 1, D(2000, 6, 1), D(2001, 12, 31), 100000, 1000, "New")], usage=usage)
    act = contract_active(stg_contracts(f["contracts"]), CFG)
    su = {r["snapshot_date"]: r for r in snapshot_usage(act, f["daily_usage_logs"], f["accounts"], CFG).collect()}
    assert su[s]["credits_last_3mo"] == 100 and su[s]["n_days_90d"] == 1


def test_ticket_closed_on_snapshot_is_not_open(spark):
    s = D(2001, 1, 31)
    tickets = [("a", 1, D(2001, 1, 10), s, 1, "A", "Closed"),
               ("b", 1, D(2001, 1, 10), s + dt.timedelta(days=1), 2, "A", "Closed")]
    rows, _ = mart_rows(spark, contracts=[(1, 1, D(2000, 6, 1), D(2001, 12, 31), 100000, 1000, "New")],
                        tickets=tickets)
    r = rows[(s, 1)]
    assert r["open_sev1"] == 0 and r["open_sev2"] == 1


def test_orphan_and_out_of_window_logs_do_not_count(spark):
    usage = [("orph", 99, D(2001, 1, 15), 500), ("pre", 1, D(2000, 5, 15), 500), ("ok", 1, D(2001, 1, 15), 7)]
    from vantage.operators.contracts import orphan_usage, out_of_window_usage
    f = frames(spark, contracts=[(1, 1, D(2000, 6, 1), D(2001, 12, 31), 100000, 1000, "New")], usage=usage)
    assert [r["log_id"] for r in orphan_usage(f["daily_usage_logs"], f["accounts"]).collect()] == ["orph"]
    assert [r["log_id"] for r in out_of_window_usage(
        f["daily_usage_logs"], f["accounts"], f["contracts"]).collect()] == ["pre"]
    am, _ = build_marts(f, CFG)
    r = [x for x in am.collect() if x["snapshot_date"] == D(2001, 1, 31)][0]
    assert r["b_score"] == pytest.approx(min(1.0, 7 / (1000 * (245 / 30.0))))


def test_rep_without_accounts_has_zero_book(spark):
    _, cm = mart_rows(spark, contracts=[(1, 1, D(2001, 1, 1), D(2001, 2, 1), 100000, 1000, "New")])
    r = [x for x in cm.collect() if x["snapshot_date"] == D(2001, 6, 30)][0]
    assert r["n_accounts"] == 0 and r["avg_avr"] is None and r["pct_red"] is None


def test_dense_ticket_grid_prev_load(spark):
    from vantage.operators.contracts import contract_active
    from vantage.operators.staging import stg_contracts
    from vantage.operators.tickets import snapshot_tickets
    f = frames(spark, contracts=[(1, 1, D(2001, 1, 1), D(2001, 2, 15), 100000, 1000, "New")],
               tickets=[("a", 1, D(2001, 3, 20), None, 1, "A", "Open")])
    act = contract_active(stg_contracts(f["contracts"]), CFG)
    g = {r["snapshot_date"]: r for r in snapshot_tickets(f["support_tickets"], act, CFG).collect()}
    assert len(g) == 6                                   # every snapshot for an ever-active account
    assert g[D(2001, 1, 31)]["prev_age_weighted_load"] is None
    assert g[D(2001, 3, 31)]["age_weighted_load"] == pytest.approx(0.5 * (1 + 11 / 30))
    assert g[D(2001, 4, 30)]["prev_age_weighted_load"] == pytest.approx(0.5 * (1 + 11 / 30))
