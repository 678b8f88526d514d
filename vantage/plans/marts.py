"""Account mart (M-16), rep mart (M-17), single-date variant (M-18) and the
per-account contribution table (M-21).

The SQL source builds six component relations keyed by (snapshot_date,
account_id) and re-joins them; here every component is a column expression
on one frame (active contract + usage stats), so the only joins are with the
ticket and health signals and the two dimensions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.config import MetricConfig
from vantage.functions import scoring as S
from vantage.functions.dates import calendar_array, days_between, lit_date
from vantage.operators.contracts import ACTIVE_COLUMNS, contract_active
from vantage.operators.health import health_at, snapshot_health
from vantage.operators.staging import (stg_account_health, stg_accounts, stg_contracts,
                                       stg_csm_reps)
from vantage.operators.tickets import open_severity_counts_at, snapshot_tickets
from vantage.operators.usage import days_in_reach, days_of, known_days, sample_sd, since_first_start, usage_stats

ACCOUNT_MART_COLUMNS = [
    "snapshot_date", "account_id", "company_name", "industry", "account_segment", "rep_id",
    "region", "csm_name", "contract_id", "contract_type", "annual_commit_dollars",
    "included_monthly_compute_credits", "days_to_renewal", "days_in_contract",
    "is_ramp_period", "d_score", "c_score", "t_score", "r_score", "b_score",
    "open_sev1", "open_sev2", "open_sev3", "latest_color", "avr_score", "expansion_flag", "band"]


@dataclass
class Stages:
    """Intermediate frames of one build (shared by several consumers)."""
    accounts: DataFrame
    reps: DataFrame
    contracts: DataFrame
    days: DataFrame      # usage by account and day
    tickets: DataFrame
    health: DataFrame
    active: DataFrame
    model: Callable[[str], DataFrame] | None = None    # gives written models by name


def stages(frames: dict[str, DataFrame], cfg: MetricConfig, model: Callable[[str], DataFrame] | None = None) -> Stages:
    con = stg_contracts(frames["contracts"])
    return Stages(
        accounts=stg_accounts(frames["accounts"]),
        reps=stg_csm_reps(frames["csm_reps"]),
        contracts=con,
        days=days_of(frames),
        tickets=frames["support_tickets"],
        health=stg_account_health(frames["account_health"]),
        active=model("contract_active") if model else contract_active(con, cfg),
        model=model)


def scored_active(st: Stages, cfg: MetricConfig) -> DataFrame:
    """Active contract rows with usage stats, ticket and health signals and
    all component scores (before the dimension joins). Where the models are
    written tables, they are read; their rows without an account meet none."""
    if st.model:
        enriched = st.active.join(st.model("snapshot_usage").drop("contract_start"), ["snapshot_date", "account_id"])
        tick, health = st.model("snapshot_tickets"), st.model("snapshot_health")
    else:
        daily = known_days(days_in_reach(st.days, st.contracts, cfg), st.accounts)
        enriched = usage_stats(st.active, daily, cfg, carry=ACTIVE_COLUMNS + [
            "days_to_renewal", "days_in_contract"])
        tick = snapshot_tickets(st.tickets, st.active, cfg)
        health = snapshot_health(st.health, cfg)
    m = (enriched.join(tick, ["snapshot_date", "account_id"], "left")
         .join(health, ["snapshot_date", "account_id"], "left"))
    allot = F.col("included_monthly_compute_credits")
    dic = F.col("days_in_contract")
    d = S.d_score(F.col("credits_last_month"), allot)
    cc = S.c_score(F.col("mean_90d"), F.col("sd_90d"), F.col("n_days_90d"), cfg)
    t = S.t_score(F.col("latest_color"), F.col("age_weighted_load"), F.col("prev_age_weighted_load"))
    r = S.r_score(F.col("days_to_renewal"), F.col("had_red_last_30d"))
    b = S.b_score(F.col("credits_ytd_contract"), allot, dic)
    return m.select(
        "*",
        S.is_ramp(dic, cfg).alias("is_ramp_period"),
        d.alias("d_score"), cc.alias("c_score"), t.alias("t_score"),
        r.alias("r_score"), b.alias("b_score"),
        S.expansion_flag(F.col("credits_last_3mo"), allot, F.col("days_to_renewal"), cfg)
         .alias("expansion_flag"))


def account_mart(frames: dict[str, DataFrame], cfg: MetricConfig,
                 st: Stages | None = None) -> DataFrame:
    st = st or stages(frames, cfg)
    m = scored_active(st, cfg)
    reps = st.reps.select("csm_id", "csm_name", "region")
    m = (m.join(st.accounts.select("account_id", "company_name", "industry",
                                   "account_segment", "rep_id"), "account_id")
         .join(reps, F.col("rep_id") == F.col("csm_id"), "left"))
    score = S.avr_score(F.col("d_score"), F.col("c_score"), F.col("t_score"),
                        F.col("r_score"), F.col("b_score"), F.col("days_in_contract"), cfg)
    m = m.select(
        *[c for c in ACCOUNT_MART_COLUMNS if c not in
          ("open_sev1", "open_sev2", "open_sev3", "avr_score", "band")],
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
          for c in ("open_sev1", "open_sev2", "open_sev3")],
        score.alias("avr_score"))
    m = m.withColumn("band", S.band(F.col("avr_score"), F.col("is_ramp_period"), cfg))
    return m.select(*ACCOUNT_MART_COLUMNS)


def csm_mart(mart: DataFrame, reps: DataFrame, cfg: MetricConfig) -> DataFrame:
    """Per (snapshot, rep): book KPIs over scoreable (non-ramp) accounts, one
    row for every rep and snapshot (zero-book reps: counts 0, averages NULL).

    Score sums are exact integer sums (AVR in tenths, T in 1e-9 units), so the
    averages do not depend on summation order."""
    book = mart.where(~F.coalesce(F.col("is_ramp_period"), F.lit(False)))
    arr = F.col("annual_commit_dollars")
    tenths = S.score_tenths(F.col("avr_score"))
    t_nano = S.score_nano(F.col("t_score"))
    flag = F.col("expansion_flag")
    per = (book.groupBy("snapshot_date", F.col("rep_id").alias("csm_id")).agg(
        F.countDistinct("account_id").alias("n_accounts"),
        F.sum(arr).alias("book_arr"),
        F.sum(tenths).alias("sum_tenths"), F.count(tenths).alias("n_scored"),
        F.sum(arr * tenths).alias("arr_tenths"),
        F.sum(arr).alias("arr_sum"),
        F.sum(t_nano).alias("t_nano_sum"), F.count(t_nano).alias("n_t"),
        F.sum(arr.cast("decimal(38,0)") * t_nano).alias("arr_t_nano"),
        F.count_if(F.col("band") == "Green").alias("n_green"),
        F.count_if(F.col("band") == "Yellow").alias("n_yellow"),
        F.count_if(F.col("band") == "Red").alias("n_red"),
        F.count_if(flag).alias("n_expansion_opps"),
        F.sum(F.when(flag, arr).otherwise(0)).alias("expansion_pipeline_arr")))
    grid = reps.select("csm_id", "csm_name", "region",
                       F.explode(calendar_array(cfg)).alias("snapshot_date"))
    g = grid.join(per, ["snapshot_date", "csm_id"], "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return g.select(
        "snapshot_date", "csm_id", "csm_name", "region",
        z("n_accounts"), z("book_arr"),
        F.try_divide(F.col("sum_tenths"), F.col("n_scored") * 10.0).alias("avg_avr"),
        F.try_divide(F.col("arr_tenths"), F.col("arr_sum") * 10.0).alias("arr_weighted_avr"),
        F.try_divide(F.col("t_nano_sum").cast("double"), F.col("n_t") * 1.0e7)
         .alias("avg_technical_health"),
        F.try_divide(F.col("arr_t_nano").cast("double"), F.col("arr_sum") * 1.0e7)
         .alias("arr_weighted_technical_health"),
        z("n_green"), z("n_yellow"), z("n_red"),
        F.try_divide(F.col("n_red"), F.col("n_accounts")).alias("pct_red"),
        z("n_expansion_opps"), z("expansion_pipeline_arr"))


def build_marts(frames: dict[str, DataFrame], cfg: MetricConfig) -> tuple[DataFrame, DataFrame]:
    st = stages(frames, cfg)
    am = account_mart(frames, cfg, st)
    return am, csm_mart(am, st.reps, cfg)


V1_COLUMNS = ["account_id", "company_name", "industry", "segment", "contract_id", "contract_type",
              "annual_commit_dollars", "included_monthly_compute_credits", "days_to_renewal",
              "d_score", "c_score", "t_score", "r_score", "b_score", "open_sev1", "open_sev2",
              "latest_color", "avr_score", "expansion_flag", "scoring_date", "band"]


def point_in_time(frames: dict[str, DataFrame], cfg: MetricConfig) -> DataFrame:
    """M-18: one row per account with a contract covering `cfg.scoring_date`
    (older formula with `MetricConfig.v1()`; no ramp rule, no rep columns).

    Usage counts when it lies inside the active contract's span; windows are
    conditional aggregates over one join of per-day moments."""
    s = lit_date(cfg.scoring_date)
    con = frames["contracts"]
    cand = con.where(s.between(F.col("start_date"), F.col("end_date")))
    rest = ["end_date", "annual_commit_dollars", "included_monthly_compute_credits", "contract_type"]
    active = (cand.groupBy("account_id")
              .agg(F.max(F.struct("start_date", "contract_id", *rest)).alias("c"))
              .select("account_id", "c.*")
              .withColumn("days_to_renewal", days_between(F.col("end_date"), s))
              .withColumn("days_in_contract", days_between(s, F.col("start_date")) + 1))
    acc = frames["accounts"]
    # every window lies between an active contract's start and the scoring date: other days meet no account
    daily = known_days(since_first_start(days_of(frames).where(F.col("date") <= s), con, s, s), acc)
    a, u = active.alias("a"), daily.alias("u")
    d = F.col("u.date")
    j = a.join(u, (F.col("a.account_id") == F.col("u.account_id"))
               & d.between(F.col("a.start_date"), F.col("a.end_date")), "left")
    lm = d.between(F.trunc(F.add_months(s, -1), "month"), F.last_day(F.add_months(s, -1)))
    w90 = d.between(F.date_sub(s, cfg.cv_window_days), s)
    ytd = d.between(F.col("a.start_date"), s)
    keys = ["account_id", "contract_id", "start_date", *rest, "days_to_renewal", "days_in_contract"]
    g = j.groupBy(*[F.col(f"a.{k}").alias(k) for k in keys]).agg(
        F.sum(F.when(lm, F.col("u.sx"))).alias("credits_last_month"),
        F.sum(F.when(w90, F.col("u.n"))).alias("n90"),
        F.sum(F.when(w90, F.col("u.sx"))).alias("sx90"),
        F.sum(F.when(w90, F.col("u.sxx"))).alias("sxx90"),
        F.sum(F.when(ytd, F.col("u.sx"))).alias("credits_ytd"))
    n90 = F.col("n90")
    g = g.select("*", F.try_divide(F.col("sx90"), n90).alias("mean_90d"),
                 sample_sd(n90, F.col("sx90"), F.col("sxx90")).alias("sd_90d"))
    tick = open_severity_counts_at(frames["support_tickets"], cfg.scoring_date)
    hl = health_at(frames["account_health"], cfg.scoring_date, cfg.red_lookback_days)
    m = (g.join(acc.select("account_id", "company_name", "industry", "segment"), "account_id")
         .join(tick, "account_id", "left").join(hl, "account_id", "left"))
    allot = F.col("included_monthly_compute_credits")
    dsc = S.d_score(F.col("credits_last_month"), allot)
    csc = S.c_score(F.col("mean_90d"), F.col("sd_90d"), F.coalesce(n90, F.lit(0)), cfg)
    if cfg.t_formula == "v1":
        tsc = S.t_score_v1(F.col("latest_color"), F.col("open_sev1"), F.col("open_sev2"))
    else:
        raise ValueError("point_in_time supports the v1 T formula only")
    rsc = S.r_score(F.col("days_to_renewal"), F.col("had_red_30d"))
    bsc = S.b_score(F.col("credits_ytd"), allot, F.col("days_in_contract"))
    score = S.composite(dsc, csc, tsc, rsc, bsc, cfg)
    out = m.select(
        "account_id", "company_name", "industry", "segment", "contract_id", "contract_type",
        "annual_commit_dollars", "included_monthly_compute_credits", "days_to_renewal",
        dsc.alias("d_score"), csc.alias("c_score"), tsc.alias("t_score"),
        rsc.alias("r_score"), bsc.alias("b_score"),
        F.coalesce(F.col("open_sev1"), F.lit(0)).cast("bigint").alias("open_sev1"),
        F.coalesce(F.col("open_sev2"), F.lit(0)).cast("bigint").alias("open_sev2"),
        "latest_color", score.alias("avr_score"),
        S.expansion_flag(F.col("sx90"), allot, F.col("days_to_renewal"), cfg).alias("expansion_flag"),
        s.alias("scoring_date"))
    return out.withColumn("band", S.band_v1(F.col("avr_score"), cfg)).select(*V1_COLUMNS)


def component_contributions(mart: DataFrame, cfg: MetricConfig) -> DataFrame:
    """M-21: per (snapshot, account) the five components as rows with weight,
    score and weighted contribution (unpivot with stack)."""
    stacked = mart.select(
        "snapshot_date", "account_id",
        F.expr("stack(5, 'D', d_score, 'C', c_score, 'T', t_score, 'R', r_score, 'B', b_score)"
               ).alias("component", "score"))
    weights = F.create_map(*[x for k, w in (("D", cfg.w_d), ("C", cfg.w_c), ("T", cfg.w_t),
                                            ("R", cfg.w_r), ("B", cfg.w_b))
                             for x in (F.lit(k), F.lit(w))])
    wt = weights[F.col("component")]
    return stacked.select("snapshot_date", "account_id", "component", wt.alias("weight"),
                          "score", (wt * F.col("score") * 100.0).alias("contribution"))
