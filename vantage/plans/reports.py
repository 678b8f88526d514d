"""Report queries over the marts and the raw facts (R-1..R-29, M-21, M-22).

Library functions take the marts / inputs plus explicit parameters
(snapshot, FilterSet, as-of date); the registered queries run them with the
fixed report parameters below over whole tables.  Top-k reports keep their
limit (it is the feature) and add the key as a tie-break.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.config import FilterSet, MetricConfig
from vantage.functions import scoring as S
from vantage.functions.dates import lit_date, month_label, prev_month_end, prev_month_start, rep_label
from vantage.functions.filters import account_filter, filtered, having, round_half_up, round_ratio
from vantage.operators.calendar import compared, rolling_window_12m, snapshot_dates, with_prior
from vantage.plans import marts
from vantage.plans.registry import CFG, inputs, materialized_marts, query, stored_table

# Fixed report parameters of the registered queries.
REPORT_SNAPSHOT = CFG.scoring_date                 # selected snapshot
QUARTER = (dt.date(2001, 1, 1), dt.date(2001, 3, 31))
GAP_THRESHOLD = 10.0
GAP_REPORTED = 0.5        # of the registered report: the driver tables' books are close to balanced
GAP_BALANCED = 2.0
EXPANSION_LIMIT = 100
ACCOUNT_LIST_LIMIT = 500
EXAMPLE_LIMIT = 25
SMOKE_LIMIT = 10
SEVERITY_LABELS = {1: "Sev 1 (Critical)", 2: "Sev 2 (High)", 3: "Sev 3 (Low)"}
BANDS = ("Green", "Yellow", "Red")


def default_filter(snapshot=REPORT_SNAPSHOT) -> FilterSet:
    # dashboard default toggles: established accounts on, ramping accounts off
    return FilterSet(snapshot_date=snapshot, include_established=True, include_ramp=False)


def consumption_range(cfg: MetricConfig) -> tuple[dt.date, dt.date]:
    return cfg.snapshot_start.replace(day=1), cfg.snapshot_end


def tenths_avg(c: str = "avr_score") -> F.Column:
    t = S.score_tenths(F.col(c))
    return F.try_divide(F.sum(t).cast("double"), F.count(t) * 10.0)


# ---- library functions ---------------------------------------------------

KPI_KEYS = ["snapshot_date", "region", "account_segment", "rep_id", "is_ramp_period", "band"]
KPI_SCORES = {"avg_d": "d_score", "avg_t": "t_score", "avg_c": "c_score", "avg_r": "r_score", "avg_b": "b_score"}


def kpi_rollup(mart: DataFrame) -> DataFrame:
    """Mergeable sums of the account mart (one row for each snapshot and account) by everything that the report filters
    know but the account: counts, exact integer sums, and the counts the averages divide by."""
    flag, arr = F.col("expansion_flag"), F.col("annual_commit_dollars")
    tenths = S.score_tenths(F.col("avr_score"))
    sums = [F.count("account_id").alias("n_accounts"), F.sum(arr).alias("book_arr"),
            F.sum(tenths).alias("tenths"), F.count(tenths).alias("n_scored"), F.count_if(flag).alias("n_flags"),
            F.sum(F.when(flag, arr).otherwise(0)).alias("flag_arr")]
    for c in KPI_SCORES.values():
        u = S.score_nano(F.col(c))
        sums += [F.sum(u).alias(f"{c}_nano"), F.count(u).alias(f"{c}_n")]
    return mart.groupBy(*KPI_KEYS).agg(*sums)


def kpis(mart: DataFrame, fs: FilterSet, snapshots) -> DataFrame:
    """R-6 headline KPIs for each requested snapshot (a list, or a frame with snapshot_date) under the same filters.

    `mart` is the account mart or, where no accounts are chosen, its rollup."""
    rows = filtered(mart, fs, with_snapshot=False)
    # a snapshot whose selection is empty still has its row: zeros, and averages of nothing
    if isinstance(snapshots, DataFrame):
        asked = snapshots.select("snapshot_date")
        rows = rows.join(asked, "snapshot_date", "left_semi")
    else:
        asked = mart.sparkSession.range(1).select(
            F.explode(F.array(*[lit_date(s) for s in snapshots])).alias("snapshot_date"))
        rows = rows.where(F.col("snapshot_date").isin([lit_date(s) for s in snapshots]))
    rolled = rows if "n_flags" in rows.columns else kpi_rollup(rows)
    n = F.coalesce(F.sum("n_accounts"), F.lit(0))
    red = F.coalesce(F.sum(F.when(F.col("band") == "Red", F.col("n_accounts"))), F.lit(0))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    out = asked.join(rolled, "snapshot_date", "left").groupBy("snapshot_date").agg(
        n.alias("n_accounts"), total("book_arr").alias("book_arr"),
        F.try_divide(F.sum("tenths").cast("double"), F.sum("n_scored") * 10.0).alias("avg_avr"),
        F.try_divide(red, n).alias("pct_red"), total("n_flags").alias("n_expansion_opps"),
        total("flag_arr").alias("expansion_pipeline_arr"),
        *[F.try_divide(F.sum(f"{c}_nano").cast("double"), F.sum(f"{c}_n") * 1.0e7).alias(k) for k, c in KPI_SCORES.items()])
    return out.withColumn("pct_red_band", S.pct_red_band(F.col("pct_red") * 100.0))


def kpi_deltas(mart: DataFrame, fs: FilterSet, calendar: DataFrame) -> DataFrame:
    """The score KPIs of the selected snapshot, of the one before it in the calendar, and their difference (one row;
    null where either side is missing, as on the first snapshot)."""
    pair = compared(calendar, fs.snapshot_date)
    kp = kpis(mart, fs, pair).join(pair, "snapshot_date")
    aggs = []
    for c in ["avg_avr", "pct_red", *KPI_SCORES]:
        a = F.max(F.when(F.col("is_current"), F.col(c)))
        b = F.max(F.when(~F.col("is_current"), F.col(c)))
        aggs += [a.alias(f"{c}_current"), b.alias(f"{c}_prior"), (a - b).alias(f"{c}_delta")]
    return kp.agg(*aggs)


def filtered_accounts(mart: DataFrame, fs: FilterSet) -> DataFrame:
    """Accounts matching the dimension filters on any snapshot, narrowed by
    the tenure toggles at the selected snapshot (J-14 semi joins)."""
    base = filtered(mart, fs, with_snapshot=False, with_tenure=False).select("account_id")
    tenure = mart.where(account_filter(FilterSet(snapshot_date=fs.snapshot_date,
                                                 include_ramp=fs.include_ramp,
                                                 include_established=fs.include_established)))
    return base.join(tenure.select("account_id"), "account_id", "left_semi").distinct()


def trimmed(series: DataFrame, window: DataFrame) -> DataFrame:
    """A monthly series within a window of snapshots, with the months' labels (F-20)."""
    months = window.select(F.col("snapshot_date").alias("month_end"))
    return series.join(months, "month_end", "left_semi").withColumn("month_label", month_label(F.col("month_end")))


def purchased_vs_consumed(mart: DataFrame, days: DataFrame, fs: FilterSet,
                          cfg: MetricConfig) -> DataFrame:
    """R-7: monthly allotment of the filtered accounts vs their usage. The usage by account and day (`usage_days`) is
    summed by account and month before it meets the accounts, so a hot account is one row a month."""
    fa = filtered_accounts(mart, fs)
    lo, hi = consumption_range(cfg)
    purchased = (mart.groupBy("account_id", F.col("snapshot_date").alias("month_end"))
                 .agg(F.sum("included_monthly_compute_credits").alias("credits")).withColumn("bought", F.lit(True)))
    consumed = (days.where(F.col("date").between(lit_date(lo), lit_date(hi)))
                .groupBy("account_id", F.last_day("date").alias("month_end"))
                .agg(F.sum("sx").alias("credits")).withColumn("bought", F.lit(False)))
    both = purchased.unionByName(consumed).join(fa, "account_id", "left_semi")
    part = lambda bought, name: F.coalesce(
        F.sum(F.when(F.col("bought") == bought, F.col("credits"))), F.lit(0)).cast("bigint").alias(name)
    return (both.groupBy("month_end").agg(part(True, "purchased_credits"), part(False, "consumed_credits"))
            .where("purchased_credits > 0 OR consumed_credits > 0"))


def severity_label(c: F.Column) -> F.Column:
    e = F.lit(None).cast("string")
    for k in sorted(SEVERITY_LABELS, reverse=True):
        e = F.when(c == k, SEVERITY_LABELS[k]).otherwise(e)
    return e


def ticket_trend(mart: DataFrame, opened: DataFrame, fs: FilterSet, cfg: MetricConfig) -> DataFrame:
    """R-8: tickets opened per month x severity for the filtered accounts, from the tickets by account and day
    (`ticket_days`), summed by account and month before they meet the accounts."""
    fa = filtered_accounts(mart, fs)
    lo, hi = consumption_range(cfg)
    monthly = (opened.where(F.col("opened_date").between(lit_date(lo), lit_date(hi)))
               .groupBy("account_id", F.last_day("opened_date").alias("month_end"),
                        severity_label(F.col("severity")).alias("severity_label")).agg(F.sum("n_tickets").alias("n")))
    return (monthly.join(fa, "account_id", "left_semi").groupBy("month_end", "severity_label")
            .agg(F.sum("n").alias("n_tickets")))


def ticket_totals(trend: DataFrame, window: DataFrame) -> DataFrame:
    """R-29: total and sev-1 tickets inside the 12-month window."""
    t = trend.join(window.withColumnRenamed("snapshot_date", "month_end"), "month_end", "left_semi")
    return t.agg(F.coalesce(F.sum("n_tickets"), F.lit(0)).cast("bigint").alias("total_tickets"),
                 F.coalesce(F.sum(F.when(F.col("severity_label") == SEVERITY_LABELS[1],
                                         F.col("n_tickets"))), F.lit(0)).cast("bigint").alias("n_sev1"))


def owners_of(mart: DataFrame, snapshot, account_ids) -> DataFrame:
    """Reps who own one of the chosen accounts (a list or a frame of ids) on a snapshot."""
    rows = having(mart.where(F.col("snapshot_date") == lit_date(snapshot)), "account_id", account_ids)
    return rows.select(F.col("rep_id").alias("csm_id")).distinct()


def chosen(ids) -> bool:
    return isinstance(ids, DataFrame) or bool(ids)


def csm_leaderboard(csm: DataFrame, fs: FilterSet, mart: DataFrame | None = None) -> DataFrame:
    """R-10 leaderboard with the tie-inclusive leader marker (W-9); with chosen accounts, of their owners' full books."""
    f = csm.where((F.col("snapshot_date") == lit_date(fs.snapshot_date)) & (F.col("n_accounts") > 0))
    if fs.regions:
        f = having(f, "region", fs.regions)
    if fs.csm_ids:
        f = having(f, "csm_id", fs.csm_ids)
    if chosen(fs.account_ids) and mart is not None:
        f = f.join(owners_of(mart, fs.snapshot_date, fs.account_ids), "csm_id", "left_semi")
    avg1 = round_half_up(F.col("avg_avr"), 1)
    out = f.select("csm_id", rep_label(F.col("csm_id")).alias("csm_label"), "csm_name", "region", "n_accounts", "book_arr",
                   avg1.alias("avg_avr"), "n_green", "n_yellow", "n_red",
                   round_half_up(F.col("pct_red") * 100.0, 1).alias("pct_red"),
                   "n_expansion_opps", "expansion_pipeline_arr")
    top = out.agg(F.max("avg_avr")).scalar()    # one value, no window over all reps
    return out.withColumn("is_leader", F.coalesce(F.col("avg_avr") == top, F.lit(False))).orderBy(
        F.col("avg_avr").desc_nulls_last(), "csm_id")


def book_gap(mart: DataFrame, fs: FilterSet) -> DataFrame:
    """R-11: average vs ARR-weighted score of the filtered book.  NULL scores
    drop out of the numerator but their ARR stays in the denominator."""
    f = filtered(mart, fs)
    t = S.score_tenths(F.col("avr_score"))
    arr = F.col("annual_commit_dollars")
    g = f.agg(F.count(F.lit(1)).alias("n_accounts"), F.sum(arr).alias("total_arr"),
              tenths_avg().alias("avg_raw"),
              F.try_divide(F.sum(arr * t).cast("double"), F.sum(arr) * 10.0).alias("wgt_raw"))
    gap = round_half_up(F.col("wgt_raw") - F.col("avg_raw"), 1)
    return (g.where(F.col("avg_raw").isNotNull())
            .select("n_accounts", "total_arr",
                    round_half_up(F.col("avg_raw"), 1).alias("avg_avr"),
                    round_half_up(F.col("wgt_raw"), 1).alias("weighted_avr"),
                    gap.alias("gap"),
                    F.when(gap >= GAP_BALANCED, "bigger accounts healthier")
                     .when(gap <= -GAP_BALANCED, "bigger accounts sicker")
                     .when(gap.isNotNull(), "balanced").alias("interpretation")))


def csm_gap_details(csm: DataFrame, fs: FilterSet, min_abs_gap: float = GAP_THRESHOLD,
                    mart: DataFrame | None = None) -> DataFrame:
    """R-12: reps whose (rounded) weighted-minus-average gap is large, narrowed
    like the leaderboard by region, rep and the owners of chosen accounts."""
    f = csm.where((F.col("snapshot_date") == lit_date(fs.snapshot_date)) & (F.col("n_accounts") > 0)
                  & F.col("arr_weighted_avr").isNotNull())
    if fs.regions:
        f = having(f, "region", fs.regions)
    if fs.csm_ids:
        f = having(f, "csm_id", fs.csm_ids)
    if mart is not None and (chosen(fs.account_ids) or fs.segments):
        own = filtered(mart, FilterSet(snapshot_date=fs.snapshot_date, segments=fs.segments, account_ids=fs.account_ids))
        f = f.join(own.select(F.col("rep_id").alias("csm_id")).distinct(), "csm_id", "left_semi")
    gap = round_half_up(F.col("arr_weighted_avr") - F.col("avg_avr"), 1)
    return (f.select("csm_id", "csm_name", "region", "n_accounts", "book_arr",
                     round_half_up(F.col("avg_avr"), 1).alias("avg_avr"),
                     round_half_up(F.col("arr_weighted_avr"), 1).alias("weighted_avr"),
                     gap.alias("gap"))
            .where(F.abs(F.col("gap")) >= min_abs_gap)
            .orderBy(F.abs(F.col("gap")).desc(), "csm_id"))


def int_score(c: F.Column) -> F.Column:
    """SAFE_CAST(ROUND(x, 0) AS INT64) for non-negative x."""
    return F.floor(c + 0.5).cast("bigint")


def expansion_opps(mart: DataFrame, fs: FilterSet, limit: int = EXPANSION_LIMIT) -> DataFrame:
    """R-13: flagged accounts, largest ARR first (top-k)."""
    return (filtered(mart, fs).where("expansion_flag")
            .select("account_id", "company_name", F.col("rep_id").alias("csm_id"), "region",
                    F.col("account_segment").alias("segment"), "annual_commit_dollars",
                    "days_to_renewal", int_score(F.col("avr_score")).alias("avr_score"), "band")
            .orderBy(F.col("annual_commit_dollars").desc(), "account_id").limit(limit))


def account_list(mart: DataFrame, fs: FilterSet, limit: int = ACCOUNT_LIST_LIMIT) -> DataFrame:
    """R-14: filtered accounts with x100 integer component scores (top-k)."""
    comps = [int_score(F.col(f"{c}_score") * 100.0).alias(f"{c}_score") for c in "dcbrt"]
    return (filtered(mart, fs)
            .select("account_id", "company_name", F.col("rep_id").alias("csm_id"), "region",
                    F.col("account_segment").alias("segment"), "annual_commit_dollars",
                    "days_in_contract", "days_to_renewal",
                    int_score(F.col("avr_score")).alias("avr_score"), *comps, "band")
            .orderBy(F.col("annual_commit_dollars").desc(), "account_id").limit(limit))


def renewal_window(mart: DataFrame, fs: FilterSet, cfg: MetricConfig) -> DataFrame:
    """R-15: active accounts and those within the renewal window."""
    f = filtered(mart, fs)
    n = F.count(F.lit(1))
    rw = F.count_if(F.col("days_to_renewal") <= cfg.expansion_days_to_renewal)
    return f.agg(n.alias("n_active"), rw.alias("n_renewal_window"),
                 F.try_divide(rw * 100.0, n).alias("pct_renewal_window"))


DETAIL_COLUMNS = ["account_id", "company_name", "industry", "account_segment", "region",
                  "csm_id", "csm_name", "contract_id", "contract_type", "annual_commit_dollars",
                  "included_monthly_compute_credits", "days_to_renewal", "days_in_contract",
                  "is_ramp_period", "d_score", "c_score", "t_score", "r_score", "b_score",
                  "open_sev1", "open_sev2", "open_sev3", "latest_color", "avr_score", "band",
                  "expansion_flag"]


def account_detail(mart: DataFrame, snapshot, account_id=None) -> DataFrame:
    """R-16: drill-down rows on a snapshot (one account when given)."""
    f = mart.where(F.col("snapshot_date") == lit_date(snapshot))
    if account_id is not None:
        f = f.where(F.col("account_id") == F.lit(account_id))
    return f.withColumn("csm_id", F.col("rep_id")).select(*DETAIL_COLUMNS)


def account_active_ranges(mart: DataFrame, account_ids=None) -> DataFrame:
    """R-5: first / last snapshot per account (min() for a deterministic name); of chosen accounts (a list or a frame
    of ids) where they are given."""
    rows = mart if account_ids is None else having(mart, "account_id", account_ids)
    return rows.groupBy("account_id").agg(F.min("company_name").alias("company_name"),
                                          F.min("snapshot_date").alias("first_snapshot"),
                                          F.max("snapshot_date").alias("last_snapshot"))


def account_labels(mart: DataFrame) -> DataFrame:
    """R-4 / F-19: picker label; "name (id)" only for names used by several ids. Names are counted with map-side
    combine; only the shared ones are looked up again, so a hot name is no group of one task."""
    d = mart.select("account_id", "company_name").distinct()
    shared = d.groupBy("company_name").count().where("count > 1").select("company_name", F.lit(True).alias("_shared"))
    return d.join(shared, "company_name", "left").select(
        "account_id", "company_name",
        F.when(F.col("_shared"), F.concat(F.col("company_name"), F.lit(" ("), F.col("account_id").cast("string"), F.lit(")")))
         .otherwise(F.col("company_name")).alias("display_label"))


def filter_options(mart: DataFrame, csm: DataFrame) -> DataFrame:
    """R-1 / R-2: snapshot, region and segment option lists (distinct, non-NULL)."""
    snaps = mart.select(F.lit("snapshot").alias("option_kind"),
                        F.date_format("snapshot_date", "yyyy-MM-dd").alias("option_value"))
    regions = csm.select(F.lit("region").alias("option_kind"), F.col("region").alias("option_value"))
    segs = mart.select(F.lit("segment").alias("option_kind"),
                       F.col("account_segment").alias("option_value"))
    return snaps.unionByName(regions).unionByName(segs).where("option_value IS NOT NULL").distinct()


def csm_options(csm: DataFrame, regions: tuple = ()) -> DataFrame:
    """R-3: reps, optionally limited to regions (cascading picker)."""
    f = csm.where(F.col("region").isin(list(regions))) if regions else csm
    return f.select("csm_id", "csm_name", "region").distinct()


def filter_diagnosis(mart: DataFrame, fs: FilterSet) -> DataFrame:
    """R-17: for every account, or every chosen one, why it is or is not in the
    filtered view on the selected snapshot (active range vs other filters)."""
    ranges = account_active_ranges(mart, fs.account_ids if chosen(fs.account_ids) else None)
    match = (filtered(mart, fs).select("account_id").distinct()
             .withColumn("matches", F.lit(True)))
    s = lit_date(fs.snapshot_date)
    in_range = (F.col("first_snapshot") <= s) & (F.col("last_snapshot") >= s)
    j = ranges.join(match, "account_id", "left")
    return j.select("account_id", "company_name", "first_snapshot", "last_snapshot",
                    F.when(~in_range, "not_active_on_snapshot")
                     .when(F.col("matches").isNull(), "excluded_by_filters")
                     .otherwise("included").alias("status"))


def bought_vs_consumed(f: dict[str, DataFrame], as_of, limit: int = EXAMPLE_LIMIT) -> DataFrame:
    """R-18: last complete month's allotment vs raw usage per covering
    contract (overlapping contracts give several rows), top-k by ratio."""
    s = lit_date(as_of)
    m0, m1 = prev_month_start(s), prev_month_end(s)
    consumed = (f["daily_usage_logs"].where(F.col("date").between(m0, m1))
                .groupBy("account_id").agg(F.sum("compute_credits_consumed").alias("consumed_credits")))
    committed = (f["contracts"].where(m1.between(F.col("start_date"), F.col("end_date")))
                 .select("account_id", F.col("included_monthly_compute_credits").alias("included_credits"),
                         "annual_commit_dollars"))
    j = (f["accounts"].select("account_id", "company_name", "segment")
         .join(committed, "account_id").join(consumed, "account_id", "left")
         .withColumn("consumed_last_month",
                     F.coalesce("consumed_credits", F.lit(0)).cast("bigint")))
    return (j.select("account_id", "company_name", "segment", "annual_commit_dollars",
                     F.col("included_credits").alias("purchased_monthly_credits"),
                     "consumed_last_month",
                     round_ratio("consumed_last_month", "included_credits", 3).alias("consumption_ratio"))
            .orderBy(F.col("consumption_ratio").desc_nulls_last(), "account_id",
                     "annual_commit_dollars", "purchased_monthly_credits")
            .limit(limit))


def danger_zone(f: dict[str, DataFrame], as_of, limit: int = EXAMPLE_LIMIT) -> DataFrame:
    """R-19: latest colour Red or open sev-1/2 tickets (by status)."""
    s = lit_date(as_of)
    h = f["account_health"]
    latest = h.groupBy("account_id").agg(F.max_by("health_color", "date").alias("latest_health_color"))
    open_t = f["support_tickets"].where(F.col("status").isin("Open", "In Progress"))
    per_t = open_t.groupBy("account_id").agg(
        F.count_if(F.col("severity").isin(1, 2)).alias("open_sev1_sev2"),
        F.max(F.datediff(s, F.col("opened_date"))).cast("bigint").alias("oldest_open_ticket_days"))
    j = (f["accounts"].select("account_id", "company_name", "segment")
         .join(latest, "account_id", "left").join(per_t, "account_id", "left")
         .withColumn("open_sev1_sev2", F.coalesce("open_sev1_sev2", F.lit(0)).cast("bigint")))
    return (j.where((F.col("latest_health_color") == "Red") | (F.col("open_sev1_sev2") > 0))
            .select("account_id", "company_name", "segment", "latest_health_color",
                    "open_sev1_sev2", "oldest_open_ticket_days")
            .orderBy(F.col("open_sev1_sev2").desc(), F.col("latest_health_color").desc_nulls_last(),
                     "account_id")
            .limit(limit))


def weekly_usage(days: DataFrame, accounts: DataFrame) -> DataFrame:
    """R-20: Monday-based weekly active accounts and credits (known accounts),
    from the usage by account and day, which is reduced to weeks before it meets the accounts."""
    weekly = days.groupBy("account_id", F.trunc("date", "week").alias("week_start")).agg(F.sum("sx").alias("credits"))
    return (weekly.join(accounts.select("account_id"), "account_id", "left_semi").groupBy("week_start")
            .agg(F.count(F.lit(1)).alias("active_accounts"), F.sum("credits").alias("total_credits_consumed")))


def band_distribution(scored: DataFrame) -> DataFrame:
    """R-21 / R-22: accounts and mean score per band, fixed band order with
    zero fill."""
    agg = scored.groupBy("band").agg(F.count(F.lit(1)).alias("n_accounts"),
                                     tenths_avg().alias("avg_avr_score"))
    spark = scored.sparkSession
    order = spark.createDataFrame([(b, i) for i, b in enumerate(BANDS)], "band string, band_order int")
    return (order.join(agg, "band", "left")
            .select("band", "band_order",
                    F.coalesce("n_accounts", F.lit(0)).cast("bigint").alias("n_accounts"),
                    "avg_avr_score"))


def segment_band_crosstab(scored: DataFrame) -> DataFrame:
    """R-23: segment x band counts with fixed band columns and zero fill."""
    return (scored.groupBy("segment").pivot("band", list(BANDS)).count()
            .na.fill(0, list(BANDS))
            .select("segment", *[F.col(b).cast("bigint").alias(b) for b in BANDS]))


def top_red(scored: DataFrame, limit: int = SMOKE_LIMIT) -> DataFrame:
    """R-24a: lowest-scoring Red accounts."""
    return (scored.where(F.col("band") == "Red")
            .select("account_id", "company_name", "segment", "avr_score", "d_score", "c_score",
                    "t_score", "r_score", "b_score", "annual_commit_dollars", "days_to_renewal",
                    "latest_color")
            .orderBy("avr_score", "account_id").limit(limit))


def top_expansion(scored: DataFrame, limit: int = SMOKE_LIMIT) -> DataFrame:
    """R-24b: flagged accounts with the largest commit."""
    return (scored.where(F.col("expansion_flag"))
            .select("account_id", "company_name", "segment", "band", "avr_score",
                    "annual_commit_dollars", "included_monthly_compute_credits", "days_to_renewal")
            .orderBy(F.col("annual_commit_dollars").desc(), "account_id").limit(limit))


def company_trend(csm: DataFrame) -> DataFrame:
    """R-25: per snapshot mean of rep weighted scores and total book."""
    return csm.groupBy("snapshot_date").agg(
        F.round(F.avg("arr_weighted_avr"), 9).alias("avg_arr_weighted_avr"),
        F.sum("book_arr").alias("total_book_arr"))


def coaching_list(csm: DataFrame) -> DataFrame:
    """R-26: reps on the latest snapshot, most Red first."""
    latest = csm.agg(F.max("snapshot_date").alias("snapshot_date"))
    return (csm.join(latest, "snapshot_date", "left_semi")
            .select("csm_id", "csm_name", "arr_weighted_avr", "n_red", "pct_red")
            .orderBy(F.col("pct_red").desc_nulls_last(), "csm_id"))


def quarterly_rep_score(csm: DataFrame, q_start, q_end) -> DataFrame:
    """R-27: mean weighted score per rep over a quarter's snapshots."""
    return (csm.where(F.col("snapshot_date").between(lit_date(q_start), lit_date(q_end)))
            .groupBy("csm_id").agg(F.round(F.avg("arr_weighted_avr"), 9).alias("avg_arr_weighted_avr")))


def handoff_queue(csm: DataFrame, snapshot) -> DataFrame:
    """R-28: expansion hand-off counts per rep on a snapshot."""
    return (csm.where(F.col("snapshot_date") == lit_date(snapshot))
            .select("csm_id", "n_expansion_opps", "expansion_pipeline_arr"))


# ---- registered queries ----------------------------------------------------

def _marts(spark, root):
    f = inputs(spark, root)
    am, cm = materialized_marts(spark, root, CFG)
    return f, am, cm


def _v1(spark, root):
    cfg = MetricConfig.v1(scoring_date=CFG.scoring_date)
    return marts.point_in_time(inputs(spark, root, cfg), cfg)


def _rollup(spark, root):
    """The account mart's rollup as a written table beside it."""
    am = materialized_marts(spark, root, CFG)[0]
    return stored_table(spark, root, "kpi_rollup", lambda: kpi_rollup(am))


def _calendar(spark, root):
    """The snapshots that the mart has."""
    return _rollup(spark, root).select("snapshot_date").distinct()


def _window(spark, root):
    return rolling_window_12m(_calendar(spark, root), REPORT_SNAPSHOT)


@query("kpis")
def q_kpis(spark, root):
    return kpis(_rollup(spark, root), default_filter(), compared(_calendar(spark, root), REPORT_SNAPSHOT))


@query("kpis_filtered")
def q_kpis_filtered(spark, root):
    fs = FilterSet(snapshot_date=REPORT_SNAPSHOT, regions=("ASIA", "EUROPE", "AMERICA"),
                   segments=("Enterprise",), include_ramp=True, include_established=True)
    return kpis(_rollup(spark, root), fs, [REPORT_SNAPSHOT])


@query("kpi_deltas")
def q_kpi_deltas(spark, root):
    return kpi_deltas(_rollup(spark, root), default_filter(), _calendar(spark, root))


@query("prior_snapshots")
def q_prior_snapshots(spark, root):
    return with_prior(_calendar(spark, root))


@query("purchased_vs_consumed")
def q_pvc(spark, root):
    f, am, _ = _marts(spark, root)
    return purchased_vs_consumed(am, f["usage_days"], default_filter(), CFG)


@query("purchased_vs_consumed_12m")
def q_pvc_12m(spark, root):
    return trimmed(q_pvc(spark, root), _window(spark, root))


@query("ticket_trend")
def q_ticket_trend(spark, root):
    f, am, _ = _marts(spark, root)
    return ticket_trend(am, f["ticket_days"], default_filter(), CFG)


@query("ticket_trend_12m")
def q_ticket_trend_12m(spark, root):
    return trimmed(q_ticket_trend(spark, root), _window(spark, root))


@query("ticket_totals")
def q_ticket_totals(spark, root):
    win = rolling_window_12m(snapshot_dates(spark, CFG), REPORT_SNAPSHOT)
    return ticket_totals(q_ticket_trend(spark, root), win)


@query("rolling_window_12m")
def q_rolling_window(spark, root):
    _, am, _ = _marts(spark, root)
    return rolling_window_12m(am.select("snapshot_date").distinct(), REPORT_SNAPSHOT)


@query("csm_leaderboard")
def q_leaderboard(spark, root):
    _, _, cm = _marts(spark, root)
    return csm_leaderboard(cm, default_filter())


@query("book_gap")
def q_book_gap(spark, root):
    _, am, _ = _marts(spark, root)
    return book_gap(am, default_filter())


def _expanding(am) -> FilterSet:
    """The report filters with chosen accounts, as a table: those flagged for expansion on the snapshot."""
    ids = am.where((F.col("snapshot_date") == lit_date(REPORT_SNAPSHOT)) & F.col("expansion_flag")).select("account_id")
    return replace(default_filter(), account_ids=ids)


@query("csm_leaderboard_owners")
def q_leaderboard_owners(spark, root):
    _, am, cm = _marts(spark, root)
    return csm_leaderboard(cm, _expanding(am), am)


@query("csm_gap_details")
def q_csm_gap(spark, root):
    return csm_gap_details(_marts(spark, root)[2], default_filter(), GAP_REPORTED)


@query("csm_gap_details_owners")
def q_csm_gap_owners(spark, root):
    _, am, cm = _marts(spark, root)
    return csm_gap_details(cm, replace(_expanding(am), segments=("Mid-Market",)), GAP_REPORTED, am)


@query("expansion_opps")
def q_expansion_opps(spark, root):
    _, am, _ = _marts(spark, root)
    return expansion_opps(am, default_filter())


@query("account_list")
def q_account_list(spark, root):
    _, am, _ = _marts(spark, root)
    return account_list(am, default_filter())


@query("renewal_window")
def q_renewal_window(spark, root):
    _, am, _ = _marts(spark, root)
    return renewal_window(am, default_filter(), CFG)


@query("account_detail")
def q_account_detail(spark, root):
    _, am, _ = _marts(spark, root)
    return account_detail(am, REPORT_SNAPSHOT)


@query("account_active_ranges")
def q_active_ranges(spark, root):
    _, am, _ = _marts(spark, root)
    return account_active_ranges(am)


@query("account_active_ranges_chosen")
def q_active_ranges_chosen(spark, root):
    _, am, _ = _marts(spark, root)
    return account_active_ranges(am, _expanding(am).account_ids)


@query("account_labels")
def q_account_labels(spark, root):
    _, am, _ = _marts(spark, root)
    return account_labels(am)


@query("filter_options")
def q_filter_options(spark, root):
    _, am, cm = _marts(spark, root)
    return filter_options(am, cm)


@query("csm_options")
def q_csm_options(spark, root):
    _, _, cm = _marts(spark, root)
    return csm_options(cm)


@query("filter_diagnosis")
def q_filter_diagnosis(spark, root):
    _, am, _ = _marts(spark, root)
    return filter_diagnosis(am, default_filter())


@query("filter_diagnosis_chosen")
def q_filter_diagnosis_chosen(spark, root):
    _, am, _ = _marts(spark, root)
    early = replace(_expanding(am), snapshot_date=CFG.snapshot_start.replace(month=6, day=30))
    return filter_diagnosis(am, early)


@query("bought_vs_consumed")
def q_bought_vs_consumed(spark, root):
    return bought_vs_consumed(inputs(spark, root), CFG.as_of)


@query("danger_zone")
def q_danger_zone(spark, root):
    return danger_zone(inputs(spark, root), CFG.as_of)


@query("weekly_usage")
def q_weekly_usage(spark, root):
    f = inputs(spark, root)
    return weekly_usage(f["usage_days"], f["accounts"])


@query("avr_point_in_time_v1")
def q_v1(spark, root):
    return _v1(spark, root).orderBy("avr_score", "account_id")    # K-1: the lowest score first


@query("band_distribution")
def q_band_distribution(spark, root):
    return band_distribution(_v1(spark, root))


@query("segment_band_crosstab")
def q_crosstab(spark, root):
    return segment_band_crosstab(_v1(spark, root))


@query("top_red")
def q_top_red(spark, root):
    return top_red(_v1(spark, root))


@query("top_expansion")
def q_top_expansion(spark, root):
    return top_expansion(_v1(spark, root))


@query("company_trend")
def q_company_trend(spark, root):
    return company_trend(_marts(spark, root)[2])


@query("coaching_list")
def q_coaching_list(spark, root):
    return coaching_list(_marts(spark, root)[2])


@query("quarterly_rep_score")
def q_quarterly(spark, root):
    return quarterly_rep_score(_marts(spark, root)[2], *QUARTER)


@query("handoff_queue")
def q_handoff(spark, root):
    return handoff_queue(_marts(spark, root)[2], REPORT_SNAPSHOT)


@query("component_contributions")
def q_contributions(spark, root):
    return marts.component_contributions(_marts(spark, root)[1], CFG)


def _scored(spark, root):
    f = inputs(spark, root)
    return marts.scored_active(marts.stages(f, CFG), CFG)


for _name, _col in [("component_d", "d_score"), ("component_c", "c_score"),
                    ("component_t", "t_score"), ("component_r", "r_score"),
                    ("component_b", "b_score"), ("expansion_flag", "expansion_flag"),
                    ("ramp_flag", "is_ramp_period")]:
    def _make(col):
        return lambda spark, root: _scored(spark, root).select("snapshot_date", "account_id", col)
    query(_name)(_make(_col))
