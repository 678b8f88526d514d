"""Weekly health colour derivation (M-19) and as-of health signals (M-6).

All as-of / open-interval questions are answered with bounded explodes over a
config-bounded calendar plus running sums over per-account event rows, never
with inequality joins; every window runs over at most calendar-size rows per
account, so a hot account cannot concentrate raw data in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vantage.config import MetricConfig
from vantage.functions.dates import (calendar_bounds, lit_date, month_ends_between,
                                     prev_month_end, sundays_between, week_ending_sunday)

# Fixed values of the weekly colour rule.
WEEKS_PER_MONTH = 4.33
RED_USAGE_FRACTION = 0.05
YELLOW_USAGE_FRACTION = 0.15
RED_OPEN_SEV12_ABOVE = 5
YELLOW_OPEN_SEV12_FROM = 3
SEV1_STALE_AFTER_DAYS = 7
COLORS = ("Green", "Yellow", "Red")


def covering_spans(contracts: DataFrame, cfg: MetricConfig) -> DataFrame:
    """(account_id, first, last, newness, included_monthly_compute_credits): spans of Sundays; the newest of those that
    cover a Sunday (the largest newness) is the account's newest covering contract there.

    Of contracts with the same Sundays only the newest counts, so an account keeps one row for each span that differs,
    however many contracts it has. A span ends before the next newer one where that lasts at least as long; only
    spans around a shorter newer one still overlap."""
    sundays = sundays_between(F.col("start_date"), F.col("end_date"), cfg)
    spans = (contracts.select("account_id", "start_date", "contract_id", "included_monthly_compute_credits", sundays.alias("s"))
             .where(F.size("s") > 0)
             .select("account_id", F.col("s")[0].alias("first"), F.element_at("s", -1).alias("last"),
                     F.struct("start_date", "contract_id", "included_monthly_compute_credits").alias("c"))
             .groupBy("account_id", "first", "last").agg(F.max("c").alias("c")))
    w = Window.partitionBy("account_id").orderBy("c")
    newer, until = F.lead("first").over(w), F.lead("last").over(w)
    return spans.select(
        "account_id", "first", F.when(until >= F.col("last"), F.least(F.col("last"), F.date_sub(newer, 7)))
        .otherwise(F.col("last")).alias("last"), F.row_number().over(w).alias("newness"),
        F.col("c.included_monthly_compute_credits").alias("included_monthly_compute_credits")).where("first <= last")


def _spans_apart(spans: DataFrame) -> DataFrame:
    """`covering_spans`, where an account has any that overlap, as spans of one Sunday: an older and a newer span have
    no Sunday in common then but the same one, and the newest is the last of it. Few accounts have such spans."""
    by_newness = Window.partitionBy("account_id").orderBy("newness")
    before = F.max("last").over(by_newness.rowsBetween(Window.unboundedPreceding, -1))
    overlaps = F.coalesce(before >= F.col("first"), F.lit(False))
    any_overlap = F.max("overlaps").over(by_newness.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    one = lambda s, e: F.struct(s.alias("first"), e.alias("last"))
    sundays = F.transform(F.sequence("first", "last", F.expr("INTERVAL 7 DAYS")), lambda s: one(s, s))
    parts = F.when(F.col("any_overlap"), sundays).otherwise(F.array(one(F.col("first"), F.col("last"))))
    return (spans.withColumn("overlaps", overlaps).withColumn("any_overlap", any_overlap)
            .select("account_id", "newness", "included_monthly_compute_credits", F.explode(parts).alias("part"))
            .select("account_id", "newness", "included_monthly_compute_credits", "part.first", "part.last"))


def derive_health(contracts: DataFrame, usage: DataFrame, tickets: DataFrame,
                  cfg: MetricConfig) -> DataFrame:
    """One row per (account, week-ending Sunday) with a covering contract:
    health_color from the week's usage vs the weekly share of the newest
    covering contract's monthly allotment, and from open sev-1/2 tickets.

    - covering contract: `covering_spans` leaves each contract about the Sundays
      it wins (`_spans_apart`: exactly those);
    - weekly usage: logs bucketed to their week-ending Sunday, summed;
    - open-ticket counts: +1/-1 events at open/close (and at opened+8 days for
      "sev-1 open more than 7 days"), bucketed to Sundays and turned into
      counts by a running sum per account.

    Usage and events are reduced together to one row for each account and week
    that has any. They meet the spans in one sorted pass over an account's
    changes (weeks with usage or events, and starts of spans), both dealt by
    account before, and the union keeps that. What holds from a change to the next
    is settled there, and only then exploded to weeks: the first week has the
    usage of the change, those after it have none.
    """
    h0 = lit_date(cfg.health_first) if cfg.health_first else None
    h1 = lit_date(cfg.health_end)
    # plain date tests, so that they reach the scan
    usage = usage.where(F.col("date") <= h1)
    tickets = tickets.where(F.col("opened_date") <= h1)
    if h0 is not None:
        usage = usage.where(F.col("date") > F.date_sub(h0, 7))
    none = F.lit(None)
    cover = _spans_apart(covering_spans(contracts, cfg)).select(
        "account_id", F.col("first").alias("sunday"), "newness",
        F.struct("last", F.col("included_monthly_compute_credits").alias("allot")).alias("span"),
        none.cast("bigint").alias("wu"), none.cast("bigint").alias("d12"), none.cast("bigint").alias("d1"))

    wk = week_ending_sunday(F.col("date"))
    weekly = usage.select("account_id", wk.alias("sunday"), F.col("compute_credits_consumed").alias("wu"),
                          F.lit(0).alias("d12"), F.lit(0).alias("d1"))

    sev = F.col("severity")
    opened, closed = F.col("opened_date"), F.col("closed_date")
    stale_from = F.date_add(opened, SEV1_STALE_AFTER_DAYS + 1)
    is1 = F.when(sev == 1, 1).otherwise(0)

    def close_at(not_before):
        # greatest() skips NULLs: a ticket that never closed has no close event
        return F.when(closed.isNotNull(), F.greatest(closed, not_before))

    def ev(day, d12, d1):
        return F.struct(day.alias("day"), F.lit(d12).alias("d12"), d1.cast("int").alias("d1"))

    events = (tickets.where(sev.isin(1, 2))
              .select("account_id", F.explode(F.array(
                  ev(opened, 1, F.lit(0)),
                  ev(close_at(opened), -1, F.lit(0)),
                  ev(stale_from, 0, is1),
                  ev(close_at(stale_from), 0, -is1))).alias("e"))
              .where(F.col("e.day").isNotNull())
              .select("account_id",
                      (week_ending_sunday(F.col("e.day")) if h0 is None else
                       F.greatest(week_ending_sunday(F.col("e.day")), h0)).alias("sunday"),
                      F.col("e.d12").alias("d12"), F.col("e.d1").alias("d1"))
              .where(F.col("sunday") <= h1)
              .select("account_id", "sunday", none.cast("bigint").alias("wu"), "d12", "d1"))
    weeks = (weekly.unionByName(events).groupBy("account_id", "sunday")
             .agg(F.coalesce(F.sum("wu"), F.lit(0)).alias("wu"), F.sum("d12").cast("bigint").alias("d12"),
                  F.sum("d1").cast("bigint").alias("d1"))
             .select("account_id", "sunday", F.lit(0).alias("newness"), none.cast("struct<last:date,allot:bigint>").alias("span"),
                     "wu", "d12", "d1"))

    # a week's usage and events come first, its contracts by newness after them: the last row of a week knows all of it
    by_week = Window.partitionBy("account_id").orderBy("sunday", "newness")
    upto = by_week.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    used = F.struct(F.col("sunday").alias("week"), "wu")
    rows = cover.unionByName(weeks.repartition("account_id")).select(
        "account_id", "sunday", F.lead("sunday").over(by_week).alias("next"),
        F.last("span", ignorenulls=True).over(upto).alias("span"),
        F.last(F.when(F.col("newness") == 0, used), ignorenulls=True).over(upto).alias("used"),
        F.coalesce(F.sum("d12").over(upto), F.lit(0)).alias("n12"), F.coalesce(F.sum("d1").over(upto), F.lit(0)).alias("n1_stale"))
    until = F.least("span.last", F.date_sub("next", 7))    # least() skips NULLs: nothing follows the last change
    rows = rows.where((F.col("next").isNull() | (F.col("next") > F.col("sunday")))
                      & (F.col("span.last") >= F.col("sunday")) & F.col("span.allot").isNotNull())
    weekly_allot = F.col("span.allot") / WEEKS_PER_MONTH
    wu = F.when(F.col("used.week") == F.col("sunday"), F.col("used.wu")).otherwise(F.lit(0))

    def color(credits):
        frac = F.when(weekly_allot > 0, credits / weekly_allot).otherwise(F.lit(0.0))
        return (F.when((frac < RED_USAGE_FRACTION) | (F.col("n12") > RED_OPEN_SEV12_ABOVE)
                       | (F.col("n1_stale") > 0), "Red")
                .when((frac < YELLOW_USAGE_FRACTION) | (F.col("n12") >= YELLOW_OPEN_SEV12_FROM), "Yellow")
                .otherwise("Green"))

    rows = rows.select("account_id", wu.cast("bigint").alias("wu"), color(wu).alias("color"), color(F.lit(0)).alias("color_after"),
                       F.sequence("sunday", until, F.expr("INTERVAL 7 DAYS")).alias("weeks"))
    first = F.col("k") == 0
    return rows.select("account_id", "wu", "color", "color_after", F.posexplode("weeks").alias("k", "date")).select(
        "account_id", "date", F.when(first, F.col("color")).otherwise(F.col("color_after")).alias("health_color"),
        F.when(first, F.col("wu")).otherwise(F.lit(0)).cast("bigint").alias("compute_credits_consumed"))


def _signals(health: DataFrame, cfg: MetricConfig) -> DataFrame:
    """(snapshot_date, account_id, latest_color, had_red_last_30d) from one pass over the health rows.

    Rows are bucketed to the first snapshot on/after their date and reduced to
    the last date of each colour there (a hash aggregate; a maximum by date of
    colours would be sorted on the map side). In the order of an account's dates
    the last row of a bucket holds its colour, which is carried forward to the
    snapshots before the account's next bucket; so is the last Red date up to it,
    which tells whether some Red week lies in [snapshot - N, snapshot]. A Red row
    without a date counts for every snapshot; a row without an account for none."""
    cal_lo, cal_hi = calendar_bounds(cfg)
    bucket = F.greatest(F.last_day("date"), cal_lo)
    rows = (health.select("account_id", "date", "health_color", F.col("date").isNull().alias("undated"), bucket.alias("bucket"))
            .where(F.col("bucket") <= cal_hi)
            .groupBy("account_id", "bucket", "health_color", "undated").agg(F.max("date").alias("date")))
    by_date = Window.partitionBy("account_id").orderBy("date")
    red, undated = F.col("health_color") == "Red", F.col("undated")
    ever = F.max(F.when(red, undated)).over(by_date)    # rows without a date come first
    until = F.coalesce(prev_month_end(F.col("next")), cal_hi)
    near = F.col("last_red") >= F.date_sub("snapshot_date", cfg.red_lookback_days)
    return (rows.withColumn("next", F.lead("bucket").over(by_date)).withColumn("last_red", F.max(F.when(red, F.col("date"))).over(by_date))
            .withColumn("ever", ever).where(F.col("next").isNull() | (F.col("next") > F.col("bucket")))
            .select(F.explode(month_ends_between(F.col("bucket"), until, cfg)).alias("snapshot_date"), "account_id",
                    F.when(~undated, F.col("health_color")).alias("latest_color"), "last_red", "ever")
            .select("snapshot_date", "account_id", "latest_color",
                    (F.col("account_id").isNotNull() & (F.coalesce(near, F.lit(False)) | F.coalesce("ever", F.lit(False))))
                    .alias("had_red_last_30d")))


def latest_color(health: DataFrame, cfg: MetricConfig) -> DataFrame:
    """(snapshot_date, account_id, latest_color): colour of the most recent
    health row on or before each snapshot (no look-back limit)."""
    return _signals(health, cfg).select("snapshot_date", "account_id", "latest_color")


def snapshot_health(health: DataFrame, cfg: MetricConfig) -> DataFrame:
    """M-6: latest colour as of each snapshot + Red in the trailing window."""
    return _signals(health, cfg)


def health_at(health: DataFrame, scoring_date, lookback_days: int) -> DataFrame:
    """Single-date variant: latest colour on/before the date and Red in the
    trailing window, per account.

    Dates are reduced by account and colour first (numbers, which a hash
    aggregate holds in place; a maximum by date of colours is sorted)."""
    s = F.lit(scoring_date).cast("date")
    per = (health.where(F.col("date") <= s).groupBy("account_id", "health_color")
           .agg(F.max("date").alias("date")))
    recent = F.col("date") >= F.date_sub(s, lookback_days)
    return per.groupBy("account_id").agg(
        F.max_by("health_color", "date").alias("latest_color"),
        F.bool_or(F.when(recent, F.col("health_color") == "Red")).alias("had_red_30d"))
