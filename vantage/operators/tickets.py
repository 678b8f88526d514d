"""Open-ticket signals per (snapshot_date, account_id) (M-5, M-9b).

A ticket is open on snapshot s when opened_date <= s and (closed_date is NULL
or closed_date > s).  Instead of a non-equi join against the calendar, each
ticket is exploded to the month-ends in [opened_date, closed_date) (bounded by
the calendar size) and aggregated with map-side combine.

The age-weighted load is kept exact: with integer severity weights 10/4/1
(= .50/.20/.05 x 20) a ticket contributes w * (30 + min(30, age)) / 600, which
equals sev_weight * (1 + min(1, age/30)).  Summing integers makes the result
independent of summation order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vantage.config import MetricConfig
from vantage.functions.dates import calendar_bounds, calendar_array, month_ends_between

# Fixed values of the metric definition: severity weights x 20, age cap in days.
SEVERITY_WEIGHT_X20 = {1: 10, 2: 4, 3: 1}
AGE_CAP_DAYS = 30
LOAD_DIVISOR = 600.0   # 20 * 30


def load_units(severity: Column, age_days: Column) -> Column:
    w = F.lit(0)
    for sev in sorted(SEVERITY_WEIGHT_X20, reverse=True):
        w = F.when(severity == sev, SEVERITY_WEIGHT_X20[sev]).otherwise(w)
    return w * (AGE_CAP_DAYS + F.least(F.lit(AGE_CAP_DAYS), age_days))


def ticket_days(tickets: DataFrame) -> DataFrame:
    """(account_id, opened_date, severity) -> n_tickets: the reduction before any join on the account."""
    return tickets.groupBy("account_id", "opened_date", "severity").agg(F.count(F.lit(1)).alias("n_tickets"))


def ticket_days_of(frames: dict[str, DataFrame]) -> DataFrame:
    """The frames' opened tickets by account and day: theirs if they have it (a stored table), else reduced."""
    have = getattr(frames, "builders", frames)
    return frames["ticket_days"] if "ticket_days" in have else ticket_days(frames["support_tickets"])


def open_ticket_rows(tickets: DataFrame, cfg: MetricConfig) -> DataFrame:
    """(snapshot_date, account_id, severity, age_days) for every ticket open
    on a snapshot."""
    _, cal_hi = calendar_bounds(cfg)
    last_open_day = F.coalesce(F.date_sub("closed_date", 1), cal_hi)
    ex = tickets.select(
        "account_id", "severity", "opened_date",
        F.explode(month_ends_between(F.col("opened_date"), last_open_day, cfg)).alias("snapshot_date"))
    return ex.select("snapshot_date", "account_id", "severity",
                     F.datediff("snapshot_date", "opened_date").alias("age_days"))


def ticket_load(tickets: DataFrame, cfg: MetricConfig) -> DataFrame:
    """Sparse per-(snapshot, account) counts and exact load units."""
    o = open_ticket_rows(tickets, cfg)
    sev = F.col("severity")
    return o.groupBy("snapshot_date", "account_id").agg(
        F.count_if(sev == 1).alias("open_sev1"),
        F.count_if(sev == 2).alias("open_sev2"),
        F.count_if(sev == 3).alias("open_sev3"),
        F.sum(load_units(sev, F.col("age_days"))).alias("load_units"))


def snapshot_tickets(tickets: DataFrame, active: DataFrame, cfg: MetricConfig) -> DataFrame:
    """Dense grid (every account ever active x every snapshot) with open
    counts, age-weighted load and the previous snapshot's load.

    The grid is an explode of the config-bounded calendar per account (no
    cross join); LAG runs over <= calendar-size rows per account."""
    grid = (active.select("account_id").distinct()
            .select("account_id", F.explode(calendar_array(cfg)).alias("snapshot_date")))
    per = ticket_load(tickets, cfg)
    dense = grid.join(per, ["snapshot_date", "account_id"], "left")
    load = (F.coalesce(F.col("load_units"), F.lit(0)).cast("double") / LOAD_DIVISOR)
    dense = dense.select(
        "snapshot_date", "account_id",
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
          for c in ("open_sev1", "open_sev2", "open_sev3")],
        load.alias("age_weighted_load"))
    w = Window.partitionBy("account_id").orderBy("snapshot_date")
    return dense.withColumn("prev_age_weighted_load", F.lag("age_weighted_load").over(w))


def open_severity_counts_at(tickets: DataFrame, scoring_date) -> DataFrame:
    """Single-date open sev-1/sev-2 counts per account (v1 formula)."""
    s = F.lit(scoring_date).cast("date")
    open_now = F.col("closed_date").isNull() | (F.col("closed_date") > s)
    return (tickets.where(F.col("opened_date") <= s)
            .groupBy("account_id")
            .agg(F.count_if((F.col("severity") == 1) & open_now).alias("open_sev1"),
                 F.count_if((F.col("severity") == 2) & open_now).alias("open_sev2")))
