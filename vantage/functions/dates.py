"""Date column expressions (all JVM-side built-ins)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from vantage.config import MetricConfig



def _month() -> Column:
    return F.expr("INTERVAL 1 MONTH")


def _week() -> Column:
    return F.expr("INTERVAL 7 DAYS")


def lit_date(d: dt.date | str) -> Column:
    return F.lit(d if isinstance(d, dt.date) else dt.date.fromisoformat(d))


def month_start(c: Column) -> Column:
    return F.trunc(c, "month")


def prev_month_start(c: Column) -> Column:
    """First day of the calendar month before `c` (DATE_TRUNC(DATE_SUB(c, 1 MONTH)))."""
    return F.trunc(F.add_months(c, -1), "month")


def prev_month_end(c: Column) -> Column:
    """Last day of the calendar month before `c` (add_months clamps 03-31 -> 02-28)."""
    return F.last_day(F.add_months(c, -1))


def month_end_on_or_before(c: Column) -> Column:
    return F.when(c == F.last_day(c), c).otherwise(prev_month_end(c))


def week_ending_sunday(c: Column) -> Column:
    """The Sunday that closes the Monday..Sunday week containing `c`
    (the first Sunday on or after `c`)."""
    return F.next_day(F.date_sub(c, 1), "Sun")


def sunday_on_or_before(c: Column) -> Column:
    return F.date_sub(F.next_day(c, "Sun"), 7)


def calendar_bounds(cfg: MetricConfig) -> tuple[Column, Column]:
    lo = F.last_day(lit_date(cfg.snapshot_start))
    hi = F.last_day(lit_date(cfg.snapshot_end))
    return lo, hi


def calendar_array(cfg: MetricConfig) -> Column:
    """All snapshot month-ends as one array literal (bounded by the config,
    not by the data)."""
    return month_ends_between(lit_date(cfg.snapshot_start), lit_date(cfg.snapshot_end), cfg,
                              clip=False, lo_inclusive_month=True)


def month_ends_between(lo: Column, hi: Column, cfg: MetricConfig, clip: bool = True,
                       lo_inclusive_month: bool = False) -> Column:
    """Array of snapshot month-ends m with lo <= m <= hi (both closed).

    With ``lo_inclusive_month`` the month of `lo` counts even when lo is not
    its month-end (used for the calendar itself).  The array length is bounded
    by the snapshot calendar, so exploding it is a bounded fan-out that
    replaces a range join against the calendar.
    """
    first = F.last_day(lo)
    last = F.last_day(hi) if lo_inclusive_month else month_end_on_or_before(hi)
    if clip:
        cal_lo, cal_hi = calendar_bounds(cfg)
        first = F.greatest(first, cal_lo)
        last = F.least(last, cal_hi)
    seq = F.transform(F.sequence(month_start(first), month_start(last), _month()),
                      lambda d: F.last_day(d))
    return F.when(first <= last, seq).otherwise(F.array().cast("array<date>"))


def sundays_between(lo: Column, hi: Column, cfg: MetricConfig) -> Column:
    """Array of health Sundays s with lo <= s <= hi, clipped to the health range."""
    first = week_ending_sunday(lo)
    if cfg.health_first:
        first = F.greatest(first, lit_date(cfg.health_first))
    last = F.least(sunday_on_or_before(hi), lit_date(cfg.health_end))
    return F.when(first <= last, F.sequence(first, last, _week())).otherwise(
        F.array().cast("array<date>"))


def days_between(later: Column, earlier: Column) -> Column:
    """DATE_DIFF(later, earlier, DAY) as BIGINT."""
    return F.datediff(later, earlier).cast("bigint")


def month_label(c: Column, long: bool = False) -> Column:
    return F.date_format(c, "MMMM yyyy" if long else "MMM yyyy")


def rep_label(rep_id: Column) -> Column:
    """F-18: a rep's id without its prefix."""
    return F.regexp_replace(rep_id.cast("string"), "^CSM-", "")
