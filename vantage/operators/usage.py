"""Trailing usage statistics per (snapshot_date, account_id) (M-4).

Plan: raw logs are first reduced to per-(account, day) moments (row count,
sum, sum of squares) with map-side partial aggregation, which removes any
hot-account skew before the first shuffle and keeps the row-level semantics
(mean / sd / count run over log rows, not days).  Running totals of the moments
by account and day then give every window as the difference of two look-ups:
the days and the boundaries looked up (five at most for each snapshot of an
account) meet in one sorted pass over the account's days; both are dealt by
account before, the snapshots before they become five rows.  No day row goes to
the snapshots it counts for, and the aggregation of the look-ups groups by keys
that contain account_id, so it reuses the pass's partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vantage.config import MetricConfig
from vantage.functions.dates import calendar_bounds, prev_month_end, prev_month_start

USAGE_STAT_COLUMNS = ["credits_last_month", "mean_90d", "sd_90d", "n_days_90d",
                      "credits_last_3mo", "credits_ytd_contract"]


def usage_days(usage: DataFrame) -> DataFrame:
    """(account_id, date) -> n_logs (rows), n, sx, sxx (of the credits): the reduction before any join on the account."""
    x = F.col("compute_credits_consumed")
    return usage.groupBy("account_id", "date").agg(
        F.count(F.lit(1)).alias("n_logs"), F.count(x).alias("n"), F.sum(x).alias("sx"),
        F.sum(x.cast("decimal(38,0)") * x.cast("decimal(38,0)")).alias("sxx"))


def days_of(frames: dict[str, DataFrame]) -> DataFrame:
    """The frames' usage by account and day: theirs if they have it (a stored table), else reduced from the logs."""
    have = getattr(frames, "builders", frames)
    return frames["usage_days"] if "usage_days" in have else usage_days(frames["daily_usage_logs"])


def known_days(days: DataFrame, accounts: DataFrame) -> DataFrame:
    """The days of known accounts."""
    return days.join(accounts.select("account_id"), "account_id", "left_semi")


def sample_sd(n: Column, sx: Column, sxx: Column) -> Column:
    """Sample standard deviation from exact integer moments; NULL for n < 2."""
    num = (n.cast("decimal(38,0)") * sxx - sx.cast("decimal(38,0)") * sx.cast("decimal(38,0)"))
    den = n * (n - 1)
    return F.when(n >= 2, F.sqrt(num.cast("double") / den.cast("double")))


def running_totals(daily: DataFrame, probes: DataFrame) -> DataFrame:
    """`probes` (account_id, date, tag, ...) with n, sx and sxx of all the account's days up to and including the
    date; null before the account's first day."""
    extra = [c for c in probes.columns if c not in ("account_id", "date")]
    kinds = dict(probes.dtypes)
    days = daily.select("account_id", "date", "n", "sx", "sxx", F.lit(0).alias("_probe"),
                        *[F.lit(None).cast(kinds[c]).alias(c) for c in extra])
    both = days.repartition("account_id").unionByName(probes.select("account_id", "date", F.lit(1).alias("_probe"), *extra), allowMissingColumns=True)
    # days come before the probes of their date
    upto = Window.partitionBy("account_id").orderBy("date", "_probe").rowsBetween(Window.unboundedPreceding, 0)
    return both.select("account_id", "date", *extra, "_probe", *[F.sum(c).over(upto).alias(c) for c in ("n", "sx", "sxx")]) \
        .where("_probe = 1").drop("_probe")


def usage_stats(active: DataFrame, daily: DataFrame, cfg: MetricConfig,
                carry: list[str] | None = None) -> DataFrame:
    """Window statistics of every active row from running totals by day.

    All windows lie between the contract's start and the snapshot. With T(d) the
    totals up to day d: contract to date = T(s) - T(start - 1), the trailing
    window = T(s) - T(max(start, s - window) - 1), last month = T(its end) -
    T(max(start, its first day) - 1), nothing if the contract starts later.

    `carry` = extra active columns to keep (all functionally dependent on the
    (snapshot_date, account_id) key)."""
    s, start = F.col("snapshot_date"), F.col("start_date")
    keys = ["snapshot_date", "account_id", "start_date"]
    extra = [c for c in (carry or []) if c not in keys]
    month_end = prev_month_end(s)
    ends = {"now": s, "before": F.date_sub(start, 1), "window": F.date_sub(F.greatest(start, F.date_sub(s, cfg.cv_window_days)), 1),
            "month": F.when(start <= month_end, month_end),
            "month_before": F.when(start <= month_end, F.date_sub(F.greatest(start, prev_month_start(s)), 1))}
    tags = {k: i for i, k in enumerate(ends)}
    # goes with one of the five look-ups only; a date alone is aggregated by hash, a struct by a sort
    row = F.struct(*keys, *extra) if extra else start
    probes = active.repartition("account_id").select("account_id", "snapshot_date", row.alias("row"), F.explode(F.array(
        *[F.struct(F.lit(tags[k]).alias("tag"), d.alias("date")) for k, d in ends.items()])).alias("p")).select(
        "account_id", "snapshot_date", F.when(F.col("p.tag") == tags["now"], F.col("row")).alias("row"), "p.tag", "p.date")
    got = running_totals(daily, probes)
    at = lambda tag, c: F.max(F.when(F.col("tag") == tags[tag], F.col(c)))
    zero = lambda x: F.coalesce(x, F.lit(0))
    g = got.groupBy("account_id", "snapshot_date").agg(
        (F.any_value("row", ignoreNulls=True) if extra else F.max("row")).alias("row"),
        (zero(at("month", "sx")) - zero(at("month_before", "sx"))).alias("credits_last_month"),
        (zero(at("now", "n")) - zero(at("window", "n"))).alias("n90"),
        (zero(at("now", "sx")) - zero(at("window", "sx"))).alias("sx90"),
        (zero(at("now", "sxx")) - zero(at("window", "sxx"))).alias("sxx90"),
        (zero(at("now", "sx")) - zero(at("before", "sx"))).alias("credits_ytd_contract"))
    n90 = F.col("n90")
    return g.select(
        *([F.col(f"row.{c}").alias(c) for c in keys + extra] if extra else
          ["snapshot_date", "account_id", F.col("row").alias("start_date")]),
        "credits_last_month",
        F.try_divide(F.col("sx90"), n90).alias("mean_90d"),
        sample_sd(n90, F.col("sx90"), F.col("sxx90")).alias("sd_90d"),
        n90.cast("bigint").alias("n_days_90d"),
        F.col("sx90").alias("credits_last_3mo"), "credits_ytd_contract")


def until_last_snapshot(days: DataFrame, cfg: MetricConfig) -> DataFrame:
    """Days after the last snapshot never enter a window; the date predicate reaches the scan."""
    _, cal_hi = calendar_bounds(cfg)
    return days.where(F.col("date") <= cal_hi)


def since_first_start(days: DataFrame, contracts: DataFrame, first: Column, last: Column) -> DataFrame:
    """The days from the earliest start of any contract that covers some date of first..last (a superset of it: one
    that ends in time and starts in time). No window of such a date reaches back further, and the difference of two
    running totals loses nothing by the days before both. One minimum over the contracts; no key is joined. A contract
    without an end may cover any date, and one without a start has no first day."""
    reaches = F.coalesce(F.col("end_date") >= first, F.lit(True)) & F.coalesce(F.col("start_date") <= last, F.lit(True))
    start = contracts.where(reaches).agg(F.min(F.coalesce("start_date", F.lit("0001-01-01").cast("date"))).alias("_start"))
    return days.join(F.broadcast(start), F.col("date") >= F.col("_start")).drop("_start")


def days_in_reach(days: DataFrame, contracts: DataFrame, cfg: MetricConfig) -> DataFrame:
    """The days that a window of some snapshot may hold."""
    return since_first_start(until_last_snapshot(days, cfg), contracts, *calendar_bounds(cfg))


def snapshot_usage(active: DataFrame, usage: DataFrame, accounts: DataFrame,
                   cfg: MetricConfig, days: DataFrame | None = None, contracts: DataFrame | None = None) -> DataFrame:
    """M-4 output grain: (snapshot_date, account_id, contract_start) + stats;
    `days` is the usage by account and day, if it is there already. With the
    `contracts` that `active` comes from, days before any window stay out."""
    days = usage_days(usage) if days is None else days
    days = until_last_snapshot(days, cfg) if contracts is None else days_in_reach(days, contracts, cfg)
    stats = usage_stats(active, known_days(days, accounts), cfg)
    return stats.withColumnRenamed("start_date", "contract_start")
