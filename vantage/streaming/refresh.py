"""Rebuild selected snapshot partitions of the marts (scheduled refresh).

Snapshot rows depend on up to a year of history, so the whole input is read
(Catalyst prunes what it can), but only the affected snapshots are written:
a dynamic partition overwrite replaces exactly those `snapshot_date`
directories and leaves the rest of the mart untouched.

Usage has a mergeable state beside the marts: its moments by account and day,
partitioned by month. A changed month is reduced again from its own logs only;
all other months are taken from the state.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.config import MetricConfig
from vantage.functions.dates import lit_date
from vantage.operators.contracts import contract_active
from vantage.operators.staging import stg_contracts, stg_csm_reps
from vantage.operators.usage import usage_days
from vantage.plans.marts import account_mart, csm_mart
from vantage.sources.io import remove_partitions, write_mart, write_months


def affected_snapshots(changed_from: dt.date, cfg: MetricConfig) -> list[dt.date]:
    """Snapshots whose trailing windows can see data dated >= changed_from
    (every later snapshot: the contract-to-date sum has no fixed look-back)."""
    out, d = [], cfg.snapshot_start
    while d <= cfg.snapshot_end:
        end = (dt.date(d.year + (d.month == 12), d.month % 12 + 1, 1) - dt.timedelta(days=1))
        if end >= changed_from:
            out.append(end)
        d = end + dt.timedelta(days=1)
    return out


def refresh(frames: dict[str, DataFrame], cfg: MetricConfig, account_path: str, csm_path: str,
            snapshots: list[dt.date]) -> None:
    """Rebuild the named snapshots in both written marts.

    The calendar is narrowed to the named snapshots and the one before (the
    ticket trend looks back by one). Accounts that have vanished from a snapshot
    vanish from its partition, and a snapshot without any row loses it. The rep
    mart is built from the account mart as written."""
    spark = frames["accounts"].sparkSession
    before = min(snapshots).replace(day=1) - dt.timedelta(days=1)
    narrow = cfg.with_(snapshot_start=max(before, cfg.snapshot_start), snapshot_end=max(snapshots))
    keep = F.col("snapshot_date").isin([F.lit(s) for s in snapshots])
    new = account_mart(frames, narrow).where(keep)
    write_mart(new, account_path)
    # a partition that got no row was left alone by the overwrite
    left = {r[0] for r in new.select("snapshot_date").distinct().collect()}
    remove_partitions(spark, account_path, "snapshot_date", [s for s in snapshots if s not in left])
    mart = spark.read.schema(new.schema).parquet(account_path).where(keep)
    write_mart(csm_mart(mart, stg_csm_reps(frames["csm_reps"]), narrow).where(keep), csm_path)


def reached_snapshots(contracts: DataFrame, months: list[dt.date], cfg: MetricConfig) -> list[dt.date]:
    """Snapshots on which usage of one of the months (their first days) counts: from the month on, as long as some
    account's active contract had begun when the month ended. At most the calendar's length."""
    active = contract_active(stg_contracts(contracts), cfg)
    touched = F.lit(False)
    for m in months:
        touched = touched | ((F.col("snapshot_date") >= lit_date(m)) & (F.col("start_date") <= F.last_day(lit_date(m))))
    return sorted(r[0] for r in active.where(touched).select("snapshot_date").distinct().collect())


def write_usage_state(usage: DataFrame, path: str) -> None:
    """The moments of all logs by account and day, partitioned by month."""
    write_months(usage_days(usage), path, "date")


def refresh_months(frames: dict[str, DataFrame], cfg: MetricConfig, months: list[dt.date], state_path: str,
                   account_path: str, csm_path: str) -> list[dt.date]:
    """Bring the state and both marts up to date after logs of `months` (first days) were added, changed or deleted;
    returns the snapshots that were rewritten. The result equals a full rebuild from the same frames."""
    spark = frames["accounts"].sparkSession
    changed = F.trunc("date", "month").isin([lit_date(m) for m in months])
    # the filter by range reaches the scan of the logs
    lo, hi = min(months), max(months)
    logs = frames["daily_usage_logs"].where(F.col("date").between(lit_date(lo), F.last_day(lit_date(hi)))).where(changed)
    fresh = usage_days(logs)
    write_months(fresh, state_path, "date", only_given=True)
    left = {r[0] for r in fresh.select(F.trunc("date", "month")).distinct().collect()}
    remove_partitions(spark, state_path, "month", [m for m in months if m not in left])
    snapshots = reached_snapshots(frames["contracts"], months, cfg)
    if snapshots:
        state = spark.read.schema(fresh.schema).parquet(state_path)
        refresh({**frames, "usage_days": state}, cfg, account_path, csm_path, snapshots)
    return snapshots
