"""Staging projections (renames and one-line derivations)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.functions.dates import days_between

OPEN_STATUSES = ("Open", "In Progress")


def stg_csm_reps(df: DataFrame) -> DataFrame:
    return df.select("csm_id", F.col("name").alias("csm_name"), "region",
                     F.col("segment").alias("csm_segment"), "hire_date")


def stg_accounts(df: DataFrame) -> DataFrame:
    return df.select("account_id", "company_name", "industry", "rep_id",
                     F.col("segment").alias("account_segment"), "signup_date")


def stg_contracts(df: DataFrame) -> DataFrame:
    return df.select("contract_id", "account_id", "start_date", "end_date",
                     (days_between(F.col("end_date"), F.col("start_date")) + 1).alias("contract_days"),
                     "annual_commit_dollars", "included_monthly_compute_credits", "contract_type")


def stg_daily_usage_logs(df: DataFrame) -> DataFrame:
    # deliberately unfiltered: orphan / out-of-window rows stay visible to checks
    return df.select("log_id", "account_id", "date", "compute_credits_consumed")


def stg_support_tickets(df: DataFrame) -> DataFrame:
    return df.select("ticket_id", "account_id", "opened_date", "closed_date", "severity",
                     "product_area", "status",
                     F.col("status").isin(*OPEN_STATUSES).alias("is_open"))


def stg_account_health(df: DataFrame) -> DataFrame:
    return df.select("account_id", "date", "health_color",
                     F.col("compute_credits_consumed").alias("weekly_credits_consumed"))
