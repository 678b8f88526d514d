"""Explicit schemas of the six raw inputs (S-2).  `nullable=False` documents
the REQUIRED contract; file readers do not enforce it, so the not-null checks
in `vantage.plans.quality` do."""

from __future__ import annotations

from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


S, D, L = StringType(), DateType(), LongType()

SCHEMAS: dict[str, StructType] = {
    "csm_reps": _s(("csm_id", S, False), ("name", S, False), ("region", S, False),
                   ("segment", S, False), ("hire_date", D, False)),
    "accounts": _s(("account_id", S, False), ("company_name", S, False), ("industry", S, False),
                   ("rep_id", S, False), ("segment", S, False), ("signup_date", D, False)),
    "contracts": _s(("contract_id", S, False), ("account_id", S, False), ("start_date", D, False),
                    ("end_date", D, False), ("annual_commit_dollars", L, False),
                    ("included_monthly_compute_credits", L, False), ("contract_type", S, False)),
    "support_tickets": _s(("ticket_id", S, False), ("account_id", S, False),
                          ("opened_date", D, False), ("closed_date", D, True),
                          ("severity", L, False), ("product_area", S, False), ("status", S, False)),
    "account_health": _s(("account_id", S, False), ("date", D, False), ("health_color", S, False),
                         ("compute_credits_consumed", L, False)),
    "daily_usage_logs": _s(("log_id", S, False), ("account_id", S, False), ("date", D, False),
                           ("compute_credits_consumed", L, False)),
}
