"""Map the driver's TPC-H-style tables onto the six raw inputs of the metric.

The generated test data has no accounts or contracts, so they are derived
deterministically: every customer, order and line item is read, and supplier k
and customer k are one company (there are fewer suppliers, so most accounts
have no usage and no tickets).  The
same derivation exists as SQL in ``vantage.plans.oracle`` for the DuckDB
oracle.  Account health is not derived here: it is an operator
(``vantage.operators.health.derive_health``) applied to the other inputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.config import MetricConfig

# Fixed values of the mapping (see FIXTURES.md section 2).
ENTERPRISE_ACCTBAL = 6000.0
CREDIT_PRICE_DIVISOR = 1300.0
CONTRACT_LENGTH_DAYS = 365
CONTRACT_TYPES = {"F": "New", "O": "Renewal", "P": "Expansion"}
OPEN_TICKET_DISCOUNT = 0.095
SEV1_TAX_BELOW = 0.005
SEV2_TAX_BELOW = 0.015


def _read(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def csm_reps(spark: SparkSession, root: str) -> DataFrame:
    n = _read(spark, root, "nation")
    r = _read(spark, root, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey)
            .select(F.col("n_nationkey").cast("bigint").alias("csm_id"),
                    F.col("n_name").alias("name"),
                    F.col("r_name").alias("region"),
                    F.when(F.col("n_regionkey") < 2, "Enterprise")
                     .otherwise("Mid-Market").alias("segment"),
                    F.date_add(F.lit("1995-01-01").cast("date"),
                               F.col("n_nationkey").cast("int")).alias("hire_date")))


def accounts(spark: SparkSession, root: str) -> DataFrame:
    """Every customer is an account."""
    return _read(spark, root, "customer").select(
        F.col("c_custkey").alias("account_id"),
        F.col("c_name").alias("company_name"),
        F.col("c_mktsegment").alias("industry"),
        F.col("c_nationkey").cast("bigint").alias("rep_id"),
        F.when(F.col("c_acctbal") >= ENTERPRISE_ACCTBAL, "Enterprise")
         .otherwise("Mid-Market").alias("segment"),
        F.date_add(F.lit("1994-01-01").cast("date"),
                   (F.col("c_custkey") % 365).cast("int")).alias("signup_date"))


def contracts(spark: SparkSession, root: str) -> DataFrame:
    """Every order is a contract of its customer."""
    o = _read(spark, root, "orders")
    start = F.col("o_orderdate").cast("date")
    ctype = F.when(F.col("o_orderstatus") == "F", CONTRACT_TYPES["F"])
    ctype = ctype.when(F.col("o_orderstatus") == "O", CONTRACT_TYPES["O"])
    ctype = ctype.when(F.col("o_orderstatus") == "P", CONTRACT_TYPES["P"])
    return (o.select(F.col("o_orderkey").alias("contract_id"),
                    F.col("o_custkey").alias("account_id"),
                    start.alias("start_date"),
                    F.date_add(start, CONTRACT_LENGTH_DAYS).alias("end_date"),
                    F.floor("o_totalprice").cast("bigint").alias("annual_commit_dollars"),
                    F.floor(F.col("o_totalprice") / CREDIT_PRICE_DIVISOR).cast("bigint")
                     .alias("included_monthly_compute_credits"),
                    ctype.alias("contract_type")))


def _line_id() -> F.Column:
    return F.concat_ws("-", *[F.col(c).cast("string") for c in
                              ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
                       F.col("l_shipdate").cast("date").cast("string"))


def daily_usage_logs(spark: SparkSession, root: str) -> DataFrame:
    """Every line item is a usage log of the account with its supplier's key."""
    li = _read(spark, root, "lineitem")
    return (li.select(_line_id().alias("log_id"),
                    F.col("l_suppkey").alias("account_id"),
                    F.col("l_shipdate").cast("date").alias("date"),
                    F.floor("l_quantity").cast("bigint").alias("compute_credits_consumed")))


def support_tickets(spark: SparkSession, root: str) -> DataFrame:
    """Every line item is also a ticket of that account."""
    li = _read(spark, root, "lineitem")
    opened = F.col("l_shipdate").cast("date")
    still_open = (F.col("l_discount") >= OPEN_TICKET_DISCOUNT) & (F.col("l_orderkey") % 8 == 0)
    even = F.col("l_linenumber") % 2 == 0
    return li.select(
        _line_id().alias("ticket_id"),
        F.col("l_suppkey").alias("account_id"),
        opened.alias("opened_date"),
        F.when(still_open, F.lit(None).cast("date"))
         .otherwise(F.date_add(opened, F.floor("l_quantity").cast("int"))).alias("closed_date"),
        F.when(F.col("l_tax") < SEV1_TAX_BELOW, 1).when(F.col("l_tax") < SEV2_TAX_BELOW, 2)
         .otherwise(3).cast("bigint").alias("severity"),
        F.concat(F.lit("Area-"), F.col("l_linenumber").cast("string")).alias("product_area"),
        F.when(still_open, F.when(even, "Open").otherwise("In Progress"))
         .otherwise(F.when(even, "Resolved").otherwise("Closed")).alias("status"))


class Inputs(dict):
    """Frames by table name; each is built when it is first asked for."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        super().__init__()
        self.builders = builders

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self.builders[name]()
        return self[name]

    def all(self) -> dict[str, DataFrame]:
        return {name: self[name] for name in self.builders}


def load_inputs(spark: SparkSession, root: str, cfg: MetricConfig | None = None,
                health: Callable[[], DataFrame] | None = None,
                stored: Callable[[str], DataFrame] | None = None) -> Inputs:
    """The six raw inputs (S-7 source declarations) derived from `root`, and the two
    facts reduced to account and day. `health` gives the health records and
    `stored` the reductions from elsewhere (stored tables)."""
    from vantage.operators.health import derive_health
    from vantage.operators.tickets import ticket_days
    from vantage.operators.usage import usage_days

    cfg = cfg or MetricConfig()
    builders = {table.__name__: lambda table=table: table(spark, root) for table in
                (csm_reps, accounts, contracts, daily_usage_logs, support_tickets)}
    out = Inputs(builders)
    builders["account_health"] = health or (lambda: derive_health(
        out["contracts"], out["daily_usage_logs"], out["support_tickets"], cfg))
    reductions = {"usage_days": lambda: usage_days(out["daily_usage_logs"]),
                  "ticket_days": lambda: ticket_days(out["support_tickets"])}
    builders |= {k: (lambda k=k: stored(k)) if stored else build for k, build in reductions.items()}
    return out
