"""Named queries: (spark, sf_dir) -> DataFrame, one per operator / report.

Every query reads the driver tables under `sf_dir` (through the adapters) and
runs over whole tables; report parameters (dates, filters) are fixed values of
the run configuration.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vantage.config import MetricConfig
from vantage.operators import calendar as cal
from vantage.operators import contracts as con
from vantage.operators import health as hl
from vantage.operators import staging as stg
from vantage.operators import tickets as tk
from vantage.operators import usage as us
from vantage.plans import marts
from vantage.sources.adapters import load_inputs

CFG = MetricConfig()
DRIVER_TABLES = ("region", "nation", "customer", "orders", "lineitem")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def inputs(spark: SparkSession, root: str, cfg: MetricConfig = CFG) -> dict[str, DataFrame]:
    """The six inputs, each built when it is asked for; health and the facts by account and day are stored tables."""
    return load_inputs(spark, root, cfg, health=lambda: stored_health(spark, root, CFG),
                       stored=lambda name: stored_model(spark, root, name))


def account_mart_df(spark, root, cfg=CFG):
    return marts.account_mart(inputs(spark, root, cfg), cfg)


def marts_df(spark, root, cfg=CFG):
    return marts.build_marts(inputs(spark, root, cfg), cfg)


_READY: dict[str, StructType] = {}    # schemas of complete tables: reading them again needs no look at their files


def _code() -> str:
    """A digest of the library's own modules: tables made by other code are not read."""
    top = Path(__file__).resolve().parent.parent
    files = [f for d in ("", "functions", "operators", "plans", "sources") for f in sorted((top / d).glob("*.py"))]
    return hashlib.sha1(b"".join(f.read_bytes() for f in files)).hexdigest()


_CODE = _code()


def store(spark: SparkSession, root: str, cfg: MetricConfig = CFG) -> str:
    """Folder of the tables derived from `root`: below the session's shared
    checkpoint folder, named by the library's code, the configuration and name,
    size and time of every input file (as its own store reports them), so a
    changed input never meets old tables. Files that can't be listed are an error."""
    from vantage.session import ensure_checkpoint_dir
    from vantage.sources.io import file_state
    state = file_state(spark, [f"{root}/{t}.parquet" for t in DRIVER_TABLES])
    key = hashlib.sha1(repr((state, cfg, _CODE)).encode()).hexdigest()[:16]
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/vantage-marts/{key}"


def _stored(spark: SparkSession, path: str, build) -> DataFrame:
    """The table at `path`, written by `build` unless a complete one is there."""
    from vantage.sources.io import path_exists
    if path not in _READY:
        if not path_exists(spark, path + "/_SUCCESS"):
            build(path)
        _READY[path] = spark.read.parquet(path).schema
    return spark.read.schema(_READY[path]).parquet(path)


def stored_health(spark: SparkSession, root: str, cfg: MetricConfig = CFG) -> DataFrame:
    """The weekly health records (M-19) as a written table: marts and reports read it instead of deriving it again."""
    return _stored(spark, store(spark, root, cfg) + "/account_health",
                   lambda p: load_inputs(spark, root, cfg)["account_health"].write.mode("overwrite").parquet(p))


def _models(spark: SparkSession, root: str, cfg: MetricConfig) -> dict[str, Callable[[], DataFrame]]:
    """The tables between the inputs and the marts, each from those before it."""
    raw, have = load_inputs(spark, root, cfg), inputs(spark, root, cfg)
    model = lambda name: stored_model(spark, root, name, cfg)
    return {
        "usage_days": lambda: raw["usage_days"],
        "ticket_days": lambda: raw["ticket_days"],
        "contract_active": lambda: con.contract_active(stg.stg_contracts(have["contracts"]), cfg),
        "log_windows": lambda: con.log_windows(have["daily_usage_logs"], have["accounts"], have["contracts"], have["usage_days"]),
        "snapshot_usage": lambda: us.snapshot_usage(model("contract_active"), have["daily_usage_logs"], have["accounts"], cfg,
                                                    have["usage_days"], have["contracts"]),
        "snapshot_tickets": lambda: tk.snapshot_tickets(have["support_tickets"], model("contract_active"), cfg),
        "snapshot_health": lambda: hl.snapshot_health(stg.stg_account_health(have["account_health"]), cfg)}


def stored_model(spark: SparkSession, root: str, name: str, cfg: MetricConfig = CFG) -> DataFrame:
    """An intermediate model or a reduced fact as a written table, keyed like the marts. (Ids of logs are all
    different: no dictionary is tried for them.)"""
    return _stored(spark, f"{store(spark, root, cfg)}/models/{name}", lambda p: _models(spark, root, cfg)[name]().write.mode(
        "overwrite").option("parquet.enable.dictionary#log_id", "false").parquet(p))


def stored_table(spark: SparkSession, root: str, name: str, build, cfg: MetricConfig = CFG) -> DataFrame:
    """A table derived from the marts, written beside them."""
    return _stored(spark, f"{store(spark, root, cfg)}/{name}", lambda p: build().write.mode("overwrite").parquet(p))


def stored_results(spark: SparkSession, root: str, suite: str, rules: str, build) -> DataFrame:
    """Check results as a written table (S-12), keyed like the marts and by the rules they hold for."""
    key = hashlib.sha1(rules.encode()).hexdigest()[:12]
    return _stored(spark, f"{store(spark, root)}/results/{suite}-{key}", build)


def materialized_marts(spark: SparkSession, root: str, cfg: MetricConfig = CFG):
    """Both marts as written tables (as in the source project), each built once
    for each state of the input: the account mart from the written models, which
    the checks read as well, the rep mart from the account mart."""
    from vantage.sources.io import write_mart
    base = store(spark, root, cfg)

    def mart():
        have = inputs(spark, root, cfg)
        return marts.account_mart(have, cfg, marts.stages(have, cfg, lambda name: stored_model(spark, root, name, cfg)))

    am = _stored(spark, base + "/account_mart",
                 lambda p: write_mart(mart(), p, only_given=False))
    reps = stg.stg_csm_reps(load_inputs(spark, root, cfg)["csm_reps"])
    cm = _stored(spark, base + "/csm_mart", lambda p: write_mart(marts.csm_mart(am, reps, cfg), p, only_given=False))
    return am, cm


# ---- staging / calendar -------------------------------------------------

@query("stg_contracts")
def q_stg_contracts(spark, root):
    return stg.stg_contracts(inputs(spark, root)["contracts"])


@query("stg_tickets")
def q_stg_tickets(spark, root):
    return stg.stg_support_tickets(inputs(spark, root)["support_tickets"])


@query("snapshot_dates")
def q_snapshot_dates(spark, root):
    return cal.snapshot_dates_of(inputs(spark, root)["contracts"])


# ---- joins --------------------------------------------------------------

@query("contract_active")
def q_contract_active(spark, root):
    return con.contract_active(stg.stg_contracts(inputs(spark, root)["contracts"]), CFG)


@query("usage_in_contract")
def q_usage_in_contract(spark, root):
    f = inputs(spark, root)
    return con.usage_in_contract(f["daily_usage_logs"], f["accounts"], f["contracts"])


@query("orphan_usage")
def q_orphan_usage(spark, root):
    f = inputs(spark, root)
    return con.orphan_usage(f["daily_usage_logs"], f["accounts"], days=f["usage_days"])


@query("out_of_window_usage")
def q_out_of_window_usage(spark, root):
    f = inputs(spark, root)
    return con.out_of_window_usage(f["daily_usage_logs"], f["accounts"], f["contracts"])


@query("overlapping_contracts")
def q_overlapping_contracts(spark, root):
    return con.overlapping_contracts(stg.stg_contracts(inputs(spark, root)["contracts"]))


@query("contract_timeline_clip")
def q_contract_timeline_clip(spark, root):
    return con.contract_timeline_clip(inputs(spark, root)["contracts"])


# ---- signals ------------------------------------------------------------

@query("snapshot_usage")
def q_snapshot_usage(spark, root):
    f = inputs(spark, root)
    active = con.contract_active(stg.stg_contracts(f["contracts"]), CFG)
    return us.snapshot_usage(active, f["daily_usage_logs"], f["accounts"], CFG, f["usage_days"], f["contracts"])


@query("snapshot_tickets")
def q_snapshot_tickets(spark, root):
    f = inputs(spark, root)
    active = con.contract_active(stg.stg_contracts(f["contracts"]), CFG)
    return tk.snapshot_tickets(f["support_tickets"], active, CFG)


@query("derive_health")
def q_derive_health(spark, root):
    return load_inputs(spark, root, CFG)["account_health"]


@query("snapshot_health")
def q_snapshot_health(spark, root):
    return hl.snapshot_health(stg.stg_account_health(inputs(spark, root)["account_health"]), CFG)


# ---- marts --------------------------------------------------------------

@query("account_mart")
def q_account_mart(spark, root):
    return account_mart_df(spark, root)


@query("csm_mart")
def q_csm_mart(spark, root):
    return marts_df(spark, root)[1]


def register_more() -> None:
    """Import modules that add queries (reports, quality)."""
    from vantage.plans import reports, quality  # noqa: F401


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    register_more()
    return dict(QUERIES)


__all__ = ["QUERIES", "query", "all_queries", "inputs", "F"]
