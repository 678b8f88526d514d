"""Data-quality operators (G-*, Q-*) returning results DataFrames.

Checks are declared as data (table, test, column, arguments, severity) and
settled together by one ledger: every table is read once and counted by the
key it refers to, and puts down a row (check, key) for each rule with failing
values and each key; parents put down the keys they have.  One aggregation by
(check, key) then tells failures and references without a parent, so no fact row
meets a parent table and a hot key is one row for each task.  Unique keys are
counted by a 64-bit hash, and only those whose hash is repeated by themselves.  The few singular assertions that compare totals or intervals
are frames whose row count is the failure count.  Every check reports one row;
nothing is collected to the driver.
"""

from __future__ import annotations

import functools
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vantage.config import MetricConfig
from vantage.functions.dates import lit_date
from vantage.operators import contracts as con
from vantage.operators import staging as stg
from vantage.functions import scoring as S
from vantage.operators.tickets import ticket_days_of
from vantage.operators.usage import days_of
from vantage.plans import marts
from vantage.plans.registry import CFG, inputs, materialized_marts, query, stored_model, stored_results
from vantage.session import ensure_checkpoint_dir


@dataclass(frozen=True)
class Check:
    table: str
    test: str                 # unique | not_null | accepted_values | relationships | expression
    columns: tuple
    # accepted values | (parent table, parent column[, "nulls fail"]) | (SQL or column expression that holds,)
    args: tuple = ()
    severity: str = "error"
    name: str = ""            # of a singular assertion

    @property
    def check_id(self) -> str:
        return self.name or f"{self.test}:{self.table}.{'+'.join(self.columns)}"


# The declared generic tests of the source project.
REGIONS = ("AMER", "EMEA", "APAC", "JAPAC")
SEGMENTS = ("Enterprise", "Mid-Market")
SOURCE_SEGMENTS = ("Enterprise", "Mid-Market", "SMB")
CONTRACT_TYPES = ("New", "Renewal", "Expansion")
SEVERITIES = (1, 2, 3)
STATUSES = ("Open", "In Progress", "Resolved", "Closed")
COLORS = ("Green", "Yellow", "Red")
BANDS = ("Green", "Yellow", "Red", "Onboarding")

GENERIC_CHECKS: tuple[Check, ...] = (
    # raw inputs
    Check("csm_reps", "unique", ("csm_id",)),
    Check("csm_reps", "not_null", ("csm_id",)),
    Check("csm_reps", "not_null", ("region",)),
    Check("csm_reps", "accepted_values", ("region",), REGIONS),
    Check("accounts", "unique", ("account_id",)),
    Check("accounts", "not_null", ("account_id",)),
    Check("accounts", "not_null", ("rep_id",)),
    Check("accounts", "relationships", ("rep_id",), ("csm_reps", "csm_id")),
    Check("accounts", "accepted_values", ("segment",), SOURCE_SEGMENTS),
    Check("contracts", "unique", ("contract_id",)),
    Check("contracts", "not_null", ("contract_id",)),
    Check("contracts", "not_null", ("account_id",)),
    Check("contracts", "relationships", ("account_id",), ("accounts", "account_id")),
    Check("contracts", "accepted_values", ("contract_type",), CONTRACT_TYPES),
    Check("contracts", "not_null", ("annual_commit_dollars",)),
    Check("daily_usage_logs", "not_null", ("date",)),
    Check("support_tickets", "unique", ("ticket_id",)),
    Check("support_tickets", "not_null", ("ticket_id",)),
    Check("support_tickets", "accepted_values", ("severity",), SEVERITIES),
    Check("account_health", "not_null", ("date",)),
    Check("account_health", "not_null", ("account_id",)),
    Check("account_health", "relationships", ("account_id",), ("accounts", "account_id")),
    Check("account_health", "accepted_values", ("health_color",), COLORS),
    # staging
    Check("stg_csm_reps", "unique", ("csm_id",)),
    Check("stg_csm_reps", "not_null", ("csm_id",)),
    Check("stg_csm_reps", "not_null", ("region",)),
    Check("stg_csm_reps", "accepted_values", ("region",), REGIONS),
    Check("stg_csm_reps", "accepted_values", ("csm_segment",), SEGMENTS),
    Check("stg_accounts", "unique", ("account_id",)),
    Check("stg_accounts", "not_null", ("account_id",)),
    Check("stg_accounts", "not_null", ("rep_id",)),
    Check("stg_accounts", "relationships", ("rep_id",), ("stg_csm_reps", "csm_id")),
    Check("stg_accounts", "accepted_values", ("account_segment",), SEGMENTS),
    Check("stg_contracts", "unique", ("contract_id",)),
    Check("stg_contracts", "not_null", ("contract_id",)),
    Check("stg_contracts", "not_null", ("account_id",)),
    Check("stg_contracts", "relationships", ("account_id",), ("stg_accounts", "account_id")),
    Check("stg_contracts", "accepted_values", ("contract_type",), CONTRACT_TYPES),
    Check("stg_daily_usage_logs", "unique", ("log_id",)),
    Check("stg_daily_usage_logs", "not_null", ("log_id",)),
    Check("stg_daily_usage_logs", "not_null", ("date",)),
    Check("stg_support_tickets", "unique", ("ticket_id",)),
    Check("stg_support_tickets", "not_null", ("ticket_id",)),
    Check("stg_support_tickets", "not_null", ("account_id",)),
    Check("stg_support_tickets", "relationships", ("account_id",), ("stg_accounts", "account_id")),
    Check("stg_support_tickets", "not_null", ("severity",)),
    Check("stg_support_tickets", "accepted_values", ("severity",), SEVERITIES),
    Check("stg_support_tickets", "accepted_values", ("status",), STATUSES),
    Check("stg_account_health", "not_null", ("account_id",)),
    Check("stg_account_health", "relationships", ("account_id",), ("stg_accounts", "account_id")),
    Check("stg_account_health", "not_null", ("date",)),
    Check("stg_account_health", "accepted_values", ("health_color",), COLORS),
    # intermediate models
    Check("snapshot_dates", "unique", ("snapshot_date",)),
    Check("snapshot_dates", "not_null", ("snapshot_date",)),
    Check("contract_active", "unique", ("snapshot_date", "account_id")),
    Check("contract_active", "not_null", ("snapshot_date",)),
    Check("contract_active", "not_null", ("account_id",)),
    Check("contract_active", "not_null", ("contract_id",)),
    Check("usage_windows", "unique", ("log_id",)),
    Check("usage_windows", "not_null", ("log_id",)),
    Check("snapshot_usage", "not_null", ("snapshot_date",)),
    Check("snapshot_usage", "not_null", ("account_id",)),
    Check("snapshot_tickets", "not_null", ("snapshot_date",)),
    Check("snapshot_tickets", "not_null", ("account_id",)),
    Check("snapshot_tickets", "not_null", ("open_sev1",)),
    Check("snapshot_tickets", "expression", ("open_sev1",), ("open_sev1 >= 0",)),
    Check("snapshot_tickets", "not_null", ("open_sev2",)),
    Check("snapshot_tickets", "expression", ("open_sev2",), ("open_sev2 >= 0",)),
    Check("snapshot_tickets", "not_null", ("open_sev3",)),
    Check("snapshot_tickets", "expression", ("open_sev3",), ("open_sev3 >= 0",)),
    Check("snapshot_tickets", "not_null", ("age_weighted_load",)),
    Check("snapshot_tickets", "expression", ("age_weighted_load",), ("age_weighted_load >= 0",)),
    Check("snapshot_health", "not_null", ("snapshot_date",)),
    Check("snapshot_health", "not_null", ("account_id",)),
    Check("snapshot_health", "accepted_values", ("latest_color",), COLORS),
    # marts
    Check("account_mart", "unique", ("snapshot_date", "account_id")),
    Check("account_mart", "not_null", ("snapshot_date",)),
    Check("account_mart", "not_null", ("account_id",)),
    Check("account_mart", "not_null", ("rep_id",)),
    Check("account_mart", "relationships", ("rep_id",), ("stg_csm_reps", "csm_id")),
    Check("account_mart", "not_null", ("band",)),
    Check("account_mart", "accepted_values", ("band",), BANDS),
    Check("account_mart", "not_null", ("is_ramp_period",)),
    Check("account_mart", "not_null", ("expansion_flag",)),
    Check("account_mart", "not_null", ("d_score",)),
    Check("account_mart", "not_null", ("c_score",)),
    Check("account_mart", "not_null", ("t_score",)),
    Check("account_mart", "not_null", ("r_score",)),
    Check("account_mart", "not_null", ("b_score",)),
    Check("csm_mart", "unique", ("snapshot_date", "csm_id")),
    Check("csm_mart", "not_null", ("snapshot_date",)),
    Check("csm_mart", "not_null", ("csm_id",)),
    Check("csm_mart", "relationships", ("csm_id",), ("stg_csm_reps", "csm_id")),
    Check("csm_mart", "not_null", ("n_accounts",)),
    Check("csm_mart", "not_null", ("book_arr",)),
)


#: Staging tables that hold every row of a raw table: checks on columns that both have are settled in one pass.
SAME_ROWS = {"accounts": "stg_accounts", "contracts": "stg_contracts", "daily_usage_logs": "stg_daily_usage_logs",
             "support_tickets": "stg_support_tickets", "account_health": "stg_account_health"}


def _fails(c: Check) -> F.Column:
    col = F.col(c.columns[0])
    if c.test == "not_null":
        return col.isNull()
    if c.test == "accepted_values":
        return col.isNotNull() & ~col.isin(list(c.args))
    if c.test == "expression":
        holds = F.expr(c.args[0]) if isinstance(c.args[0], str) else c.args[0]
        return ~F.coalesce(holds, F.lit(True))
    raise ValueError(c.test)


def _key(columns: tuple) -> F.Column:
    """The columns as one string; a NULL in a combination is a value like others."""
    if len(columns) == 1:
        return F.col(columns[0]).cast("string")
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.concat_ws("\u0001", *parts)


LEDGER = ["check_no", "key", "weight", "parent"]


def settle(rows: DataFrame) -> DataFrame:
    """check_no, n_rows, n_repeated (keys put down more than once), n_missing (rows whose key no parent has), from
    ledger rows (check_no, key, weight, parent)."""
    keys = rows.groupBy("check_no", "key").agg(F.sum("weight").alias("n"), F.bool_or("parent").alias("known"))
    return keys.groupBy("check_no").agg(F.sum("n").alias("n_rows"), F.count_if(F.col("n") > 1).alias("n_repeated"),
                                        F.sum(F.when(F.col("known"), 0).otherwise(F.col("n"))).alias("n_missing"))


def _same_rows(table: str, columns, tables: dict[str, DataFrame]) -> str:
    """The staging table with the rows of `table`, if it is there and has the columns."""
    staged = SAME_ROWS.get(table, table)
    return staged if staged in tables and not set(columns) - set(tables[staged].columns) else table


def _distinct_checks(tables: dict[str, DataFrame], checks) -> tuple[list[Check], list[int]]:
    """The checks that differ once staging tables stand for their raw tables, and the number there of each check:
    a rule that is declared for a raw and for a staging table of the same rows is settled once."""
    own, numbers = {}, []
    for c in checks:
        args = c.args
        if c.test == "relationships":
            args = (_same_rows(args[0], (args[1],), tables), *args[1:])
        table = _same_rows(c.table, c.columns, tables)
        key = (table, c.test, c.columns, repr(args))
        own.setdefault(key, (len(own), Check(table, c.test, c.columns, args)))
        numbers.append(own[key][0])
    return [c for _, c in own.values()], numbers


def _stacked(tables: dict[str, DataFrame], passes: dict[str, list[list[F.Column]]], names: list[str]) -> DataFrame | None:
    """The rows that each table puts down, each table read once."""
    out = None
    for table, entries in passes.items():
        rows = tables[table].select(F.stack(F.lit(len(entries)), *[x for e in entries for x in e])
                                    .alias(*names)).where("check_no IS NOT NULL")
        out = rows if out is None else out.unionByName(rows)
    return out


def _ledger(tables: dict[str, DataFrame], checks) -> DataFrame | None:
    """Ledger rows of all checks but unique keys.

    A table's rows are counted in one aggregation by the key they refer to (all
    together if they refer to none), with a count for each check on rows; only
    those counts become ledger rows, so no row of a table is copied for each
    check and keys are made strings once for each that differs. A table that
    refers to several parents is read once for each."""
    rows: dict[str, list[int]] = {}
    refs: dict[str, list[int]] = {}
    parents: dict[str, list[list[F.Column]]] = {}
    entry = lambda no, key, weight, parent: [no, key, F.lit(weight).cast("bigint"), F.lit(parent)]
    for i, c in enumerate(checks):
        if c.test == "relationships":
            refs.setdefault(c.table, []).append(i)
            parent, column, *_ = c.args
            parents.setdefault(parent, []).append(
                entry(F.when(F.col(column).isNotNull(), i), F.col(column).cast("string"), 0, True))
        elif c.test != "unique":
            rows.setdefault(c.table, []).append(i)
    out = []
    for table in dict.fromkeys([*rows, *refs]):
        own = rows.get(table, [])
        by_key: dict[tuple, list[int]] = {}    # checks that refer by one column to columns of one type
        for i in refs.get(table, []):
            parent, column, *_ = checks[i].args
            by_key.setdefault((checks[i].columns[0], dict(tables[parent].dtypes)[column]), []).append(i)
        for k, (key, same) in enumerate((by_key or {None: []}).items()):
            tests = own if k == 0 else []
            counts = [F.count_if(_fails(checks[i])).alias(f"n{i}") for i in tests]
            entries = [entry(F.when(F.col(f"n{i}") > 0, i), F.lit(None).cast("string"), F.col(f"n{i}"), False) for i in tests]
            if key is None:
                found = tables[table].agg(*counts)
            else:
                column, kind = key
                found = tables[table].groupBy(F.col(column).cast(kind).alias("_key"), F.col(column).isNull().alias("_null")).agg(
                    F.count(F.lit(1)).alias("_n"), *counts)
                for i in same:
                    some = F.lit(True) if checks[i].args[2:] else ~F.col("_null")
                    entries.append(entry(F.when(some, i), F.col("_key").cast("string"), F.col("_n"), False))
            out.append(_stacked({table: found}, {table: entries}, LEDGER))
    if parents:
        out.append(_stacked(tables, parents, LEDGER))
    return functools.reduce(DataFrame.unionByName, out) if out else None


#: Bytes of input files for each task that counts hashes: it holds a million or so, which need no spilling.
HASHED_BYTES = 16 << 20


def _hash_tasks(rows: DataFrame) -> int:
    """How many tasks count the hashes of `rows`: more for larger files, at least as many as any shuffle has."""
    leaves = rows._jdf.queryExecution().optimizedPlan().collectLeaves()
    files = [x for x in map(leaves.apply, range(leaves.size())) if x.getClass().getSimpleName() == "LogicalRelation"]
    size = sum(int(str(x.stats().sizeInBytes())) for x in files)
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // HASHED_BYTES)


#: Hashes that may belong to repeated keys: so many go to every task, above that all keys are settled as they are.
FEW_HASHES = 100_000


def _repeated(tables: dict[str, DataFrame], checks) -> DataFrame | None:
    """settle()'s result for the unique checks (None: no key is repeated).

    Keys are nearly all different, so counting them by themselves sends and holds
    every one. 64-bit hashes of them are counted first: a key whose hash occurs
    once is not repeated. Only keys whose hash occurs more often are compared as
    they are, so the result is exact whatever the hash does. The hashes are dealt
    before they are counted: a task of the map side would hold one for each of its
    rows to no use, and tasks put together by bytes would hold too many, as a
    hash takes five times its bytes there."""
    hashes: dict[str, list[list[F.Column]]] = {}
    keys: dict[str, list[list[F.Column]]] = {}
    for i, c in enumerate(checks):
        if c.test == "unique":   # a NULL is no duplicate of another; a NULL in a combination is
            some = F.col(c.columns[0]).isNotNull() if len(c.columns) == 1 else F.lit(True)
            no, own = F.when(some, i), F.xxhash64(*[F.col(x) for x in c.columns])
            hashes.setdefault(c.table, []).append([no, own])
            keys.setdefault(c.table, []).append([no, own, _key(c.columns)])
    if not keys:
        return None
    dealt = _stacked(tables, hashes, ["check_no", "hash"])
    dealt = dealt.repartition(_hash_tasks(dealt), "check_no", "hash")
    twice = dealt.groupBy("check_no", "hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("check_no", "hash")
    twice = _written(twice)
    n = twice.count()
    if not n:
        return None
    rows = _stacked(tables, keys, ["check_no", "hash", "key"])
    if n <= FEW_HASHES:
        rows = rows.join(F.broadcast(twice), ["check_no", "hash"], "left_semi")
    return settle(rows.select("check_no", "key", F.lit(1).cast("bigint").alias("weight"), F.lit(False).alias("parent")))


def _written(df: DataFrame) -> DataFrame:
    """`df` as a table in the session's shared scratch folder."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/vantage-checks/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def run_checks(tables: dict[str, DataFrame], checks) -> DataFrame:
    """check_id, table_name, test, severity, n_failing of every check; one row for each, also without any ledger row."""
    own, numbers = _distinct_checks(tables, checks)
    ledger, found = _ledger(tables, own), _repeated(tables, own)
    if ledger is not None:
        found = settle(ledger) if found is None else settle(ledger).unionByName(found)
    spark = next(iter(tables.values())).sparkSession
    names = ("check_no", "check_id", "table_name", "test", "severity")
    listed = spark.range(1).select(F.inline(F.array(*[F.struct(*[F.lit(x).alias(n) for n, x in zip(names, (
        k, c.check_id, c.table, c.test, c.severity))]) for k, c in zip(numbers, checks)])))    # no Python worker for it
    if found is None:
        found = listed.select("check_no", *[F.lit(0).alias(c) for c in ("n_rows", "n_repeated", "n_missing")]).limit(0)
    n = F.when(F.col("test") == "unique", F.col("n_repeated")).when(
        F.col("test") == "relationships", F.col("n_missing")).otherwise(F.col("n_rows"))
    return listed.join(found, "check_no", "left").select(
        "check_id", "table_name", "test", "severity", F.coalesce(n, F.lit(0)).cast("bigint").alias("n_failing"))


def run_generic(tables: dict[str, DataFrame], checks=GENERIC_CHECKS) -> DataFrame:
    """One results row per check: check_id, table_name, test, severity,
    n_failing, status (PASS / WARN / FAIL)."""
    return with_status(run_checks(tables, checks))


def with_status(df: DataFrame) -> DataFrame:
    return df.withColumn("status", F.when(F.col("n_failing") == 0, "PASS")
                         .when(F.col("severity") == "warn", "WARN").otherwise("FAIL"))


def model_tables(frames: dict[str, DataFrame], cfg: MetricConfig,
                 built: tuple[DataFrame, DataFrame] | None = None, model=None) -> dict[str, DataFrame]:
    """Raw inputs, staging frames, intermediate models and both marts; `built` are written marts, `model` gives
    written models by name."""
    from vantage.operators.health import snapshot_health
    from vantage.operators.calendar import snapshot_dates
    from vantage.operators.tickets import snapshot_tickets
    from vantage.operators.usage import snapshot_usage
    st = marts.stages(frames, cfg)
    if built is None:
        am = marts.account_mart(frames, cfg, st)
        cm = marts.csm_mart(am, st.reps, cfg)
    else:
        am, cm = built
    # no check reads the tickets by day: they are not written for these
    t = {name: frames[name] for name in getattr(frames, "builders", frames) if name != "ticket_days"}
    t.update({
        "stg_csm_reps": st.reps, "stg_accounts": st.accounts, "stg_contracts": st.contracts,
        "stg_daily_usage_logs": stg.stg_daily_usage_logs(frames["daily_usage_logs"]),
        "stg_support_tickets": stg.stg_support_tickets(frames["support_tickets"]),
        "usage_days": st.days, "snapshot_dates": snapshot_dates(am.sparkSession, cfg),
        "stg_account_health": st.health, "account_mart": am, "csm_mart": cm})
    if model:    # the logs met their windows once, for this and the assertion on the others
        t["log_windows"] = model("log_windows")
    models = {
        "contract_active": lambda: st.active,
        "usage_windows": lambda: con.usage_in_contract(frames["daily_usage_logs"], frames["accounts"], frames["contracts"], st.days,
                                                       t.get("log_windows")),
        "snapshot_usage": lambda: snapshot_usage(st.active, frames["daily_usage_logs"], frames["accounts"], cfg, st.days),
        "snapshot_tickets": lambda: snapshot_tickets(st.tickets, st.active, cfg),
        "snapshot_health": lambda: snapshot_health(st.health, cfg)}
    t.update({name: model(name) if model and name != "usage_windows" else build() for name, build in models.items()})
    return t


def row_assertions(cfg: MetricConfig) -> tuple[Check, ...]:
    """Singular assertions on single rows and references: Q-1, 2, 3, 5, 6, 7, 8, 11, 12, 13 and two of Q-31."""
    avr, band, ramp = F.col("avr_score"), F.col("band"), F.col("is_ramp_period")
    scores = " AND ".join(f"coalesce({x}_score BETWEEN 0 AND 1, true)" for x in "dcrtb")
    by_score = S.band(avr, avr.isNull(), cfg)     # no score: Onboarding
    waiting = band == "Onboarding"
    within = lambda *cols: " AND ".join(f"coalesce({c} BETWEEN 0 AND 100, true)" for c in cols)
    one = lambda name, table, column, holds: Check(table, "expression", (column,), (holds,), name=name)
    return (
        one("avr_score_range", "account_mart", "avr_score", f"{within('avr_score')} AND {scores}"),
        one("band_matches_score", "account_mart", "band", (band == by_score) & (waiting == ramp)),
        one("contract_start_before_end", "stg_contracts", "start_date", "start_date < end_date"),
        one("csm_rollup_band_counts", "csm_mart", "n_accounts", "n_green + n_yellow + n_red = n_accounts"),
        one("csm_technical_health_range", "csm_mart", "avg_technical_health",
            within("avg_technical_health", "arr_weighted_technical_health")),
        one("negative_usage", "daily_usage_logs", "compute_credits_consumed", "compute_credits_consumed >= 0"),
        Check("daily_usage_logs", "relationships", ("account_id",), ("accounts", "account_id", "nulls fail"), "warn",
              "orphaned_usage"),
        one("ramp_accounts_have_null_avr", "account_mart", "avr_score", (ramp == avr.isNull()) & (ramp == waiting)),
        one("snapshot_dates_are_month_ends", "snapshot_dates", "snapshot_date", "snapshot_date = last_day(snapshot_date)"),
        one("ticket_closed_after_opened", "stg_support_tickets", "closed_date", "closed_date >= opened_date"),
        one("csm_weighted_avr_range", "csm_mart", "arr_weighted_avr", within("arr_weighted_avr")),
        Check("csm_mart", "relationships", ("csm_id",), ("stg_csm_reps", "csm_id", "nulls fail"), name="csm_exists"))


def total_assertions(t: dict[str, DataFrame]) -> DataFrame:
    """Singular assertions on totals and intervals (Q-4, Q-9, Q-10, one of Q-31): check_id, severity, n_failing."""
    am, cm = t["account_mart"], t["csm_mart"]
    scored = am.where(~F.col("is_ramp_period"))
    csm_side = cm.groupBy("snapshot_date").agg(F.sum("n_accounts").alias("csm_total"))
    acc_side = scored.groupBy("snapshot_date").agg(F.countDistinct("account_id").alias("account_total"))
    q4 = csm_side.join(acc_side, "snapshot_date").where(F.col("csm_total") != F.col("account_total"))
    book = scored.groupBy("snapshot_date", F.col("rep_id").alias("csm_id")).agg(F.sum("annual_commit_dollars").alias("arr"))
    q31 = (cm.join(book, ["snapshot_date", "csm_id"], "left")
           .where(F.col("book_arr") != F.coalesce(F.col("arr"), F.lit(0))))
    q9 = con.out_of_window_usage(t["daily_usage_logs"], t["accounts"], t["contracts"], t.get("usage_days"),
                                 t.get("log_windows"))
    count = lambda df: df.agg(F.count(F.lit(1)).alias("n_failing"))
    parts = {"csm_rollup_account_counts": count(q4), "csm_book_arr_matches": count(q31), "out_of_window_usage": count(q9),
             "overlapping_contracts_unexpected": con.count_overlapping_contracts(t["stg_contracts"])}
    out = None
    for name, n in parts.items():
        row = n.select(F.lit(name).alias("check_id"), F.lit("warn" if name == "out_of_window_usage" else "error").alias("severity"),
                       "n_failing")
        out = row if out is None else out.unionByName(row)
    return out


def singular_checks(t: dict[str, DataFrame], cfg: MetricConfig) -> DataFrame:
    """Q-1..Q-13 and Q-31: check_id, severity, n_failing, status of the 16 singular assertions."""
    rows = run_checks(t, row_assertions(cfg)).select("check_id", "severity", "n_failing")
    return with_status(rows.unionByName(total_assertions(t)))


def all_results(t: dict[str, DataFrame], cfg: MetricConfig, generic=GENERIC_CHECKS) -> DataFrame:
    """Results of the generic checks and the singular assertions from one pass over the tables: suite, check_id,
    table_name, test, severity, n_failing, status."""
    both = run_checks(t, (*generic, *row_assertions(cfg)))
    singular = [c.check_id for c in row_assertions(cfg)]
    rows = both.withColumn("suite", F.when(F.col("check_id").isin(singular), "singular").otherwise("generic"))
    return with_status(rows.unionByName(total_assertions(t).withColumn("suite", F.lit("singular")), allowMissingColumns=True))


# Pre-load QA bounds of the source project.
ROW_COUNT_BOUNDS = {"csm_reps": (50, 50), "accounts": (1000, 1000), "contracts": (1080, 1320),
                    "support_tickets": (22500, 37500), "account_health": (40000, 60000),
                    "daily_usage_logs": (160000, 240000)}
FK_CHECKS = (("RI-1", "accounts", "rep_id", "csm_reps", "csm_id", 1.0),
             ("RI-2", "contracts", "account_id", "accounts", "account_id", 1.0),
             ("RI-3", "support_tickets", "account_id", "accounts", "account_id", 1.0),
             ("RI-4", "account_health", "account_id", "accounts", "account_id", 1.0),
             ("RI-5", "daily_usage_logs", "account_id", "accounts", "account_id", 0.9985))


def _row_sources(frames: dict[str, DataFrame]) -> dict[str, tuple[DataFrame, str | None]]:
    """Table -> (frame with its key columns, column that counts its rows): the facts are read as reduced."""
    return {"accounts": (frames["accounts"], None), "contracts": (frames["contracts"], None),
            "csm_reps": (frames["csm_reps"], None), "account_health": (frames["account_health"], None),
            "support_tickets": (ticket_days_of(frames), "n_tickets"), "daily_usage_logs": (days_of(frames), "n_logs")}


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """G-8: row count per input table against [lo, hi] (S-10)."""
    sources, out = _row_sources(frames), None
    for name, (lo, hi) in ROW_COUNT_BOUNDS.items():
        df, weight = sources[name]
        n = F.coalesce(F.sum(weight), F.lit(0)) if weight else F.count(F.lit(1))
        row = df.agg(n.cast("bigint").alias("n_rows")).select(
            F.lit(f"COUNT-{name}").alias("check_id"), F.lit(name).alias("table_name"), "n_rows",
            F.lit(lo).cast("bigint").alias("lo"), F.lit(hi).cast("bigint").alias("hi"))
        out = row if out is None else out.unionByName(row)
    return out.withColumn("status", F.when(F.col("n_rows").between(F.col("lo"), F.col("hi")), "PASS")
                          .otherwise("FAIL"))


def fk_fractions(frames: dict[str, DataFrame]) -> DataFrame:
    """G-9 / Q-14: share of child rows whose key exists in the parent, from one
    ledger of weighted keys: no child row meets its parent, a hot key is one row."""
    sources, rows = _row_sources(frames), None
    for i, (_, child, ccol, parent, pcol, _) in enumerate(FK_CHECKS):
        df, weight = sources[child]
        kind = dict(frames[parent].dtypes)[pcol]
        one = df.select(F.lit(i).alias("check_no"), F.col(ccol).cast(kind).cast("string").alias("key"),
                        (F.col(weight) if weight else F.lit(1)).cast("bigint").alias("weight"), F.lit(False).alias("parent"))
        have = frames[parent].where(F.col(pcol).isNotNull()).select(
            F.lit(i).alias("check_no"), F.col(pcol).cast("string").alias("key"), F.lit(0).cast("bigint").alias("weight"),
            F.lit(True).alias("parent"))
        rows = one.unionByName(have) if rows is None else rows.unionByName(one).unionByName(have)
    spark = frames["accounts"].sparkSession
    listed = spark.createDataFrame([(i, c[0], c[5]) for i, c in enumerate(FK_CHECKS)], "check_no int, check_id string, min_frac double")
    valid = F.try_divide(F.col("n_rows") - F.col("n_missing"), F.col("n_rows"))
    return (listed.join(settle(rows), "check_no", "left").select("check_id", valid.alias("valid_frac"), "min_frac")
            .withColumn("status", F.when(F.col("valid_frac") >= F.col("min_frac"), "PASS").otherwise("FAIL")))


def segment_checks(frames: dict[str, DataFrame]) -> DataFrame:
    """Q-15 / Q-16: account vs rep segment agreement and Enterprise shares."""
    a, r = frames["accounts"], frames["csm_reps"]
    j = a.join(r.select("csm_id", F.col("segment").alias("csm_segment")),
               F.col("rep_id") == F.col("csm_id"))
    seg1 = j.agg(F.count_if(F.col("segment") != F.col("csm_segment")).cast("double").alias("actual"))
    share = lambda df: df.agg(F.avg((F.col("segment") == "Enterprise").cast("double")).alias("actual"))
    rows = [seg1.select(F.lit("SEG-1").alias("check_id"), "actual",
                        (F.col("actual") == 0).alias("ok")),
            share(a).select(F.lit("SEG-2").alias("check_id"), "actual",
                            F.col("actual").between(0.37, 0.43).alias("ok")),
            share(r).select(F.lit("SEG-3").alias("check_id"), "actual",
                            F.col("actual").between(0.35, 0.45).alias("ok"))]
    out = rows[0].unionByName(rows[1]).unionByName(rows[2])
    return out.select("check_id", "actual", F.when(F.col("ok"), "PASS").otherwise("FAIL").alias("status"))


# Target severity mix and New-contract commit ranges.
SEVERITY_TARGET = {1: 0.03, 2: 0.12, 3: 0.85}
COMMIT_RANGES = {"Enterprise": (200_000, 2_000_000), "Mid-Market": (25_000, 200_000)}


def distribution_checks(frames: dict[str, DataFrame], cfg: MetricConfig) -> DataFrame:
    """Q-24..Q-27: severity mix, New-contract commit ranges, colour domain,
    contract starts inside the run window."""
    sev, n = F.col("severity"), F.col("n_tickets")
    per = ticket_days_of(frames).agg(*[
        F.try_divide(F.sum(F.when(sev == k, n).otherwise(0)), F.sum(n)).alias(f"s{k}") for k in SEVERITY_TARGET])
    worst = F.greatest(*[F.abs(F.col(f"s{k}") - F.lit(v)) for k, v in SEVERITY_TARGET.items()])
    d1 = per.select(F.lit("DIST-1").alias("check_id"), worst.alias("actual"),
                    (worst <= 0.05).alias("ok"))
    newc = (frames["contracts"].where(F.col("contract_type") == "New")
            .join(frames["accounts"].select("account_id", "segment"), "account_id"))
    outs = [d1]
    for cid, seg in (("DIST-2", "Enterprise"), ("DIST-3", "Mid-Market")):
        lo, hi = COMMIT_RANGES[seg]
        c = newc.where(F.col("segment") == seg).agg(F.min("annual_commit_dollars").alias("mn"),
                                                    F.max("annual_commit_dollars").alias("mx"))
        outs.append(c.select(F.lit(cid).alias("check_id"), F.col("mn").cast("double").alias("actual"),
                             F.coalesce((F.col("mn") >= lo) & (F.col("mx") <= hi), F.lit(False)).alias("ok")))
    h = frames["account_health"]
    d4 = h.agg(F.count_if(~F.col("health_color").isin(*COLORS)).cast("double").alias("actual"))
    outs.append(d4.select(F.lit("DIST-4").alias("check_id"), "actual", (F.col("actual") == 0).alias("ok")))
    w0, w1 = lit_date(cfg.snapshot_start.replace(day=1)), lit_date(cfg.snapshot_end)
    d5 = frames["contracts"].agg(F.count_if(~F.col("start_date").between(w0, w1)).cast("double")
                                 .alias("actual"))
    outs.append(d5.select(F.lit("DIST-5").alias("check_id"), "actual", (F.col("actual") == 0).alias("ok")))
    out = outs[0]
    for p in outs[1:]:
        out = out.unionByName(p)
    return out.select("check_id", "actual", F.when(F.col("ok"), "PASS").otherwise("FAIL").alias("status"))


def monthly_vs_allotment(frames: dict[str, DataFrame]) -> DataFrame:
    """(account, month, allotment) usage totals, counting a log once per
    covering contract (as the source check does). Days and contracts meet by
    account and month, in a merge join: the size of the exploded contracts is
    not what Spark estimates."""
    u = days_of(frames).withColumn("ym", F.trunc("date", "month"))
    c = frames["contracts"].where(F.col("start_date") <= F.col("end_date")).select(
        "account_id", "start_date", "end_date", "included_monthly_compute_credits",
        F.explode(F.sequence(F.trunc("start_date", "month"), F.trunc("end_date", "month"), F.expr("INTERVAL 1 MONTH"))).alias("ym"))
    j = u.join(c.hint("merge"), ["account_id", "ym"]).where(F.col("date").between(F.col("start_date"), F.col("end_date")))
    return (j.groupBy("account_id", "ym", "included_monthly_compute_credits").agg(F.sum("sx").alias("credits")))


# Thresholds of the edge-case cohorts, and how many of each the source's data set must hold.
COHORT_RULES = {"spike_share": 0.85, "spike_days": 30, "overage": 1.20, "approach": 0.80, "months": 6}
EDGE_CASE_MINIMA = {"EC-1": 45, "EC-2": 90, "EC-3": 140, "EC-4": 25, "EC-5a": 150, "EC-5b": 75, "EC-6": 70}


def usage_cohorts(frames: dict[str, DataFrame], rules: dict = COHORT_RULES) -> DataFrame:
    """Edge-case cohort labels per contracted account (EC-1..EC-4, EC-6)."""
    ctr = frames["contracts"]
    usage = days_of(frames).withColumnRenamed("sx", "credits")
    accts = ctr.select("account_id").distinct()
    first = (ctr.groupBy("account_id").agg(F.min(F.struct("start_date", "contract_id")).alias("f"))
             .select("account_id", F.col("f.start_date").alias("first_start")))
    uw = usage.join(first, "account_id")
    off = F.datediff("date", "first_start")
    spike = (uw.groupBy("account_id")
             .agg(F.sum(F.when(off.between(0, rules["spike_days"] - 1), F.col("credits")).otherwise(0))
                  .alias("m1"), F.sum("credits").alias("tot"))
             .select("account_id", F.coalesce(F.try_divide("m1", "tot"), F.lit(0.0)) >= rules["spike_share"])
             .toDF("account_id", "is_spike_drop"))
    used = usage.select("account_id").distinct().withColumn("has_usage", F.lit(True))
    m = monthly_vs_allotment(frames)
    allot = F.col("included_monthly_compute_credits")
    months = m.groupBy("account_id").agg(
        F.count_if(F.col("credits") >= allot * rules["overage"]).alias("over_months"),
        F.count_if((F.col("credits") >= allot * rules["approach"]) & (F.col("credits") < allot * rules["overage"]))
         .alias("approach_months"))
    adj = con.adjacent_overlap_accounts(ctr).withColumn("has_adjacent_overlap", F.lit(True))
    out = (accts.join(spike, "account_id", "left").join(used, "account_id", "left")
           .join(months, "account_id", "left").join(adj, "account_id", "left"))
    return out.select(
        "account_id",
        F.coalesce("is_spike_drop", F.lit(False)).alias("is_spike_drop"),
        F.col("has_usage").isNull().alias("is_shelfware"),
        (F.coalesce("over_months", F.lit(0)) >= rules["months"]).alias("is_overage"),
        (F.coalesce("approach_months", F.lit(0)) >= rules["months"]).alias("is_approaching_cap"),
        F.coalesce("has_adjacent_overlap", F.lit(False)).alias("has_adjacent_overlap"))


def edge_case_checks(frames: dict[str, DataFrame], minima: dict[str, int] = EDGE_CASE_MINIMA) -> DataFrame:
    """Q-17..Q-23: how many accounts or logs show each edge case, against the
    minimum asked for. EC-5b (Q-22) compares a known account's logs with the
    span from its first contract's start to its last contract's end (A-18)."""
    labels = {"EC-1": "is_spike_drop", "EC-2": "is_shelfware", "EC-3": "is_overage", "EC-4": "has_adjacent_overlap",
              "EC-6": "is_approaching_cap"}
    days = days_of(frames)
    known = frames["accounts"].select("account_id")
    span = frames["contracts"].groupBy("account_id").agg(F.min("start_date").alias("lo"), F.max("end_date").alias("hi"))
    logs = lambda df, name: df.agg(F.coalesce(F.sum("n_logs"), F.lit(0)).alias("actual")).select(
        F.lit(name).alias("check_id"), "actual")
    cohorts = usage_cohorts(frames).agg(*[F.count_if(c).alias(c) for c in labels.values()])
    rows = cohorts.select(F.expr("stack(%d, %s)" % (len(labels), ", ".join(f"'{k}', {c}" for k, c in labels.items())))
                          .alias("check_id", "actual"))
    outside = days.join(known, "account_id", "left_semi").join(span, "account_id").where(
        (F.col("date") < F.col("lo")) | (F.col("date") > F.col("hi")))
    rows = (rows.unionByName(logs(days.join(known, "account_id", "left_anti"), "EC-5a"))
            .unionByName(logs(outside, "EC-5b")))
    least = F.create_map(*[F.lit(x) for kv in minima.items() for x in kv])[F.col("check_id")].cast("bigint")
    return rows.select("check_id", F.col("actual").cast("bigint").alias("actual"), least.alias("minimum"),
                       F.when(F.col("actual") >= least, "PASS").otherwise("FAIL").alias("status"))


def preload_results(frames: dict[str, DataFrame], cfg: MetricConfig) -> DataFrame:
    """check_id and status of all 26 checks before a load."""
    parts = [row_counts(frames), fk_fractions(frames), segment_checks(frames), edge_case_checks(frames),
             distribution_checks(frames, cfg)]
    out = parts[0].select("check_id", "status")
    for p in parts[1:]:
        out = out.unionByName(p.select("check_id", "status"))
    return out


def reconcile_formulas(mart: DataFrame, single: DataFrame, snapshot) -> DataFrame:
    """Q-30: the current formula's bands and flags against the older one's on one date, by pair of bands."""
    now = mart.where(F.col("snapshot_date") == lit_date(snapshot)).select(
        "account_id", F.col("band").alias("current_band"), F.col("expansion_flag").alias("f"))
    old = single.select("account_id", F.col("band").alias("v1_band"), F.col("expansion_flag").alias("g"))
    both = now.join(old, "account_id", "full")
    return both.groupBy("current_band", "v1_band").agg(
        F.count(F.lit(1)).alias("n_accounts"), F.count_if("f").alias("n_flag_current"),
        F.count_if("g").alias("n_flag_v1"), F.count_if(F.col("f") & F.col("g")).alias("n_flag_both"))


# Least figures of the metric's smoke checks.
METRIC_MINIMA = {"MET-1": 3, "MET-2": 50, "MET-3": 50}


def metric_smoke(scored: DataFrame, minima: dict[str, int] = METRIC_MINIMA) -> DataFrame:
    """Q-28: MET-1 bands present, MET-2 zero-D/C/B accounts Red, MET-3
    expansion flags (on the single-date result), against the minima."""
    zero = (F.col("d_score") == 0) & (F.col("c_score") == 0) & (F.col("b_score") == 0)
    a = scored.agg(F.countDistinct("band").alias("met1"),
                   F.count_if(zero & (F.col("band") == "Red")).alias("met2"),
                   F.count_if("expansion_flag").alias("met3"))
    rows = ", ".join(f"'{k}', met{k[-1]}, {v}L" for k, v in minima.items())
    return a.select(F.expr(f"stack({len(minima)}, {rows})")
                    .alias("check_id", "actual", "threshold")).select(
        "check_id", F.col("actual").cast("bigint").alias("actual"),
        F.col("threshold").cast("bigint").alias("threshold"),
        F.when(F.col("actual") >= F.col("threshold"), "PASS").otherwise("FAIL").alias("status"))


def overall(results: DataFrame) -> DataFrame:
    """Q-29: roll-up of a results frame (status counts and exit code)."""
    return results.agg(F.count_if(F.col("status") == "PASS").alias("n_pass"),
                       F.count_if(F.col("status") == "WARN").alias("n_warn"),
                       F.count_if(F.col("status") == "FAIL").alias("n_fail")).withColumn(
        "exit_code", F.when(F.col("n_fail") > 0, 1).otherwise(0))


# ---- registered queries ----------------------------------------------------

def _results(spark, root) -> DataFrame:
    """The stored results of both suites for this state of the input."""
    def build(path):
        t = model_tables(inputs(spark, root), CFG, materialized_marts(spark, root, CFG),
                         lambda name: stored_model(spark, root, name))
        all_results(t, CFG).write.mode("overwrite").parquet(path)
    return stored_results(spark, root, "dq", repr(GENERIC_CHECKS + row_assertions(CFG)), build)


@query("dq_generic")
def q_dq_generic(spark, root):
    return _results(spark, root).where("suite = 'generic'").drop("suite")


@query("dq_singular")
def q_dq_singular(spark, root):
    return _results(spark, root).where("suite = 'singular'").select("check_id", "severity", "n_failing", "status")


@query("dq_summary")
def q_dq_summary(spark, root):
    return overall(_results(spark, root))


@query("dq_row_counts")
def q_dq_row_counts(spark, root):
    return row_counts(inputs(spark, root))


@query("dq_fk_fraction")
def q_dq_fk(spark, root):
    return fk_fractions(inputs(spark, root))


@query("dq_segment")
def q_dq_segment(spark, root):
    return segment_checks(inputs(spark, root))


@query("dq_distributions")
def q_dq_dist(spark, root):
    return distribution_checks(inputs(spark, root), CFG)


@query("usage_cohorts")
def q_usage_cohorts(spark, root):
    return usage_cohorts(inputs(spark, root))


@query("metric_smoke")
def q_metric_smoke(spark, root):
    cfg = MetricConfig.v1(scoring_date=CFG.scoring_date)
    return metric_smoke(marts.point_in_time(inputs(spark, root, cfg), cfg))


__all__ = ["Check", "GENERIC_CHECKS", "run_generic", "singular_checks", "usage_cohorts",
           "metric_smoke", "overall", "Window"]


@query("dq_edge_cases")
def q_dq_edge_cases(spark, root):
    return edge_case_checks(inputs(spark, root))


@query("dq_preload")
def q_dq_preload(spark, root):
    rules = repr((ROW_COUNT_BOUNDS, FK_CHECKS, SEVERITY_TARGET, COMMIT_RANGES, COHORT_RULES, EDGE_CASE_MINIMA))
    return overall(stored_results(spark, root, "preload", rules, lambda path: preload_results(
        inputs(spark, root), CFG).write.mode("overwrite").parquet(path)))


@query("formula_reconciliation")
def q_formula_reconciliation(spark, root):
    v1 = MetricConfig.v1(scoring_date=CFG.scoring_date)
    return reconcile_formulas(materialized_marts(spark, root, CFG)[0],
                              marts.point_in_time(inputs(spark, root, v1), v1), CFG.scoring_date)
