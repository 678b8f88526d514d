"""Contract-interval operators: active contract per snapshot (M-2), usage
inside any contract (M-3), contract anomalies (Q-8, Q-9, Q-10, Q-20) and
timeline clipping (M-20).

Interval joins are rewritten as bounded fan-out + equi operators: an interval
is exploded into the calendar buckets it covers (month-ends, months), so no
nested-loop join is planned and a hot account is spread over its buckets.
What looks at an account's contracts in order does so over its days, to which
they are reduced before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vantage.config import MetricConfig
from vantage.functions.dates import calendar_array, days_between, month_ends_between

ACTIVE_COLUMNS = ["contract_id", "start_date", "end_date", "contract_days",
                  "annual_commit_dollars", "included_monthly_compute_credits", "contract_type"]


def contract_active(contracts: DataFrame, cfg: MetricConfig) -> DataFrame:
    """For each (snapshot_date, account_id) the contract covering the snapshot
    with the latest start_date (tie-break: highest contract_id).

    Of contracts that cover the same month-ends only the newest (a max over a
    (start_date, contract_id, ...) struct, with map-side partial aggregation)
    can win, so an account keeps one row for each span of the calendar, however
    many contracts it has. Its month-ends then take the newest of those spans
    that cover them: no contract is exploded before the winner is known.
    """
    if "contract_days" not in contracts.columns:
        contracts = contracts.withColumn(
            "contract_days", days_between(F.col("end_date"), F.col("start_date")) + 1)
    rest = [c for c in ACTIVE_COLUMNS if c not in ("start_date", "contract_id")]
    spans = (contracts.select("account_id", *ACTIVE_COLUMNS,
                              month_ends_between(F.col("start_date"), F.col("end_date"), cfg).alias("s"))
             .where(F.size("s") > 0)
             .groupBy("account_id", F.col("s")[0].alias("first"), F.element_at("s", -1).alias("last"))
             .agg(F.max(F.struct("start_date", "contract_id", *rest)).alias("c")))
    own = spans.groupBy("account_id").agg(F.collect_list(F.struct("c", "first", "last")).alias("own"))
    s = F.col("snapshot_date")
    newest = F.expr("array_max(transform(filter(own, x -> snapshot_date BETWEEN x.first AND x.last), x -> x.c))")
    best = (own.select("account_id", "own", F.explode(calendar_array(cfg)).alias("snapshot_date"))
            .select("snapshot_date", "account_id", newest.alias("c")).where("c IS NOT NULL"))
    return best.select(
        "snapshot_date", "account_id", *[F.col(f"c.{c}").alias(c) for c in ACTIVE_COLUMNS],
        days_between(F.col("c.end_date"), s).alias("days_to_renewal"),
        (days_between(s, F.col("c.start_date")) + 1).alias("days_in_contract"))


def covered_days(contracts: DataFrame) -> DataFrame:
    """(account_id, month, days): bit d - 1 of `days` says that some contract covers day d of the month.

    Spans of an account that touch are joined to one first (the running latest
    end over its distinct spans), so that a day is covered by one span only and
    becomes no more rows than there are covered months: exploding every contract
    made a row for each of its months, which the map side had to hold. An
    inverted contract covers no day."""
    start, end = F.col("start_date"), F.col("end_date")
    by_start = Window.partitionBy("account_id").orderBy("start_date", "end_date")
    before = F.max("end_date").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    first = F.when(before >= F.date_sub("start_date", 1), 0).otherwise(1)
    spans = (contracts.where(start <= end).select("account_id", "start_date", "end_date").distinct()
             .withColumn("first", first).withColumn("span", F.sum("first").over(by_start))
             .groupBy("account_id", "span").agg(F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date")))
    month = F.explode(F.sequence(F.trunc(start, "month"), F.trunc(end, "month"), F.expr("INTERVAL 1 MONTH")))
    first = F.dayofmonth(F.greatest(start, F.col("month")))
    last = F.dayofmonth(F.least(end, F.last_day("month")))
    days = F.expr("shiftleft(1L, last) - shiftleft(1L, first - 1)")
    return (spans.select("account_id", "start_date", "end_date", month.alias("month"))
            .select("account_id", "month", first.alias("first"), last.alias("last"))
            .select("account_id", "month", days.alias("days")).repartition("account_id", "month")
            .groupBy("account_id", "month").agg(F.bit_or("days").alias("days")))


def _days(usage: DataFrame) -> DataFrame:
    """The distinct (account_id, date) keys of logs: what meets accounts and
    contracts in their place. A hot account has one row a day at most."""
    return usage.select("account_id", "date").distinct()


def _day_is_in(days: str) -> F.Column:
    return F.expr(f"({days} & shiftleft(1L, dayofmonth(date) - 1)) != 0")


def log_windows(usage: DataFrame, accounts: DataFrame, contracts: DataFrame,
                days: DataFrame | None = None) -> DataFrame:
    """Usage rows of a known account that has contracts, with `inside`: whether some contract of it covers the date.

    The months of such accounts' logs (from `days`, the usage by account and
    day, if it is known already) get their covered days; the logs meet them by
    account and month, in a hash table of months. With `days`, contracts of
    accounts without a log are no months that are held. `usage_in_contract` and
    `out_of_window_usage` are its two sides: where both are asked for, it is
    written once and the logs are shuffled once."""
    month = F.trunc("date", "month").alias("month")
    known = accounts.select("account_id").join(contracts.select("account_id"), "account_id", "left_semi")
    covering = contracts.join(accounts.select("account_id"), "account_id", "left_semi")
    if days is not None:
        covering = covering.join(days.select("account_id").distinct(), "account_id", "left_semi")
    covered = covered_days(covering)
    months = ((usage if days is None else days).where(F.col("date").isNotNull()).select("account_id", month).distinct()
              .join(known, "account_id", "left_semi").join(covered.hint("shuffle_hash"), ["account_id", "month"], "left"))
    return (usage.select("log_id", "account_id", "date", "compute_credits_consumed", month)
            .join(months.hint("shuffle_hash"), ["account_id", "month"])
            .withColumn("inside", F.coalesce(_day_is_in("days"), F.lit(False))).drop("days"))


def usage_in_contract(usage: DataFrame, accounts: DataFrame, contracts: DataFrame,
                      days: DataFrame | None = None, windows: DataFrame | None = None) -> DataFrame:
    """Usage rows of a known account whose date lies inside ANY of its
    contracts; one row per log row (no overlap fan-out, no DISTINCT over the
    fact).  Logs meet the covered days by account and month: a hash table of
    months, so the logs are neither reduced nor sorted before (`days`, the usage
    by account and day, isn't needed). `windows`: the table of `log_windows`, if
    it is there already."""
    if windows is not None:
        return windows.where("inside").select("log_id", "account_id", "date", "compute_credits_consumed")
    covered = covered_days(contracts.join(accounts.select("account_id"), "account_id", "left_semi"))
    return (usage.withColumn("month", F.trunc("date", "month")).join(covered.hint("shuffle_hash"), ["account_id", "month"])
            .where(_day_is_in("days")).select("log_id", "account_id", "date", "compute_credits_consumed"))


def orphan_usage(usage: DataFrame, accounts: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """Q-8: usage rows whose account_id is not an account (or is null).

    The (account, date) keys meet the accounts; logs meet the keys that are
    left on both columns, so no log is shuffled by its account alone."""
    keys = (_days(usage) if days is None else days.select("account_id", "date")).join(
        accounts.select("account_id"), "account_id", "left_anti").select(
            F.col("account_id").alias("_account"), F.col("date").alias("_date"))
    return (usage.join(keys, F.col("account_id").eqNullSafe(F.col("_account"))
                       & F.col("date").eqNullSafe(F.col("_date")), "left_semi")
            .select("log_id", "account_id", "date", "compute_credits_consumed"))


def out_of_window_usage(usage: DataFrame, accounts: DataFrame, contracts: DataFrame,
                        days: DataFrame | None = None, windows: DataFrame | None = None) -> DataFrame:
    """Q-9: usage rows of a known account that has contracts, none of which
    covers the row's date.  (An account without any contract yields NULL
    coverage in the SQL test and is therefore not reported.)

    The logs meet the covered days by account and month (`log_windows`, or
    `windows`, its table, if it is there already); equal rows are within one month."""
    found = log_windows(usage, accounts, contracts, days) if windows is None else windows
    return (found.where(~F.col("inside"))
            .select("log_id", "account_id", "date", "month").distinct().drop("month"))


def overlapping_contracts(contracts: DataFrame, same_type_only: bool = True, only_inverted: bool = False) -> DataFrame:
    """Q-10 / J-16: pairs of contracts of one account whose closed intervals
    overlap (and have the same type).

    Bucketed interval join: the earlier-starting contract x is exploded into
    the months it covers, the other contract y is keyed by the month of its
    start; pair (x, y) overlaps iff y.start lies in [x.start, x.end] and y does
    not end before x starts (which only an inverted y can).  Only candidates
    whose starts share a covered month are ever formed, in tasks by account and
    month. Rows of one contract_id are no pair. Spark estimates the exploded side
    by its contracts alone, so the join is told to be no broadcast.
    """
    keys = ["account_id"] + (["contract_type"] if same_type_only else [])
    cols = ["contract_id", "contract_type", "start_date", "end_date"]
    later = contracts
    if only_inverted:   # y is inverted; x is looked for in its accounts only
        later = contracts.where(F.col("end_date") < F.col("start_date"))
        contracts = contracts.join(later.select("account_id").distinct(), "account_id", "left_semi")
    x = contracts.select("account_id", *[F.col(c).alias(f"x_{c}") for c in cols],
                         F.explode(F.sequence(F.trunc("start_date", "month"),
                                              F.trunc(F.greatest("start_date", "end_date"), "month"),
                                              F.expr("INTERVAL 1 MONTH"))).alias("bucket"))
    y = later.select("account_id", *[F.col(c).alias(f"y_{c}") for c in cols],
                         F.trunc("start_date", "month").alias("bucket"))
    x = x.withColumnRenamed("x_contract_type", "contract_type") if same_type_only else x
    y = y.withColumnRenamed("y_contract_type", "contract_type") if same_type_only else y
    pairs = x.hint("merge").join(y, keys + ["bucket"]).where(
        F.col("y_start_date").between(F.col("x_start_date"), F.col("x_end_date"))
        & (F.col("y_end_date") >= F.col("x_start_date")) & (F.col("x_contract_id") != F.col("y_contract_id"))
        & ((F.col("x_start_date") < F.col("y_start_date"))
           | ((F.col("x_start_date") == F.col("y_start_date"))
              & (F.col("x_contract_id") < F.col("y_contract_id")))))
    tx = F.col("contract_type") if same_type_only else F.col("x_contract_type")
    ty = F.col("contract_type") if same_type_only else F.col("y_contract_type")
    a_first = F.col("x_contract_id") < F.col("y_contract_id")

    def pick(a, b):
        return F.when(a_first, a).otherwise(b)

    return pairs.select(
        "account_id",
        pick(F.col("x_contract_id"), F.col("y_contract_id")).alias("contract_a"),
        pick(F.col("y_contract_id"), F.col("x_contract_id")).alias("contract_b"),
        pick(tx, ty).alias("type_a"), pick(ty, tx).alias("type_b"),
        pick(F.col("x_start_date"), F.col("y_start_date")).alias("start_a"),
        pick(F.col("x_end_date"), F.col("y_end_date")).alias("end_a"),
        pick(F.col("y_start_date"), F.col("x_start_date")).alias("start_b"),
        pick(F.col("y_end_date"), F.col("x_end_date")).alias("end_b"))


def _sweep(contracts: DataFrame, keys: list[str]) -> DataFrame:
    """n_pairs (one row): overlapping pairs within each group of `keys`, of contracts that aren't inverted.

    Of n contracts, n (n - 1) / 2 pairs, those don't overlap of which one ends
    before the other starts. Starts and ends are counted by day first (map-side
    combine); the running count of ends then goes over the days of a group,
    not over its contracts."""
    sound = contracts.where(F.col("start_date") <= F.col("end_date"))
    day = F.explode(F.array(F.struct(F.col("start_date").alias("day"), F.lit(1).alias("s"), F.lit(0).alias("e")),
                            F.struct(F.col("end_date").alias("day"), F.lit(0).alias("s"), F.lit(1).alias("e"))))
    big = lambda c: F.sum(c).cast("decimal(38,0)")
    days = (sound.select(*keys, day.alias("d")).groupBy(*keys, "d.day")
            .agg(F.sum("d.s").alias("s"), F.sum("d.e").alias("e")))
    earlier = Window.partitionBy(*keys).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    groups = (days.withColumn("ended", F.coalesce(F.sum("e").over(earlier), F.lit(0)))
              .groupBy(*keys).agg(big("s").alias("n"), big(F.col("s").cast("decimal(19,0)") * F.col("ended")).alias("apart")))
    return groups.agg(F.coalesce(F.sum(F.expr("CAST(n * (n - 1) / 2 AS DECIMAL(38,0)) - apart")), F.lit(0)).cast("bigint")
                      .alias("n_pairs"))


def count_overlapping_contracts(contracts: DataFrame, same_type_only: bool = True) -> DataFrame:
    """n_failing (one row): how many pairs `overlapping_contracts` lists, without listing them.

    Sound contracts are counted by a sweep over days; pairs of rows with one
    contract_id (a fault that the key checks report) come off again. Pairs whose
    later contract is inverted are few and are listed."""
    keys = ["account_id"] + (["contract_type"] if same_type_only else [])
    rows = contracts.select("contract_id", *dict.fromkeys([*keys, "contract_type"]), "start_date", "end_date")
    rows = rows.dropna(subset=["account_id", "contract_id", *keys])
    twice = rows.join(rows.groupBy("contract_id").count().where("count > 1").select("contract_id"), "contract_id", "left_semi")
    inverted = overlapping_contracts(rows, same_type_only, only_inverted=True).agg(F.count(F.lit(1)).alias("n_pairs"))
    signed = (_sweep(rows, keys).unionByName(_sweep(twice, [*keys, "contract_id"]).select((-F.col("n_pairs")).alias("n_pairs")))
              .unionByName(inverted))
    return signed.agg(F.sum("n_pairs").cast("bigint").alias("n_failing"))


def contract_timeline_clip(contracts: DataFrame) -> DataFrame:
    """M-20: make each account's contracts non-overlapping by ending every
    contract the day before the next one (by start date, then contract_id)
    begins; a contract that is left without a day (the next begins on the same
    date) goes.

    Of the contracts that start on one day only the last can keep a day, so the
    account's days are reduced to it first (an aggregate with map-side combine,
    by account and day); the look ahead then goes over days, not contracts."""
    rest = [c for c in contracts.columns if c not in ("account_id", "start_date", "contract_id")]
    last = (contracts.where(F.col("start_date").isNotNull()).groupBy("account_id", "start_date")
            .agg(F.max(F.struct("contract_id", *rest)).alias("c")))
    nxt = F.lead("start_date").over(Window.partitionBy("account_id").orderBy("start_date"))
    kept = last.select("account_id", "start_date", "c.*", nxt.alias("_next")).withColumn(
        "end_date", F.when(F.col("_next").isNotNull(), F.least(F.col("end_date"), F.date_sub("_next", 1)))
        .otherwise(F.col("end_date")))
    return kept.where(F.col("end_date") >= F.col("start_date")).select(*contracts.columns)


def adjacent_overlap_accounts(contracts: DataFrame) -> DataFrame:
    """Q-20 (EC-4): accounts where some contract starts on or before the end
    of the contract immediately preceding it by start date (then contract_id).

    Reduced to days like the clipping: within a day each contract but the last
    precedes one that starts on the same day; from day to day only the last
    contract of a day is looked back at."""
    reaches = F.col("end_date") >= F.col("start_date")
    days = (contracts.where(F.col("start_date").isNotNull()).groupBy("account_id", "start_date")
            .agg(F.count_if(reaches).alias("reaching"), F.max(F.struct("contract_id", "end_date")).alias("c"))
            .select("account_id", "start_date", "reaching", F.col("c.end_date").alias("end_date")))
    before = F.lag("end_date").over(Window.partitionBy("account_id").orderBy("start_date"))
    within = F.col("reaching") > F.coalesce(reaches, F.lit(False)).cast("int")
    found = days.select("account_id", (within | F.coalesce(F.col("start_date") <= before, F.lit(False))).alias("ov"))
    return found.groupBy("account_id").agg(F.bool_or("ov").alias("ov")).where("ov").select("account_id")
