"""Mixing sources to target weights by hierarchical budgeting.

The tree is domain - language - source. A token budget is shared from the root
down: children get budget in proportion to their weights, but none more than
its subtree holds (its tokens times `max_epochs`); what a short child cannot
take goes to its siblings first, and only what a whole subtree cannot take goes
to the siblings of its ancestors, since the parent was never given it. Each
leaf then reads its documents in seeded epochs, one order for each epoch, and
takes the prefix of that stream whose tokens reach the leaf's budget.

Only sums meet in windows over the tree. A leaf's cut is found by bucket: the
leaf's keys (md5 of seed, epoch and doc_id) fall into 4,096 buckets, whose sums
show the bucket in which the budget ends, so that the rows of a hot leaf are
never sorted in one task. Documents are taken by comparing their key with it.
The budgets, one row for each leaf, are written once; they are broadcast to the
documents if their bytes are few, and otherwise meet them by leaf and salt.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vantage.llm.common import materialize

LEVELS = ["domain", "lang", "source"]
BROADCAST_BYTES = 16 << 20   # of the leaves' names and budgets
SALTS = 64                   # parts of a leaf where its budget is not broadcast


def weight(column: Column, weights: dict[str, int], default: int = 1) -> Column:
    out = F.lit(default)
    for name, value in weights.items():
        out = F.when(column == name, value).otherwise(out)
    return out.cast("long")


def token_count(text: Column) -> Column:
    """Pieces between blanks and line ends: 0 for a null or empty text."""
    breaks = F.length(text) - F.length(F.translate(text, " \n", ""))
    return F.when(F.length(text) > 0, breaks + 1).otherwise(0).cast("long")


def share(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Add `budget` to nodes (parent columns, name, weight, cap, given): `given` is
    the parent's budget; whole tokens, left-over ones in order of name.

    Sorted by cap / weight, a node is full if its cap is within its share of
    what the full ones before it leave; the others divide the rest by weight."""
    by = Window.partitionBy(*parent)
    asc = by.orderBy(F.col("cap") / F.col("weight"), name)
    before = asc.rowsBetween(Window.unboundedPreceding, -1)
    after = asc.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    n = nodes.withColumns({"_used": F.coalesce(F.sum("cap").over(before), F.lit(0)), "_w": F.sum("weight").over(after)})
    n = n.withColumn("_full", F.col("cap") * F.col("_w") <= F.col("weight") * (F.col("given") - F.col("_used")))
    n = n.withColumns({"_rest": F.col("given") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("cap"))).over(by), F.lit(0)),
                       "_ws": F.sum(F.when(~F.col("_full"), F.col("weight"))).over(by)})
    n = n.withColumn("_part", F.when(~F.col("_full"), F.expr("(_rest * weight) div _ws")))
    n = n.withColumns({"_over": F.col("_rest") - F.sum("_part").over(by),
                       "_nth": F.sum(F.when(~F.col("_full"), 1)).over(by.orderBy(name))})
    extra = F.when(F.col("_nth") <= F.col("_over"), 1).otherwise(0)
    return n.withColumn("budget", F.when(F.col("_full"), F.col("cap")).otherwise(F.col("_part") + extra)).drop(
        "_used", "_w", "_full", "_rest", "_ws", "_part", "_over", "_nth")


def leaf_budgets(leaves: DataFrame, budget_share: float, max_epochs: int, weights: dict[str, dict[str, int]]) -> DataFrame:
    """domain, lang, source, tokens, budget of every leaf (domain, lang, source, tokens)."""
    n = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    for depth in (2, 1):
        n = n.withColumn(f"cap{depth}", F.sum("cap").over(Window.partitionBy(*LEVELS[:depth])))
    total = leaves.agg(F.sum("tokens")).first()[0] or 0  # one number
    n = n.withColumn("given", F.lit(math.floor(float(total) * budget_share)).cast("long"))
    for depth, level in enumerate(LEVELS, 1):
        cap = f"cap{depth}" if depth < len(LEVELS) else "cap"
        nodes = n.select(*LEVELS[:depth], F.col(cap).alias("cap"), "given").distinct().withColumn(
            "weight", weight(F.col(level), weights.get(level, {})))
        got = share(nodes, LEVELS[:depth - 1], level).select(*LEVELS[:depth], "budget")
        n = n.drop("given").join(got, LEVELS[:depth]).withColumnRenamed("budget", "given")
    return n.select(*LEVELS, "tokens", F.col("given").alias("budget"))


def with_leaf(rows: DataFrame, leaves: DataFrame, few: bool) -> DataFrame:
    """Inner join of rows with one row for each leaf; a leaf may hold most of the rows."""
    if few:
        return rows.join(F.broadcast(leaves), LEVELS)
    parts = leaves.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))  # the same if a task runs again
    return salted.join(parts.hint("merge"), [*LEVELS, "_salt"]).drop("_salt")


def mix(docs: DataFrame, domain: Column, weights: dict[str, dict[str, int]], budget_share: float = 0.5,
        max_epochs: int = 2, seed: int = 11) -> DataFrame:
    """The chosen rows of `docs` with its columns, and _domain, _epoch, _tokens; a row of several epochs comes once for each.

    The budget is `budget_share` of all tokens. A null domain, language or
    source counts as the name ''. Rows that repeat a doc_id share a key and are
    taken or left together. Documents without tokens follow their key too; a
    leaf without any token takes none. An empty table gives an empty result."""
    names = [f"_c{i}" for i in range(len(docs.columns))]  # no column can clash
    lang, source, doc_id, text = (F.col(names[docs.columns.index(c)]) for c in ("lang", "source", "doc_id", "text"))
    blank = F.lit("")
    rows = docs.withColumn("_domain", F.coalesce(domain, blank)).toDF(*names, "domain").withColumns(
        {"lang": F.coalesce(lang, blank), "source": F.coalesce(source, blank), "_tokens": token_count(text)})
    slim = materialize(rows.select(*LEVELS, "_tokens", doc_id.alias(names[docs.columns.index("doc_id")])), "mixing-rows")
    leaves = materialize(slim.groupBy(*LEVELS).agg(F.sum("_tokens").alias("tokens")), "mixing-leaves")
    plan = materialize(leaf_budgets(leaves, budget_share, max_epochs, weights).where("tokens > 0").select(
        *LEVELS, F.expr("budget div tokens").alias("whole"), F.expr("budget % tokens").alias("rest")), "mixing-plan")
    held = plan.agg(F.sum(sum(F.octet_length(c) for c in LEVELS) + F.lit(64 + 32))).first()[0] or 0
    few = held <= BROADCAST_BYTES
    key = F.md5(F.concat_ws(":", F.lit(seed), F.col("whole"), F.coalesce(doc_id.cast("string"), blank)))
    keyed = with_leaf(slim, plan.where("rest > 0"), few).withColumn("key", key)
    sums = keyed.groupBy(*LEVELS, "rest", "key").agg(F.sum("_tokens").alias("n")).withColumn(
        "bucket", F.substring("key", 1, 3))
    ends = Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    edge = (sums.groupBy(*LEVELS, "rest", "bucket").agg(F.sum("n").alias("n"))
            .withColumn("before", F.coalesce(F.sum("n").over(ends), F.lit(0)))
            .where("before < rest").groupBy(*LEVELS, "rest").agg(F.max(F.struct("bucket", "before")).alias("e"))
            .select(*LEVELS, F.col("e.bucket").alias("bucket"), F.col("e.before").alias("before")))
    inside = Window.partitionBy(*LEVELS, "bucket").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    cut = (sums.join(edge, [*LEVELS, "bucket"])
           .withColumn("before", F.col("before") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
           .where("before < rest").groupBy(*LEVELS).agg(F.max("key").alias("cut")))
    take = materialize(plan.join(cut, LEVELS, "left"), "mixing-cuts")
    chosen = (with_leaf(rows, take, few).withColumn("copies", F.col("whole") + F.when(key <= F.col("cut"), 1).otherwise(0))
              .where("copies > 0").withColumn("_epoch", F.explode(F.sequence(F.lit(0), (F.col("copies") - 1).cast("int")))))
    out = chosen.select(*names, "domain", "_epoch", "_tokens")
    return out.toDF(*docs.columns, "_domain", "_epoch", "_tokens")


def oracle(domain_sql: str, weights: dict[str, dict[str, int]], budget_share: float, max_epochs: int, seed: int) -> str:
    """DuckDB SQL of a mixing run: doc_id, epoch, domain, lang, source, n_tokens of `documents`."""

    def level(depth: int) -> str:
        name, parent = LEVELS[depth - 1], LEVELS[:depth - 1]
        keys, by = ", ".join(LEVELS[:depth]), f"PARTITION BY {', '.join(parent)}" if parent else ""
        given = (f"JOIN b{depth - 1} p USING ({', '.join(parent)})" if parent else
                 f"CROSS JOIN (SELECT CAST(floor(sum(tokens) * {budget_share}::DOUBLE) AS BIGINT) AS budget FROM leaf) p")
        case = " ".join(f"WHEN '{k}' THEN {v}" for k, v in weights.get(name, {}).items())
        weight_sql = f"CASE {name} {case} ELSE 1 END" if case else "1"
        return f"""
n{depth} AS (SELECT {keys}, cap, given, weight, sum(cap) OVER ({by} ORDER BY cap / weight, {name}
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - cap AS used,
                    sum(weight) OVER ({by} ORDER BY cap / weight DESC, {name} DESC
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS w
            FROM (SELECT {keys}, sum(tokens) * {max_epochs} AS cap, any_value(p.budget) AS given, {weight_sql} AS weight
                  FROM leaf {given} GROUP BY {keys}) x),
f{depth} AS (SELECT *, cap * w <= weight * (given - used) AS is_full FROM n{depth}),
r{depth} AS (SELECT *, given - coalesce(sum(cap) FILTER (WHERE is_full) OVER ({by}), 0) AS rest,
                    sum(weight) FILTER (WHERE NOT is_full) OVER ({by}) AS ws FROM f{depth}),
s{depth} AS (SELECT *, if(is_full, NULL, (rest * weight) // ws) AS part,
                    count(*) FILTER (WHERE NOT is_full) OVER ({by} ORDER BY {name}) AS nth FROM r{depth}),
b{depth} AS (SELECT {keys}, CAST(if(is_full, cap, part + CAST(nth <= rest - sum(part) OVER ({by}) AS INTEGER)) AS BIGINT) AS budget
            FROM s{depth})"""

    return f"""
WITH d AS (SELECT doc_id, lang AS own_lang, source AS own_source, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  {domain_sql} AS domain, CAST(CASE WHEN length(text) > 0 THEN
                    length(text) - length(translate(text, ' ' || chr(10), '')) + 1 ELSE 0 END AS BIGINT) AS n_tokens
           FROM documents),
leaf AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM d GROUP BY ALL),{level(1)},{level(2)},{level(3)},
plan AS (SELECT domain, lang, source, budget // tokens AS whole, budget % tokens AS rest
         FROM b3 JOIN leaf USING (domain, lang, source) WHERE tokens > 0),
keyed AS (SELECT d.*, whole, rest, md5(concat_ws(':', {seed}, whole, coalesce(CAST(doc_id AS VARCHAR), ''))) AS k
          FROM d JOIN plan USING (domain, lang, source)),
placed AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY k
                     RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP), 0) AS before FROM keyed)
SELECT doc_id, CAST(unnest(range(CAST(whole + CAST(before < rest AS INTEGER) AS BIGINT))) AS INTEGER) AS epoch, domain,
       own_lang AS lang, own_source AS source, n_tokens
FROM placed
"""
