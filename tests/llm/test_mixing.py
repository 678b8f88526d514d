import hashlib
import random

import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as E
from llm_data import awkward, frame, with_clashes, words
from vantage.llm import op4_mixing
from vantage.llm.op4_mixing import leaf_budgets, mix


def water(total, nodes):
    """Shares of a budget by (weight, cap): the plain round-by-round way."""
    got, open_ = {}, dict(nodes)
    while open_:
        w = sum(x for x, _ in open_.values())
        full = [k for k, (x, cap) in open_.items() if cap * w <= x * total]
        if not full:
            return got | {k: total * x / w for k, (x, _) in open_.items()}
        k = min(full, key=lambda n: open_[n][1] / open_[n][0])
        got[k] = open_.pop(k)[1]
        total -= got[k]
    return got


def test_budgets_go_to_siblings_before_ancestors(spark):
    rnd = random.Random(3)
    leaves = [(d, x, s, rnd.choice([0, 5, 40, 300, 5000])) for d in "ab" for x in ("en", "de", "fr") for s in ("s1", "s2", "s3")]
    weights = {"domain": {"a": 3}, "lang": {"en": 5}, "source": {"s2": 2}}
    df = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long")
    got = {(r.domain, r.lang, r.source): r.budget for r in leaf_budgets(df, 0.6, 2, weights).collect()}
    caps = {k[:3]: 2 * k[3] for k in leaves}
    total = int(sum(k[3] for k in leaves) * 0.6)
    w = lambda level, name: weights[level].get(name, 1)
    for d, b1 in water(total, {d: (w("domain", d), sum(c for k, c in caps.items() if k[0] == d)) for d in "ab"}).items():
        langs = {x: (w("lang", x), sum(c for k, c in caps.items() if k[:2] == (d, x))) for x in ("en", "de", "fr")}
        for x, b2 in water(b1, langs).items():
            for s, b3 in water(b2, {s: (w("source", s), caps[d, x, s]) for s in ("s1", "s2", "s3")}).items():
                assert abs(got[d, x, s] - b3) <= 4, (d, x, s)
    assert sum(got.values()) == total


def test_prefix_of_seeded_epochs(spark):
    rnd = random.Random(4)
    rows = [(i, " ".join(words(rnd, rnd.randint(1, 40))), "en", "s1") for i in range(300)]
    out = mix(frame(spark, rows), F.lit("d"), {}, budget_share=1.3, max_epochs=2, seed=5).collect()
    n = {i: len(t.split()) for i, t, *_ in rows}
    rest = int(sum(n.values()) * 1.3) - sum(n.values())
    order, at, want = sorted(n, key=lambda i: hashlib.md5(f"5:1:{i}".encode()).hexdigest()), 0, set()
    for i in order:
        if at >= rest:
            break
        want.add(i)
        at += n[i]
    assert sorted(r.doc_id for r in out if r._epoch == 0) == sorted(n)
    assert {r.doc_id for r in out if r._epoch == 1} == want


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    got = E.queries()["op4_mixing"](spark, sf)
    want = con.sql(E.oracle_sql()["op4_mixing"])
    assert sorted(map(tuple, got.collect())) == sorted(want.project(", ".join(got.columns)).fetchall())


def test_leaves_too_many_to_broadcast(spark, monkeypatch):
    rnd = random.Random(6)
    rows = [(i, " ".join(words(rnd, rnd.randint(0, 30))), rnd.choice(["en", "de"]), f"s{max(0, rnd.randint(-9, 4))}")
            for i in range(400)]
    take = lambda: sorted((r.doc_id, r._epoch) for r in mix(frame(spark, rows), F.col("lang"), {}, 0.7, 2).collect())
    few = take()
    monkeypatch.setattr(op4_mixing, "BROADCAST_BYTES", -1)
    assert few and take() == few


def test_awkward_rows(spark, hard, none):
    for share, epochs in ((0.5, 2), (1.0, 1), (2.5, 3), (0.0, 1)):
        out = mix(with_clashes(hard), F.col("source"), {}, share, epochs)
        assert out.columns == [*with_clashes(hard).columns, "_domain", "_epoch", "_tokens"]
        total = out.count()
        assert (total == 0) if share == 0 else total > 0
    assert mix(hard, F.lit(None).cast("string"), {}, 1.0, 1).count() == len(awkward())
    assert mix(none, F.lit("d"), {}).count() == 0
