import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from llm_data import awkward, frame, with_clashes
from vantage.llm.op7_vantage_point import Search, Tree, nearest
from vantage.llm.op8_licenses import TEMPLATES, key_words, plain_words, scan

SF = "/root/testdata/sf0.01"


def brute(rows, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    out = {}
    for q in ids[ids % 20 == 0]:
        s, other = (x * x[ids == q][0]).sum(1), ids != q
        best = np.lexsort((ids[other], -s[other]))[:k]
        out[int(q)] = list(zip(ids[other][best].tolist(), s[other][best].tolist()))
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_query_is_exact_with_factor_one(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert found(E.queries()["op7_vantage_point"](spark, SF)) == brute(rows, 20)


def test_shards_and_recall(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16))
    rows = [(i, (centres[i % 40] * 3 + rng.normal(size=16)).astype(np.float32).tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    want = brute(rows, 10)
    assert found(nearest(df, F.col("vec_id") % 20 == 0, k=10, shard_size=700)) == want
    loose = found(nearest(df, F.col("vec_id") % 20 == 0, k=10, factor=1.5, shard_size=700))
    hits = sum(len({i for i, _ in loose[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9


def test_pruning_saves_work():
    rng = np.random.default_rng(5)
    x = (rng.normal(size=(50, 8))[np.arange(5000) % 50] * 10 + rng.normal(size=(5000, 8)) * 0.1)
    top = np.sqrt((x ** 2).sum(1).max())
    tree = Tree(np.hstack([x, np.sqrt(top ** 2 - (x ** 2).sum(1)).reshape(-1, 1)]))
    taken = [Search(tree, x, x[:50], top, 10, f).taken for f in (1.0, 4.0)]
    assert taken[1] < taken[0] < 50 * 5000


def test_vectors_that_take_no_part_and_ties(spark, none):
    v = [1.0, 0.0]
    rows = [(0, v, 1), (1, v, 1), (2, v, 1), (2, v, 1), (3, [0.5, 0.5], 1), (4, None, 1), (5, [0.0, 0.0], 1), (6, [None, 1.0], 1),
            (7, [float("nan"), 1.0], 1), (8, [float("inf"), 1.0], 1), (None, v, 1), (9, [1.0, 2.0, 3.0], 1), (10, [], 1),
            (20, [0.0, 1.0], 1), (40, None, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, shard int")
    got = found(nearest(df, F.col("vec_id") % 20 == 0, k=20))
    assert got[0] == [(1, 1.0), (2, 1.0), (3, 0.5), (20, 0.0)]
    assert got[20] == [(3, 0.5), (0, 0.0), (1, 0.0), (2, 0.0)] and set(got) == {0, 20}
    assert nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_license_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    got = E.queries()["op8_licenses"](spark, SF)
    want = con.sql(E.oracle_sql()["op8_licenses"]).project(", ".join(got.columns)).fetchall()
    assert want and sorted(map(tuple, got.collect())) == sorted(want)


def test_every_template_is_found_whole_and_in_part(spark):
    rows = []
    for i, (name, t) in enumerate(TEMPLATES.items()):
        w = plain_words(t)
        rows += [(10 * i, "Some words before. " + t.upper() + " and after it"), (10 * i + 1, "  ".join(w))]
        if len(w) >= 14:  # without its last word a template keeps most shingles
            rows.append((10 * i + 2, "x y z " + " ".join(w[:-1]) + " q r s"))
    got = {(r.doc_id, r.license_id) for r in scan(frame(spark, rows)).collect()}
    for i, (name, t) in enumerate(TEMPLATES.items()):
        assert {(10 * i, name), (10 * i + 1, name)} <= got
        if len(plain_words(t)) >= 14:
            assert (10 * i + 2, name) in got


def test_shared_templates_and_notices_equal_the_sql(spark, tmp_path):
    """Whole, cut and mixed notices between other words, by the SQL that knows no key words."""
    texts, rows = [plain_words(t) for t in TEMPLATES.values()], []
    rnd = np.random.default_rng(3)
    for i in range(150):
        out = []
        for j in rnd.integers(0, len(texts), 3):
            t = texts[j]
            low = int(rnd.integers(0, max(1, len(t) // 6)))
            out += ["filler"] * int(rnd.integers(0, 40)) + t[low:len(t) - int(rnd.integers(0, max(1, len(t) // 8)))]
        rows.append((i // 2, " ".join(out)))
    frame(spark, rows).write.parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents/*.parquet')")
    got = scan(spark.read.parquet(str(tmp_path / "documents")))
    want = con.sql(E.oracle_sql()["op8_licenses"]).project(", ".join(got.columns)).fetchall()
    assert len(want) > 200 and sorted(map(tuple, got.collect())) == sorted(want)


def test_key_words_leave_no_room_for_a_match_without_them():
    for threshold in (0.5, 0.8, 1.0):
        keys = set(key_words(TEMPLATES, threshold))
        for t in TEMPLATES.values():
            w = plain_words(t)
            k = min(5, len(w))
            runs = [set(w[i:i + k]) for i in range(len(w) - k + 1)]
            assert sum(not r & keys for r in runs) < threshold * len(runs)


def test_license_scan_of_awkward_rows(spark, hard, none):
    assert scan(with_clashes(hard)).count() == 0 and scan(none).count() == 0
    assert scan(hard, templates={}).count() == 0 and scan(hard, templates={"empty": "!!"}).count() == 0
    got = scan(frame(spark, [(1, "all rights reserved"), (1, "All rights reserved. All rights reserved."), (None, "ALL RIGHTS RESERVED")]))
    assert {(r.doc_id, r.license_id) for r in got.collect()} == {(1, "all-rights-reserved"), (None, "all-rights-reserved")}


def test_native_plan(spark):
    plan = scan(frame(spark, awkward()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan.replace("ArrowEval", "Python")


@pytest.mark.parametrize("n", [0, 1, 30])
def test_small_trees(n):
    x = np.random.default_rng(1).normal(size=(n, 4))
    assert Tree(np.hstack([x, np.zeros((n, 1))])).root is not None


def test_ties_between_different_vectors_go_to_the_smaller_id(spark):
    rng = np.random.default_rng(12)
    for low in (0, -1):    # few distinct scores: ties at nearly every last place
        rows = [(int(i), rng.integers(low, 2, 12).astype(float).tolist()) for i in rng.permutation(900)]
        rows = [r for r in rows if any(r[1])]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        for shard_size in (16_384, 200):
            assert found(nearest(df, F.col("vec_id") % 20 == 0, k=20, shard_size=shard_size)) == brute(rows, 20)


def test_extra_columns_with_clashing_names(spark):
    rows = [(i, [float(i % 3), 1.0]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    odd = df.select("*", *[F.lit("x").alias(c) for c in ("v", "q", "dim", "shard", "block", "rank", "query_id", "score")])
    assert found(nearest(odd, F.col("vec_id") % 20 == 0, k=5)) == brute(rows, 5)
