import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from llm_data import CLASHES, frame, with_clashes
from vantage.llm.op12_periodic_runs import Sequence, find_runs, periodic_runs, synchronising_set

SF = "/root/testdata/sf0.001"


def plain_runs(w, least=24, exponent=3):
    """(start, length, period) by comparing words at every distance; a stretch's first period found is its smallest."""
    best = {}
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, exponent * q):
                best.setdefault((i, j + q), q)
            i = j + 1
    return sorted((b, e - b, q) for (b, e), q in best.items())


def words(rnd):
    out = []

    def root(depth):
        if not depth or rnd.random() < .3:
            return [rnd.randrange(4) for _ in range(rnd.randrange(1, 12))]
        return root(depth - 1) * rnd.randrange(1, 6) + [rnd.randrange(4) for _ in range(rnd.randrange(4))]

    upto = rnd.choice([5, 60, 300, 700])
    while len(out) < upto:
        if rnd.random() < .4:
            out += [rnd.randrange(50) for _ in range(rnd.randrange(40))]
        else:
            r = root(3)[:120]
            out += (r * 8)[:int(len(r) * rnd.uniform(2.5, 6))]
    return out[:800]


@pytest.mark.parametrize("bits", [64, 6, 1])   # with narrow hashes nearly everything collides
def test_runs_equal_brute_force(bits):
    rnd, total = random.Random(bits), 0
    for _ in range(12):
        docs = [words(rnd) for _ in range(rnd.randrange(1, 6))] + [[]]
        sizes = np.array([len(d) for d in docs])
        got = find_runs(np.array([x for d in docs for x in d], np.int64), sizes, bits=bits)
        want = [(k, *r) for k, d in enumerate(docs) for r in plain_runs(d)]
        total += len(want)
        assert [tuple(r) for r in got.tolist()] == want
    assert total > 100


def test_fibonacci_and_thue_morse_words():
    a, b = [0], [0, 1]
    while len(b) < 2000:
        a, b = b, b + a
    t = [0]
    while len(t) < 4096:
        t += [1 - x for x in t]
    for w in (b, t, t * 3, [0] * 3000, ([0] * 50 + [1]) * 9):
        got = find_runs(np.array(w, np.int64), np.array([len(w)]))
        assert [tuple(r[1:]) for r in got.tolist()] == plain_runs(w)


def test_synchronising_sets_are_consistent_and_dense():
    rnd = random.Random(4)
    w = [rnd.randrange(3) for _ in range(900)]
    w[500:700] = w[100:300]
    seq, t = Sequence(np.array(w, np.int64), np.array([0, len(w)])), 12
    at = synchronising_set(seq, t, len(w), np.zeros((0, 3), np.int64)).tolist()
    inner = range(100, 300 - 2 * t + 1)
    assert [i for i in at if i in inner] == [i - 400 for i in at if i - 400 in inner]
    assert all(b - a <= t for a, b in zip(at, at[1:])) and len(at) < len(w)


def plant(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def expected(doc_id, text):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    w = plant(doc_id, text) if doc_id is not None else re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = plain_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    top = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_equals_the_definition_on_short_texts(spark):
    got = {r.doc_id: tuple(r) for r in E.queries()["op12_periodic_runs"](spark, SF).select(*COLUMNS).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert set(got) == {r.doc_id for r in rows} and any(x[1] for x in got.values())
    for r in rows:
        if len(r.text or "") < 12_000:   # the plain comparison takes the square of a text's length
            assert got[r.doc_id] == expected(r.doc_id, r.text)


def query(spark, tmp_path, docs):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    return E.queries()["op12_periodic_runs"](spark, str(tmp_path))


def test_awkward_rows(spark, hard, tmp_path):
    rows = [r for r in hard.collect() if len(r.text or "") < 100_000]
    extra = [(9, " ".join(["x", "y"] * 20)), (9, "a\tb\nc\x0bd\x0ce\rf " * 9), (20, "wörter 中文 " * 30), (30, " ".join("ab" * 40))]
    docs = with_clashes(frame(spark, [(r.doc_id, r.text) for r in rows] + extra)).withColumn("runs", F.lit(1))
    got = query(spark, tmp_path, docs)
    want = [expected(r.doc_id, r.text) for r in rows] + [expected(*x) for x in extra]
    assert sorted(map(repr, map(tuple, got.select(*COLUMNS).collect()))) == sorted(map(repr, want))
    assert any(w[1] for w in want)


def test_empty_table_and_a_very_long_text(spark, none, tmp_path):
    assert query(spark, tmp_path / "a", none).collect() == []
    rnd = random.Random(6)
    root = [f"w{rnd.randrange(9000)}" for _ in range(30_000)]
    text = " ".join(root * 3 + ["end"] + ["la"] * 200_000)
    found = periodic_runs(frame(spark, [(1, text), (2, None)]), ["doc_id", *[]]).orderBy("doc_id").collect()
    assert [tuple(r) for r in found[0].runs] == [(0, 90_000, 30_000), (90_001, 200_000, 1)]
    assert found[0].collapsed == " ".join(root + ["end", "la"]) and found[0].n_words == 290_001
    assert found[1].runs == [] and found[1].collapsed == ""


def test_operator_keeps_columns(spark):
    docs = with_clashes(frame(spark, [(1, "a b c")])).withColumn("collapsed", F.lit("mine"))
    out = periodic_runs(docs, ["doc_id", *CLASHES, "collapsed"])
    assert out.columns == ["doc_id", *CLASHES, "n_words", "runs", "collapsed"] and out.first().collapsed == "a b c"
    with pytest.raises(ValueError):
        find_runs(np.zeros(5, np.int64), np.array([5]), exponent=2)
