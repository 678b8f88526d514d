import numpy as np
import pytest
from pyspark.sql import functions as F

from vantage.llm.op11_hard_negatives import Packed, _best_within, _ordered, best, mine

def anchor():
    return F.col("vec_id") % 50 == 0


def plain(rows, positives=5, negatives=3, scale=256):
    """(vec_id, vector, label) rows by the definition, in Python's integers."""
    rows = [(i, [int(np.floor(scale * float(x))) for x in v], lab) for i, v, lab in rows]
    out = []
    for a, va, la in rows:
        if a % 50:
            continue
        score = [(sum(x * y for x, y in zip(va, v)), i, lab) for i, v, lab in rows if i != a and len(v) == len(va)]
        order = sorted(score, key=lambda s: (-s[0], s[1]))
        for p, pid, _ in [s for s in order if s[2] == la][:positives]:
            fits = [s for s in order if s[2] != la and 50 * p <= 100 * s[0] <= 95 * p]
            out += [(a, pid, k + 1, i, p, s) for k, (s, i, _) in enumerate(fits[:negatives])]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                              "negative_score").collect())


@pytest.mark.parametrize("most", [1, 200, 40_000, 1 << 40])
def test_packed_products_are_exact(most):
    rng = np.random.default_rng(most % 97)
    c, a = rng.integers(-most, most + 1, (101, 9)), rng.integers(-most // 3, most + 1, (13, 9))
    packed = Packed(c, int(a.min()), int(a.max()))
    assert packed.small == (most <= 200) and packed.fields > 1
    assert (packed.scores(a) == a.astype(object) @ c.astype(object).T).all()


def test_widest_fields_do_not_overflow():
    c = np.full((5, 64), 255)
    c[1] = -256
    packed = Packed(c, -256, 255)
    assert packed.scores(np.array([[255] * 64, [-256] * 64])).tolist() == [
        [64 * 255 * 255, -64 * 256 * 255] + [64 * 255 * 255] * 3, [-64 * 256 * 255, 64 * 256 * 256] + [-64 * 256 * 255] * 3]


def test_best_breaks_ties_to_the_left():
    s = np.array([[3, 5, 5, 5, 1], [2, 2, 2, 2, 2]])
    ok = np.array([[True, False, True, True, True], [False] * 5])
    for kind in (np.int64, object):
        r, c = best(s.astype(kind), ok, 2)
        assert sorted(zip(r.tolist(), c.tolist())) == [(0, 2), (0, 3)]


def test_equals_the_definition_over_shards(spark):
    rng = np.random.default_rng(8)
    # few values, so that many scores are equal
    rows = [(i, (rng.integers(-1, 3, 6) / 256).tolist(), int(rng.integers(0, 3))) for i in range(700)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    want = plain(rows)
    assert len(want) > 60 and got(mine(df, anchor(), shard_size=150)) == want
    assert got(mine(df, anchor())) == want


def test_large_components_use_wide_integers(spark):
    rng = np.random.default_rng(9)
    rows = [(i, (rng.normal(size=4) * 3000 + 4000).tolist(), i % 2) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert got(mine(df, anchor(), shard_size=40)) == plain(rows) != []


def test_a_hot_label(spark):
    rng = np.random.default_rng(10)
    rows = [(i, rng.normal(size=5).astype(np.float32).tolist(), 0 if i % 3 else i % 9) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert got(mine(df, anchor(), shard_size=90)) == plain(rows) != []


def test_rows_that_take_no_part(spark):
    v, w = [1.0, 1.0], [0.5, 1.0]
    rows = [(0, v, 1, 7), (1, v, 1, 7), (1, v, 1, 7), (2, w, 2, 7), (3, None, 1, 7), (4, v, None, 7), (5, [None, 1.0], 1, 7),
            (6, [float("nan"), 1.0], 1, 7), (8, [float("inf"), 1.0], 2, 7), (None, v, 1, 7), (9, [], 1, 7),
            (10, [1.0, 1.0, 1.0], 1, 7), (50, [-1.0, 0.0], 3, 7), (51, v, 3, 7), (100, [0.0, 0.0], 4, 7), (101, v, 4, 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, shard int").withColumn("block", F.lit("x"))
    # 100 is all zeros: its positive and every other row score 0, and 0 lies in 0 .. 0
    assert got(mine(df, anchor())) == plain([(0, v, 1), (1, v, 1), (2, w, 2), (50, [-1.0, 0.0], 3), (51, v, 3),
                                           (100, [0.0, 0.0], 4), (101, v, 4)])
    assert got(mine(df.limit(0), anchor())) == []
    assert got(mine(df.where("vec_id = 1"), anchor())) == []


def test_products_that_a_double_holds_are_one_matrix_product():
    rng = np.random.default_rng(12)
    c, a = rng.integers(-256, 257, (4_000, 64)), rng.integers(-256, 257, (60, 64))
    packed = Packed(c, int(a.min()), int(a.max()))
    assert packed.words.dtype == np.float64 and packed.fields == 2
    assert (packed.scores(a) == a @ c.T).all()
    edge = Packed(np.array([[1 << 12] * 3, [-(1 << 12)] * 3] * 5), -(1 << 12), 1 << 12)    # fields of 28 bits: 64-bit words
    assert edge.words.dtype == np.uint64 and edge.small
    assert edge.scores(np.array([[1 << 12] * 3]))[0, :2].tolist() == [3 << 24, -(3 << 24)]


def test_bands_from_ordered_keys():
    rng = np.random.default_rng(13)
    for n in (1, 7, 300):
        s, ok = rng.integers(-20, 21, (9, n)), rng.random((9, n)) < 0.6
        ok[3] = False
        keys, shut = _ordered(s, ok)
        least = np.array([-(1 << 62), -5, 3, 0, 21, 5, -100])
        most = np.array([1 << 62, 5, 3, 20, 1 << 61, -5, -50])
        for i in range(9):
            band, column, score = _best_within(keys[i], shut[i], n, least, most, 3)
            want = [(b, j, s[i, j]) for b in range(len(least)) for j in sorted(
                (j for j in range(n) if ok[i, j] and least[b] <= s[i, j] <= most[b]), key=lambda j: (-s[i, j], j))[:3]]
            assert list(zip(band.tolist(), column.tolist(), score.tolist())) == want
