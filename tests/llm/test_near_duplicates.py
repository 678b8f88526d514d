import collections
import random
import re

import numpy as np

from llm_data import awkward, frame, with_clashes, words
from vantage.llm import op10_order_minhash
from vantage.llm.common import materialize
from vantage.llm.op10_order_minhash import classes, keep_representatives, near_duplicates, similarity

WORD = re.compile(r"[a-z0-9\x80-\U0010ffff]+")


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_alignment_equals_the_plain_table():
    rnd = random.Random(1)
    for _ in range(1500):
        a = [rnd.randint(0, rnd.choice([3, 50])) for _ in range(rnd.randint(1, 40))]
        b = list(a)
        for _ in range(rnd.randint(0, 6)):
            i = rnd.randrange(len(b) + 1)
            b[i:i + rnd.randint(0, 1)] = [rnd.randint(0, 50)] * rnd.randint(0, 1)
        if b:
            t, m = rnd.choice([0.5, 0.8]), lcs(a, b)
            want = m / (len(a) + len(b) - m)
            got = similarity(np.array(a, np.uint64), np.array(b, np.uint64), t)
            assert (got > 0) == (want >= t - 1e-9) and (not got or abs(got - want) < 1e-12)


def brute(rows, threshold=0.8):
    runs = {}
    for d, t in rows:
        w = WORD.findall((t or "").lower())
        if w:
            runs[d] = [tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))]
    root = {d: d for d, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = collections.defaultdict(set)
    for d, r in runs.items():
        for x in r:
            holders[x].add(d)
    for a, r in runs.items():
        for b in sorted(set().union(*(holders[x] for x in r))):
            if b > a and min(len(r), len(runs[b])) >= threshold * max(len(r), len(runs[b])):
                m = lcs(r, runs[b])
                if m >= threshold * (len(r) + len(runs[b]) - m) - 1e-9:
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {d: find(d) for d, _ in rows}


def corpus(seed=1, groups=25):
    rnd = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = words(rnd, rnd.randint(3, 120), 2000)
        for _ in range(rnd.choice([1, 1, 2, 3, 8])):
            w = list(base)
            for _ in range(rnd.randint(0, 3)):
                i = rnd.randrange(len(w))
                w[i:i + rnd.randint(0, 2)] = words(rnd, rnd.randint(0, 2), 2000)
            rows.append((len(rows), " ".join(x.upper() if rnd.random() < .1 else x for x in w)))
    return rows


def test_classes_equal_brute_force(spark):
    rows = corpus()
    got = {r.doc_id: r.class_id for r in classes(frame(spark, rows)).collect()}
    assert got == brute(rows)


def test_large_lists_are_whole(spark):
    """A group far beyond `small`, whose members are near its origin but not near each other, beside a shared passage."""
    rnd = random.Random(9)
    base, passage = words(rnd, 150, 3000), words(rnd, 14, 3000)
    rows = [(0, " ".join(base))]
    for i in range(1, 60):
        w = list(base)
        for _ in range(3):
            w[rnd.randrange(len(w))] = f"new{i}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, " ".join(passage + words(rnd, 6, 3000))) for i in range(40)]
    member, links = near_duplicates(frame(spark, rows), small=4)
    assert {r.doc_id: r.class_id for r in member.collect()} == brute(rows)
    assert links.count() < 60 * 59 / 4  # never all pairs


def test_rounds_end_with_the_largest_list(spark, monkeypatch):
    """Lists of a passage that texts share without being near: once all classes of the largest have met, no round follows."""
    rnd = random.Random(4)
    passage, written = words(rnd, 40, 3000), []
    rows = [(i, " ".join(passage + words(rnd, 40, 3000))) for i in range(80)]
    rows += [(100, rows[5][1] + " more"), (101, "less " + rows[70][1])]
    monkeypatch.setattr(op10_order_minhash, "materialize", lambda df, name: written.append(name) or materialize(df, name))
    member, _ = near_duplicates(frame(spark, rows), small=4)
    assert {r.doc_id: r.class_id for r in member.collect()} == brute(rows)
    assert len(written) <= 10  # one leader, 8 leaders, all pairs: two tables a round


def test_one_of_each_class_stays(spark):
    rows = corpus(2, 10)
    kept = keep_representatives(frame(spark, rows + rows[:5]))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(brute(rows).values()))


def test_awkward_rows(spark, hard, none):
    df = with_clashes(hard)
    got = classes(df).collect()
    assert len(got) == len(awkward())
    own = {r.doc_id: r.class_id for r in got if r.doc_id in (1, 2, 3, 8, 11, 13)}
    assert all(k == v for k, v in own.items())
    assert {r.class_id for r in got if r.doc_id in (4, 5)} == {4}
    assert {r.class_id for r in got if r.doc_id in (6, 7, 10)} == {None}  # copies of the row without an id
    kept = keep_representatives(df)
    assert kept.columns == df.columns
    texts = [r.text for r in kept.collect()]
    assert len([t for t in texts if t and WORD.findall(t.lower())]) == len({t for _, t, *_ in awkward() if t and WORD.findall(t.lower())})
    assert classes(none).count() == 0 and keep_representatives(none).count() == 0


HAN = "".join(chr(0x4E00 + 7 * i) for i in range(400))


def test_texts_without_blanks_and_typography(spark):
    """Near copies in scripts without blanks, and copies that differ only in their signs, are classes."""
    thai = "".join(chr(0x0E01 + i * 5 % 46) + chr(0x0E34 + i % 4) for i in range(90))
    plain = '"It is" - he said - a matter of, say, taste; and that - one may think - is all.'
    fancy = "\u201cIt is\u201d \u2014 he said\u2014a matter of,\u00a0say, taste; and that \u2013 one may think \u2013 is all\u2026"
    rows = [(0, HAN[:80]), (1, HAN[:30] + "\u4e01" + HAN[31:80]), (2, HAN[:40] + "\uff0c" + HAN[40:80] + "\u3002"),
            (3, HAN[200:280]), (4, thai), (5, thai[:60] + "\u0e2e" + thai[62:]), (6, plain), (7, fancy)]
    got = {r.doc_id: r.class_id for r in classes(frame(spark, rows)).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 3, 4: 4, 5: 4, 6: 6, 7: 6}
