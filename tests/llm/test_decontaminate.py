import collections
import random
import re

import numpy as np

import __spark_entry__ as E
from llm_data import frame, with_clashes, words
from vantage.llm.op3_decontaminate import BLOCKS, Index, Items, find_leaks, remove_leaks

WORD = re.compile(r"[a-z0-9\x80-\U0010ffff]+")


def runs(text):
    w = WORD.findall((text or "").lower())
    return [tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))] if w else []


def brute(docs, items, threshold=0.8):
    out = {}
    for d, t in docs:
        h = runs(t)
        for i, x in items:
            own = runs(x)
            if not own or not h:
                continue
            c, z = collections.Counter(own), min(len(own), len(h))
            for s in range(len(h) - z + 1):
                shared = (collections.Counter(h[s:s + z]) & c).total()
                j = shared / (z + len(own) - shared)
                if j >= threshold and j > out.get((d, i), (0, 0))[0]:
                    out[d, i] = (j, s)
    return out


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_leaks_equal_brute_force(spark):
    rnd = random.Random(7)
    items = [(i, " ".join(words(rnd, rnd.randint(14, 50)))) for i in range(20)]
    docs = []
    for d in range(80):
        w = words(rnd, rnd.randint(5, 200))
        if d % 2:
            leak = rnd.choice(items)[1].split()
            for _ in range(rnd.randint(0, 2)):  # near copies: some reach the threshold, some do not
                leak[rnd.randrange(len(leak))] = "changed"
            at = rnd.randrange(len(w))
            w[at:at] = leak if d % 3 else [x.upper() + "," for x in leak]
        docs.append((d, " ".join(w)))
    got = {(r.doc_id, r.item_id): (r.similarity, r.start_word) for r in find_leaks(frame(spark, docs), bench(spark, items)).collect()}
    want = brute(docs, items)
    assert len(want) > 15 and got == want


def test_query_on_the_given_tables(spark):
    sf = "/root/testdata/sf0.001"
    got = {(r.doc_id, r.item_id): (r.similarity, r.start_word) for r in E.queries()["op3_decontaminate"](spark, sf).collect()}
    assert got == brute([(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()],
                        [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()])


def test_tables_hold_every_fingerprint_within_the_radius():
    rng = np.random.default_rng(1)
    index = Index(Items([1], ["a b c d e f g h i j k l m n"], radius=23, threshold=0.8))
    own, prints, table = index.by_size[10]
    for _ in range(2000):
        flips = rng.choice(64, rng.integers(0, 24), replace=False)
        near = int(prints[0]) ^ sum(1 << int(f) for f in flips)
        block = near.to_bytes(8, "little")
        assert any(table[b][block[b], 0] for b in range(BLOCKS))


def test_awkward_rows(spark, hard, none):
    items = bench(spark, [(1, None), (2, ""), (3, "one"), (4, "two other words here"), (5, "!!"), (5, "x y z")])
    got = {(r.doc_id, r.item_id) for r in find_leaks(with_clashes(hard), items).collect()}
    assert got == {(9, 3), (9, 4)}
    kept = remove_leaks(with_clashes(hard), items)
    assert kept.columns == with_clashes(hard).columns and kept.count() == hard.count() - 2
    assert find_leaks(none, items).count() == 0 and remove_leaks(none, items).count() == 0
    assert remove_leaks(hard, bench(spark, [])).count() == hard.count()
    inside = frame(spark, [(1, "here is ONE, and more text that goes on"), (2, "none of it")])
    assert {(r.doc_id, r.item_id) for r in find_leaks(inside, items).collect()} == {(1, 3)}


def test_texts_without_blanks_and_typography(spark):
    han = "".join(chr(0x4E00 + 7 * i) for i in range(300))
    items = bench(spark, [(1, han[100:130]), (2, 'He said: "one may think" - of it - what one likes, or not')])
    docs = [(1, han[:200]), (2, han[150:]), (3, han[:115] + "\uff0c" + han[115:200]),
            (4, "Then he said: \u201cone\u00a0may think\u201d\u2014of it\u2014what one likes, or\u2009not\u2026")]
    got = {(r.doc_id, r.item_id): r.similarity for r in find_leaks(frame(spark, docs), items).collect()}
    assert got == {(1, 1): 1.0, (3, 1): 1.0, (4, 2): 1.0}
