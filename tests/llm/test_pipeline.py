import random

import corpus_pipeline
from llm_data import frame, words
from vantage.llm.common import materialize


def corpus(spark, path):
    rnd = random.Random(3)
    items = [(i, " ".join(words(rnd, 30, 3000))) for i in range(5)]
    rows = []
    for i in range(120):
        text = " ".join(words(rnd, rnd.randint(20, 80), 3000))
        if i % 10 == 0:
            text += " " + items[i // 10 % 5][1] + " end"
        rows.append((i, text, rnd.choice(["en", "de"]), f"src{i % 4}"))
    rows += [(200 + i, rows[i][1], "en", "src0") for i in range(15)]        # copies
    rows += [(300 + i, t, None, None) for i, t in enumerate([None, "", "12 34", "!?"])]
    frame(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return rows


def test_each_stage_takes_effect(spark, tmp_path):
    rows = corpus(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, str(tmp_path)), "test-stage")
        kept[name] = {r.doc_id for r in docs.collect()}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
            assert docs.count() == len(kept[name])
    a, b, c, d, e = kept.values()
    assert a == {r[0] for r in rows if r[0] < 300}              # the language is unknown without a letter
    assert b == set(range(120))                                 # one of each group of copies
    assert c == {i for i in range(120) if i % 10}               # no benchmark passage
    assert d < c and len(d) > 0.6 * len(c) and e == d
    out = corpus_pipeline.run(spark, str(tmp_path)).orderBy("start").collect()
    assert {r.doc_id for r in out} == e
    assert all(x.start + x.n_tokens == y.start and x.doc_id < y.doc_id for x, y in zip(out, out[1:]))
