import random

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as E
from llm_data import awkward, frame, with_clashes
from vantage.llm.op1_language import Counts, Model, fit, identify, keep_identified, training_sample

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ung", "ver", "ich"], "cc": ["eau", "tion", "ent", "que"]}


def text(rnd, lang, n=30):
    return " ".join("".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(n))


def corpus(n=120, seed=1):
    rnd = random.Random(seed)
    return [(i, text(rnd, lang), lang) for i, lang in enumerate(rnd.choice(list(SYLLABLES)) for _ in range(n))]


def plain_bits(counts: Counts, lang: int, data: bytes) -> float:
    """Code length by the definition, with dictionaries."""
    trees, total = [{} for _ in range(4)], [{} for _ in range(4)]
    for g, who, c in zip(counts.gram.tolist(), counts.language.tolist(), counts.count.tolist()):
        for order in range(4):
            ctx = (g >> 8) & ((1 << 8 * order) - 1)
            total[order][ctx] = total[order].get(ctx, 0) + c
            if who == lang:
                node = trees[order].setdefault(ctx, {})
                node[g & 255] = node.get(g & 255, 0) + c
    bits, before = 0.0, b"\0\0\0"
    for b in data:
        ctx3 = int.from_bytes(before, "big")
        order = 3
        while order > 1 and total[order].get(ctx3 & ((1 << 8 * order) - 1), 0) < counts.min_context:
            order -= 1
        if order == 1 and (ctx3 & 255) not in total[1]:
            order = 0
        while order >= 0:
            node = trees[order].get(ctx3 & ((1 << 8 * order) - 1), {})
            t, d = sum(node.values()), len(node)
            if b in node:
                bits -= np.log2(node[b] / (t + d))
                break
            bits -= np.log2(d / (t + d)) if t else 0
            order -= 1
        else:
            bits += 8
        before = before[1:] + bytes([b])
    return bits


def test_code_lengths_are_those_of_the_definition(spark):
    counts = fit(frame(spark, corpus()))
    probes = ["kalomi tu", "schungver zzz", "", "éé quetion", "kkkkkkk"]
    got = Model(counts).bits(pa.array(probes))
    for i, p in enumerate(probes):
        for k in range(len(counts.languages)):
            assert got[i, k] == pytest.approx(plain_bits(counts, k, p.lower().encode()), abs=1e-3)


def test_held_out_accuracy_on_the_given_documents(spark):
    sf = "/root/testdata/sf0.01"
    out = E.queries()["op1_language"](spark, sf).join(
        spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out")
    right, all_ = out.where("lang_pred = lang").count(), out.count()
    assert all_ > 200 and right / all_ >= 0.98


def test_labels_of_held_out_rows_are_not_used(spark):
    rows = corpus(200)
    a = identify(frame(spark, rows)).toPandas().sort_values("doc_id")
    held = set(a[a.held_out].doc_id)
    b = identify(frame(spark, [(d, t, "zz" if d in held else x) for d, t, x in rows])).toPandas().sort_values("doc_id")
    assert a.lang_pred.tolist() == b.lang_pred.tolist() and a.score.tolist() == b.score.tolist()


def test_awkward_rows(spark, hard, none):
    df = with_clashes(frame(spark, [r for r in corpus(60)]).unionByName(hard))
    out = identify(df)
    assert out.count() == 60 + len(awkward())
    und = {r.doc_id for r in out.where("lang_pred = 'und'").collect()}
    assert {1, 2, 3, 8} <= und and 4 not in und
    assert out.where("score < 0 or score > 1").count() == 0
    kept = keep_identified(df)
    assert kept.columns == df.columns
    assert kept.where("text is null or trim(text) = ''").count() == 0
    assert identify(none).count() == 0
    unlabelled = identify(frame(spark, [(1, "some text", None)])).collect()
    assert [r.lang_pred for r in unlabelled] == ["und"]


def test_copies_do_not_thin_the_sample(spark):
    """One language is mostly copies of a single text; every different text is still learned from."""
    rows = corpus(60)
    rows += [(100 + i, "kalo mitu tulo", "dd") for i in range(3000)] + [(5000 + i, f"zza {i} zzo", "dd") for i in range(20)]
    sample = training_sample(frame(spark, rows), "text", "lang", 40).collect()
    assert {r._text for r in sample if r._label == "dd"} == {t for _, t, x in rows if x == "dd"}
    assert len(sample) == len({(r._label, r._text) for r in sample})
    many = [(i, f"text {i // 10}", "ee") for i in range(20_000)]
    assert 330 < training_sample(frame(spark, many), "text", "lang", 400).count() < 470
