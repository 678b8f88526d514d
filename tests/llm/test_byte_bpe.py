import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as E
from llm_data import frame, with_clashes
from vantage.llm.op13_byte_bpe import Vocabulary, decode, encode, merge, pair_ranks, read_ranks
from vantage.llm.perfect_hash import MinimalHash

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(PATH), special_tokens={})


def test_minimal_perfect_hash():
    rnd = random.Random(1)
    keys = list({bytes(rnd.randrange(3) for _ in range(rnd.randrange(1, 40))) for _ in range(3000)})
    table = MinimalHash(keys)
    assert sorted(table.key.tolist()) == list(range(len(keys)))      # every slot has one key
    others = [k + b"\x07" for k in keys] + [b"\x09", b"x" * 500]
    every = keys + others
    size = np.array([len(k) for k in every])
    found = table.find(np.frombuffer(b"".join(every), np.uint8), np.cumsum(size) - size, size)
    assert found.tolist() == list(range(len(keys))) + [-1] * len(others)
    assert MinimalHash([b"a"]).find(np.frombuffer(b"ab", np.uint8), np.array([0, 1]), np.array([1, 1])).tolist() == [0, -1]


def test_ids_equal_the_library(vocabulary, library):
    rnd = random.Random(2)
    letters = "aab b  \n\t'sreé中文字1२#!.,’Ⅷ  😀́ßдн_\x00\x1c\u0085　՘꟝\U000323af"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(50))) for _ in range(5000)]
    texts += ["", "a" * 3000, "ab" * 2000 + " " * 300, "don't we'll  it's 'RE 're' ''s", "<|endoftext|>", "x\r\n\r\n y"]
    bpe = vocabulary.bpe()
    ids, offs = bpe.encode(pa.array([*texts, None]))
    assert [ids[a:b].tolist() for a, b in zip(offs, offs[1:])] == [library.encode_ordinary(t) for t in texts] + [[]]
    assert vocabulary.decoder().decode(ids)[0].tobytes() == "".join(texts).encode()


def test_heap_takes_equal_pairs_from_the_left():
    ranks = {bytes([i]): i for i in range(256)} | {b"aa": 300, b"ab": 301, b"aab": 302}
    pairs = pair_ranks(ranks)
    assert merge(list(b"aaab"), pairs.get) == [300, 301] and merge(list(b"aaa"), pairs.get) == [300, 97]
    assert merge([], pairs.get) == [] and merge([98], pairs.get) == [98]


def test_rare_pieces_start_anew(vocabulary, library, monkeypatch):
    monkeypatch.setattr("vantage.llm.op13_byte_bpe.KEEP_BYTES", 200)
    bpe, rnd = vocabulary.bpe(), random.Random(3)
    for _ in range(6):
        text = " ".join("".join(rnd.choice("qxzjv") for _ in range(9)) for _ in range(20))
        ids, _ = bpe.encode(pa.array([text]))
        assert ids.tolist() == library.encode_ordinary(text)
        assert bpe.held <= 200 + 300


def test_query_round_trip(spark, library):
    got = {r.doc_id: r for r in E.queries()["op13_byte_bpe"](spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids, text = library.encode_ordinary(r.text or ""), (r.text or "").encode()
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(text).hexdigest()


def test_awkward_rows(spark, hard, none, vocabulary, library):
    docs = with_clashes(hard).withColumn("ids", F.lit("mine")).withColumn("decoded", F.lit("mine"))
    out = decode(encode(docs, vocabulary), vocabulary)
    assert set(out.columns) == (set(docs.columns) - {"text"})
    got = sorted((str(r.doc_id), list(r.ids), bytes(r.decoded), r.tag) for r in out.collect())
    assert got == sorted((str(r.doc_id), library.encode_ordinary(r.text or ""), (r.text or "").encode(), "x")
                         for r in hard.collect())
    assert decode(encode(none, vocabulary), vocabulary).collect() == []


def test_decoding_other_ids(spark, vocabulary):
    df = spark.createDataFrame([(1, [195]), (2, []), (3, None)], "doc_id long, ids array<int>")
    got = {r.doc_id: bytes(r.decoded) for r in decode(df, vocabulary).collect()}
    assert got == {1: vocabulary.tokens[vocabulary.ids.index(195)], 2: b"", 3: b""}
    for bad in ([1_000_000], [-1], [None]):
        with pytest.raises(Exception, match="no token|null among"):
            decode(spark.createDataFrame([(1, bad)], "doc_id long, ids array<int>"), vocabulary).collect()
    with pytest.raises(ValueError, match="no token for bytes"):
        v = Vocabulary(PATH, public_tokenizers.PATTERN)
        v.tokens, v.ids, v.key = v.tokens[300:], v.ids[300:], "other"
        v.bpe()


def test_a_very_long_piece(spark, vocabulary, library):
    text = "x" * 200_000 + " " + "é" * 50_000
    want = library.encode_ordinary(text)
    assert encode(frame(spark, [(1, text)]), vocabulary).first().ids == want
    row = encode(frame(spark, [(1, text)]), vocabulary, keep=["doc_id"], binary=True).first()
    assert bytes(row.ids) == np.array(want, "<u4").tobytes()
