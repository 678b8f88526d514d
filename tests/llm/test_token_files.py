import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from llm_data import awkward, frame, with_clashes, words
from vantage.llm import range_coder
from vantage.llm.op2_token_files import SCHEMA, default_tokenizer, index, token_index, unpack_segments, write_token_files
from vantage.llm.tokens import ByteBpe


@pytest.mark.parametrize("n,block", [(0, 8), (1, 8), (37, 8), (5000, 64), (20000, 2048)])
def test_coder_round_trip(n, block):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % 50257).astype(np.uint32)
    if n > 1000:
        ids[n // 2:n // 2 + 400] = ids[:400]
        ids[-60:] = 65535
        ids[100:300] = 7
    lengths = np.array([block] * (n // block) + [n % block] * (n % block > 0), np.int64)
    coded, counts = range_coder.encode(ids, lengths)
    assert (range_coder.decode(coded, counts, lengths) == ids).all()


def test_blocks_are_independent_and_compress():
    ids = np.array(([3, 1, 4, 1, 5, 9, 2, 6] * 256), np.uint32)
    one, c1 = range_coder.encode(ids, np.array([2048]))
    two, c2 = range_coder.encode(np.tile(ids, 3), np.array([2048] * 3))
    assert (np.tile(one, 3) == two).all() and c2.tolist() == c1.tolist() * 3
    assert len(one) * 16 < len(ids) * 2  # repetition is learned


def test_ids_that_do_not_fit_are_refused():
    with pytest.raises(ValueError):
        range_coder.encode(np.array([70000]), np.array([1]))


def test_pieces_equal_the_library(rnd=random.Random(5)):
    bpe = ByteBpe(default_tokenizer())
    alphabet = list("aab  \n\t'''stmrevld019.,!é中  ²Ⅷ😀\r") + ["'s", "'ll", " '", "'re", "<|endoftext|>", "<|endoftext", "|>"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 30))) for _ in range(4000)] + ["", None, " ", "\n", "a" * 5000]
    ids, sizes = bpe.encode(pa.array(texts, pa.string()))
    got = np.split(ids, np.cumsum(sizes)[:-1])
    plain = Tokenizer.from_file(default_tokenizer())
    for t, g, e in zip(texts, got, plain.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)):
        assert g.tolist() == e.ids, t


def test_special_strings_are_their_token():
    bpe, plain = ByteBpe(default_tokenizer()), Tokenizer.from_file(default_tokenizer())
    one = "<|endoftext|>"
    texts = [one, one + one, "a " + one + " b", "<|endof", "text|>" + one, "it'" + one + "s", " " + one + "  x", one[:-1], ">",
             "é" + one + "é", None, "", one + "\n\n" + one[1:]]
    ids, sizes = bpe.encode(pa.array(texts, pa.string()))
    got = [g.tolist() for g in np.split(ids, np.cumsum(sizes)[:-1])]
    assert got == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert got[0] == [50256] and 50256 not in got[3] + got[7]


def test_index_equals_plain_encoding(spark, tmp_path):
    rnd = random.Random(2)
    rows = [(i * 7 % 101, " ".join(words(rnd, rnd.randint(0, 300))) + "<|endoftext|>" * (i % 3)) for i in range(101)]
    bpe = Tokenizer.from_file(default_tokenizer())
    path = str(tmp_path / "files")
    write_token_files(frame(spark, rows), path, block_ids=64)
    got = index(spark.read.schema(SCHEMA).parquet(path), with_ids=True).orderBy("doc_id").collect()
    at = 0
    for r, (d, t) in zip(got, sorted(rows)):
        ids = bpe.encode(t, add_special_tokens=False).ids + [0]
        assert (r.doc_id, r.start, r.n_tokens, r.ids) == (d, at, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_damage_is_found(spark, tmp_path):
    path = str(tmp_path / "files")
    write_token_files(frame(spark, [(1, "some words " * 400)], 1), path, block_ids=64)
    row = spark.read.schema(SCHEMA).parquet(path).first().asDict()
    raw = bytearray(row["payload"])
    raw[len(raw) // 2] ^= 0xFF
    with pytest.raises(ValueError):
        unpack_segments([row | {"payload": bytes(raw)}])
    with pytest.raises(ValueError):
        unpack_segments([row | {"payload": row["payload"][:-2]}])


def test_awkward_rows(spark, hard, none):
    out = token_index(with_clashes(hard)).collect()
    assert len(out) == len(awkward())
    out.sort(key=lambda r: r.start)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(out, out[1:])) and out[0].start == 0
    ids = [r.doc_id for r in out]
    assert ids == sorted(ids, key=lambda d: (d is not None, d))
    assert {r.n_tokens for r in out if r.doc_id in (1, 2)} == {1}
    assert token_index(none).count() == 0
