import hashlib
import random
import re
import sys

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as E
from llm_data import awkward, frame, with_clashes, words
from vantage.llm.op5_suffix_dedup import remove_repeats, suffix_sort
from vantage.llm.op9_sentence_spans import remove_spans
from vantage.llm.textops import PrefixHash, Words


def digest(data):
    return hashlib.sha256(data).hexdigest()


def brute_bytes(rows, length):
    seen, out = set(), {}
    for d, t in sorted(rows):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            w = data[i:i + length]
            if w in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(w)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[d] = (len(data), sum(gone), spans, digest(bytes(b for b, g in zip(data, gone) if not g)))
    return out


def as_dict(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


@pytest.mark.parametrize("hot", [128, 2])
def test_bytes_equal_brute_force(spark, hot):
    rnd = random.Random(3)
    parts = ["".join(rnd.choice("abcdé") for _ in range(rnd.randint(5, 60))) for _ in range(6)]
    rows = [(i, "".join(rnd.choice(parts + ["xy" * rnd.randint(1, 20), "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 20)))])
                        for _ in range(rnd.randint(0, 6)))) for i in range(250)]
    assert as_dict(remove_repeats(frame(spark, rows, 5), length=12, gram=4, hot=hot)) == brute_bytes(rows, 12)


def test_given_documents_equal_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert as_dict(remove_repeats(df)) == brute_bytes(rows, 100)


def test_a_gram_of_thousands_of_regions(spark):
    """One passage behind different words in 2,500 texts: parts of 300 regions give what one part gives."""
    rnd = random.Random(12)
    passage = " ".join(words(rnd, 30))
    rows = [(i, "".join(rnd.choice("ab") for _ in range(rnd.randint(60, 90))) + passage[:rnd.randint(140, len(passage))]
             + "".join(rnd.choice("yz") for _ in range(60))) for i in range(2500)]
    want = brute_bytes(rows, 100)
    for hot in (300, 8192):
        assert as_dict(remove_repeats(frame(spark, rows, 6), length=100, hot=hot)) == want


def test_suffix_order():
    rnd = np.random.default_rng(2)
    data = rnd.integers(97, 99, 4000).astype(np.uint8)
    start = rnd.integers(0, 3900, 1500)
    bucket = np.sort(rnd.integers(0, 40, 1500))
    order = suffix_sort(data, PrefixHash(data, 3), start, bucket, 60)
    got = [(bucket[i], data[start[i]:start[i] + 60].tobytes()) for i in order]
    assert got == sorted(got) and sorted(order.tolist()) == list(range(1500))


def test_bytes_of_awkward_rows(spark, hard, none):
    out = remove_repeats(with_clashes(hard), with_text=True).collect()
    assert len(out) == len(awkward())
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
        assert digest(bytes(r.kept)) == r.kept_sha256 and len(r.kept) == r.n_bytes - r.n_removed
    assert by[4][0].n_removed == 0 and by[5][0].n_removed == by[5][0].n_bytes  # ties: the smaller id keeps
    assert sorted(r.n_removed for r in by[7]) == [by[7][0].n_bytes] * 2        # copies of 6, or of the null id
    assert by[1][0].n_bytes == by[2][0].n_bytes == 0
    assert remove_repeats(none).count() == 0
    twice = as_dict(remove_repeats(frame(spark, [(1, "z" * 10 + "q" * 300), (1, "z" * 10 + "q" * 300)])))
    assert len(twice) == 1
    got = sorted(r.n_removed for r in remove_repeats(frame(spark, [(1, "abc" * 99), (1, "abc" * 99)])).collect())
    assert got[1] == 297 and got[0] < 297  # one of two equal rows keeps, but for its own repeats


WORD = re.compile(r"[A-Za-z0-9\x80-\U0010ffff]+")


def sentences(text, piece):
    out, cur, end = [], [], 0
    for m in WORD.finditer(text):
        if cur and (re.search(r"[.!?\n]", text[end:m.start()]) or len(cur) == piece):
            out.append(cur)
            cur = []
        cur.append(m)
        end = m.end()
    return out + [cur] * bool(cur)


def brute_spans(rows, run=3, least=12, piece=16):
    seen, out = set(), {}
    for d, t in sorted(rows):
        t = t or ""
        s = sentences(t, piece)
        gone = [False] * len(s)
        for i in range(len(s)):
            j = i + run - 1
            while j < len(s) and sum(map(len, s[i:j + 1])) < least:
                j += 1
            if j < len(s):
                key = tuple(m.group().lower() for x in s[i:j + 1] for m in x)
                if key in seen:
                    gone[i:j + 1] = [True] * (j + 1 - i)
                seen.add(key)
        kept, removed, spans, before = "" if s else t, 0, 0, False
        for i, x in enumerate(s):
            piece_ = t[0 if i == 0 else x[0].start():s[i + 1][0].start() if i + 1 < len(s) else len(t)]
            if gone[i]:
                removed += len(piece_.encode())
                spans += not before
            else:
                kept += piece_
            before = gone[i]
        out[d] = (len(t.encode()), removed, spans, digest(kept.encode()))
    return out


def test_spans_equal_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    want = brute_spans(rows)
    assert as_dict(remove_spans(df.repartition(4))) == want and any(v[1] for v in want.values())


def test_spans_of_awkward_rows(spark, hard, none):
    out = remove_spans(with_clashes(hard), with_text=True)
    assert out.count() == len(awkward()) and remove_spans(none).count() == 0
    assert {r.n_removed for r in out.where("doc_id in (1, 2, 3, 8, 9)").collect()} == {0}
    assert out.where("doc_id = 5 and n_removed = n_bytes").count() == 1 and out.where("doc_id = 4 and n_removed = 0").count() == 1


def test_texts_that_share_an_id_are_told_apart(spark):
    """4,500 different texts without an id: among so many, about 40 pairs agree in 18 bits of a hash of the text."""
    rnd = random.Random(8)

    def sentence(letters, n):
        return " ".join("".join(rnd.choice(letters) for _ in range(6)) for _ in range(n)) + ". "

    common, own = sentence("abcdefgh", 40), [sentence("klmnopqr", rnd.randint(3, 40)) for _ in range(4500)]
    df = frame(spark, [(None, (common if i % 3 == 0 else "") + x) for i, x in enumerate(own)], 4)
    size = len(common)
    for out in (remove_repeats(df, with_text=True), remove_spans(df, run=1, piece=99, with_text=True)):
        rows = out.collect()
        cut = [r for r in rows if r.n_removed]
        assert len(rows) == 4500 and len(cut) == 1499
        assert all(r.n_spans == 1 and size <= r.n_removed <= size + 20 for r in cut)  # next letters may agree
        assert sum(common in bytes(r.kept).decode() for r in rows) == 1


def test_a_hot_row_is_one_row_in_the_joins(spark):
    text = " ".join(f"w{i}" for i in range(200)) + "."
    rows = [(None, text)] * 400 + [(3, text), (4, "another " + text)]
    out = remove_repeats(frame(spark, rows, 6)).collect()
    assert sorted(r.n_removed == 0 for r in out if r.doc_id is None) == [False] * 399 + [True]
    assert all(r.n_removed >= len(text) for r in out if r.doc_id is not None)
    spans = remove_spans(frame(spark, rows, 6)).collect()
    assert [r.n_removed for r in spans if r.doc_id is None] == [0] * 400
    assert all(r.n_removed == r.n_bytes for r in spans if r.doc_id == 3)


def content_sentences(text, piece):
    """Sentences by stops; those of more than `piece` words are cut at the least word of every 3/4 `piece` in a row."""
    out, width = [], piece * 3 // 4
    for s in sentences(text, 1 << 30):
        cuts = {0}
        if len(s) > piece:
            h = [int(Words(pa.array([m.group()]), in_place=True).hash[0]) >> 28 for m in s]
            cuts |= {min(range(i, i + width), key=h.__getitem__) for i in range(len(s) - width + 1)}
        at = sorted(cuts) + [len(s)]
        out += [s[a:b] for a, b in zip(at, at[1:])]
    return out


def test_content_cuts_equal_brute_force(spark, monkeypatch):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    monkeypatch.setattr(sys.modules[__name__], "sentences", lambda t, piece, plain=sentences: content_sentences(t, piece)
                        if piece < 1 << 30 else plain(t, piece))
    want = brute_spans(rows)
    assert as_dict(E.queries()["op9_sentence_spans"](spark, "/root/testdata/sf0.001")) == want


@pytest.mark.parametrize("n", [60, 500])
def test_passages_without_stops_are_found_at_any_offset(spark, n):
    rnd = random.Random(n)
    passage = [f"p{rnd.randrange(3000)}" for _ in range(n)]
    rows = [(i, " ".join([f"lead{i}x{k}" for k in range(i)] + passage + [f"tail{i}x{k}" for k in range(9)]))
            for i in range(40)]
    rows.append((90, "Short lead. " + " ".join(passage)))
    out = remove_spans(frame(spark, rows), with_text=True, cuts="content").collect()
    for r in out:
        left = bytes(r.kept).decode().split()
        if r.doc_id == 0:
            assert r.n_removed == 0
        else:
            assert sum(w[0] == "p" for w in left) <= 2 * 12 and r.n_spans == 1
            assert sum(w[0] == "l" for w in left) == (r.doc_id if r.doc_id < 90 else 1)


def test_a_text_of_one_repeated_word(spark):
    out = remove_spans(frame(spark, [(1, "la " * 300), (2, "x " + "la " * 300)]), cuts="content").collect()
    assert all(r.n_removed > r.n_bytes - 120 for r in out)


def test_spans_without_blanks_and_typography(spark):
    han = ["".join(chr(0x4E00 + 40 * k + i) for i in range(10)) + "\u3002" for k in range(8)]
    fancy = "\u201cOne two three\u201d \u2014 four five. Six\u00a0seven\u2026 Eight nine ten? Eleven\u2013twelve thirteen fourteen!"
    plain = '"One two three" - four five. Six seven. Eight nine ten? Eleven-twelve thirteen fourteen!'
    rows = [(1, "".join(han[:6])), (2, han[7] + "".join(han[1:5]) + han[6]), (3, plain), (4, fancy)]
    by = {r.doc_id: r for r in remove_spans(frame(spark, rows), with_text=True, cuts="content").collect()}
    assert bytes(by[2].kept).decode() == han[7] + han[6] and by[1].n_removed == by[3].n_removed == 0
    assert by[4].n_removed == by[4].n_bytes


def test_words_by_unicode_class():
    texts = ["a\u4e2d\u6587b1", "\u0e01\u0e34\u0e02x", "\u0301e\u0301t\u00e9 \u2014\u201cno\u201d", "\ud55c\uad6d \U00020000\U0001f600z",
             "\u0301\u0301q", "\u4e2d", "z"]
    want = [["a", "\u4e2d", "\u6587", "b1"], ["\u0e01\u0e34", "\u0e02", "x"], ["\u0301e\u0301t\u00e9", "no"],
            ["\ud55c\uad6d", "\U00020000", "z"], ["\u0301\u0301q"], ["\u4e2d"], ["z"]]
    w = Words(pa.array(texts))
    got = [[w.data[a:b].tobytes().decode() for a, b in zip(w.start[s:e], w.end[s:e])]
           for s, e in zip(w.offsets, w.offsets[1:])]
    assert got == want
