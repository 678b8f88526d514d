import zlib

from llm_data import awkward, frame, with_clashes
from vantage.llm.op6_sharding import permute_int, round_keys, shard_documents


def test_permutation_is_one_to_one():
    for n in (1, 2, 3, 5, 16, 17, 1000):
        assert sorted(permute_int(i, n, round_keys(3)) for i in range(n)) == list(range(n))


def test_shards_against_plain_python(spark):
    rows = [(i * 3, f"text {i}") for i in range(203)]
    got = {r.doc_id: r for r in shard_documents(frame(spark, rows), shards=8, seed=17).collect()}
    for i, (d, t) in enumerate(rows):
        p = permute_int(i, len(rows), round_keys(17))
        assert (got[d].shard, got[d].slot) == (p % 8, p // 8)
        assert (got[d].size, got[d].text_crc32) == (len(t) + 1, zlib.crc32(t.encode()))


def test_awkward_rows(spark, hard, none):
    out = shard_documents(with_clashes(hard)).collect()
    assert len(out) == len(awkward())
    by = {}
    for r in out:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    counts = [len(by.get(s, [])) for s in range(8)]
    assert max(counts) - min(counts) <= 1
    assert {r.size for r in out if r.text_crc32 is None} == {1}
    assert shard_documents(none).count() == 0
