import zlib

from newsalpha.llm.sharding import byte_shards

from .conftest import ROWS


def test_shards_are_contiguous_and_nearly_equal(spark, frame):
    docs = frame([(i, "ü" * (i * 37 % 90)) for i in range(500)], "doc_id long, text string").repartition(7)
    rows = sorted(byte_shards(docs, 8).collect(), key=lambda r: r.doc_id)
    assert [r.size for r in rows] == [16 + 2 * (i * 37 % 90) for i in range(500)]
    assert [r.shard for r in rows] == sorted(r.shard for r in rows)
    totals = {s: sum(r.size for r in rows if r.shard == s) for s in range(8)}
    target = sum(totals.values()) / 8
    assert all(abs(t - target) <= 16 + 180 for t in totals.values())
    for s in range(8):
        assert [r.slot for r in rows if r.shard == s] == list(range(sum(r.shard == s for r in rows)))
    before = 0
    for r in rows:
        assert r.bytes_before == before
        before += r.size


def test_odd_rows(odd):
    rows = byte_shards(odd, 4).collect()
    expected = sorted(((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in ROWS), key=str)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=str) == expected
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    assert sum(r.slot == 0 for r in rows) == len({r.shard for r in rows})


def test_one_hot_id_and_equal_rows(frame):
    rows = byte_shards(frame([(1, "same")] * 100, "doc_id long, text string").repartition(4), 5).collect()
    assert sorted(r.shard for r in rows) == sorted(list(range(5)) * 20)


def test_empty(empty):
    assert byte_shards(empty).collect() == []
