import random
import zlib

from orderloom.llm import sharding
from tests.llm.conftest import ODD_ROWS


def test_equal_bytes_contiguous_and_gapless(spark, documents):
    draw = random.Random(8)
    rows = [(k, "é" * draw.choice([0, 3, 50, 400])) for k in range(3000)]
    got = sharding.shard_documents(documents(rows), shards=7).orderBy("doc_id").collect()
    assert [(r.doc_id, r.size, r.text_crc32) for r in got] == [
        (k, 16 + len(t.encode()), zlib.crc32(t.encode())) for k, t in rows
    ]
    # brute force: the shard of the row's middle byte
    total, at, slots = sum(r.size for r in got), 0, {}
    for r in got:
        assert r.shard == (2 * at + r.size) * 7 // (2 * total)
        assert r.slot == slots.get(r.shard, 0)
        assert (r.law, r.grown_shard) == ("bytes", None)
        slots[r.shard] = r.slot + 1
        at += r.size
    assert sorted(slots) == list(range(7))


def test_one_hot_id(spark, documents):
    """Rows that are all alike still spread: the place in the input breaks the ties."""
    got = sharding.shard_documents(documents([(1, "same")] * 400), shards=4).groupBy("shard").count().collect()
    assert sorted((r.shard, r["count"]) for r in got) == [(k, 100) for k in range(4)]


def test_odd_rows(spark, documents):
    got = sharding.shard_documents(documents(ODD_ROWS)).collect()
    assert len(got) == len(ODD_ROWS)
    assert sorted(r.size for r in got)[:4] == [16, 16, 16, 16 + 4]
    assert all(0 <= r.shard < 40 for r in got)
    assert sharding.shard_documents(documents([])).count() == 0
