import zlib

import numpy as np

from subpanel.llm import sharding

from ..conftest import SF_SMALL


def check(rows, docs, shards):
    assert sorted(r["doc_id"] for r in rows if r["doc_id"] is not None) == sorted(
        d for d, _ in docs if d is not None) and len(rows) == len(docs)
    for s in range(shards):
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))
    text = dict(docs)
    for r in rows:
        if r["doc_id"] is not None:
            raw = (text[r["doc_id"]] or "").encode()
            assert (r["size"], r["text_crc32"]) == (len(raw) + 16, zlib.crc32(raw))


def test_bytes_near_equal(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    rows = sharding.shard(docs, 8).collect()
    check(rows, [tuple(r) for r in docs.collect()], 8)
    sums = np.bincount([r["shard"] for r in rows], [r["size"] for r in rows], minlength=8)
    assert sums.max() / sums.mean() < 1.05


def test_hot_group_is_split_and_blocks_agree(spark, docs_of):
    docs = docs_of([(i, "same words " * 20 if i % 3 == 0 else f"text {i} " * (5 + i % 40)) for i in range(3000)])
    rows = sharding.shard(docs, 10, block_groups=300).collect()
    check(rows, [(i, "same words " * 20 if i % 3 == 0 else f"text {i} " * (5 + i % 40)) for i in range(3000)], 10)
    sums = np.bincount([r["shard"] for r in rows], [r["size"] for r in rows], minlength=10)
    assert sums.max() / sums.mean() < 1.03 and sums.min() / sums.mean() > 0.97


def test_one_row_repeated_is_split(docs_of):
    rows = sharding.shard(docs_of([(7, "same row " * 20)] * 1000 + [(None, "no id " * 30)] * 300 + [
        (i, f"text {i} " * (5 + i % 40)) for i in range(1700)]), 10, block_groups=300).collect()
    sums = np.bincount([r["shard"] for r in rows], [r["size"] for r in rows], minlength=10)
    assert sums.max() / sums.mean() < 1.05 and sums.min() / sums.mean() > 0.95
    for s in range(10):
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))


def test_pack_takes_the_largest_dot_product():
    groups = np.array([[4.0, 1, 1], [1, 4, 1], [2, 2, 2]])
    capacity = np.array([[5.0, 2, 3], [2.0, 5, 3]])
    out = sharding.pack(groups, capacity)
    assert out[0] != out[1]


def test_messy_and_empty(messy):
    rows = sharding.shard(messy).collect()
    assert len(rows) == messy.count()
    assert {r["size"] for r in rows if r["text_crc32"] == 0} == {16}
    assert sharding.shard(messy.limit(0)).count() == 0
