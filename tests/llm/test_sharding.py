"""Sharding by sampled splitters against the exact byte prefix computed in plain Python."""

import zlib

import pytest

from labelloom.llm import sharding


def _frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, score double")


def _check(out, texts, shards):
    by_shard = {}
    for r in out:
        by_shard.setdefault(r["shard"], []).append(r)
        text = texts[(r["doc_id"], r["text_crc32"])]
        assert r["size"] == len((text or "").encode()) + 8
        assert r["text_crc32"] == zlib.crc32((text or "").encode())
        assert r["law"] == "bytes" and r["grown_shard"] is None
        assert 0 <= r["shard"] < shards
    total = sum(r["size"] for r in out)
    largest = max(r["size"] for r in out)
    for rows in by_shard.values():
        assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
        assert abs(sum(r["size"] for r in rows) - total / shards) <= largest


def test_shards_equal_bytes_through_several_levels(spark):
    rows = [(i, ("word " * (i % 37)) + str(i % 11), 0.5) for i in range(3000)]
    rows += [(10_000 + i, "the same copied text " * 5, None) for i in range(1000)]  # a hot group of copies
    rows += [(None, None, 1.0), (20_000, "", 2.0), (2 ** 60 + 1, "x" * 5000, None)]
    texts = {(d, zlib.crc32((t or "").encode())): t for d, t, _ in rows}
    out = sharding.assign(_frame(spark, rows), shards=24, fanout=3, oversample=8, leaf_bytes=2000).collect()
    assert len(out) == len(rows)
    _check(out, texts, 24)
    assert {r["doc_id"] for r in out} >= {2 ** 60 + 1, None}
    # copies lie side by side: the hot group spans few shards, each a run
    copies = sorted(r["shard"] for r in out if r["doc_id"] is not None and 10_000 <= r["doc_id"] < 20_000)
    assert copies[-1] - copies[0] <= 24


def test_shard_is_the_byte_prefix(spark):
    rows = [(i, "a" * (i * 7 % 101), None) for i in range(500)]
    df = _frame(spark, rows)
    keys = sharding.narrow(df).orderBy("_crc", "_hash", "_id", "_tag").collect()
    total = sum(k["size"] for k in keys)
    expected, before = {}, 0
    for k in keys:
        expected[k["doc_id"]] = min(23, before * 24 // total)
        before += k["size"]
    got = {r["doc_id"]: r["shard"] for r in sharding.assign(df, fanout=2, oversample=4, leaf_bytes=500).collect()}
    assert got == expected


def test_empty_and_repeated(spark):
    assert sharding.assign(_frame(spark, [])).collect() == []
    rows = [(1, "same", None)] * 50
    out = sharding.assign(_frame(spark, rows), shards=5, fanout=2, oversample=4, leaf_bytes=30).collect()
    assert sorted(r["shard"] for r in out) == sorted([s for s in range(5) for _ in range(10)])
    _check(out, {(1, zlib.crc32(b"same")): "same"}, 5)
