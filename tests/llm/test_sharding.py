"""Shards: laws, groups, slots."""

import zlib
from collections import defaultdict

import numpy as np

from churnlens.llm.sharding import pack, shard_documents

from .cases import ODD, prose, table


def check(rows, texts, shards):
    assert len(rows) == len(texts)
    for row in rows:
        text = (texts[row["doc_id"]] or "").encode()
        assert (row["size"], row["text_crc32"]) == (len(text) + 16, zlib.crc32(text))
        assert row["law"] == "bytes" and row["grown_shard"] is None and 0 <= row["shard"] < shards
    slots = defaultdict(list)
    for row in rows:
        slots[row["shard"]].append(row["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def spread(rows, column, shards):
    held = np.zeros(shards)
    for row in rows:
        held[row["shard"]] += row[column]
    return held.max() / held.mean() - 1, 1 - held.min() / held.mean()


def test_sizes_are_near_equal_and_groups_whole(spark):
    texts = [prose(5 + i * 37 % 180, i) for i in range(3000)] + [prose(60, 7)] * 40 + [prose(30, 5000)] * 1500
    rows = shard_documents(table(spark, texts), shards=8).collect()
    check(rows, texts, 8)
    assert max(spread(rows, "size", 8)) < 0.01
    groups = defaultdict(set)
    for row in rows:
        groups[texts[row["doc_id"]]].add(row["shard"])
    hot = groups.pop(prose(30, 5000))
    assert max(map(len, groups.values())) == 1
    assert len(hot) > 1  # a third of all rows does not fit a shard


def test_odd_texts(spark):
    rows = shard_documents(table(spark, ODD), shards=3).collect()
    check(rows, ODD, 3)
    assert shard_documents(table(spark, []), shards=3).count() == 0
    again = shard_documents(table(spark, [(None, None), (1, "a"), (1, "a")]), shards=2).collect()
    assert sorted((r["shard"], r["slot"]) for r in again)[0][1] == 0 and len(again) == 3


def test_pack_balances_every_resource():
    rng = np.random.default_rng(1)
    vectors = rng.lognormal(0, 1, (4000, 3))
    places = pack(vectors, 10)
    for column in range(3):
        held = np.bincount(places, vectors[:, column], 10)
        assert held.max() / held.mean() < 1.02
    assert pack(np.zeros((0, 3)), 4).tolist() == []
