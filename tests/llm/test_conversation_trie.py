"""Prefix tries of conversations against plain dictionaries."""

import hashlib
import random
import zlib

import pytest

from churnlens.llm.conversation_trie import conversation_trie

SCHEMA = "conv_id long, turn int, role string, text string, turns int, family string, key binary, shard string"


def by_hand(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs.setdefault(conv, []).append((turn is not None, turn or 0, digest, (role, text)))
    own = {c: [turn[3] for turn in sorted(turns)] for c, turns in convs.items()}
    nodes = {}
    built = {}
    for conv in own:
        h = zlib.crc32(str(conv).encode()) % 9
        donor = conv - abs(conv) % 5 * (1 if conv >= 0 else -1)
        built[conv] = tuple(own.get(donor, [])[:h] + own[conv][h:])
        for depth in range(len(built[conv]) + 1):
            nodes.setdefault(built[conv][:depth], []).append(conv)
    children = dict.fromkeys(nodes, 0)
    for path in nodes:
        if path:
            children[path[:-1]] += 1
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for path, members in nodes.items():
        own_saved = (len(members) - 1) * len(path[-1][1].encode()) if path else 0
        for depth in range(len(path) + 1):
            saved[path[:depth]] += own_saved
            leaves[path[:depth]] += not children[path]
    for path, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(path))
        parent = min(nodes[path[:-1]]) if path else None
        yield (
            min(members), len(path), parent, len(members), children[path], leaves[path], saved[path],
            hashlib.sha256(ends.encode()).hexdigest(),
        )


def rows_of_all_kinds():
    draw = random.Random(1)
    rows = [
        (c, t, draw.choice(["user", "a", None]), draw.choice(["x", "yy", "é", "zzz", None]))
        for c in range(300) for t in range(draw.choice([1, 2, 3, 8, 9, 12]))
    ]
    rows += [(500 + c, t, "u", "same") for c in range(300) for t in range(4)]  # a large group of copies
    rows += [(900, t, "u", f"long{t % 7}") for t in range(300)] + [(901, t, "u", f"long{t % 7}") for t in range(290)]
    rows += [(-3, None, None, None), (-3, 1, "q", None), (-3, 1, "q", None), (None, 1, "a", "b"), (1234, 5, "r", "t" * 50_000)]
    rows += [(7000 + c, 1, "b", "tie") for c in range(3)] + [(7000 + c, 1, "a", "tie") for c in range(3)]
    return rows


def found(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.mark.parametrize("rows_a_shard", [20_000, 25, 3])
def test_tries_of_odd_conversations(spark, rows_a_shard):
    rows = rows_of_all_kinds()
    docs = spark.createDataFrame([(*r, 1, "x", b"y", "z") for r in rows], SCHEMA)
    assert found(conversation_trie(docs, rows_a_shard=rows_a_shard)) == sorted(by_hand(rows), key=repr)


def test_without_turns_or_rows(spark):
    # 11 takes all its turns from 10, which is absent: it has none.
    absent = next(c for c in range(11, 500) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    docs = spark.createDataFrame([(absent, 1, "a", "b", 1, "x", b"y", "z")], SCHEMA)
    assert found(conversation_trie(docs)) == [
        (absent, 0, None, 1, 0, 1, 0, hashlib.sha256(str(absent).encode()).hexdigest())
    ]
    assert conversation_trie(docs.limit(0)).count() == 0
