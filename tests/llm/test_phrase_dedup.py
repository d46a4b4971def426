"""Repeated substrings by phrases against a dictionary of all strings."""

import random

import numpy as np
import pytest

from churnlens.llm import phrase_dedup
from churnlens.llm.phrase_dedup import SPAN, dedup_phrases, suffix_order

from .cases import LONG, ODD, table


def by_hand(rows):
    texts = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for one, text in texts:
        for at in range(len(text) - SPAN + 1 if one is not None else 0):
            string = text[at : at + SPAN]
            first[string] = min(first.get(string, (one, at)), (one, at))
    for one, text in texts:
        gone = bytearray(len(text))
        for at in range(len(text) - SPAN + 1 if one is not None else 0):
            if first[text[at : at + SPAN]] < (one, at):
                gone[at : at + SPAN] = b"\1" * SPAN
        spans, start = [], None
        for at, flag in enumerate([*gone, 0]):
            if flag and start is None:
                start = at
            if not flag and start is not None:
                spans.append((start, at))
                start = None
        yield one, len(text), sum(gone), len(spans), spans, bytes(c for c, g in zip(text, gone) if not g)


def rows_of_all_kinds():
    draw = random.Random(3)
    words = ["the", "of", "ornd", "lim", "pasér", "qu", "strange", "words", "日本", "x"]

    def prose(n):
        return " ".join(draw.choice(words) + str(draw.randrange(50)) for _ in range(n))

    passages, rows = [prose(40) for _ in range(6)], []
    for i in range(150):
        text = prose(draw.randrange(5, 60))
        for _ in range(draw.randrange(4)):
            passage = draw.choice(passages)
            cut = draw.randrange(len(passage) // 2)
            text = text[: len(text) // 2] + passage[cut : cut + len(passage) // 2] + text[len(text) // 2 :]
        rows.append((i * 3 % 151, text))
    base = prose(200)
    for k in range(60):  # near copies
        near = base.split()
        near[draw.randrange(200)] = f"new{k}"
        rows.append((1000 + k, " ".join(near)))
    rows += [(2000, "x" * 3000), (2001, "x" * 2500 + "y"), (2002, "ab" * 900), (2003, "abc" * 600 + base), (2004, base + base)]
    rows += [(None, base), (2007, "x" * (SPAN - 1)), (2008, base), (2008, base), (2009, base[:700]), (2009, base[100:900])]
    return [*rows, (-4, passages[0]), *[(3000 + i, t) for i, t in enumerate(ODD) if t not in (LONG, LONG.upper())]]


def found(frame):
    rows = frame.collect()
    return sorted(((r[0], r[1], r[2], r[3], [tuple(s) for s in r[4]], bytes(r[5])) for r in rows), key=repr)


# A dictionary sorted a few phrases at a time, with common triggers dealt over shards, is the same.
@pytest.mark.parametrize("shards", [{}, {"phrases_a_sort": 5, "phrases_a_shard": 3}])
def test_texts_of_all_kinds(spark, shards):
    rows = rows_of_all_kinds()
    wanted = sorted(by_hand(rows), key=repr)
    assert found(dedup_phrases(table(spark, rows), **shards)) == wanted
    assert sum(r[2] for r in wanted) > 50_000


def test_a_full_bitmap_and_long_texts_in_pieces(spark, monkeypatch):
    rows = [(1, LONG[:60_000]), (2, LONG[20_000:50_000] + "end"), (0, LONG[59_000:61_000]), (3, None), (4, "")]
    docs = table(spark, rows)
    plain = found(dedup_phrases(docs))
    assert plain == sorted(by_hand(rows), key=repr)
    monkeypatch.setattr(phrase_dedup, "MAX_BITS", 1 << 15)
    monkeypatch.setattr(phrase_dedup, "PIECE_BYTES", 700)
    assert found(dedup_phrases(docs)) == plain
    assert dedup_phrases(docs.limit(0)).count() == 0


def test_phrases_hold_every_string_once():
    text = np.random.default_rng(5).integers(97, 100, 5000).astype(np.uint8).tobytes()
    phrases = phrase_dedup.Phrases([(0, 0, text[:3000]), (0, 2901, text[2901:])], phrase_dedup.hashes())
    covered = sorted(s for a, c in zip(phrases.start.tolist(), phrases.count.tolist()) for s in range(a, a + c))
    assert covered == list(range(len(text) - SPAN + 1))
    assert phrases.count.max() <= SPAN - phrase_dedup.GRAM + 1


def test_suffixes_are_in_corpus_order():
    texts = [LONG[i : i + SPAN + 20].encode() for i in (0, 40, 40, 7)]
    ids, starts = np.array([4, 3, 1, 2]), np.array([0, 40, 0, 9])
    phrase, offset, new, _, _ = suffix_order(texts, ids, starts)
    keys = [(texts[p][o : o + SPAN], ids[p], starts[p] + o) for p, o in zip(phrase, offset)]
    assert keys == sorted(keys)
    assert new.tolist() == [i == 0 or keys[i][0] != keys[i - 1][0] for i in range(len(keys))]
