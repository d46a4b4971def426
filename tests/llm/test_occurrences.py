"""Every occurrence of a segment has skips of its own."""

from collections import Counter

import pytest

from churnlens.llm import merge_dropout
from churnlens.llm.merge_dropout import Codec, encoded, read_model

from .cases import table


@pytest.fixture(scope="module")
def model():
    return read_model(merge_dropout.MODEL)


def test_skips_come_at_the_rate_of_the_dropout(model):
    codec, plain = Codec(model, 0.1, 7), Codec(model, 0.0, 7)
    merges = plain._segment(b" there", iter(()))[0]
    whole = plain.encode(b"there", 0).tolist()
    kept = sum(codec.encode(b"there", key).tolist() == whole for key in range(20_000)) / 20_000
    # A run without any skip gives the plain pieces; some runs with one do too.
    assert 0.9**merges - 0.015 < kept < 1 and merges > 2
    one = next(w for w in (b"to", b"at", b"in") if plain._segment(w, iter(()))[0] == 1)
    found = Counter(codec._segment(one, iter((n,) if n == 0 else ()))[1] for n in (0, 1))
    assert len(found) == 2


def test_a_frequent_word_has_more_than_four_segmentations(model):
    codec = Codec(model, 0.1, 7)
    seen = Counter(codec.encode(b"unbelievable", key).tobytes() for key in range(3000))
    assert len(seen) > 8
    remembered = [codec.encode(b"a few plain words there", k).tolist() for k in range(200)]
    fresh = [Codec(model, 0.1, 7) for _ in range(3)]
    assert [c.encode(b"a few plain words there", 5 * i).tolist() for i, c in enumerate(fresh)] == remembered[:15:5]


def test_documents_have_their_own_pieces(spark):
    docs = table(spark, [(i, "unbelievable") for i in range(300)] + [(None, "unbelievable")] * 2 + [(4, "unbelievable")])
    rows = encoded(docs).collect()
    assert all(r["lossless"] for r in rows)
    assert len({tuple(r["piece_ids"]) for r in rows}) > 4
    assert len({tuple(r["piece_ids"]) for r in rows if r["doc_id"] == 4}) == 1
