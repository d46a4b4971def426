"""Token counts and merge-dropout against plain implementations."""

import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from churnlens.llm import merge_dropout
from churnlens.llm.merge_dropout import Codec, encoded, read_model
from churnlens.llm.token_count import VOCABULARY, Automaton, read_ranks, token_counts

from .cases import ODD, by_id, table

TEXTS = [t or "" for t in ODD] + [
    "Hello  World", " lead", "trail  ", "\n\n x\ty\n", "naïve café, Größe! 12,345.67 ﬁ Å", "🙂🙃 emoji", "a" * 300,
    "tion" * 40, "   ", "unbelievable antidisestablishmentarianism",
]


def longest_match(word, pieces):
    """Greedy word pieces by trying every length."""
    found, rest, first = 0, b" " + word, True
    while rest:
        ends = [n for n in range(1, len(rest) + 1) if rest[:n] in pieces and (first or rest[:1] != b" ")]
        if not ends:
            return 1
        rest, first, found = rest[max(ends) :], False, found + 1
    return found


@pytest.mark.parametrize("seed", range(3))
def test_automaton_counts_greedy_pieces(seed):
    rng = random.Random(seed)
    pieces = [bytes([b]) for b in b"abc "] + [
        (b" " if rng.random() < 0.4 else b"") + bytes(rng.choices(b"abc", k=rng.randint(1, 6))) for _ in range(40)
    ]
    automaton = Automaton(pieces)
    for _ in range(2000):
        word = bytes(rng.choices(b"abc", k=rng.randint(1, 14)))
        assert automaton.count(word) == longest_match(word, set(pieces))


def test_a_word_that_cannot_be_cut_is_one_unknown_piece():
    automaton = Automaton([b" a", b"b", b" ab", b"bc"])
    assert [automaton.count(w) for w in (b"a", b"ab", b"abc", b"abz", b"z", b"abbc")] == [1, 1, 1, 1, 1, 2]


def test_token_counts(spark):
    got = by_id(token_counts(table(spark, ODD)))
    pieces = read_ranks(VOCABULARY)
    known = set(pieces)
    for i, text in enumerate(ODD):
        words = (text or "").encode().split()
        sample = {w: longest_match(w, known) if len(w) < 200 else Automaton(pieces).count(w) for w in set(words)}
        assert got[i] == {
            "doc_id": i, "n_bytes": len((text or "").encode()), "n_words": len(words),
            "n_tokens": sum(sample[w] for w in words),
        }
    assert token_counts(table(spark, []).limit(0)).count() == 0
    assert token_counts(table(spark, [(None, "a b"), (1, "a"), (1, "a")])).count() == 3


@pytest.fixture(scope="module")
def model():
    return read_model(merge_dropout.MODEL)


def test_without_dropout_it_is_the_library(model):
    library = sentencepiece.SentencePieceProcessor(model_file=merge_dropout.MODEL)
    codec = Codec(model, 0.0, 1, 1)
    for text in TEXTS:
        if "▁" in text:
            continue  # a literal one goes as bytes here, so that it comes back
        assert codec.encode(text.encode(), 0).tolist() == library.encode(text), text[:40]


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 0.99])
def test_any_dropout_decodes_to_the_text(model, dropout):
    for seed in (1, 2):
        codec = Codec(model, dropout, seed, 3)
        for key, text in enumerate(TEXTS):
            assert codec.decode(codec.encode(text.encode(), key)) == text.encode()


def test_a_seed_repeats_itself_and_another_varies(model):
    text = TEXTS[-1].encode() * 20
    one, again, other = (Codec(model, 0.3, seed, 4).encode(text, 5) for seed in (1, 1, 2))
    assert one.tolist() == again.tolist() != other.tolist()
    plain = Codec(model, 0.0, 1, 4).encode(text, 5)
    assert len(one) > len(plain)
    assert Codec(model, 0.3, 1, 4).encode(text, 6).tolist() != one.tolist()
    assert set(one.tolist()) <= set(range(len(model)))


def test_encoded_table(spark):
    docs = table(spark, ODD).withColumn("lossless", F.lit("old"))
    got = encoded(docs)
    assert got.columns == [c for c in docs.columns if c != "lossless"] + ["piece_ids", "lossless"]
    rows = by_id(got)
    assert all(r["lossless"] is True for r in rows.values())
    assert [len(rows[i]["piece_ids"]) for i in (0, 1)] == [0, 0]
    assert [rows[i]["text"] for i in range(len(ODD))] == ODD
    assert encoded(docs.limit(0)).count() == 0
    assert encoded(table(spark, [(None, "a b"), (1, None)])).where("lossless").count() == 2


def test_segments_side_by_side_are_merged_like_one_by_one(spark):
    from churnlens.llm import merge_dropout as M

    codec = M.Codec(M.read_model(M.MODEL), 0.3, 5)
    texts = [t.encode() for t in [*ODD, "日本 größte ▁▁ naïve \U0001f600 a-b_c  wordsandwords\n x" * 9] if t]
    for key, text in enumerate(texts):
        segments = M._SEGMENTS.findall(b" " + text)
        turns = M._mixed(np.arange(len(segments), dtype=np.uint64) * np.uint64(M._MIX) + np.uint64(M._mixed_one(key)))
        draws = M._mixed(turns ^ np.uint64(codec.seed))
        plain = [
            np.frombuffer(codec._segment(s, codec._skips(first, draw))[1], np.int32)
            for s, first, draw in zip(segments, codec._gaps(draws).tolist(), draws.tolist())
        ]
        assert np.concatenate(plain).tolist() == codec.encode(text, key).tolist()
    together = codec.encode_all(texts, range(len(texts)))
    assert [t.tolist() for t in together] == [codec.encode(t, k).tolist() for k, t in enumerate(texts)]


def test_the_stage_encodes_once(spark):
    from churnlens.llm.merge_dropout import encoded

    plan = encoded(table(spark, ODD)).where("lossless")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
