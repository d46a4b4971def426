"""Suffix tree scores of texts in many scripts against a plain computation."""

import math
import zlib

import numpy as np

from churnlens.llm.suffix_tree_lm import score_texts

from .cases import by_id, table


def plain_scores(texts, train, depth, limit):
    coded = [[256] * depth + [*" ".join(t.lower().split()).encode(), 256] for t in texts]
    counts = [{} for _ in range(depth + 1)]
    for own in (coded[i] for i in train):
        for i in range(depth, len(own)):
            for size in range(depth + 1):
                nexts = counts[size].setdefault(tuple(own[i - size : i]), {})
                nexts[own[i]] = nexts.get(own[i], 0) + 1
    kept = {()}
    for size in range(1, depth + 1):
        for context, own in counts[size].items():
            short, total = counts[size - 1][context[1:]], sum(own.values())
            gain = sum(n * math.log(n / total * sum(short.values()) / short[x]) for x, n in own.items())
            if gain >= limit * len(own):
                kept |= {context[k:] for k in range(size)}

    def chance(context, x):
        own = counts[len(context)][context]
        lower = chance(context[1:], x) if context else 1 / 256
        return (own.get(x, 0) + len(own) * lower) / (sum(own.values()) + len(own))

    longest = lambda own, i: next(c for k in range(i - depth, i + 1) if (c := tuple(own[k:i])) in kept)
    return [sum(math.log10(chance(longest(o, i), o[i])) for i in range(depth, len(o))) for o in coded]


def test_rare_scripts_keep_their_contexts(spark):
    rng = np.random.default_rng(5)
    common = "abcdefghijklmnopqrstuvwxyz0123456789.,:;!?-()[]'\"%&/=+*#@<>{}|~$éèüößäñçàù"
    texts = ["".join(rng.choice([*common, " "], 60)) for _ in range(150)]
    texts += ["жук лук жук лук щука", "αβγ δεζ αβγ δεζ", "日本語 日本 中国語", "سلام دنیا سلام"] * 3
    texts += ["жук лук жук", "кжу клу кжу", "日本語", "本日語", "ю", "ༀ"]
    train = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 10]
    wanted = plain_scores(texts, train, 4, 0.5)
    for states in (200_000, 3000):
        got = by_id(score_texts(table(spark, texts), depth=4, divergence=0.5, pass_states=states))
        assert np.allclose([got[i]["score"] for i in range(len(texts))], wanted, rtol=1e-4)
    assert abs(got[len(texts) - 6]["score"] - got[len(texts) - 5]["score"]) > 0.5  # of equal shape


def test_scores_by_joins_are_the_plain_ones(spark):
    """A tree held in part, down to no context at all, scores like the whole one."""
    rng = np.random.default_rng(8)
    texts = [" ".join(rng.choice(["ab", "abc", "bca", "The", "é", "日本", "q"], 14)) for _ in range(90)]
    texts += [None, "", "unheard zzz", texts[0], "ab " * 400]
    train = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 10]
    wanted = plain_scores([t or "" for t in texts], train + [i for i in train if i == 0], 5, 0.3)
    repeated = table(spark, texts).union(table(spark, texts[:1]))
    for states in (0, 8):
        rows = score_texts(repeated, depth=5, divergence=0.3, pass_states=states)
        got = by_id(rows)
        assert rows.count() == len(texts) + 1
        assert np.allclose([got[i]["score"] for i in range(len(texts))], wanted, rtol=1e-5)


def test_joins_by_salted_keys(spark):
    """The same scores when no table is small enough to be broadcast."""
    rng = np.random.default_rng(9)
    texts = [" ".join(rng.choice(["ab", "abc", "bca", "The"], 14)) for _ in range(60)]
    train = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 10]
    wanted = plain_scores(texts, train, 3, 0.3)
    got = by_id(score_texts(table(spark, texts), depth=3, divergence=0.3, pass_states=1, broadcast_bytes=0))
    assert np.allclose([got[i]["score"] for i in range(len(texts))], wanted, rtol=1e-5)
