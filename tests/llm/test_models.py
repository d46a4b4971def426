"""The language network and the suffix tree against plain computations."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from churnlens.llm.context_tree import context_tree, divergent_contexts
from churnlens.llm.language_id import Network, cut_segments, identify_languages
from churnlens.llm.suffix_tree_lm import (
    GramCounts, Tree, gram_counts, gram_keys, places, score_texts, stream, symbol_table,
)

from .cases import ODD, by_id, table

WORDS = {"en": "the and with from there which".split(), "de": "der und mit für größe über".split()}


def lines(lang, seed, n=25):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(WORDS[lang], n))


def test_gradients_are_the_slopes_of_the_loss():
    network = Network(["a", "b", "c"], hidden=3, seed=4)
    network.weights = {k: v.astype(np.float64) for k, v in network.weights.items()}
    data, sizes, _ = cut_segments([b"some bytes", b"other", b"x"], 10)
    valid = (np.arange(10) < sizes[:, None]).astype(np.float64)
    wanted = np.array([0, 2, 1])
    _, slopes = network.gradients(data, valid, wanted)
    rng = np.random.default_rng(0)
    for name, weight in network.weights.items():
        rows = [ord("o"), ord("t"), ord("x")] if name.endswith("_in") else range(weight.shape[0])
        for row in rows:
            at = (row,) if weight.ndim == 1 else (row, rng.integers(weight.shape[1]))
            kept, step = weight[at], 1e-2
            weight[at] = kept + step
            more = network.gradients(data, valid, wanted)[0]
            weight[at] = kept - step
            less = network.gradients(data, valid, wanted)[0]
            weight[at] = kept
            assert math.isclose((more - less) / (2 * step), slopes[name][at], rel_tol=0.03, abs_tol=2e-4), (name, at)


def test_padding_changes_nothing():
    network = Network(["a", "b"], hidden=4)
    texts = [b"short", b"a text of more than one segment " * 5, b"z"]
    together = network.pooled(texts)
    alone = np.concatenate([network.pooled([t]) for t in texts])
    assert np.allclose(together, alone, atol=1e-5)
    assert np.allclose(together.sum(axis=1), 1, atol=1e-4)


def test_languages(spark):
    rows = [(i, lines("en" if i % 2 else "de", i), "en" if i % 2 else "de") for i in range(200)]
    docs = spark.createDataFrame([*rows, (900, "12 !?", "en"), (901, None, "en"), (902, "", None)], "doc_id long, text string, lang string")
    got = by_id(identify_languages(docs, rounds=60))
    assert len(got) == 203
    held = {i for i in got if zlib.crc32(str(i).encode()) % 4 == 2}
    assert {i for i, r in got.items() if r["held_out"]} == held
    right = [got[i]["lang_pred"] == lang for i, _, lang in rows if i in held]
    assert len(right) > 20 and sum(right) >= 0.95 * len(right)
    assert [(got[i]["lang_pred"], got[i]["score"]) for i in (900, 901, 902)] == [("und", 0.0)] * 3
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_languages_of_odd_texts_and_without_labels(spark):
    got = by_id(identify_languages(table(spark, ODD), rounds=5))
    assert {i for i, r in got.items() if r["lang_pred"] == "und"} == {0, 1, 2, 14}
    assert {r["lang_pred"] for r in got.values()} == {"und", "en"}
    bare = spark.createDataFrame([(1, "text", None), (None, "text", "en")], "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in identify_languages(bare).collect()} == {"und"}
    assert identify_languages(bare.limit(0)).count() == 0


# The suffix tree --------------------------------------------------------------


def symbols_of(text, symbols):
    return [*symbols[np.frombuffer(b" ".join(text), np.uint8)].tolist(), 0]


def test_grams_do_not_reach_into_other_texts():
    symbols = symbol_table(Counter(b"a bc d"))
    texts = [[b"ab", b"c"], [], [b"d"]]
    flat, starts, sizes = stream(texts, symbols, 3)
    keys = np.concatenate([gram_keys(flat, at, 3) for at in places(starts, sizes)]).tolist()
    wanted = []
    for text in texts:
        own = [0, 0, 0, *symbols_of(text, symbols)]
        wanted += [sum(own[i - d] << 6 * d for d in range(4)) for i in range(3, len(own))]
    assert keys == wanted


def test_counts_survive_merging(monkeypatch):
    monkeypatch.setattr("churnlens.llm.suffix_tree_lm._DISTINCT", 64)
    rng, counts, total = np.random.default_rng(1), GramCounts(), Counter()
    given = Counter()
    for _ in range(50):
        keys = rng.integers(0, 200, 40)
        total.update(keys.tolist())
        if (full := counts.add(keys)) is not None:
            for k, n in zip(*full):
                given[int(k)] += int(n)
    for k, n in zip(*counts.merged()):
        given[int(k)] += int(n)
    assert given == total


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(3)
    return [" ".join(rng.choice(["ab", "abc", "bca", "The", "é"], 12)) for _ in range(80)]


def test_tree_is_the_plain_one(spark, corpus):
    depth, limit = 3, 2.0
    texts = [t.encode().lower().split() for t in corpus]
    symbols = symbol_table(Counter(b"".join(b" ".join(t) for t in texts)))
    counts = [Counter() for _ in range(depth + 1)]
    for text in texts:
        own = [0] * depth + symbols_of(text, symbols)
        for i in range(depth, len(own)):
            for size in range(depth + 1):
                counts[size][tuple(own[i - size : i + 1])] += 1
    nexts = [dict() for _ in counts]
    for size, grams in enumerate(counts):
        for gram, n in grams.items():
            nexts[size].setdefault(gram[:-1], {})[gram[-1]] = n
    kept = {()}
    for size in range(1, depth + 1):
        for context, own in nexts[size].items():
            total, short = sum(own.values()), nexts[size - 1][context[1:]]
            gain = sum(n * math.log(n / total * sum(short.values()) / short[x]) for x, n in own.items())
            if gain >= limit * len(own):
                kept |= {context[k:] for k in range(size)}

    def chance(context, x):
        own = nexts[len(context)][context]
        lower = chance(context[1:], x) if context else 1 / 64
        return (own.get(x, 0) + len(own) * lower) / (sum(own.values()) + len(own))

    frame = spark.createDataFrame([(t,) for t in corpus], "text string")
    code = lambda c: sum(x << 6 * d for d, x in enumerate(reversed(c)))
    grams = gram_counts(frame, symbols, depth)
    levels = [spark.createDataFrame([(code(g), n) for g, n in own.items()], "key long, n long") for own in counts]
    found = {(r["size"], r["context"]) for r in divergent_contexts(levels, limit, 6).collect()}
    assert found == {(len(c), code(c)) for c in kept if c}
    wanted = sorted((size, code(g), n) for size, own in enumerate(counts) for g, n in own.items() if g[:-1] in kept)
    assert sorted(map(tuple, context_tree(grams, depth, limit, 6).collect())) == wanted

    rows = []
    for size in range(depth + 1):
        held = {code(g): n for g, n in counts[size].items() if g[:-1] in kept}
        rows.append((np.array(sorted(held), np.int64), np.array([held[k] for k in sorted(held)])))
    tree = Tree(rows, depth, int((symbols == 63).sum()), len(kept))
    for text in [*texts[:5], [b"zzz", b"ab"], []]:
        own = [0] * depth + symbols_of(text, symbols)
        wanted = 0.0
        for i in range(depth, len(own)):
            context = next(tuple(own[k:i]) for k in range(i - depth, i + 1) if tuple(own[k:i]) in kept)
            wanted += math.log10(chance(context, own[i])) - (own[i] == 63) * math.log10((symbols == 63).sum())
        flat, starts, sizes = stream([text], symbols, depth)
        got = sum(tree.scores(flat, at).sum() for at in places(starts, sizes))
        assert math.isclose(got, wanted, rel_tol=1e-4)


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_tree_does_not_depend_on_where_the_grams_are_cut(spark, partitions):
    depth, limit, bits, rng = 3, 0.4, 3, np.random.default_rng(partitions)
    keys = np.unique(rng.integers(0, 1 << bits * (depth + 1), 700) & rng.integers(0, 1 << bits * (depth + 1), 700))
    grams = [(int(k), int(n)) for k, n in zip(keys, rng.integers(1, 30, len(keys)))]
    counts = [Counter() for _ in range(depth + 1)]
    for size in range(depth + 1):
        for k, n in grams:
            counts[size][k & (1 << bits * (size + 1)) - 1] += n
    totals = [Counter() for _ in counts]
    kept = {(0, 0)}
    for size, own in enumerate(counts):
        for k, n in own.items():
            totals[size][k >> bits] += n
    for size in range(1, depth + 1):
        gains, types = Counter(), Counter(k >> bits for k in counts[size])
        for k, n in counts[size].items():
            short = k & (1 << bits * size) - 1
            gains[k >> bits] += n * math.log(
                n / totals[size][k >> bits] * totals[size - 1][short >> bits] / counts[size - 1][short]
            )
        for c, gain in gains.items():
            if gain >= limit * types[c]:
                kept |= {(s, c & (1 << bits * s) - 1) for s in range(1, size + 1)}
    wanted = sorted((s, k, n) for s, own in enumerate(counts) for k, n in own.items() if (s, k >> bits) in kept)
    assert 20 < len(kept) < sum(map(len, totals))
    before = {name: spark.conf.get(name) for name in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        frame = spark.createDataFrame(grams, "key long, n long")
        assert sorted(map(tuple, context_tree(frame, depth, limit, bits).collect())) == wanted
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_scores_of_odd_texts(spark, corpus):
    texts = [*ODD, *corpus, "unheard words only"]
    got = by_id(score_texts(table(spark, texts), hot_share=50))
    tokens = {i: [*(t or "").encode().lower().split(), None] for i, t in enumerate(texts)}
    held = {i for i in tokens if zlib.crc32(str(i).encode()) % 10 == 0}
    c = Counter(w for i, own in tokens.items() if i not in held for w in own)
    n, v = sum(c.values()), len(c)
    assert {i for i, r in got.items() if r["held_out"]} == held
    for i, own in tokens.items():
        row = got[i]
        assert (row["n_tokens"], row["train_tokens"]) == (len(own), n)
        assert row["n_known"] == sum(c[w] > 0 for w in own)
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        assert math.isclose(row["base_score"], base, rel_tol=1e-9)
        assert row["score"] < 0
    assert got[0]["score"] == got[1]["score"] == got[2]["score"]


def test_scores_do_not_depend_on_the_passes(spark, corpus):
    texts = table(spark, [*ODD, *corpus, corpus[0]])
    repeated = texts.union(texts.limit(7))
    one = sorted(map(tuple, score_texts(repeated, divergence=0.1).select("doc_id", "score").collect()))
    many = score_texts(repeated, divergence=0.1, pass_states=400).select("doc_id", "score").collect()
    assert [r[0] for r in one] == [r[0] for r in sorted(many)]
    assert np.allclose([r[1] for r in one], [r[1] for r in sorted(many)])


def test_scores_without_training_texts(spark):
    rows = score_texts(table(spark, [(None, "a b"), (None, None)])).collect()
    assert [r["train_tokens"] for r in rows] == [0, 0] and all(r["held_out"] for r in rows)
    assert sorted(r["n_tokens"] for r in rows) == [1, 3]
    assert score_texts(table(spark, []).limit(0)).count() == 0
