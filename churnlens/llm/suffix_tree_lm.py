"""Language-model scores by a probabilistic suffix tree over bytes.

A text is its words (A-Z lower-cased) with single spaces between and an end. Contexts of
up to six bytes, all 256 values told apart, are counted over all training texts; a
context stays in the tree if its next-symbol distribution diverges enough from that of
its suffix. Distributions are smoothed along the suffixes, and each symbol is scored in
the longest suffix that is in the tree.

The tree grows with the corpus, so it never has to fit anywhere whole: it is two tables,
its grams and its contexts. The contexts seen most often, up to a bounded size, are also
broadcast, and one pass over the texts scores the symbols whose longest context is surely
among them. The other symbols' grams, counted for each text, are joined with the tables.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.llm.context_tree import context_tree
from churnlens.llm.language_id import id_remainder
from churnlens.llm.tables import map_batches
from churnlens.operators.lookup import lookup
from churnlens.operators.materialise import materialise, scratch

DEPTH = 6
DIVERGENCE = 1.0  # nats that a context must save for each of its next symbols
PASS_STATES = 200_000  # contexts of the tree that the pass over the texts holds in memory, for
STATE_ROWS = 10  # so many grams and contexts each
JOIN_BYTES = 16 << 20  # tables of the rest that are broadcast; larger ones are shuffled
GRADES = 8  # steps in which contexts are held, for each doubling of how often they are seen
HOT_SHARE = 500_000  # words with at least one in so many tokens are looked up in memory
WIDE = 8  # bits of a symbol in the operator: every byte is one
_BITS, _END, _OTHER = 6, 0, 63  # the narrow symbols of `symbol_table`
_BLOCK = 1 << 21
_BATCH_BYTES = 1 << 22
_DISTINCT = 1 << 22


# Symbols ----------------------------------------------------------------------


def symbol_table(counts: dict[int, int]) -> np.ndarray:
    """The symbol of each byte: 1 to 62 for the most frequent, one symbol for the rest."""
    table = np.full(256, _OTHER, np.int64)
    for i, byte in enumerate(sorted(range(256), key=lambda b: (-counts.get(b, 0), b))[: _OTHER - 1]):
        table[byte] = i + 1
    return table


def byte_symbols() -> np.ndarray:
    """A symbol of ``WIDE`` bits for each byte. 0xFF, which UTF-8 never has, is the end."""
    return (np.arange(256) + 1) % 256


def stream(texts: list[list[bytes]], table: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of texts (as words) one after the other; where each text's symbols start
    and how many it has, its end included. ``depth`` end symbols stand before each text,
    so no context reaches into the text before."""
    joined = [b" ".join(words) for words in texts]
    sizes = np.array([len(t) for t in joined], int)
    starts = depth + np.concatenate([[0], np.cumsum(sizes[:-1] + depth)]).astype(int) if len(sizes) else sizes
    symbols = np.full(int(sizes.sum()) + depth * (len(sizes) + 1), _END, np.int64)
    for text, start in zip(joined, starts):
        symbols[start : start + len(text)] = table[np.frombuffer(text, np.uint8)]
    return symbols, starts, sizes + 1


def places(starts: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Positions of all symbols of all texts, in blocks."""
    held, count = [], 0
    for start, size in zip(starts.tolist(), sizes.tolist()):
        for at in range(start, start + size, _BLOCK):
            part = np.arange(at, min(at + _BLOCK, start + size))
            held.append(part)
            count += len(part)
            if count >= _BLOCK:
                yield np.concatenate(held)
                held, count = [], 0
    if held:
        yield np.concatenate(held)


def gram_keys(symbols: np.ndarray, at: np.ndarray, depth: int, bits: int = _BITS) -> np.ndarray:
    """A symbol and the ``depth`` before it as one number, the nearest in the lowest bits."""
    key = symbols[at].copy()
    for back in range(1, depth + 1):
        key |= symbols[at - back] << bits * back
    return key


class GramCounts:
    """Counts of grams; what is held stays bounded, as full tables are given out."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        part = np.unique(keys, return_counts=True)
        self.parts.append(part)
        self.size += len(part[0])
        if self.size < _DISTINCT:
            return None
        merged = self.merged()
        if len(merged[0]) < _DISTINCT // 2:
            self.parts, self.size = [merged], len(merged[0])
            return None
        self.parts, self.size = [], 0
        return merged

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys = np.concatenate([p[0] for p in self.parts])
        counts = np.concatenate([p[1] for p in self.parts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return keys[heads], np.add.reduceat(counts, heads)


# The tree ---------------------------------------------------------------------


def _found(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``wanted`` stand in the sorted ``table``, and whether they do."""
    at = np.minimum(np.searchsorted(table, wanted), max(len(table) - 1, 0))
    return at, table[at] == wanted if len(table) else np.zeros(len(wanted), bool)


def _here(part: Any) -> Any:
    """What a broadcast holds; anything else as it is."""
    return part.value if isinstance(part, Broadcast) else part


class Tree:
    """Log10 chances of grams, as sorted arrays for each context size.

    A gram that was counted has its smoothed chance. A context passes on to its suffix what
    it keeps spare for symbols that it has not seen. ``beyond`` are the contexts, for each
    size, that the whole tree extends by some that aren't held here.
    """

    def __init__(
        self,
        rows: Iterable[tuple[np.ndarray, np.ndarray]],
        depth: int,
        unlisted: int,
        states: int,
        bits: int = _BITS,
        beyond: list[np.ndarray] | None = None,
        share: Callable[[Any], Any] = lambda part: part,
    ) -> None:
        """``rows``: for each context size the gram keys and counts of the contexts held, one
        size at a time. The whole tree has ``states`` contexts with the empty one. ``unlisted`` bytes share the
        symbol ``_OTHER``. ``share`` takes the arrays of a size as soon as they are made and may
        give a broadcast for them, so that only two sizes are ever held together here."""
        self.depth, self.bits, self.beyond = depth, bits, share(beyond)
        alphabet, held = 1 << bits, 1
        self.grams, self.contexts = [], []
        for size, (own_keys, own_counts) in enumerate(rows):
            if size == 0:
                counts, types = np.zeros(alphabet), max(len(own_keys), 1)
                counts[own_keys] = own_counts
                keys, chances = np.arange(alphabet), (counts + types / alphabet) / (counts.sum() + types)
                self.base = np.log10(chances)
                continue
            order = np.argsort(own_keys, kind="stable")
            shorter, lower = keys, chances
            keys, chances = own_keys[order], own_counts[order].astype(float)
            own = keys >> bits
            heads = np.flatnonzero(np.diff(own, prepend=-1))
            contexts, types = own[heads], np.diff(np.append(heads, len(keys)))
            weight = np.add.reduceat(chances, heads) + types if len(heads) else types
            del order, own
            chances += np.repeat(types, types) * lower[_found(shorter, keys & ((1 << bits * size) - 1))[0]]
            chances /= np.repeat(weight, types)
            self.grams.append(share((keys, np.log10(chances).astype(np.float32))))
            self.contexts.append(share((contexts, np.log10(types / weight).astype(np.float32))))
            del own_keys, own_counts
            held += len(contexts)
        self.whole = held == states
        self.shared = np.zeros(alphabet)
        self.shared[_OTHER] = np.log10(unlisted)  # bytes of one symbol are alike

    def log_chances(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 chance of the last symbol of each gram, in the longest context of the gram that
        is held; and the size of that context if the whole tree may have a longer one, else -1."""
        logs, far = self.base[keys & ((1 << self.bits) - 1)], np.full(len(keys), -1)
        alive = np.arange(len(keys))
        for size in range(1, self.depth + 1):
            grams, chances = _here(self.grams[size - 1])
            own = keys[alive]
            at, going = _found(grams, own & ((1 << self.bits * (size + 1)) - 1))
            logs[alive[going]] = chances[at[going]]
            # Not counted there: what the context passes on, if there is such a context.
            contexts, spare = _here(self.contexts[size - 1])
            rest = np.flatnonzero(~going)
            above = own[rest] >> self.bits
            at, known = _found(contexts, above & ((1 << self.bits * size) - 1))
            logs[alive[rest[known]]] += spare[at[known]]
            if not self.whole:
                ended = rest[~known]
                short = above[~known] & ((1 << self.bits * (size - 1)) - 1)
                far[alive[ended]] = np.where(_found(_here(self.beyond)[size - 1], short)[1], size - 1, -1)
            going[rest[known]] = True
            alive = alive[going]
        return logs, far

    def scores(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """log10 probability of the symbols at these places, each in its longest suffix held."""
        return self.partial_scores(symbols, at)[0]

    def partial_scores(self, symbols: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
        """Scores as by ``scores``; which places may have a longer context in the whole tree (these
        score 0 instead), the grams there, each with the size of its context held, and the
        chances in that context."""
        # Each different gram is looked up once.
        which, keys = pd.factorize(gram_keys(symbols, at, self.depth, self.bits))
        order = np.argsort(keys)
        logs, reached = np.empty(len(keys)), np.empty(len(keys), np.int64)
        logs[order], reached[order] = self.log_chances(keys[order])
        logs -= self.shared[keys & ((1 << self.bits) - 1)]
        far = reached >= 0
        out = np.flatnonzero(far[which]) if far.any() else np.zeros(0, np.int64)
        own = which[out]
        codes = keys[own] | reached[own] << WIDE * (DEPTH + 1)
        return np.where(far, 0.0, logs)[which], at[out], codes, logs[own]


# The operator -----------------------------------------------------------------


def _words(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def word_counts(texts: DataFrame) -> DataFrame:
    """Partial counts per task: ``word``, ``n``."""

    def count(batches):
        words = Counter()
        for batch in batches:
            for text in batch["text"]:
                words.update(_words(text))
            if len(words) > _DISTINCT // 8:
                yield {"word": list(words), "n": list(words.values())}
                words = Counter()
        yield {"word": list(words), "n": list(words.values())}

    return map_batches(texts, {"text": "binary"}, count, "word binary, n bigint")


def gram_counts(texts: DataFrame, table: np.ndarray, depth: int, bits: int = _BITS) -> DataFrame:
    """``key``, ``n`` of all grams of ``depth + 1`` symbols."""

    def count(batches):
        counts = GramCounts()
        for batch in batches:
            symbols, starts, sizes = stream([_words(t) for t in batch["text"]], table, depth)
            for at in places(starts, sizes):
                if (full := counts.add(gram_keys(symbols, at, depth, bits))) is not None:
                    yield {"key": full[0], "n": full[1]}
        rest = counts.merged()
        yield {"key": rest[0], "n": rest[1]}

    partial = map_batches(texts, {"text": "binary"}, count, "key bigint, n bigint")
    return partial.groupBy("key").agg(F.sum("n").alias("n"))


def tree_contexts(grams: DataFrame) -> DataFrame:
    """``size``, ``context``, ``total``, ``types`` and ``grade`` of the tree's contexts. A suffix
    has no smaller total, and so no lower grade, than what it is a suffix of."""
    own = grams.where(F.col("size") > 0).groupBy("size", F.shiftright("key", WIDE).alias("context"))
    totals = own.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("types"))
    return totals.withColumn("grade", F.floor(F.log2("total") * GRADES).cast("int"))


def least_grade(contexts: DataFrame, rows: int) -> int | None:
    """The lowest grade that can be held with all above it in ``rows`` grams and contexts;
    None if all can. The driver sees a count for each grade, some hundreds at most."""
    counts = contexts.groupBy("grade").agg(F.sum(F.col("types") + 1).alias("n")).collect()
    held, least = 0, None
    for grade, n in sorted(counts, reverse=True):
        held += n
        if held > rows:
            return grade + 1 if least is None else least
        least = grade
    return None


def _code(size: Column, key: Column) -> Column:
    """A gram or context and its size as one number."""
    return F.shiftleft(size.cast("long"), WIDE * (DEPTH + 1)).bitwiseOR(key)


def _last(key: Column, size: Column | int) -> Column:
    """The nearest ``size`` symbols."""
    if isinstance(size, int):
        return key.bitwiseAND(F.lit((1 << WIDE * size) - 1))
    return key.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), size * WIDE) - 1)


def held_tree(grams: DataFrame, contexts: DataFrame, depth: int, least: int | None) -> Tree:
    """The contexts of grade ``least`` and above (None: all) with their grams, broadcast."""
    states, beyond = contexts.count() + 1, None
    if least is not None:
        held = contexts.where(F.col("grade") >= least).select("size", "context")
        short = _last(F.col("context"), F.col("size") - 1)
        out = contexts.where(F.col("grade") < least)
        out = out.select((F.col("size") - 1).alias("size"), short.alias("context")).distinct()
        root = F.col("size") == 0
        edge = out.join(held, ["size", "context"], "left_semi").union(out.where(root)).toArrow().sort_by("context")
        sizes, keys = edge["size"].to_numpy(), edge["context"].to_numpy()
        beyond = [keys[sizes == size] for size in range(depth)]

    def rows(size: int) -> tuple[np.ndarray, np.ndarray]:
        own = grams.where(F.col("size") == size)
        if size and least is not None:
            mine = held.where(F.col("size") == size).select("context")
            own = own.withColumn("context", F.shiftright("key", WIDE)).join(mine, "context", "left_semi")
        found = own.select("key", "n").toArrow()
        return found["key"].to_numpy(), found["n"].to_numpy()

    share = grams.sparkSession.sparkContext.broadcast
    return Tree((rows(size) for size in range(depth + 1)), depth, 1, states, WIDE, beyond, share)


def joined_chances(
    keys: DataFrame, grams: DataFrame, contexts: DataFrame, depth: int, broadcast_bytes: int
) -> DataFrame:
    """``key``, ``log``: the smoothed log10 chance of each distinct ``key``'s last symbol in the
    longest context of the whole tree, which the contexts and grams are joined for.

    ``keys`` have the size of a shorter context in their top bits, and ``log``, the chance in
    it. A key has a row for each longer size, and they are put together from the shortest on.
    """
    reached = F.shiftright("key", WIDE * (DEPTH + 1)).cast("int")
    size = F.explode(F.sequence(reached + 1, F.lit(depth))).alias("size")
    rows = keys.select("key", size)
    rows = rows.select(
        "key",
        "size",
        _code(F.col("size"), _last(F.shiftright("key", WIDE), F.col("size"))).alias("context_code"),
        _code(F.col("size"), _last(F.col("key"), F.col("size") + 1)).alias("gram_code"),
    )
    by_context = contexts.select(_code(F.col("size"), F.col("context")).alias("context_code"), "total", "types")
    by_gram = grams.where(F.col("size") > 0).select(_code(F.col("size"), F.col("key")).alias("gram_code"), "n")
    met = lookup(rows, materialise(by_context), "context_code", how="inner", broadcast_bytes=broadcast_bytes)
    met = lookup(met, materialise(by_gram), "gram_code", broadcast_bytes=broadcast_bytes)
    steps = F.sort_array(F.collect_list(F.struct("size", F.coalesce("n", F.lit(0)).alias("n"), "total", "types")))
    steps = keys.join(met.groupBy("key").agg(steps.alias("steps")), "key", "left")
    start = F.pow(F.lit(10.0), F.col("log"))
    chance = F.aggregate(
        F.coalesce("steps", F.expr("CAST(array() AS array<struct<size:int,n:bigint,total:bigint,types:bigint>>)")),
        start,
        lambda chance, step: (step["n"] + step["types"] * chance) / (step["total"] + step["types"]),
    )
    return steps.select("key", F.log10(chance).alias("log"))


def suffix_tree(training: DataFrame, depth: int, divergence: float) -> tuple[DataFrame, DataFrame]:
    """The tree of the training texts as two written tables: its grams and its contexts. The
    counts of all grams and the steps between are deleted once the tree is written."""
    with scratch(training.sparkSession) as keep:
        counted = materialise(gram_counts(training, byte_symbols(), depth, WIDE))
        grams = keep(context_tree(counted, depth, divergence, WIDE))
    return grams, materialise(tree_contexts(grams))


def gathered(batches: Iterator[dict[str, list]], size: int) -> Iterator[dict[str, list]]:
    """Batches put together until their texts have ``size`` bytes: more grams in common."""
    held, count = None, 0
    for batch in batches:
        held = batch if held is None else {name: held[name] + values for name, values in batch.items()}
        count += sum(len(t or b"") for t in batch["text"])
        if count >= size:
            yield held
            held, count = None, 0
    if held is not None:
        yield held


def tree_scores(tree: Tree, texts: list[list[bytes]], table: np.ndarray) -> tuple[list, list, list, list]:
    """For each text (as words) the score of the symbols that the held tree decides, and the other
    grams with how often they stand in it and their chances in the held tree."""
    symbols, starts, sizes = stream(texts, table, tree.depth)
    if not len(sizes):
        return [], [], [], []
    parts = [tree.partial_scores(symbols, at) for at in places(starts, sizes)]
    values, far_at, far_keys, far_starts = (np.concatenate(part) for part in zip(*parts))
    heads = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(int)
    scores = np.add.reduceat(values, heads).tolist()
    far, far_times, far_logs = [], [], []
    cuts = np.searchsorted(far_at, starts[1:])
    for own, logs in zip(np.split(far_keys, cuts), np.split(far_starts, cuts)):
        keys, first, times = np.unique(own, return_index=True, return_counts=True)
        far.append(keys.tolist())
        far_times.append(times.tolist())
        far_logs.append(logs[first].tolist())
    return scores, far, far_times, far_logs


def held_logs(tree: Tree) -> Callable[[Iterator[dict[str, list]]], Iterator[dict[str, list]]]:
    """For batches of codes of grams that `Tree.partial_scores` gives out: the chance of each in
    the context held, as it gives it. It depends on the gram alone, so it is found once for each."""

    def logs(batches):
        for batch in batches:
            codes = np.array(batch["key"], np.int64)
            keys = codes & ((1 << WIDE * (DEPTH + 1)) - 1)
            order = np.argsort(keys)
            found = np.empty(len(keys))
            if len(keys):
                found[order] = tree.log_chances(keys[order])[0]
            found -= tree.shared[keys & ((1 << tree.bits) - 1)]
            yield {"key": batch["key"], "log": found.tolist()}

    return logs


def score_texts(
    docs: DataFrame,
    *,
    held_out: Column | None = None,
    depth: int = DEPTH,
    divergence: float = DIVERGENCE,
    pass_states: int = PASS_STATES,
    hot_share: int = HOT_SHARE,
    broadcast_bytes: int = JOIN_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: ``id_col``, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score``, ``score``.

    Learns from the rows that aren't held out (by default: crc32 of the id as text is
    divisible by 10) and scores all. ``base_score`` is the smoothed unigram score of the
    tokens (words and one end), exactly; ``score`` the tree's log10 probability of the
    text. Null, empty and blank texts are one end. Without training texts all counts are
    zero and the tree is uniform. A null id counts as an empty text for the split.
    Repeated rows get equal rows; other columns aren't looked at.

    The tree has every context that passes the divergence test. ``pass_states`` only says how
    much of it is in memory (a context counts for ``STATE_ROWS`` grams and contexts of 12
    bytes), and so how many symbols are scored by joins; the scores don't depend on it
    (beyond rounding).

    Words with one in ``hot_share`` tokens or more (so at most that many words) are looked up
    in memory; only the rarer ones are joined, which no word can skew.
    """
    if not 1 <= depth <= DEPTH:
        raise ValueError(f"contexts of 1 to {DEPTH} bytes fit a gram's key")
    held = held_out if held_out is not None else id_remainder(id_col, 10) == 0
    kind = dict(docs.dtypes)[id_col]
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), held.alias("held_out"))
    training = texts.where(~F.col("held_out"))
    context = docs.sparkSession.sparkContext

    with scratch(docs.sparkSession) as keep:
        partial = materialise(word_counts(training.select("text")))
        vocabulary = keep(partial.groupBy("word").agg(F.sum("n").alias("c")))
    n_words, n_distinct = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    n_ends = training.count()
    total, distinct = n_words + n_ends, n_distinct + (n_ends > 0)
    floor = total + 0.1 * (distinct + 1)
    hot = vocabulary.where(F.col("c") * hot_share >= total).toArrow()
    logs = np.log10((hot["c"].to_numpy() + 0.1) / floor).tolist()
    common = context.broadcast(dict(zip(hot["word"].to_pylist(), logs)))
    end = float(np.log10((n_ends + 0.1) / floor))

    grams, contexts = suffix_tree(training.select("text"), depth, divergence)
    tree = held_tree(grams, contexts, depth, least_grade(contexts, pass_states * STATE_ROWS))
    whole, table = tree.whole, byte_symbols()

    def score(batches):
        known = common.value
        for batch in gathered(batches, _BATCH_BYTES):
            words = [_words(t) for t in batch["text"]]
            scores, far, far_times, _ = tree_scores(tree, words, table)
            out = {c: batch[c] for c in ("id", "held_out")} | {"n_tokens": [len(w) + 1 for w in words]}
            out |= {"near_score": scores, "far": far, "far_times": far_times}
            hot_sums, hot_counts, rare, times = [], [], [], []
            for own in words:
                found = [known.get(w) for w in own]
                left = Counter(w for w, log in zip(own, found) if log is None)
                hot_sums.append(end + sum(log for log in found if log is not None))
                hot_counts.append(len(own) - sum(left.values()) + (n_ends > 0))
                rare.append(list(left))
                times.append(list(left.values()))
            yield out | {"hot_sum": hot_sums, "hot_count": hot_counts, "rare": rare, "times": times}

    schema = (
        f"id {kind}, held_out boolean, n_tokens bigint, hot_sum double, hot_count bigint, rare array<binary>,"
        " times array<int>, near_score double, far array<bigint>, far_times array<int>"
    )
    kinds = {"id": kind, "text": "binary", "held_out": "boolean"}
    scored = map_batches(texts, kinds, score, schema).withColumn("row", F.monotonically_increasing_id())
    scored = materialise(scored)
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w"))
    rare = rare.select("row", F.col("w.rare").alias("word"), F.col("w.times").alias("times"))
    counted = rare.join(vocabulary, "word", "left")
    c = F.coalesce("c", F.lit(0))
    sums = counted.groupBy("row").agg(
        F.sum(F.col("times") * F.log10((c + 0.1) / F.lit(floor))).alias("rare_sum"),
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("rare_count"),
    )
    joined = scored.drop("rare", "times", "far", "far_times", "far_logs").join(sums, "row", "left")
    score = F.col("near_score")
    if not whole:
        far = scored.select("row", F.explode(F.arrays_zip("far", "far_times")).alias("g"))
        far = far.select("row", F.col("g.far").alias("key"), F.col("g.far_times").alias("times"))
        with scratch(docs.sparkSession) as keep:
            distinct = far.select("key").distinct()
            keys = materialise(map_batches(distinct, {"key": "bigint"}, held_logs(tree), "key bigint, log double"))
            chances = keep(joined_chances(keys, grams, contexts, depth, broadcast_bytes))
        met = lookup(far, chances, "key", broadcast_bytes=broadcast_bytes)
        far_sums = met.groupBy("row").agg(F.sum(F.col("times") * F.col("log")).alias("far_sum"))
        joined = joined.join(far_sums, "row", "left")
        score = score + F.coalesce("far_sum", F.lit(0.0))
    return joined.select(
        F.col("id").alias(id_col), "held_out", "n_tokens",
        (F.col("hot_count") + F.coalesce("rare_count", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("hot_sum") + F.coalesce("rare_sum", F.lit(0.0))).alias("base_score"), score.alias("score"),
    )
