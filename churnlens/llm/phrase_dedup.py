"""Repeated substrings of a corpus by prefix-free parsing: every byte under a string of
``SPAN`` bytes that also starts earlier goes.

Parsing. The trigger of a string is the place whose rolling hash of ``GRAM`` bytes is the
least in it; a phrase is a maximal run of strings with one trigger, with all their bytes.
Phrases overlap by ``SPAN - 1`` bytes, so every string lies in exactly one phrase, and equal
strings lie in phrases of equal triggers, at the same distance from it. Where a phrase
starts and ends is told by its own bytes, whatever stands around it.

Corpus order. A phrase that has its trigger to itself only needs its first occurrence: the
parse, ordered by document and place, has it. The other phrases are the dictionary. Its
suffixes are sorted in shards, a trigger's phrases together; neighbours that agree in
``SPAN`` bytes are the same string, and the dictionary's order followed by the parse's
gives the earliest. As a string never leaves its phrase, no suffix has to be compared on
into the phrases that follow.

What moves: one hash for each phrase (about 1 in 31 bytes starts one), then only phrases
whose trigger may occur twice. A bitmap tells these. It has a bound; beyond it more
phrases move and the result is the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.tables import map_batches
from churnlens.operators.lookup import lookup
from churnlens.operators.materialise import materialise

SPAN, GRAM = 100, 40
_WIDTH = SPAN - GRAM + 1  # places a trigger can have in a string; fits the bits of a long
BITS_A_TRIGGER = 8
MAX_BITS = 1 << 30
PIECE_BYTES = 1 << 20
PHRASES_A_SORT = 8192
PHRASES_A_SHARD = 512  # of one trigger; more are dealt over shards
_SEGMENT = 15  # log2 of the bits that bitmap_construct_agg packs into one value
_ALL = -1


# Rolling hashes --------------------------------------------------------------------


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


class Rolling:
    """Hashes of byte strings as sums of byte values times powers of an odd number, modulo
    2^64: that of any stretch is the difference of two running sums, moved to place 0."""

    def __init__(self, base: int, seed: int):
        self.base = np.uint64(base | 1)
        self.inverse = np.uint64(pow(base | 1, -1, 1 << 64))
        self.table = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(seed | 1))
        self.powers = self.back = np.ones(1, np.uint64)

    def __reduce__(self):
        return Rolling, (int(self.base), 0), {"table": self.table}

    def sums(self, data: np.ndarray) -> np.ndarray:
        if len(self.powers) <= len(data):
            size = max(len(data) + 1, 1 << 16)
            self.powers, self.back = (
                np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, factor, np.uint64))]) for factor in (self.base, self.inverse)
            )
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.powers[: len(data)], out=out[1:])
        return out

    def between(self, sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (sums[stop] - sums[start]) * self.back[start]


def hashes() -> tuple[Rolling, Rolling]:
    return Rolling(0x5851F42D4C957F2D, 0x2545F4914F6CDD1D), Rolling(0xD6E8FEB86659FD93, 0x369DEA0F31A53F85)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    size, out = 1, values
    while 2 * size <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    return np.minimum(out[: len(out) - (width - size)], out[width - size :]) if size < width else out


class Phrases:
    """The phrases of some pieces of text: piece, start in its text, number of strings,
    trigger, two digests, and the bytes they were cut from."""

    def __init__(self, pieces: list[tuple[int, int, bytes]], rolling: tuple[Rolling, Rolling]):
        self.data = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
        sizes = np.array([len(p[2]) for p in pieces], np.int64)
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        sums, other = (r.sums(self.data) for r in rolling)
        n = len(self.data)
        grams = _mixed((sums[GRAM:] - sums[:-GRAM]) * rolling[0].back[: n - GRAM + 1])
        least = _least(grams, _WIDTH)
        new = np.ones(len(least), bool)
        # The leftmost of equal triggers counts; the one at a string's own start ends with it.
        new[1:] = (least[1:] != least[:-1]) | (grams[: len(least) - 1] == least[:-1])
        held = np.zeros(len(least) + SPAN, bool)
        for start, size in zip(first.tolist(), sizes.tolist()):
            held[start : start + size - SPAN + 1] = True
            new[start] = True
        at = np.flatnonzero(new & held[: len(least)])
        self.piece = np.searchsorted(first, at, "right") - 1
        ends = np.minimum(np.append(at[1:], n), (first + sizes - SPAN + 1)[self.piece])
        self.at, self.count = at, ends - at
        self.row = np.array([p[0] for p in pieces], np.int64)[self.piece]
        self.start = at - first[self.piece] + np.array([p[1] for p in pieces], np.int64)[self.piece]
        self.trigger = least[at].view(np.int64)
        stop = ends + SPAN - 1
        long = self.count.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
        self.one = _mixed(rolling[0].between(sums, at, stop) + long).view(np.int64)
        self.two = _mixed(rolling[1].between(other, at, stop) + long).view(np.int64)

    def earliest(self, chosen: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Of the chosen phrases, the first of each content."""
        order = chosen[np.lexsort((self.start[chosen], ids[chosen], self.two[chosen], self.one[chosen]))]
        new = np.ones(len(order), bool)
        new[1:] = (self.one[order][1:] != self.one[order][:-1]) | (self.two[order][1:] != self.two[order][:-1])
        return order[new]


def cut(texts: list[bytes | None]) -> Iterator[list[tuple[int, int, bytes]]]:
    """Pieces (row, start, bytes) of the texts, together about ``PIECE_BYTES``. Those of a
    longer text overlap, so that every string is in one piece."""
    pieces, size = [], 0
    for row, text in enumerate(texts):
        if text is None or len(text) < SPAN:
            continue
        for start in range(0, len(text) - SPAN + 1, PIECE_BYTES):
            piece = text[start : start + PIECE_BYTES + SPAN - 1]
            if size + len(piece) > 2 * PIECE_BYTES:
                yield pieces
                pieces, size = [], 0
            pieces.append((row, start, piece))
            size += len(piece)
    if pieces:
        yield pieces


def _has(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    place = values & (len(bitmap) * 8 - 1)
    return (bitmap[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)


def _bits(rows: int) -> int:
    return min(MAX_BITS, max(1 << _SEGMENT, 1 << max(0, rows * BITS_A_TRIGGER - 1).bit_length()))


def _bitmap(places: DataFrame, bits: int) -> np.ndarray:
    """Bits of the places (one row each); the driver gets ``bits / 8`` bytes at most."""
    packed = places.groupBy(F.shiftright("place", _SEGMENT).alias("segment")).agg(
        F.bitmap_construct_agg(F.col("place").bitwiseAND((1 << _SEGMENT) - 1)).alias("bitmap")
    )
    found, size = np.zeros(bits // 8, np.uint8), (1 << _SEGMENT) // 8
    for segment, bitmap in packed.collect():
        found[segment * size : (segment + 1) * size] = np.frombuffer(bitmap, np.uint8)
    return found


# Passes over the texts -------------------------------------------------------------


def possible_triggers(docs: DataFrame) -> np.ndarray:
    """Bitmap of the triggers that occur more than once, and of few that do not."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = _bits(2 * total // (_WIDTH + 1))
    rolling = hashes()

    def places(batches):
        for batch in batches:
            for pieces in cut(batch["text"]):
                yield {"place": (Phrases(pieces, rolling).trigger & (bits - 1)).astype(np.int32)}

    counts = map_batches(docs, {"text": "binary"}, places, "place int").groupBy("place").agg(F.count(F.lit(1)).alias("n"))
    return _bitmap(counts.where("n > 1").select("place"), bits)


def first_phrases(docs: DataFrame, triggers) -> DataFrame:
    """Distinct phrases with a possible trigger: ``trigger``, ``one``, ``two``, and the
    document and place of the first (``first.id``, ``first.start``)."""
    rolling = hashes()

    def parse(batches):
        for batch in batches:
            ids = np.array(batch["id"], np.int64)
            for pieces in cut(batch["text"]):
                found = Phrases(pieces, rolling)
                chosen = found.earliest(np.flatnonzero(_has(triggers.value, found.trigger)), ids[found.row])
                yield {
                    "trigger": found.trigger[chosen], "one": found.one[chosen], "two": found.two[chosen],
                    "id": ids[found.row[chosen]], "start": found.start[chosen],
                }

    parsed = map_batches(
        docs, {"id": "bigint", "text": "binary"}, parse, "trigger bigint, one bigint, two bigint, id bigint, start bigint"
    )
    return parsed.groupBy("trigger", "one", "two").agg(F.min(F.struct("id", "start")).alias("first"))


def dictionary(docs: DataFrame, shared: DataFrame, count: int) -> DataFrame:
    """Phrases that share their trigger with others, with their bytes and first occurrence."""
    bits = _bits(2 * count)
    wanted = docs.sparkSession.sparkContext.broadcast(
        _bitmap(shared.select(F.col("one").bitwiseAND(bits - 1).alias("place")).distinct(), bits)
    )
    rolling = hashes()

    def collect(batches):
        for batch in batches:
            ids = np.array(batch["id"], np.int64)
            for pieces in cut(batch["text"]):
                found = Phrases(pieces, rolling)
                chosen = found.earliest(np.flatnonzero(_has(wanted.value, found.one)), ids[found.row])
                spans = zip(found.at[chosen].tolist(), (found.at + found.count + SPAN - 1)[chosen].tolist())
                yield {
                    "trigger": found.trigger[chosen], "one": found.one[chosen], "two": found.two[chosen],
                    "id": ids[found.row[chosen]], "start": found.start[chosen],
                    "phrase": [found.data[a:b].tobytes() for a, b in spans],
                }

    phrases = map_batches(
        docs, {"id": "bigint", "text": "binary"}, collect,
        "trigger bigint, one bigint, two bigint, id bigint, start bigint, phrase binary",
    )
    first = phrases.groupBy("trigger", "one", "two").agg(F.min(F.struct("id", "start", "phrase")).alias("first"))
    return first.select("trigger", "one", "first.*")


# The suffix array of the dictionary ---------------------------------------------------


def suffix_order(phrases: list[bytes], ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """The strings of the phrases in corpus order: by their bytes, then document and place.

    Gives phrase, offset in it, and whether the string differs from the one before, in
    that order; and the strings as rows of bytes, unordered, with their places in it.
    """
    data = np.frombuffer(b"".join(phrases), np.uint8)
    sizes = np.array([len(p) for p in phrases], np.int64)
    counts = sizes - SPAN + 1
    phrase = np.repeat(np.arange(len(phrases)), counts)
    offset = np.arange(len(phrase)) - np.repeat(np.cumsum(counts) - counts, counts)
    spots = (np.cumsum(sizes) - sizes)[phrase] + offset
    strings = np.lib.stride_tricks.sliding_window_view(data, SPAN)[spots]
    padded = np.zeros((len(strings), -(-SPAN // 8) * 8), np.uint8)
    padded[:, :SPAN] = strings
    words = padded.view(">u8").astype(np.uint64)
    order = np.lexsort((starts[phrase] + offset, ids[phrase], *words.T[::-1]))
    new = np.ones(len(order), bool)
    new[1:] = (words[order][1:] != words[order][:-1]).any(axis=1)
    return phrase[order], offset[order], new, strings, order


def _kept_bits(phrase: np.ndarray, offset: np.ndarray, size: int) -> np.ndarray:
    bits = np.zeros(size, np.uint64)
    np.bitwise_or.at(bits, phrase, np.uint64(1) << offset.astype(np.uint64))
    return bits.view(np.int64)


def first_strings(phrases: DataFrame, *, phrases_a_sort: int = PHRASES_A_SORT, phrases_a_shard: int = PHRASES_A_SHARD) -> DataFrame:
    """``id``, ``start``, ``one`` of dictionary phrases and ``kept``: bits of their strings
    that start nowhere earlier. Phrases without one are left out.

    The phrases of a trigger are sorted together. Those of a very common one are dealt
    over shards, whose earliest strings are compared by digest.
    """
    counts = phrases.groupBy("trigger").agg(F.count(F.lit(1)).alias("n"))
    salts = F.ceil(F.col("n") / phrases_a_shard).alias("salts")
    many = materialise(counts.where(F.col("n") > phrases_a_shard).select("trigger", salts))
    salted = lookup(phrases, many, "trigger").withColumn("salt", F.pmod("one", F.coalesce("salts", F.lit(1))))
    salted = salted.withColumn("split", F.col("salts").isNotNull()).drop("salts")
    dealt = salted.repartition("trigger", "salt").sortWithinPartitions("trigger", "salt")

    def solved(held):
        ids, starts = np.array(held["id"], np.int64), np.array(held["start"], np.int64)
        ones, split = np.array(held["one"], np.int64), np.array(held["split"], bool)
        phrase, offset, new, strings, order = suffix_order(held["phrase"], ids, starts)
        whole = new & ~split[phrase]
        bits = _kept_bits(phrase[whole], offset[whole], len(ids))
        some = np.flatnonzero(bits)
        none = [None] * len(some)
        yield {"id": ids[some], "start": starts[some], "one": ones[some], "kept": bits[some], "high": none, "low": none}
        part = np.flatnonzero(new & split[phrase])
        if len(part):
            digests = [xxhash.xxh3_128_digest(strings[i]) for i in order[part].tolist()]
            pairs = np.frombuffer(b"".join(digests), ">i8").reshape(-1, 2).astype(np.int64)
            p = phrase[part]
            yield {
                "id": ids[p], "start": starts[p], "one": ones[p], "kept": offset[part], "high": pairs[:, 0], "low": pairs[:, 1]
            }

    def sort(batches):
        # Groups of phrases are sorted by their trigger as a whole, some thousand at a time.
        names = ["trigger", "salt", "one", "id", "start", "phrase", "split"]
        held, group = {n: [] for n in names}, None
        for batch in batches:
            for values in zip(*(batch[n] for n in names)):
                if values[:2] != group and len(held["id"]) >= phrases_a_sort:
                    yield from solved(held)
                    held = {n: [] for n in names}
                group = values[:2]
                for name, value in zip(names, values):
                    held[name].append(value)
        if held["id"]:
            yield from solved(held)

    kinds = {"trigger": "bigint", "salt": "bigint", "one": "bigint", "id": "bigint", "start": "bigint", "phrase": "binary", "split": "boolean"}
    sorted_ = materialise(map_batches(dealt, kinds, sort, "id bigint, start bigint, one bigint, kept bigint, high bigint, low bigint"))
    place = F.struct("id", (F.col("start") + F.col("kept")).alias("at"), "start", "one")
    earliest = sorted_.where(F.col("high").isNotNull()).groupBy("high", "low").agg(F.min(place).alias("first"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("at") - F.col("start")).cast("int"))
    merged = earliest.select("first.*").groupBy("id", "start", "one").agg(F.bit_or(bit).alias("kept"))
    return sorted_.where(F.col("high").isNull()).select("id", "start", "one", "kept").unionByName(merged)


# Removal -----------------------------------------------------------------------------


def removed_spans(found: Phrases, possible: np.ndarray, firsts: dict[tuple[int, int], int], seen: set, row: int) -> np.ndarray:
    """Starts of the strings of text ``row`` that go."""
    gone = []
    for i in np.flatnonzero(possible & (found.row == row)).tolist():
        start, one, count = int(found.start[i]), int(found.one[i]), int(found.count[i])
        content = (one, int(found.two[i]))
        kept = 0 if content in seen else firsts.get((start, one), 0)
        seen.add(content)
        if kept != _ALL:
            gone += [start + o for o in range(count) if not kept >> o & 1]
    return np.array(gone, np.int64)


def dedup_phrases(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **shards: int) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_bytes``, ``n_removed``, ``n_spans``,
    ``spans`` (``start``, ``stop`` of the maximal removed runs, in bytes) and ``kept``, the
    bytes that are left (not always whole characters).

    A byte goes if a string of 100 bytes over it also starts earlier: in a document with a
    smaller id, or further left in the same. Ids are whole numbers. A null text has no
    bytes. A row without an id is left as it is and is no earlier text of others. Rows that
    repeat an id are one document in that order: a string at the same place of both goes
    from neither. Other columns are not looked at. An empty table gives an empty result. ``shards`` go to
    ``first_strings``; the result does not depend on them.
    """
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("binary").alias("text"))
    ranked = texts.where(F.col("id").isNotNull())
    context = docs.sparkSession.sparkContext
    triggers = context.broadcast(possible_triggers(ranked))
    phrases = materialise(first_phrases(ranked, triggers))
    counts = phrases.groupBy("trigger").agg(F.count(F.lit(1)).alias("n"), F.count(F.lit(1)).alias("weight"))
    several = materialise(counts.where("n > 1"))
    tagged = materialise(lookup(phrases, several, "trigger", weight="weight"))
    shared = tagged.where(F.col("n").isNotNull())
    alone = tagged.where(F.col("n").isNull()).select("first.id", "first.start", "one", F.lit(_ALL).cast("bigint").alias("kept"))
    words = materialise(dictionary(ranked, shared, shared.count()))
    firsts = alone.unionByName(first_strings(words, **shards))
    lists = firsts.groupBy("id").agg(F.collect_list(F.struct("start", "one", "kept")).alias("all"))
    lists = lists.select("id", *[F.col(f"all.{c}").alias(c) for c in ("start", "one", "kept")])

    none = F.lit(None).cast("array<bigint>")
    unranked = texts.where(F.col("id").isNull()).select("id", "text", *[none.alias(c) for c in ("start", "one", "kept")])
    joined = ranked.join(lists, "id", "left").unionByName(unranked)
    rolling = hashes()

    def take_out(batches):
        for batch in batches:
            texts = batch["text"]
            masks: dict[int, np.ndarray] = {}
            known = [None if s is None else dict(zip(zip(s, o), k)) for s, o, k in zip(batch["start"], batch["one"], batch["kept"])]
            asked = [None if one is None else text for one, text in zip(batch["id"], texts)]
            seen: dict[int, set] = {}
            for pieces in cut(asked):
                found = Phrases(pieces, rolling)
                possible = _has(triggers.value, found.trigger)
                for row in np.unique(found.row[possible]).tolist():
                    gone = removed_spans(found, possible, known[row] or {}, seen.setdefault(row, set()), row)
                    if len(gone):
                        mask = masks.setdefault(row, np.zeros(len(texts[row]) + 1, np.int64))
                        np.add.at(mask, gone, 1)
                        inside = gone + SPAN < len(mask)
                        np.add.at(mask, (gone + SPAN)[inside], -1)
            out = {name: [] for name in ("n_bytes", "n_removed", "n_spans", "spans", "kept")}
            for row, text in enumerate(texts):
                text = text or b""
                spans = []
                if row in masks:
                    over = np.cumsum(masks[row])[:-1] > 0
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], over, [False]]).astype(np.int8)))
                    spans = edges.reshape(-1, 2).tolist()
                    kept = np.frombuffer(text, np.uint8)[~over].tobytes()
                else:
                    kept = text
                out["n_bytes"].append(len(text))
                out["n_removed"].append(len(text) - len(kept))
                out["n_spans"].append(len(spans))
                out["spans"].append([{"start": a, "stop": b} for a, b in spans])
                out["kept"].append(kept)
            yield {id_col: batch["id"], **out}

    kinds = {"id": "bigint", "text": "binary", "start": "array<bigint>", "one": "array<bigint>", "kept": "array<bigint>"}
    return map_batches(
        joined, kinds, take_out,
        f"`{id_col}` bigint, n_bytes bigint, n_removed bigint, n_spans bigint, "
        "spans array<struct<start: bigint, stop: bigint>>, kept binary",
    )
