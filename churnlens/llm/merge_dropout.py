"""SentencePiece BPE encoding with seeded merge-dropout, and decoding.

A segment (spaces and what follows up to the next space) starts as characters. The
agenda holds the merges that the vocabulary allows, best score first; each merge
that comes up is skipped with a given probability, decided by a hash of the seed, the
document's key, the place of the segment in it and how many skips came before. So each
occurrence has a segmentation of its own, a seed gives the same pieces on every machine
and another seed other pieces, and any of them decode to the same text.

A segmentation follows from the segment and from which of its merges are skipped. Many
segments are merged side by side, as rows of a matrix: a step takes the best merge of
every row or skips it. Nothing is remembered from one batch to the next.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from math import log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm.tables import small_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
_SEGMENTS = re.compile(rb" +[^ \n]*|\n|[^ \n]+")
_LONGEST = 24  # bytes of a segment that is merged beside others; longer ones go one by one
_AT_ONCE = 1 << 17  # segments
_NO_PIECE = -16  # and below: characters that stand in no piece
_PAD, _NONE = -1, (1 << 31) - 1
_WIDTHS = ((0, 8), (8, 14), (14, _LONGEST))  # bytes of the segments that are merged side by side
_NEVER = 1 << 62
_MIX, _FIRST, _SECOND = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
_ALL = (1 << 64) - 1


def _mixed(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finish of each number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_FIRST)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_SECOND)
    return x ^ (x >> np.uint64(31))


def _mixed_one(x: int) -> int:
    x = (x ^ (x >> 30)) * _FIRST & _ALL
    x = (x ^ (x >> 27)) * _SECOND & _ALL
    return x ^ (x >> 31)


def read_model(path: str) -> list[tuple[str, float, str]]:
    """``(piece, score, kind)`` in id order; ``kind`` is normal, byte or other."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)

    def kind(i: int) -> str:
        if model.is_byte(i):
            return "byte"
        return "other" if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else "normal"

    return [(model.id_to_piece(i), model.get_score(i), kind(i)) for i in range(model.get_piece_size())]


class Codec:
    """Encodes and decodes UTF-8 bytes with a BPE model that has byte pieces."""

    def __init__(self, pieces, dropout: float, seed: int, variants: int | None = None) -> None:
        self.ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == "normal"}
        self.ranks = {p: -s for p, s, kind in pieces if kind == "normal"}
        self.bytes = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == "byte"}
        if len(self.bytes) < 256:
            raise ValueError("the model has no byte pieces: what it doesn't know could not be decoded")
        if any("\n" in p or SPACE in p.lstrip(SPACE) for p in self.ids if len(p) > 1):
            raise ValueError("the model has pieces across spaces or lines")
        plain = [p.replace(SPACE, " ").encode() if kind == "normal" else b"" for p, _, kind in pieces]
        for byte, i in self.bytes.items():
            plain[i] = bytes([byte])
        self.plain = np.array(plain, object)
        self.seed, self.variants = _mixed_one((seed * _MIX + 1) & _ALL), variants
        # How many merges pass before one is skipped is geometric: log(u) over this.
        self.log_kept = log1p(-dropout) if dropout else 0.0
        self._pairs()

    def _gaps(self, draws: np.ndarray) -> np.ndarray:
        """How many merges pass before the next skip, by the draw of each."""
        if not self.log_kept:
            return np.full(len(draws), _NEVER, np.int64)
        uniform = ((draws >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53
        return np.minimum(np.log(uniform) / self.log_kept, 2.0**40).astype(np.int64)

    def _skips(self, first: int, draw: int) -> Iterator[int]:
        """Numbers of the merges that an occurrence skips, by the draw of its first one."""
        while True:
            yield first
            draw = _mixed_one((draw + _MIX) & _ALL)
            first += 1 + int(self._gaps(np.array([draw], np.uint64))[0])

    def _segment(self, segment: bytes, skips: Iterator[int]) -> tuple[int, bytes]:
        """How many merges came up, and the ids; ``skips`` has the numbers of the merges that
        are skipped, in order."""
        text, ranks, ids = segment.decode("utf-8", "replace"), self.ranks, self.ids
        # A literal U+2581 would decode to a space; it goes as bytes, like unknown characters.
        apart = {i for i, c in enumerate(text) if c == SPACE} if SPACE in text else ()
        parts = list(text.replace(" ", SPACE))
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        agenda = []
        for left in range(len(parts) - 1):
            merged = parts[left] + parts[left + 1]
            if merged in ranks and left not in apart and left + 1 not in apart:
                agenda.append((ranks[merged], left, left + 1, merged))
        heapify(agenda)
        count, skip, end = 0, next(skips, _NEVER), len(parts)
        while agenda:
            _, left, right, merged = heappop(agenda)
            # The sides lie next to each other, so equal lengths mean equal pieces.
            if after[left] != right or not parts[left] or len(parts[left]) + len(parts[right]) != len(merged):
                continue  # one side was merged meanwhile
            count += 1
            if count > skip:
                skip = next(skips, _NEVER)
                continue
            parts[left], parts[right] = merged, ""
            right, back = after[right], before[left]
            after[left] = right
            if right < end:
                before[right] = left
                wider = merged + parts[right]
                if wider in ranks and right not in apart:
                    heappush(agenda, (ranks[wider], left, right, wider))
            if back >= 0:
                wider = parts[back] + merged
                if wider in ranks and back not in apart:
                    heappush(agenda, (ranks[wider], back, left, wider))
        out: list[int] = []
        for place, part in enumerate(parts):
            if part in ids and place not in apart:
                out.append(ids[part])
            elif part:
                out += [self.bytes[b] for b in part.encode()]
        return count, array("i", out).tobytes()

    def _pairs(self) -> None:
        """Symbols (pieces, and characters of pieces) and which two of them merge."""
        letters = dict.fromkeys(c for p in self.ids for c in p if c not in self.ids)
        symbols = {**self.ids, **{c: len(self.plain) + i for i, c in enumerate(letters)}}
        self.outside = np.array([ord(c) for c in letters], np.int64)
        codes = {ord(c): i for c, i in symbols.items() if len(c) == 1}
        # Spaces are pieces' U+2581; a literal one is no part of any piece.
        codes[ord(" ")] = codes.pop(ord(SPACE), _NO_PIECE - ord(" "))
        self.letters = np.array(sorted(codes), np.int64)
        self.symbols = np.array([codes[c] for c in self.letters.tolist()], np.int64)
        found = {}
        for piece, i in self.ids.items():
            for at in range(1, len(piece)):
                left, right = symbols.get(piece[:at]), symbols.get(piece[at:])
                if left is not None and right is not None:
                    found[left << 32 | right] = (self.ranks[piece], i)
        order = {rank: i for i, rank in enumerate(sorted({rank for rank, _ in found.values()}))}
        # A hash table with free places, so most searches end at the first.
        size = 1 << (4 * len(found) + 1).bit_length()
        self.pairs = np.full(size, _PAD, np.int64)
        self.pair_ranks, self.pair_symbols = np.full(size, _NONE, np.int32), np.zeros(size, np.int32)
        taken: set[int] = set()
        for name, at in zip(found, self._slots(np.array(list(found), np.int64)).tolist()):
            while at in taken:
                at = (at + 1) % size
            taken.add(at)
            self.pairs[at], self.pair_ranks[at], self.pair_symbols[at] = name, order[found[name][0]], found[name][1]

    def _slots(self, names: np.ndarray) -> np.ndarray:
        return (names.view(np.uint64) * np.uint64(_MIX) >> np.uint64(65 - len(self.pairs).bit_length())).astype(np.int64)

    def _merges(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the merge of two symbols (``_NONE``: none) and the symbol it gives."""
        ranks, merged = np.full(left.shape, _NONE, np.int32), np.zeros(left.shape, np.int32)
        asked = np.flatnonzero((left >= 0) & (right >= 0))
        names = left.ravel()[asked].astype(np.int64) << 32 | right.ravel()[asked]
        at = self._slots(names)
        while len(asked):
            there = self.pairs[at]
            hit = there == names
            ranks.flat[asked[hit]], merged.flat[asked[hit]] = self.pair_ranks[at[hit]], self.pair_symbols[at[hit]]
            on = np.flatnonzero(~hit & (there != _PAD))
            asked, names, at = asked[on], names[on], (at[on] + 1) & (len(self.pairs) - 1)
        return ranks, merged

    def _together(self, parts: np.ndarray, skips: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge all rows of symbols (padded by ``_PAD``) step by step, each with its own
        skips: how many merges came up in each, and the symbols that are left."""
        done, counts = np.full(parts.shape, _PAD, np.int32), np.zeros(len(parts), np.int64)
        rows, number = np.arange(len(parts)), 0
        parts = np.concatenate([parts, np.full((len(parts), 2), _PAD, np.int32)], axis=1)
        ranks, merged = self._merges(parts[:, :-1], parts[:, 1:])
        places = np.arange(parts.shape[1], dtype=np.int32)
        while len(rows):
            at = ranks.argmin(axis=1)
            going = ranks[np.arange(len(rows)), at] < _NONE
            if not going.all():
                over = ~going
                done[rows[over]], counts[rows[over]] = parts[over, : done.shape[1]], number
                rows, parts, ranks, merged = rows[going], parts[going], ranks[going], merged[going]
                skips, draws, at = skips[going], draws[going], at[going]
                if not len(rows):
                    break
            every = np.arange(len(rows))
            skipped = skips == number
            number += 1
            ranks[every[skipped], at[skipped]] = _NONE
            if skipped.any():
                draws[skipped] = _mixed(draws[skipped] + np.uint64(_MIX))
                skips[skipped] += 1 + self._gaps(draws[skipped])
            these = every[~skipped]
            spot = at[these]
            parts[these, spot] = merged[these, spot]
            # What stands right of the merged pair moves up by one.
            moved = np.minimum(places + (places > spot[:, None]), len(places) - 1)
            parts[these] = np.take_along_axis(parts[these], moved, 1)
            moved = np.minimum(moved[:, :-1], len(places) - 2)
            for table in (ranks, merged):
                table[these] = np.take_along_axis(table[these], moved, 1)
            for side in (spot - 1, spot):
                there = side >= 0
                row, column = these[there], side[there]
                ranks[row, column], merged[row, column] = self._merges(parts[row, column], parts[row, column + 1])
        return counts, done

    def _rows(self, segments: list[bytes]) -> np.ndarray:
        """Symbols of the characters of some segments, a row each."""
        texts = [s.decode("utf-8", "replace") for s in segments]
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.int64)
        at = np.minimum(np.searchsorted(self.letters, codes), len(self.letters) - 1)
        symbols = np.where(self.letters[at] == codes, self.symbols[at], _NO_PIECE - codes)
        size = np.array([len(t) for t in texts])
        out = np.full((len(texts), int(size.max())), _PAD, np.int32)
        out[np.arange(out.shape[1]) < size[:, None]] = symbols
        return out

    def encode(self, text: bytes, key: int) -> np.ndarray:
        """Ids of a text. ``key`` and a segment's place in the text tell its occurrences apart;
        with ``variants`` there are only so many of them."""
        return self.encode_all([text], [key])[0]

    def encode_all(self, texts: list[bytes], keys: list[int]) -> list[np.ndarray]:
        """Ids of some texts, as many segments at a time as fit together."""
        segments, skips, draws, sizes, out, ends = [], [], [], [], [], []
        for text, key in zip(texts, keys):
            found = _SEGMENTS.findall(b" " + text) if text else []
            places = np.arange(len(found), dtype=np.uint64) * np.uint64(_MIX)
            turns = _mixed(places + np.uint64(_mixed_one(key & _ALL)))
            if self.variants:
                turns %= np.uint64(self.variants)
            turns = _mixed(turns ^ np.uint64(self.seed))
            segments += found
            draws.append(turns)
            skips.append(self._gaps(turns))
            sizes.append(len(found))
            while len(segments) >= _AT_ONCE:
                allskips, alldraws = np.concatenate(skips), np.concatenate(draws)
                ids, size = self._some(segments[:_AT_ONCE], allskips[:_AT_ONCE], alldraws[:_AT_ONCE])
                out.append(ids)
                ends.append(size)
                segments, skips, draws = segments[_AT_ONCE:], [allskips[_AT_ONCE:]], [alldraws[_AT_ONCE:]]
        if segments:
            ids, size = self._some(segments, np.concatenate(skips), np.concatenate(draws))
            out.append(ids)
            ends.append(size)
        if not out:
            return [np.zeros(0, np.int32) for _ in texts]
        until = np.concatenate([[0], np.cumsum(np.concatenate(ends))])[np.cumsum(sizes)]
        return np.split(np.concatenate(out), until[:-1])

    def _some(self, segments: list[bytes], skips: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some segments, and how many each has.

        Each different segment is merged without skips first; that tells how many merges
        come up, and an occurrence that skips none of them has its ids. The others are
        merged again, each with its own skips.
        """
        numbers: dict[bytes, int] = {}
        of = np.array([numbers.setdefault(s, len(numbers)) for s in segments], np.int64)
        different = list(numbers)
        lengths = np.fromiter(map(len, different), np.int64, len(different))
        merges = np.full(len(different), -1, np.int64)
        tables, row = [], np.full((len(segments), 2), -1, np.int64)
        where = np.full((len(different), 2), -1, np.int64)
        for low, high in _WIDTHS:
            some = np.flatnonzero((lengths > low) & (lengths <= high))
            if not len(some):
                continue
            plain = self._rows([different[i] for i in some.tolist()])
            never = np.full(len(some), _NEVER)
            merges[some], done = self._together(plain, never, np.zeros(len(some), np.uint64))
            where[some, 0], where[some, 1] = len(tables), np.arange(len(some))
            tables.append(done)
            mine = np.zeros(len(different), bool)
            mine[some] = True
            again = np.flatnonzero(mine[of] & (skips < merges[of]))
            if len(again):
                start = np.zeros(len(different), np.int64)
                start[some] = np.arange(len(some))
                _, done = self._together(plain[start[of[again]]], skips[again], draws[again])
                row[again, 0], row[again, 1] = len(tables), np.arange(len(again))
                tables.append(done)
        row = np.where(row >= 0, row, where[of])
        size = np.zeros(len(segments), np.int64)
        lists: list[np.ndarray] = [(t != _PAD).sum(axis=1) for t in tables]
        long = np.flatnonzero(row[:, 0] < 0)
        ids = {}
        for i in long.tolist():
            ids[i] = np.frombuffer(self._segment(segments[i], self._skips(int(skips[i]), int(draws[i])))[1], np.int32)
            size[i] = len(ids[i])
        for k, counts in enumerate(lists):
            here = row[:, 0] == k
            size[here] = counts[row[here, 1]]
        first = np.cumsum(size) - size
        flat = np.zeros(int(size.sum()), np.int64)
        for k, table in enumerate(tables):
            here = np.flatnonzero(row[:, 0] == k)
            got = table[row[here, 1]]
            held = got != _PAD
            flat[(first[here][:, None] + np.arange(table.shape[1]))[held]] = got[held]
        for i, values in ids.items():
            flat[first[i] : first[i] + size[i]] = values
        return self._as_bytes(flat, size)

    def _as_bytes(self, flat: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of symbols; characters that are no pieces become the ids of their bytes."""
        odd = np.flatnonzero((flat < 0) | (flat >= len(self.plain)))
        if not len(odd):
            return flat.astype(np.int32), size
        codes = np.where(flat[odd] < 0, _NO_PIECE - flat[odd], 0)
        inside = flat[odd] >= len(self.plain)
        codes[inside] = self.outside[flat[odd][inside] - len(self.plain)]
        spelt = [[self.bytes[b] for b in chr(c).encode()] for c in codes.tolist()]
        width = np.ones(len(flat), np.int64)
        width[odd] = [len(s) for s in spelt]
        out = np.repeat(flat, width)
        start = (np.cumsum(width) - width)[odd]
        for at, values in zip(start.tolist(), spelt):
            out[at : at + len(values)] = values
        owner = np.repeat(np.arange(len(size)), size)
        return out.astype(np.int32), np.bincount(owner, width, len(size)).astype(np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of a row of ids; the space that was put before it goes."""
        return b"".join(self.plain[ids].tolist())[1:]


_codecs: dict[tuple, Codec] = {}


def _codec(shared, dropout: float, seed: int, variants: int | None) -> Codec:
    """A worker builds a codec once, for all its tasks."""
    name = (shared.id if hasattr(shared, "id") else id(shared), dropout, seed, variants)
    if name not in _codecs:
        _codecs.clear()
        _codecs[name] = Codec(shared.value, dropout, seed, variants)
    return _codecs[name]


class Pieces:
    """Encoding and decoding as column expressions, for one model, seed and dropout."""

    def __init__(
        self, spark: SparkSession, *, model: str = MODEL, dropout: float = 0.1, seed: int = 7, variants: int | None = None
    ) -> None:
        """Each occurrence of a segment has its own skips; ``variants`` would bound them."""
        if not 0 <= dropout < 1 or (variants is not None and variants < 1):
            raise ValueError("dropout must be in [0, 1) and variants at least 1")
        small_batches(spark)
        shared = spark.sparkContext.broadcast(read_model(model))  # the vocabulary: a fixed size

        def id_lists(values: list[np.ndarray]) -> pa.Array:
            sizes = np.cumsum([0, *map(len, values)]).astype(np.int32)
            flat = np.concatenate(values) if values else np.zeros(0, np.int32)
            return pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat, pa.int32()))

        @F.arrow_udf("array<int>")
        def encode(texts: pa.Array, keys: pa.Array) -> pa.Array:
            codec, plain = _codec(shared, dropout, seed, variants), texts.cast(pa.binary()).to_pylist()
            return id_lists(codec.encode_all([t or b"" for t in plain], [k % 2**63 for k in keys.to_pylist()]))

        @F.arrow_udf("struct<piece_ids: array<int>, lossless: boolean>")
        def round_trip(texts: pa.Array, keys: pa.Array) -> pa.Array:
            codec, plain = _codec(shared, dropout, seed, variants), texts.cast(pa.binary()).to_pylist()
            values = codec.encode_all([t or b"" for t in plain], [k % 2**63 for k in keys.to_pylist()])
            same = pa.array([codec.decode(ids) == (t or b"") for t, ids in zip(plain, values)], pa.bool_())
            return pa.StructArray.from_arrays([id_lists(values), same], ["piece_ids", "lossless"])

        @F.arrow_udf("string")
        def decode(ids: pa.Array) -> pa.Array:
            codec = _codec(shared, dropout, seed, variants)
            rows = (codec.decode(row.values.to_numpy()) if row.is_valid else None for row in ids)
            return pa.array(rows, pa.binary()).cast(pa.string())

        # Not to be worked out again where a later filter or column refers to it.
        self._encode, self._decode, self._round_trip = encode, decode, round_trip.asNondeterministic()

    def encode(self, text: Column, key: Column) -> Column:
        """Piece ids; none for a null or empty text. ``key`` is hashed, of any type."""
        return self._encode(text, F.xxhash64(key))

    def decode(self, ids: Column) -> Column:
        return self._decode(ids)

    def round_trip(self, text: Column, key: Column) -> Column:
        """``piece_ids``, and ``lossless``: whether they decode to the text (null: empty).
        One call for both: columns that share an encoding would each work it out."""
        return self._round_trip(text, F.xxhash64(key))


def encoded(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with ``piece_ids`` and ``lossless``: whether the ids decode to the text.

    Texts are encoded whole and as they are: no case folding, no normalisation, no piece
    for the ends. Null and empty texts have no pieces and decode to empty, which counts as
    lossless. A document's id and text are the key of its skips, so rows that repeat both
    get the same pieces. Extra columns stay; of those called like a new one, the new
    one is left.
    """
    pieces = Pieces(docs.sparkSession, **options)
    both = pieces.round_trip(F.col(text_col), F.struct(id_col, text_col))
    plain = docs.drop("piece_ids", "lossless")
    done = plain.withColumn("__pieces", both)
    return done.select(*[F.col(f"`{c}`") for c in plain.columns], "__pieces.piece_ids", "__pieces.lossless")
