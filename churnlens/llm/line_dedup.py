"""Repeated lines, paragraphs or sentences: the earliest occurrence stays, the rest goes.

Units are normalised and hashed to 128 bits, digests are grouped over all documents,
and each document learns which of its units came first. What one digest or document
shuffles is a fixed-size row per unit; texts move once, by document.

A line may say little ("of.", a heading) and repeat by chance, and a passage may start
inside a line. So lines can be cut further at the ends of sentences, and repeated units can
be asked to stand next to each other with some number of words together before they go.
"""

from __future__ import annotations

import re

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.tables import map_batches
from churnlens.operators.materialise import materialise

# A separator belongs to the unit before it and goes with it.
SEPARATORS = {"line": rb"\n", "paragraph": rb"\n[ \t\r\x0b\x0c]*\n\s*", "sentence": rb"\n|[.!?]+[ \t]+"}


def cut(text: bytes, pattern: re.Pattern) -> list[tuple[int, int, bytes]]:
    """``(start, stop, bytes)`` of each unit; offsets count characters and leave the
    separator out."""
    found, byte, char = [], 0, 0
    for match in [*pattern.finditer(text), None]:
        end = match.start() if match else len(text)
        if match is None and byte == end:
            break
        unit = text[byte:end]
        size = len(unit) if unit.isascii() else len(unit.decode("utf-8", "replace"))
        found.append((char, char + size, unit))
        if match:
            char += size + len(match.group().decode("utf-8", "replace"))
            byte = match.end()
    return found


def normal(unit: bytes) -> bytes:
    """A-Z lower-cased, ASCII white space made single spaces, none at the ends."""
    return b" ".join(unit.lower().split())


def heavy_runs(units: list[tuple[int, int, bytes]], gone: list[bool], min_words: int) -> list[bool]:
    """``gone`` without the runs of adjacent units that have fewer words together. Blank
    units neither belong to a run nor end it."""
    out, run, words = [False] * len(units), [], 0
    for i, (_, _, content) in enumerate([*units, (0, 0, b".")]):
        size = len(content.split())
        if i < len(units) and gone[i]:
            run.append(i)
            words += size
        elif size:
            if words >= min_words:
                for k in run:
                    out[k] = True
            run, words = [], 0
    return out


def first_units(docs: DataFrame, unit: str, id_col: str, text_col: str) -> DataFrame:
    """``id_col``, ``starts``: where the units begin that no earlier unit repeats."""
    pattern, kind = re.compile(SEPARATORS[unit]), dict(docs.dtypes)[id_col]

    def hash_units(batches):
        for batch in batches:
            out = {id_col: [], "start": [], "high": [], "low": []}
            for one, text in zip(batch[id_col], batch["text"]):
                for start, _, content in cut(text or b"", pattern):
                    wanted = normal(content)
                    if not wanted:
                        continue
                    digest = xxhash.xxh3_128_digest(wanted)
                    out[id_col].append(one)
                    out["start"].append(start)
                    out["high"].append(int.from_bytes(digest[:8], "big", signed=True))
                    out["low"].append(int.from_bytes(digest[8:], "big", signed=True))
            yield out

    texts = docs.select(id_col, F.col(text_col).alias("text")).where(F.col(id_col).isNotNull())
    units = map_batches(
        texts, {id_col: kind, "text": "binary"}, hash_units,
        f"`{id_col}` {kind}, start int, high bigint, low bigint",
    )
    first = units.groupBy("high", "low").agg(F.min(F.struct(id_col, "start")).alias("first"))
    return first.groupBy(F.col(f"first.{id_col}").alias(id_col)).agg(F.collect_list("first.start").alias("starts"))


def dedup_units(
    docs: DataFrame, *, unit: str = "line", min_words: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with repeated units taken out of ``text_col``, and three more columns:
    ``n_units``, ``n_removed`` and ``removed``, the spans (``start``, ``stop``) that went,
    as character offsets into the original text.

    ``unit`` is ``line``, ``paragraph`` or ``sentence`` (lines, cut after ``.``, ``!`` or
    ``?`` and white space, which go with the unit before). Of equal normalised units the
    one with the smallest (id, offset) stays, also within one document. The others are
    repeated; a run of repeated units next to each other goes if it has ``min_words`` words
    or more together, else it stays whole. Blank units always stay and end no run. A
    null text stays null; rows without an id are left as they are and rank nowhere; rows
    that repeat an id are one document in the ranking and keep the same units. Extra
    columns stay, those called like one of the three new columns are replaced.
    """
    pattern = re.compile(SEPARATORS[unit])
    starts = materialise(first_units(docs, unit, id_col, text_col))
    new = ["n_units", "n_removed", "removed"]
    plain = docs.drop(*new)
    kept = plain.join(starts.withColumnRenamed("starts", "__starts"), id_col, "left").select(*plain.columns, "__starts")

    @F.arrow_udf("struct<text: string, n_units: int, n_removed: int, removed: array<struct<start: int, stop: int>>>")
    def take_out(texts, first, known):
        import pyarrow as pa

        rows = []
        for text, mine, ranked in zip(texts.cast(pa.binary()).to_pylist(), first.to_pylist(), known.to_pylist()):
            units = cut(text or b"", pattern)
            keep = set(mine or ())
            gone = [bool(ranked and u[0] not in keep and normal(u[2])) for u in units]
            gone = heavy_runs(units, gone, min_words)
            rows.append((text, units, [u for u, lost in zip(units, gone) if lost]))
        out = []
        for text, units, gone in rows:
            left = text
            if gone:
                lost = {u[0] for u in gone}
                whole = text.decode("utf-8", "replace")
                ends = [u[0] for u in units[1:]] + [len(whole)]
                left = "".join(whole[u[0] : end] for u, end in zip(units, ends) if u[0] not in lost)
            elif text is not None:
                left = text.decode("utf-8", "replace")
            out.append({
                "text": left, "n_units": len(units), "n_removed": len(gone),
                "removed": [{"start": u[0], "stop": u[1]} for u in gone],
            })
        span = pa.struct([("start", pa.int32()), ("stop", pa.int32())])
        kind = pa.struct([("text", pa.string()), ("n_units", pa.int32()), ("n_removed", pa.int32()), ("removed", pa.list_(span))])
        return pa.array(out, kind)

    done = kept.withColumn("__done", take_out(F.col(text_col), F.col("__starts"), F.col(id_col).isNotNull()))
    return done.select(
        *[F.col("__done.text").alias(c) if c == text_col else F.col(f"`{c}`") for c in plain.columns],
        *[F.col(f"__done.{c}").alias(c) for c in new],
    )
