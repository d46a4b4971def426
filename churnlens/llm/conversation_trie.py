"""Prefix trie of conversations, from sorted matrices of turn ids.

A conversation is a row of turn ids. Rows are range-sharded by their whole sequence, ties
by conversation id, so a conversation that occurs very often spans shards. Inside a shard
the rows are one padded matrix, sorted by numpy's lexsort. Column change masks,
OR-accumulated from left to right, mark where a node starts at each depth, and ``reduceat``
over these starts aggregates every depth. Only nodes that hold a shard's first or last row
and go on in the neighbour are incomplete; they are recombined by a digest of their path.

Every aggregate adds up over rows, so parts of a node add up too: tokens saved are the
bytes of all turns less those of node starts, leaves belong to the last row of a sequence
that nothing extends, children to the row where they start.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.tables import map_batches
from churnlens.operators.lookup import lookup
from churnlens.operators.materialise import materialise

# A turn is its 16-byte digest and its text's length in 4 bytes.
_ID, _TURN = 16, 20
_TURN_TYPE = np.dtype([("high", ">u8"), ("low", ">u8"), ("size", ">u4")])
COLUMNS = 64  # of the matrix that are worked on at a time
ROWS_A_SHARD = 20_000
BYTES_A_SHARD = 8 << 20
IDS_A_CHUNK = 4096
NO_ENDS = hashlib.sha256(b"").hexdigest()
NODE = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends_sha256 string"
)
_PART = NODE + ", key binary, parent_key binary, ends string, shard int, chunk int"


# Conversations as rows of turn ids -------------------------------------------------


def conversation_rows(turns: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """``conv_id`` and ``turns``, the conversation's turns in order, 20 bytes each.

    Turns go by ``turn``, null first, equal turns by role and text digest. Rows without a
    conversation id belong to none. A conversation is one row, however long.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    record = F.unhex(F.concat(digest, F.lpad(F.hex(F.octet_length(text)), 8, "0")))
    rows = turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("conv_id"), F.col(turn_col).alias("turn"), record.alias("record")
    )
    # Partitioned by what the next steps group by, so nothing is shuffled again.
    rows = rows.withColumn("family", _family(F.col("conv_id"))).repartition("family")
    grouped = rows.groupBy("family", "conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "record"))).alias("all"))
    joined = F.array_join(F.transform("all", lambda turn: F.hex(turn["record"])), "")
    return grouped.select("family", "conv_id", F.unhex(joined).alias("turns"))


def _family(conv: Column) -> Column:
    return conv - conv % 5


def rebuilt(rows: DataFrame) -> DataFrame:
    """Conversations that start like the first of their five: of ``c`` the first h turns
    come from ``c - c % 5``, h being the CRC-32 of the decimal id modulo 9."""
    heads = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    first = F.when(F.col("conv_id") == F.col("family"), F.substring("turns", 1, 8 * _TURN))
    donor = F.coalesce(F.max(first).over(Window.partitionBy("family")), F.lit(b""))
    table = rows.withColumns({"h": heads, "donor": donor})
    size = F.lit(_TURN)
    taken = F.substring("donor", F.lit(1), F.col("h") * size)
    own = F.substring("turns", F.col("h") * size + 1, F.octet_length("turns"))
    return table.select("conv_id", F.concat(taken, own).alias("turns"))


# One shard -----------------------------------------------------------------------


class _Rows:
    """The sequences of a shard; turn ids are numbered from 1 in the order of their digests."""

    def __init__(self, conv: np.ndarray, turns: list[bytes]):
        self.conv = conv
        self.lens = np.array([len(t) // _TURN for t in turns], np.int64)
        self.ids = np.frombuffer(b"".join(turns), _TURN_TYPE)
        self.first = np.concatenate([[0], np.cumsum(self.lens)[:-1]]).astype(np.int64)
        high, low = self.ids["high"].astype(np.uint64), self.ids["low"].astype(np.uint64)
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        new = np.ones(len(order), bool)
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        self.code = np.empty(len(order), np.int32)
        self.code[order] = np.cumsum(new)
        self.size = self.ids["size"].astype(np.int64)
        self._sort()

    def blocks(self) -> range:
        return range(0, int(self.lens.max(initial=0)), COLUMNS)

    def matrix(self, values: np.ndarray, rows: np.ndarray, column: int) -> np.ndarray:
        """``values`` of the rows' turns from ``column`` on, 0 where a row has ended."""
        width = min(COLUMNS, int(self.lens.max()) - column)
        places = column + np.arange(width)
        there = places < self.lens[rows][:, None]
        spots = np.minimum(self.first[rows][:, None] + places, len(values) - 1)
        return np.where(there, values[spots], 0)

    def _sort(self) -> None:
        rank = np.zeros(len(self.conv), np.int64)
        for column in self.blocks():
            rows = np.flatnonzero(self.lens > column)
            padded = self.matrix(self.code, rows, column)
            keys = (*padded.T[::-1], rank[rows])
            order = np.lexsort(keys)
            new = np.zeros(len(rows), bool)
            for key in keys:
                new[1:] |= key[order][1:] != key[order][:-1]
            place = np.empty(len(rows), np.int64)
            place[order] = np.cumsum(new)
            # Rows that have ended come before those that go on.
            rank *= len(rows) + 1
            rank[rows] += 1 + place
            rank = np.unique(rank, return_inverse=True)[1].astype(np.int64)
        order = np.lexsort((self.conv, rank))
        self.conv, self.lens, self.first = self.conv[order], self.lens[order], self.first[order]

    def path(self, row: int, depth: int) -> Iterator[bytes]:
        """Digests of the row's prefixes of 0 to ``depth`` turns."""
        key = hashlib.md5(b"").digest()
        yield key
        start = int(self.first[row])
        raw = self.ids[start : start + min(depth, int(self.lens[row]))].tobytes()
        for at in range(0, len(raw), _TURN):
            key = hashlib.md5(key + raw[at : at + _ID]).digest()
            yield key


def _masks(rows: _Rows, before: int) -> tuple[list[tuple], np.ndarray]:
    """For each block of columns: alive rows, change mask, which places hold a turn, which
    start a node that no earlier shard has; and how many turns a row shares with the one above."""
    differs, shared, blocks = np.zeros(len(rows.conv), bool), np.zeros(len(rows.conv), np.int64), []
    for column in rows.blocks():
        alive = np.flatnonzero(rows.lens > column)
        padded = rows.matrix(rows.code, alive, column)
        change = np.ones(padded.shape, bool)
        # A row that ended between two others parts them, as does a difference further left.
        apart = (alive[1:] != alive[:-1] + 1) | differs[alive[1:]]
        steps = np.column_stack([apart, padded[1:] != padded[:-1]])
        change[1:] = np.logical_or.accumulate(steps, axis=1)[:, 1:]
        differs[alive[1:]] = change[1:, -1]
        held = padded > 0
        shared[alive[1:]] += (~change[1:] & held[1:]).sum(axis=1)
        starts = change & held
        if alive[0] == 0:
            starts[0] &= column + 1 + np.arange(padded.shape[1]) > before
        blocks.append((column, alive, change, held, starts))
    return blocks, shared


def shard_nodes(conv: np.ndarray, turns: list[bytes], before: int, after: int, shard: int) -> Iterator[dict[str, list]]:
    """The nodes of one shard, those that go on in a neighbour with the ``key`` of their path.

    ``before`` and ``after`` are how many turns the shard's first and last row share with
    the row before and after it, -1 where there is none.
    """
    rows = _Rows(conv, turns)
    conv, lens, n = rows.conv, rows.lens, len(conv)
    blocks, shared = _masks(rows, before)
    leaf = lens > np.concatenate([shared[1:], [after]])
    keys = [list(rows.path(0, before)) if before >= 0 else [], list(rows.path(n - 1, after)) if after >= 0 else []]

    # Bytes saved by the turns from each place on, over the blocks from right to left.
    rest, saved = np.zeros(n, np.int64), []
    for column, alive, _, _, starts in reversed(blocks):
        net = np.where(starts, 0, rows.matrix(rows.size, alive, column))
        saved.append(np.cumsum(net[:, ::-1], axis=1)[:, ::-1] + rest[alive][:, None])
        rest[alive] = saved[-1][:, 0]
    saved.reverse()

    parent_rows, parent_conv, parent_key = np.zeros(0, np.int64), np.zeros(0, np.int64), {}

    def level(depth, alive, change, held, tokens, kids):
        nonlocal parent_rows, parent_conv, parent_key
        cuts = np.flatnonzero(change)
        size = np.diff(np.append(cuts, len(alive)))
        add = [np.add.reduceat(v.astype(np.int64), cuts) for v in (kids, leaf[alive], tokens, lens[alive] == depth)]
        least = np.minimum.reduceat(conv[alive], cuts)
        top, last = alive[cuts], alive[cuts + size - 1]
        keep = held[cuts]
        size, least, top, last = size[keep], least[keep], top[keep], last[keep]
        kids, leaves, tokens, ends = (v[keep] for v in add)

        key = {}
        if before >= depth and len(top) and top[0] == 0:
            key[0] = keys[0][depth]
        if after >= depth and len(top) and last[-1] == n - 1:
            key[len(top) - 1] = keys[1][depth]
        out = {"conv_id": least.tolist(), "depth": [depth] * len(top), "n_convs": size.tolist()}
        out |= {"n_children": kids.tolist(), "n_leaves": leaves.tolist(), "saved_tokens": tokens.tolist()}
        out["key"] = [key.get(i) for i in range(len(top))]
        if depth:
            of = np.searchsorted(parent_rows, top, "right") - 1
            out["parent_key"] = [parent_key.get(p) for p in of.tolist()]
            out["parent_conv_id"] = [
                None if k is not None else c for k, c in zip(out["parent_key"], parent_conv[of].tolist())
            ]
        else:
            out["parent_key"] = out["parent_conv_id"] = [None] * len(top)
        out["ends_sha256"], out["ends"] = [NO_ENDS] * len(top), [None] * len(top)
        out["shard"], out["chunk"] = [shard] * len(top), [0] * len(top)
        more = []
        for i in np.flatnonzero(ends).tolist():
            ids = conv[top[i] : top[i] + ends[i]].tolist()
            if i not in key:
                out["ends_sha256"][i] = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
                continue
            texts = [",".join(map(str, ids[a : a + IDS_A_CHUNK])) for a in range(0, len(ids), IDS_A_CHUNK)]
            out["ends"][i] = texts[0]
            more += [(i, c, t) for c, t in enumerate(texts) if c]
        for i, c, text in more:
            # Further ids of the same part; nothing else of it counts twice.
            for name, value in (("n_convs", 0), ("n_children", 0), ("n_leaves", 0), ("saved_tokens", 0)):
                out[name].append(value)
            for name in ("conv_id", "depth", "key", "parent_key", "parent_conv_id", "ends_sha256", "shard"):
                out[name].append(out[name][i])
            out["ends"].append(text)
            out["chunk"].append(c)
        parent_rows, parent_conv, parent_key = top, least, key
        return out

    whole = np.zeros(n, bool)
    whole[0] = True
    kids = np.zeros(n, np.int64)
    if blocks:
        kids[blocks[0][1]] = blocks[0][4][:, 0]
    tokens = np.zeros(n, np.int64)
    if blocks:
        tokens[blocks[0][1]] = saved[0][:, 0]
    yield level(0, np.arange(n), whole, np.ones(n, bool), tokens, kids)
    for at, (column, alive, change, held, starts) in enumerate(blocks):
        for j in range(change.shape[1]):
            if j + 1 < change.shape[1]:
                kids = starts[:, j + 1]
            else:
                below = np.zeros(n, bool)
                if at + 1 < len(blocks):
                    below[blocks[at + 1][1]] = blocks[at + 1][4][:, 0]
                kids = below[alive]
            yield level(column + j + 1, alive, change[:, j], held[:, j], saved[at][:, j], kids)


# All shards ------------------------------------------------------------------------


def _joined(found: Iterator[dict[str, list]], rows: int = 1 << 14) -> Iterator[dict[str, list]]:
    """The same rows in batches of a bounded size: a level is often one row."""
    held: dict[str, list] = {}
    for out in found:
        for name, values in out.items():
            held.setdefault(name, []).extend(values)
        if len(held["key"]) >= rows:
            yield held
            held = {}
    if held:
        yield held


def _neighbours(shards: DataFrame) -> dict[int, int]:
    """For each shard, how many turns its first row shares with the last one before it.

    Compared on two rows a shard; the driver gets two integers a shard.
    """
    ends = shards.groupBy("shard").agg(F.min("turns").alias("low"), F.max("turns").alias("high"))
    previous = F.lag("high").over(Window.orderBy("shard"))
    pairs = ends.select("shard", "low", previous.alias("high"))

    def compare(batches):
        for batch in batches:
            out = {"shard": batch["shard"], "shared": []}
            for low, high in zip(batch["low"], batch["high"]):
                if high is None:
                    out["shared"].append(-1)
                    continue
                size = min(len(low), len(high)) // _TURN * _TURN
                a, b = (np.frombuffer(t[:size], np.uint8).reshape(-1, _TURN) for t in (low, high))
                differ = np.flatnonzero((a != b).any(axis=1))
                out["shared"].append(int(differ[0]) if len(differ) else size // _TURN)
            yield out

    return dict(map(tuple, map_batches(pairs, {"shard": "int", "low": "binary", "high": "binary"}, compare, "shard int, shared int").collect()))


def _ends(parts: DataFrame) -> DataFrame:
    """``key``, ``ends_sha256``: hash of all ids of a node's parts, shard by shard.

    A hash has one order to be read in, so one task reads the ids of a node; it holds a
    chunk at a time.
    """
    ordered = parts.where(F.col("ends").isNotNull()).select("key", "shard", "chunk", "ends")
    ordered = ordered.repartition("key").sortWithinPartitions("key", "shard", "chunk")

    def read(batches):
        key, state = None, None
        for batch in batches:
            out = {"key": [], "ends_sha256": []}
            for one, text in zip(batch["key"], batch["ends"]):
                if one != key:
                    if state is not None:
                        out["key"].append(key)
                        out["ends_sha256"].append(state.hexdigest())
                    key, state = one, hashlib.sha256()
                    state.update(text)
                else:
                    state.update(b"," + text)
            yield out
        if state is not None:
            yield {"key": [key], "ends_sha256": [state.hexdigest()]}

    return map_batches(ordered, {"key": "binary", "ends": "binary"}, read, "key binary, ends_sha256 string")


def prefix_trie(rows: DataFrame, *, rows_a_shard: int = ROWS_A_SHARD, bytes_a_shard: int = BYTES_A_SHARD) -> DataFrame:
    """One row for each distinct prefix of the conversations ``rows`` (``conv_id``, ``turns``).

    ``conv_id`` is the smallest conversation that starts with the prefix, ``depth`` its
    turns, ``parent_conv_id`` the ``conv_id`` of the prefix one turn shorter (null at the
    root). A conversation without turns is in the root. No conversation, no node.
    """
    rows = materialise(rows.select("conv_id", "turns"))
    count, size = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("turns"))).first()
    parallel = rows.sparkSession.sparkContext.defaultParallelism
    wanted = max(parallel, -(-count // rows_a_shard), -(-(size or 0) // bytes_a_shard))
    # The bounds of a range partitioning differ between runs, so the shard is written down.
    ranged = rows.repartitionByRange(int(wanted), "turns", "conv_id")
    shards = materialise(ranged.withColumn("shard", F.spark_partition_id()))
    before = _neighbours(shards)
    follows = dict(zip(sorted(before), [before[s] for s in sorted(before)[1:]]))

    def nodes(batches):
        held: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for shard, conv, turns in zip(batch["shard"], batch["conv_id"], batch["turns"]):
                convs, texts = held.setdefault(shard, ([], []))
                convs.append(conv)
                texts.append(turns)
        for shard in list(held):
            convs, texts = held.pop(shard)
            found = shard_nodes(np.array(convs, np.int64), texts, before[shard], follows.get(shard, -1), shard)
            yield from _joined(found)

    placed = shards.repartitionById(max(before, default=0) + 1, F.col("shard"))
    parts = materialise(map_batches(placed, {"shard": "int", "conv_id": "bigint", "turns": "binary"}, nodes, _PART))

    columns = [c.split()[0] for c in NODE.split(", ")]
    whole = parts.where(F.col("key").isNull()).select(*columns, "parent_key")
    open_parts = parts.where(F.col("key").isNotNull())
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    merged = open_parts.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent_conv_id").alias("parent_conv_id"),
        F.min("parent_key").alias("parent_key"), *sums,
    )
    merged = materialise(merged.join(_ends(open_parts), "key", "left").fillna({"ends_sha256": NO_ENDS}))
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("merged_conv_id"))
    found = lookup(whole.unionByName(merged.select(*columns, "parent_key")), parents, "parent_key")
    parent = F.coalesce("merged_conv_id", "parent_conv_id")
    return found.select(*[parent.alias(c) if c == "parent_conv_id" else F.col(c) for c in columns])


def conversation_trie(turns: DataFrame, **options) -> DataFrame:
    """The prefix trie of the rebuilt conversations of ``turns`` (``conv_id``, ``turn``,
    ``role``, ``text``): ``prefix_trie`` of ``rebuilt`` of ``conversation_rows``.

    A null role or text is empty. Rows without a ``conv_id`` belong to no conversation.
    Equal turn numbers go by the digest of role and text; a repeated row is a turn of its
    own. Other columns are not looked at. An empty table gives an empty trie.
    """
    return prefix_trie(rebuilt(conversation_rows(turns)), **options)
