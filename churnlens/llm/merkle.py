"""Merkle tree over a dataset: one leaf a row, one subtree a language, proofs that fold.

A level of the tree is kept in aligned blocks, each as one string of concatenated hex
digests. Parents are hashes of fixed-width substrings of it, the siblings of a node are
the substrings at its flanks. The tops of the blocks are the nodes of the next round
(``block_levels`` levels higher), until each subtree has one; the subroots then go the
same way. No task holds more than a block, whatever a language's share of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.operators.lookup import lookup
from churnlens.operators.materialise import materialise
from churnlens.operators.order import with_position

ARITY = 2
BLOCK_LEVELS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_HEX = 64
_KEY = "__key"


def stated(value: Column) -> Column:
    """``-`` for null, else the value's UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(row: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[stated(row[f]) for f in FIELDS]), 256)


def part_of(level: Column, first: Column, nodes: Column | int) -> Column:
    """``nodes`` digests of a level from node ``first`` on; those there are, at its end.

    Levels are binary (hex digits as bytes), where a substring costs its length only.
    """
    length = nodes * _HEX if isinstance(nodes, Column) else F.lit(nodes * _HEX)
    return F.substring(level, first * _HEX + 1, length)


def _upwards(arity: int):
    def step(levels: Column, _: Column) -> Column:
        below = F.element_at(levels, -1)
        runs = F.ceil(F.octet_length(below) / F.lit(_HEX * arity)).cast("int")
        hashes = F.transform(F.sequence(F.lit(0), runs - 1), lambda i: F.sha2(part_of(below, i * arity, arity), 256))
        return F.concat(levels, F.array(F.array_join(hashes, "").cast("binary")))

    return step


def _blocks(nodes: DataFrame, arity: int, block_levels: int, extra: list[str]) -> DataFrame:
    """Aligned blocks of ``nodes`` (``grp``, ``pos``, ``total``, ``node``, extra columns).

    A subtree of one block is climbed until one node is left, one of several blocks by
    all its levels: a short last block then hashes its lone nodes up like any other.
    """
    size = arity**block_levels
    rows = F.sort_array(F.collect_list(F.struct("pos", "node", *extra)))
    held = nodes.groupBy("grp", F.floor(F.col("pos") / size).alias("block")).agg(
        rows.alias("rows"), F.first("total").alias("total")
    )
    needed = sum([(F.col("total") > arity**k).cast("int") for k in range(block_levels)], F.lit(0))
    bottom = F.array_join(F.col("rows.node"), "").cast("binary")
    levels = F.aggregate(F.array_repeat(F.lit(0), needed), F.array(bottom), _upwards(arity))
    return held.withColumns({"levels": levels, _KEY: F.concat_ws("/", "grp", "block")})


def _climb(nodes: DataFrame, arity: int, block_levels: int, extra: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """The block tables of all rounds, and ``grp``, ``pos`` (0), ``node`` of each subroot."""
    size, tables = arity**block_levels, []
    while True:
        blocks = materialise(_blocks(nodes, arity, block_levels, extra))
        tables.append(blocks)
        nodes, extra = blocks.select(
            "grp", F.col("block").alias("pos"), F.ceil(F.col("total") / size).cast("long").alias("total"),
            F.element_at("levels", -1).cast("string").alias("node"),
        ), []
        if (nodes.agg(F.max("total")).first()[0] or 1) == 1:
            return tables, nodes


def _siblings(levels: Column, at: Column, arity: int) -> Column:
    """``left`` and ``right`` flank of node ``at`` in its run, for every level but the top."""

    def flanks(k: Column, level: Column) -> Column:
        here = F.floor(at / F.pow(F.lit(float(arity)), k)).cast("int")
        inside = here % arity
        left = part_of(level, here - inside, inside)
        right = part_of(level, here + 1, F.lit(arity - 1) - inside)
        return F.struct(left.cast("string").alias("left"), right.cast("string").alias("right"))

    below = F.slice(levels, F.lit(1), F.size(levels) - 1)
    return F.transform(below, lambda level, k: flanks(k, level))


def _nodes_with_path(blocks: DataFrame, arity: int, extra: list[str], attached: list[str]) -> DataFrame:
    """Every node of ``blocks`` (with ``above``, the block's own path) and its path to the root."""
    paths = F.transform(
        "rows",
        lambda row, i: F.struct(
            row["pos"].alias("pos"), row["node"].alias("node"), *[row[c].alias(c) for c in extra],
            F.concat(_siblings(F.col("levels"), i, arity), F.col("above")).alias("path"),
        ),
    )
    return blocks.select("grp", *attached, F.inline(paths))


def _descend(tables: list[DataFrame], above: DataFrame, arity: int, attached: list[str]) -> DataFrame:
    """Blocks of the lowest table with ``above``, the path from their top to the root.

    ``above`` has it for each subtree (``grp``), and the ``attached`` columns.
    """
    top = above.withColumn(_KEY, F.concat_ws("/", "grp", F.lit(0))).drop("grp")
    for blocks in reversed(tables[1:]):
        with_above = lookup(blocks, materialise(top), _KEY, how="inner")
        nodes = _nodes_with_path(with_above, arity, [], attached)
        top = nodes.select(
            F.concat_ws("/", "grp", "pos").alias(_KEY), F.col("path").alias("above"), *attached
        )
    return lookup(tables[0], materialise(top), _KEY, how="inner")


def manifest(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    group_col: str = "lang",
    tampered: Column | None = None,
    arity: int = ARITY,
    block_levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``path``
    (for each level the digests left and right of the node in its run), ``proof_sha256``,
    ``folded_root`` and ``verified``.

    A leaf is the hash of the row's ``doc_id``, ``source``, ``lang``, ``n_chars`` and
    ``text``; subtrees go by ``group_col``, the null group first, leaves by id, null ids
    first, then by leaf, so repeated ids and equal rows have their places too (equal rows
    are equal leaves). ``tampered`` replaces ``n_chars`` before the proof is folded; the
    proof itself is the untouched tree's. Other columns are not looked at, whatever their
    names. No row, no tree: an empty table gives an empty result.
    """
    row = {f: F.col(f) for f in FIELDS}
    changed = {**row, "n_chars": F.col("n_chars") if tampered is None else tampered}
    group = F.col(group_col).cast("string")
    leaves = docs.select(
        F.col(id_col).alias("id"),
        # The null group is the empty key and comes first.
        F.coalesce(F.concat(F.lit("+"), group), F.lit("")).alias("grp"),
        leaf_hash(row).alias("node"),
        leaf_hash(changed).alias("shown"),
    )
    # Written first: finding the range bounds would hash every text a second time.
    placed = materialise(with_position(materialise(leaves), "grp", F.asc_nulls_first("id"), "node", "shown"))
    groups = placed.groupBy("grp").agg(
        F.min("position").alias("first"), F.count(F.lit(1)).alias("total"), F.count(F.lit(1)).alias("weight")
    )
    nodes = lookup(placed, materialise(groups), "grp", how="inner", weight="weight")
    nodes = nodes.withColumn("pos", F.col("position") - F.col("first"))

    tables, subroots = _climb(nodes, arity, block_levels, ["id", "shown"])
    subroots = materialise(subroots)
    ranked = with_position(subroots.select(F.col("grp").alias("name"), "node"), "name", output="pos")
    upper = ranked.select(F.lit("").alias("grp"), "pos", F.lit(subroots.count()).cast("long").alias("total"), "node", "name")
    upper_tables, tops = _climb(upper, arity, block_levels, ["name"])

    none = F.array().cast("array<struct<left: string, right: string>>")
    start = tops.select("grp", none.alias("above"))
    over = _nodes_with_path(_descend(upper_tables, start, arity, []), arity, ["name"], [])
    # The top table has one row, the root of the whole tree.
    above = over.join(F.broadcast(tops.select("grp", F.col("node").alias("root"))), "grp").select(
        F.col("name").alias("grp"), F.col("path").alias("above"), F.col("node").alias("subroot"), "root"
    )
    kept = ["subroot", "root"]
    proved = _nodes_with_path(_descend(tables, above, arity, kept), arity, ["id", "shown"], kept)

    folded = F.aggregate(
        "path", F.col("shown"), lambda node, flank: F.sha2(F.concat(flank["left"], node, flank["right"]), 256)
    )
    proof = F.array_join(F.transform("path", lambda flank: F.concat(flank["left"], flank["right"])), "")
    return proved.select(
        F.col("id").alias("doc_id"), F.col("node").alias("leaf"), "subroot", "root", "path",
        F.sha2(proof, 256).alias("proof_sha256"), folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
