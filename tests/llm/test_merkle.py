"""Merkle manifests against plain trees in Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from churnlens.llm.merkle import manifest

from .cases import LONG

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, path int, grp int, id string"
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def by_hand(rows, arity=2):
    """``rows`` of (doc_id, text, lang, source, n_chars); ids divisible by crc are shown changed."""

    def stated(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    def leaf(row, chars):
        return digest("".join(map(stated, (row[0], row[3], row[2], chars, row[1]))))

    def levels_of(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            last = levels[-1]
            levels.append([digest("".join(last[i : i + arity])) for i in range(0, len(last), arity)])
        return levels

    def path(levels, at):
        for level in levels[:-1]:
            first = at - at % arity
            yield "".join(level[first:at]), "".join(level[at + 1 : first + arity])
            at //= arity

    groups = {}
    for row in rows:
        marked = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[4] is not None
        shown = row[4] + 1 if marked else row[4]
        groups.setdefault(row[2], []).append((row[0], leaf(row, row[4]), leaf(row, shown)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    trees = [levels_of([r[1] for r in groups[name]]) for name in names]
    top = levels_of([tree[-1][0] for tree in trees])
    for place, (name, tree) in enumerate(zip(names, trees)):
        for at, (one, leaf_hash, shown) in enumerate(groups[name]):
            flanks = [*path(tree, at), *path(top, place)]
            folded = shown
            for left, right in flanks:
                folded = digest(left + folded + right)
            proof = digest("".join(left + right for left, right in flanks))
            yield one, leaf_hash, tree[-1][0], top[-1][0], proof, folded, folded == top[-1][0]


def tampered():
    marked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return F.when(marked, F.col("n_chars") + 1).otherwise(F.col("n_chars"))


ROWS = [(i, f"text {i} é" * (i % 4), [None, "", "de", "en", "é"][i * i % 5], "s", i) for i in range(60)]
ROWS += [
    (None, None, None, None, None), (None, "x", "fr", None, 1), (None, "x", "fr", None, 1), (7, "a", "en", "s", None),
    (7, "b", "en", "s", 3), (7, "b", "en", "s", 3), (-5, LONG, "en", None, 9), (100, "", "zz", "", 0), (101, "日本\n", "+", "-", 4),
]


@pytest.mark.parametrize("arity, block_levels", [(2, 10), (2, 1), (3, 2)])
def test_trees_of_odd_rows(spark, arity, block_levels):
    docs = spark.createDataFrame([(*r, "x", 1, 2, "y") for r in ROWS], SCHEMA)
    got = manifest(docs, tampered=tampered(), arity=arity, block_levels=block_levels).select(COLUMNS).collect()
    wanted = sorted(by_hand(ROWS, arity), key=repr)
    assert sorted(map(tuple, got), key=repr) == wanted
    assert any(r[-1] for r in wanted) and not all(r[-1] for r in wanted)


def test_one_row_and_no_rows(spark):
    docs = spark.createDataFrame([(*r, "x", 1, 2, "y") for r in ROWS], SCHEMA)
    one = manifest(docs.where("doc_id = 3")).collect()[0]
    assert one["leaf"] == one["subroot"] == one["root"] == one["folded_root"] and one["path"] == []
    assert manifest(docs.limit(0)).count() == 0


def test_the_root_tells_any_change(spark):
    docs = spark.createDataFrame([(*r, "x", 1, 2, "y") for r in ROWS], SCHEMA)
    roots = {
        manifest(table).first()["root"]
        for table in (docs, docs.where("doc_id <> 100"), docs.withColumn("source", F.lit("t")), docs.repartition(3))
    }
    assert len(roots) == 3
