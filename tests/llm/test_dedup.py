"""Exact, line and SimHash deduplication against brute force."""

import hashlib
import itertools
import re

import pytest
import xxhash

from churnlens.llm import exact_dedup as bloom
from churnlens.llm.components import components
from churnlens.llm.exact_dedup import exact_dedup
from churnlens.llm.line_dedup import dedup_units
from churnlens.llm.simhash import drop_similar, links, similar_groups, simhash_groups
from churnlens.llm.tables import without_ids

from .cases import ODD, by_id, prose, table

EMPTY = "doc_id long, text string"


def roots_of(nodes, pairs):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


# Exact ------------------------------------------------------------------------


def test_exact_dedup_of_odd_texts(spark):
    got = by_id(exact_dedup(table(spark, ODD)))
    normal = [(t or "").encode().lower() for t in ODD]
    for i, text in enumerate(normal):
        group = [j for j, other in enumerate(normal) if other == text]
        assert got[i] == {
            "doc_id": i, "keep_id": max(group), "group_size": len(group), "kept": i == max(group),
            "text_sha256": hashlib.sha256(text).hexdigest(),
        }


def test_a_full_filter_loses_nothing(spark):
    docs = table(spark, [prose(3, i % 400) for i in range(1000)])
    plain = by_id(exact_dedup(docs))
    # 64 bits at most: every bit is set twice, so every row is possible.
    crowded = by_id(exact_dedup(docs, max_bits=1 << 15, bits_per_row=1, probes=1))
    assert plain == crowded
    assert sum(r["kept"] for r in plain.values()) == 400


def test_rows_without_copies_are_not_possible(spark):
    hashes = bloom.digests(table(spark, [prose(3, i) for i in range(300)] + [prose(3, 7)] * 5))
    tagged = bloom.possibly_repeated(hashes, bloom.filter_bits(305), 2).collect()
    assert all(r["possible"] for r in tagged if r["doc_id"] == 7 or r["doc_id"] >= 300)
    assert sum(r["possible"] for r in tagged) < 20


def test_exact_dedup_without_rows_or_ids(spark):
    assert exact_dedup(spark.createDataFrame([], EMPTY)).count() == 0
    got = exact_dedup(table(spark, [(None, "a"), (3, "A"), (3, "a"), (None, "b")])).collect()
    assert sorted((r["doc_id"] or -1, r["keep_id"] or -1, r["group_size"], r["kept"]) for r in got) == [
        (-1, -1, 1, True), (-1, 3, 3, False), (3, 3, 3, True), (3, 3, 3, True)
    ]


def test_without_ids(spark):
    docs = table(spark, ["a", "b", "c"])
    ids = spark.createDataFrame([(1,), (1,), (None,)], "doc_id long")
    for limit in (0, 1 << 20):
        left = without_ids(docs, ids, "doc_id", broadcast_bytes=limit)
        assert left.columns == docs.columns
        assert sorted(by_id(left)) == [0, 2]


# Lines ------------------------------------------------------------------------


def lines_by_hand(texts):
    seen, out = set(), {}
    for i, text in enumerate(texts):
        kept, removed, start = "", [], 0
        for line in re.findall(r"[^\n]*\n|[^\n]+", text or ""):
            bare = line.removesuffix("\n")
            key = re.sub(r"[\x20\x09-\x0D]+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), bare)).strip(" ")
            if key and key in seen:
                removed.append({"start": start, "stop": start + len(bare)})
            else:
                kept += line
            seen.add(key)
            start += len(line)
        out[i] = (None if text is None else kept, removed)
    return out


def test_lines_of_odd_texts(spark):
    texts = [*ODD, "Line\nnew é line\nNEW é  line\nend", "end\n", " end", "日本\nEND\n日本"]
    got = by_id(dedup_units(table(spark, texts)))
    wanted = lines_by_hand(texts)
    assert {i: (r["text"], r["removed"]) for i, r in got.items()} == wanted
    assert all(r["n_removed"] == len(r["removed"]) for r in got.values())
    for i, row in got.items():
        assert all("\n" not in texts[i][s["start"] : s["stop"]] for s in row["removed"])


@pytest.mark.parametrize("min_words", [1, 4])
def test_runs_of_sentences(spark, min_words):
    texts = [
        "One two. Three four five!  Six\nseven. x", "Zero. one two. Three four five! Six\nlast", "six", None, "",
        "one two.  \n\n three four five! é. six", "six. new six. one two. and three four five? seven\nseven. x ", *ODD,
    ]
    got = by_id(dedup_units(table(spark, texts), unit="sentence", min_words=min_words))
    seen = set()
    for i, text in enumerate(texts):
        cuts = [m.span() for m in re.finditer(r"\n|[.!?]+[ \t]+", text or "")]
        starts, ends = [0, *[b for _, b in cuts]], [*[a for a, _ in cuts], len(text or "")]
        keys = [" ".join((text or "")[a:b].encode().lower().decode().split()) for a, b in zip(starts, ends)]
        again = []
        for key in keys:
            again.append(bool(key) and key in seen)
            seen.add(key)
        gone, run = set(), []
        for n, key in [*enumerate(keys), (None, "end")]:
            if n is not None and again[n]:
                run.append(n)
            elif key:
                if sum(len(keys[k].split()) for k in run) >= min_words:
                    gone |= set(run)
                run = []
        assert [(s["start"], s["stop"]) for s in got[i]["removed"]] == [(starts[n], ends[n]) for n in sorted(gone)]
        left = "".join((text or "")[a:b] for n, (a, b) in enumerate(zip(starts, [*starts[1:], len(text or "")])) if n not in gone)
        assert got[i]["text"] == (None if text is None else left)


def test_paragraphs(spark):
    texts = ["a b\nc\n\nd\n \n  a", "A b c\n\nd e"]
    got = by_id(dedup_units(table(spark, texts), unit="paragraph"))
    assert got[0]["text"] == texts[0]
    assert got[1]["text"] == "d e" and got[1]["removed"] == [{"start": 0, "stop": 5}]


def test_lines_without_rows_or_ids(spark):
    assert dedup_units(spark.createDataFrame([], EMPTY)).count() == 0
    rows = dedup_units(table(spark, [(None, "a\na"), (1, "a"), (1, "a"), (2, "a")])).collect()
    assert sorted((r["doc_id"] or 0, r["text"], r["n_removed"]) for r in rows) == [
        (0, "a\na", 0), (1, "a", 0), (1, "a", 0), (2, "", 1)
    ]


# SimHash ----------------------------------------------------------------------


def print_by_hand(text):
    words = (text or "").encode().lower().split()
    spans = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in spans]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_of_odd_texts(spark):
    base = prose(600, 5).split()
    near = [" ".join(base[:k] + ["new"] + base[k + 1 :]) for k in range(0, 600, 25)]
    texts = [*ODD, *near, " ".join(base)]
    got = by_id(simhash_groups(table(spark, texts)))
    prints = {i: print_by_hand(t) for i, t in enumerate(texts)}
    pairs = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 2]
    roots = roots_of(prints, pairs)
    assert len(pairs) > 20
    assert got == {
        i: {"doc_id": i, "fingerprint": f"{p:016x}", "component_id": roots[i]} for i, p in prints.items()
    }


@pytest.mark.parametrize("radius", [0, 1, 2])
@pytest.mark.parametrize("segments", [8, 16])
def test_links_are_all_pairs_within_the_radius(spark, radius, segments):
    base = 0x0123456789ABCDEF
    prints = {base}
    for i in range(0, 64, 5):
        prints |= {base ^ 1 << i, base ^ 1 << i ^ 1 << (i + 9) % 64, base ^ 7 << i % 60}
    prints |= {0, 2**64 - 1, 2**63, 1, 3}
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(sorted(prints))]
    values = dict(signed)
    wanted = {
        (a, b) for a, b in itertools.combinations(values, 2)
        if ((values[a] ^ values[b]) & (2**64 - 1)).bit_count() <= radius
    }
    found = links(spark.createDataFrame(signed, "id long, fp long"), radius=radius, segments=segments)
    assert {tuple(r) for r in found.collect()} == wanted


def test_simhash_without_rows_or_ids(spark):
    assert simhash_groups(spark.createDataFrame([], EMPTY)).count() == 0
    rows = simhash_groups(table(spark, [(None, "a b"), (4, "a b"), (4, "a b"), (None, "zz")])).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in rows) == [(0, 0), (0, 4), (4, 4), (4, 4)]


def test_components(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)] + [(200, i) for i in range(201, 260)]
    frame = spark.createDataFrame([*pairs, (None, 3)], "a long, b long")
    nodes = {n for p in pairs for n in p}
    assert {tuple(r) for r in components(frame).collect()} == set(roots_of(nodes, pairs).items())
    assert components(frame.limit(0)).count() == 0


def jaccard(a, b):
    def sets(t):
        w = t.lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    return len(sets(a) & sets(b)) / len(sets(a) | sets(b))


def test_similar_texts(spark):
    base = prose(300, 9).split()
    texts = [" ".join(base)]
    texts += [" ".join([*base[:k], f"n{k}", *base[k + 1 :]]) for k in range(0, 300, 6)]  # similar to the first
    texts += [" ".join(f"m{i}" if i % 9 == 0 else w for i, w in enumerate(base))]  # not similar
    texts += [prose(40, 100 + i) for i in range(20)] + ["short text", "SHORT text", None, ""]
    docs = table(spark, texts)
    pairs = [
        (a, b) for a, b in itertools.combinations([i for i, t in enumerate(texts) if t], 2)
        if jaccard(texts[a], texts[b]) >= 0.8
    ]
    roots = roots_of(range(len(texts)), pairs)
    got = {r["doc_id"]: r["component_id"] for r in similar_groups(docs).collect()}
    linked = {n for p in pairs for n in p}
    assert got == {i: roots[i] for i in linked}
    left = drop_similar(docs)
    assert left.columns == docs.columns
    assert sorted(by_id(left)) == sorted(i for i in range(len(texts)) if roots[i] == i)
    assert drop_similar(docs.limit(0)).count() == 0


def test_a_chain_of_similar_texts_stays_one_group(spark):
    base = prose(200, 3).split()
    texts = [" ".join([f"c{j}" if j < 12 * k else w for j, w in enumerate(base)]) for k in range(8)]
    groups = similar_groups(table(spark, texts)).collect()
    pairs = [(a, b) for a, b in itertools.combinations(range(8), 2) if jaccard(texts[a], texts[b]) >= 0.8]
    assert {r["doc_id"]: r["component_id"] for r in groups} == roots_of(range(8), pairs)
