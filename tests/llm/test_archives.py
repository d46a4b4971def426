"""WARC round trips and benchmark matches."""

import hashlib
import zlib

import pytest

from churnlens.llm.decontaminate import benchmark_matches
from churnlens.llm.warc import archive_pages, inflate, record, records

from .cases import ODD, prose, table


def test_archives_round_trip(spark, tmp_path):
    big = "<p>" + "é" * 800
    rows = [(1, "http://a b/ü\r\nX: y", big), (2, None, big), (3, "u", "small"), (4, "u", "small"), (5, "u", None)]
    rows += [(6, "u", ""), (7, "u", big + "\r\n\r\nWARC/1.1\r\n"), (9, "u", big), (9, "u", big), (None, "u", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = archive_pages(pages, f"file://{tmp_path}/x", file_bytes=2000).collect()
    assert len(got) == len(rows)
    kinds = sorted((r["page_id"] or -1, r["record_type"], r["refers_to"] or 0) for r in got)
    assert kinds == [
        (-1, "revisit", 9), (1, "revisit", 9), (2, "revisit", 9), (3, "response", 0), (4, "response", 0),
        (5, "response", 0), (6, "response", 0), (7, "response", 0), (9, "response", 0), (9, "response", 0),
    ]
    texts = {i: (h or "").encode() for i, _, h in rows}
    for r in got:
        text = texts[r["page_id"]]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(text), hashlib.sha1(text).hexdigest())
        assert r["payload"] == (None if r["record_type"] == "revisit" else text)
    assert archive_pages(pages.limit(0), f"file://{tmp_path}/y").count() == 0


def test_a_cut_archive_is_an_error():
    whole = b"".join(record(i, "u", b"x" * 99, hashlib.sha1(b"x").hexdigest(), None) for i in range(3))
    packer = zlib.compressobj(wbits=31)
    packed = packer.compress(whole) + packer.flush()
    chunks = [packed[i : i + 7] for i in range(0, len(packed), 7)]
    assert len(list(records(inflate(chunks)))) == 3
    with pytest.raises(ValueError):
        list(records(inflate(chunks[:-2])))


def test_benchmark_matches(spark):
    item, other = prose(30, 77).split(), prose(20, 78)
    near = [*item[:1], "changed", *item[2:]]
    texts = [
        *ODD, f"{prose(50, 1)} {' '.join(item).upper()}!!! {prose(50, 2)}", f"{prose(9, 3)} {' '.join(near)} end",
        " ".join(item[:27]), " ".join(item[:15]), f"{other} {other}",
    ]
    items = spark.createDataFrame([(1, " ".join(item)), (2, other), (3, None), (4, "too short")], "item_id long, text string")
    for limit in (0, 1 << 27):
        found = benchmark_matches(table(spark, texts), items, broadcast_bytes=limit).collect()
        got = {(r["doc_id"], r["item_id"]): (r["start_word"], round(r["similarity"], 3)) for r in found}
        n = len(ODD)
        assert got == {
            (n, 1): (50, 1.0), (n + 1, 1): (9, 0.857), (n + 2, 1): (0, 0.885), (n + 4, 2): (0, 1.0)
        }
    assert benchmark_matches(table(spark, texts), items.limit(0)).count() == 0
