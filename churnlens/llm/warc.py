"""WARC archives: writing, normalising monolithic gzip files, reading by index.

A monolithic file is one gzip stream around many records and can only be read from
its start. The normaliser inflates it once, record by record, and writes each record
as a gzip member of its own, with a sidecar file that has each member's place. A task
holds one record at a time, and its files get their names when they are whole, so a
task that runs again replaces what it had written.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterable, Iterator
from uuid import uuid4

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.tables import map_batches
from churnlens.operators.lookup import lookup
from churnlens.operators.materialise import materialise
from churnlens.session import ensure_checkpoint_dir

DATE = "2024-01-01T00:00:00Z"
LEAST_BYTES = 1000
_CHUNK = 1 << 20
_GZIP = 31  # zlib's window bits for a gzip header
_LEVEL = 4


# Records ----------------------------------------------------------------------


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to, date: str = DATE) -> bytes:
    """A ``response`` record, or a ``revisit`` without payload if ``refers_to`` is given."""
    target = "".join(c if " " < c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "")
    kind = "response" if refers_to is None else "revisit"
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += f"Content-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target or 'urn:none'}",
        "WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
    ]
    if refers_to is not None:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def headers_of(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, v in (line.split(":", 1) for line in lines[1:] if ":" in line)}


def records(chunks: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """``(headers, whole record)`` of an inflated stream; raises if it ends in a record."""
    held, chunks = bytearray(), iter(chunks)
    while True:
        while (end := held.find(b"\r\n\r\n")) < 0:
            if (more := next(chunks, None)) is None:
                if held.strip():
                    raise ValueError("the archive ends within a header")
                return
            held += more
        headers = headers_of(bytes(held[:end]))
        size = end + 4 + int(headers["content-length"]) + 4
        while len(held) < size:
            if (more := next(chunks, None)) is None:
                raise ValueError("the archive ends within a record")
            held += more
        yield headers, bytes(held[:size])
        del held[:size]


def inflate(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """The content of a gzip file of one member or several; raises if it is cut off."""
    stream = None
    for chunk in chunks:
        while chunk:
            stream = stream or zlib.decompressobj(_GZIP)
            if content := stream.decompress(chunk, _CHUNK):
                yield content
            chunk = stream.unconsumed_tail
            if stream.eof:
                chunk, stream = stream.unused_data, None
    if stream is not None:
        raise ValueError("the gzip stream is cut off")


def page_of(value: str | None) -> str | None:
    name = (value or "").strip("<>").removeprefix("urn:page:")
    return name or None


# Files ------------------------------------------------------------------------


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if ":" in uri.split("/")[0] else (fs.LocalFileSystem(), uri)


class _Output:
    """A file that gets its name when it is whole."""

    def __init__(self, uri: str) -> None:
        self.system, self.path = _open(uri)
        folder, _, name = self.path.rpartition("/")
        self.system.create_dir(folder, recursive=True)
        self.part = f"{folder}/.{name}.{uuid4().hex}"
        self.stream = self.system.open_output_stream(self.part, compression=None)

    def write(self, data: bytes) -> None:
        self.stream.write(data)

    def close(self) -> None:
        self.stream.close()
        if self.system.get_file_info(self.path).type != fs.FileType.NotFound:
            self.system.delete_file(self.path)
        self.system.move(self.part, self.path)


def _chunks(uri: str) -> Iterator[bytes]:
    system, path = _open(uri)
    with system.open_input_stream(path, compression=None) as stream:
        while chunk := stream.read(_CHUNK):
            yield chunk


# Steps ------------------------------------------------------------------------


def with_references(pages: DataFrame, id_col: str, html_col: str, least_bytes: int) -> DataFrame:
    """``id_col``, ``url``, ``payload``, ``digest``, ``refers_to``: of equal payloads that are
    long enough, the row with the greatest id is the one the others refer to."""
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    pages = pages.select(F.col(id_col).alias("id"), "url", payload.alias("payload"))
    pages = pages.withColumn("digest", F.sha1("payload"))
    long = pages.where(F.octet_length("payload") >= least_bytes)
    first = long.groupBy("digest").agg(F.max("id").alias("kept"), F.count(F.lit(1)).alias("n")).where("n > 1")
    found = lookup(pages, materialise(first), "digest", weight="n")
    return found.withColumn("refers_to", F.when(~F.col("kept").eqNullSafe(F.col("id")), F.col("kept"))).drop("kept")


def write_monolithic(referred: DataFrame, folder: str, *, file_bytes: int = 256 << 20) -> DataFrame:
    """Write one gzip stream per task, or several when a task has more than ``file_bytes``
    of records. Returns ``path``, ``n_records`` of the files."""

    def write(batches):
        task, number, out, packer, size, held = TaskContext.get().partitionId(), 0, None, None, 0, 0
        done = {"path": [], "n_records": []}
        for batch in batches:
            for row in zip(*(batch[c] for c in ("id", "url", "payload", "digest", "refers_to"))):
                if out is None:
                    path = f"{folder}/part-{task:06d}-{number:04d}.warc.gz"
                    out, packer, size, held = _Output(path), zlib.compressobj(_LEVEL, zlib.DEFLATED, _GZIP), 0, 0
                data = record(row[0], row[1], row[2], row[3], row[4])
                out.write(packer.compress(data))
                size, held = size + len(data), held + 1
                if size >= file_bytes:
                    out.write(packer.flush())
                    out.close()
                    done["path"].append(path)
                    done["n_records"].append(held)
                    out, number = None, number + 1
        if out is not None:
            out.write(packer.flush())
            out.close()
            done["path"].append(path)
            done["n_records"].append(held)
        yield done

    kinds = {"id": "string", "url": "string", "payload": "binary", "digest": "string", "refers_to": "string"}
    return map_batches(referred, kinds, write, "path string, n_records bigint")


def _each_file(files: DataFrame) -> DataFrame:
    """One file per task."""
    return files.repartition(max(1, files.count()))


def normalise(files: DataFrame, folder: str) -> DataFrame:
    """Rewrite each archive of ``files`` (``path``) with a gzip member per record and a
    sidecar index of JSON lines (``id``, ``type``, ``offset``, ``length``).
    Returns ``path``, ``index_path``, ``n_records``."""

    def rewrite(batches):
        for batch in batches:
            done = {"path": [], "index_path": [], "n_records": []}
            for path in batch["path"]:
                target = f"{folder}/{path.rpartition('/')[2]}"
                out, index = _Output(target), _Output(f"{target}.index.jsonl")
                offset = count = 0
                for headers, whole in records(inflate(_chunks(path))):
                    packer = zlib.compressobj(_LEVEL, zlib.DEFLATED, _GZIP)
                    member = packer.compress(whole) + packer.flush()
                    out.write(member)
                    entry = {"id": headers.get("warc-record-id"), "type": headers.get("warc-type")}
                    index.write(json.dumps(entry | {"offset": offset, "length": len(member)}).encode() + b"\n")
                    offset, count = offset + len(member), count + 1
                out.close()
                index.close()
                for name, value in (("path", target), ("index_path", f"{target}.index.jsonl"), ("n_records", count)):
                    done[name].append(value)
            yield done

    return map_batches(
        _each_file(files), {"path": "string"}, rewrite, "path string, index_path string, n_records bigint"
    )


def read_records(files: DataFrame) -> DataFrame:
    """Records of normalised archives (``path``, ``index_path``), each found by its index
    entry: ``id``, ``url``, ``record_type``, ``refers_to``, ``payload`` (null for a revisit),
    ``payload_bytes`` and ``payload_digest`` as the record states them."""

    def read(batches):
        columns = ["id", "url", "record_type", "refers_to", "payload", "payload_bytes", "payload_digest"]
        for batch in batches:
            for path, index_path in zip(batch["path"], batch["index_path"]):
                system, inner = _open(path)
                out = {c: [] for c in columns}
                with system.open_input_file(inner) as archive:
                    for entry in _lines(_chunks(index_path)):
                        archive.seek(entry["offset"])
                        whole = zlib.decompress(archive.read(entry["length"]), _GZIP)
                        headers, _ = next(records([whole]))
                        block = whole[whole.index(b"\r\n\r\n") + 4 : -4]
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = int(headers_of(b"WARC/" + http)["content-length"])
                        kind = headers["warc-type"]
                        digest = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex()
                        row = (
                            page_of(headers["warc-record-id"]), headers["warc-target-uri"], kind,
                            page_of(headers.get("warc-refers-to")), None if kind == "revisit" else payload, size, digest,
                        )
                        for name, value in zip(columns, row):
                            out[name].append(value)
                        if len(out["id"]) >= 256:
                            yield out
                            out = {c: [] for c in columns}
                yield out

    return map_batches(
        _each_file(files), {"path": "string", "index_path": "string"}, read,
        "id string, url string, record_type string, refers_to string, payload binary, payload_bytes bigint,"
        " payload_digest string",
    )


def _lines(chunks: Iterable[bytes]) -> Iterator[dict]:
    rest = b""
    for chunk in chunks:
        *whole, rest = (rest + chunk).split(b"\n")
        yield from map(json.loads, whole)


def archive_pages(
    pages: DataFrame,
    folder: str | None = None,
    *,
    least_bytes: int = LEAST_BYTES,
    file_bytes: int = 256 << 20,
    id_col: str = "page_id",
    html_col: str = "html",
) -> DataFrame:
    """Write ``pages`` (``id_col``, ``url``, ``html_col``) to WARC, normalise, read back.

    Of equal payloads of at least ``least_bytes`` bytes the one with the greatest id is a
    response and the others revisit it. A null page is an empty payload, a null url is
    ``urn:none``; a null id refers to its group like any other row and is never referred
    to; rows that repeat the greatest id are all responses. Nothing is written for an
    empty table. The files stay in ``folder`` (``whole`` and ``members``), by default a new
    one in the shared checkpoint folder, which executors reach as a file system.
    Returns ``id_col`` and the other columns of ``read_records``.
    """
    spark = pages.sparkSession
    if folder is None:
        ensure_checkpoint_dir(spark)
        folder = f"{spark.sparkContext.getCheckpointDir()}/archives-{uuid4().hex}"
    referred = with_references(pages, id_col, html_col, least_bytes)
    whole = materialise(write_monolithic(referred, f"{folder}/whole", file_bytes=file_bytes))
    members = materialise(normalise(whole, f"{folder}/members"))
    found = read_records(members)
    kind = dict(pages.dtypes)[id_col]
    return found.select(
        F.col("id").cast(kind).alias(id_col), "url", "record_type", F.col("refers_to").cast(kind).alias("refers_to"),
        "payload", "payload_bytes", "payload_digest",
    )
