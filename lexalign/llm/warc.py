"""WARC archives with a two-level capture index.

Tasks write gzip members (one a record) into archive files of the shared folder and return where each record lies.
The captures are sorted by reversed-host URL key; every range partition becomes an index file of compressed blocks and
a sparse directory with the first key of each block.  A lookup finds the index file among the files' first keys,
binary-searches the directory, range-reads the blocks that can hold the key, binary-searches the lines, and then
range-reads the records.

A task that runs again writes files of a new name; only files that a committed row names are ever read.

Defined cases: a null html is the empty payload and a null url the empty key; rows that repeat a ``page_id`` are
records of their own, and all rows with the smallest id of a payload are responses; a null ``page_id`` counts as the
largest; an empty table gives an empty archive; only ``page_id``, ``url`` and ``html`` are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import Scratch, map_texts, null_last, partitions, salted_join

#: lines of an index block; bytes after which an archive file is closed; bytes that one range read may join
BLOCK_LINES = 1000
FILE_BYTES = 1 << 30
READ_BYTES = 4 << 20

_HEX32, _B32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_CAPTURE = "key string, file string, offset long, length long"
_URL = re.compile(r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?(?:[^/?#@]*@)?([^/?#]*)([^#]*)", re.S)


def payload_digest(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: 160 bits are eight groups of 20, each five hex or four base32 digits."""
    h = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(h, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), _HEX32, _B32)


def url_key(url: str | None) -> str:
    """``https://Blog.example.com:443/a?b#c`` is ``com,example,blog)/a?b``; blanks are percent-encoded."""
    if not url:
        return ""
    host, rest = _URL.match(url).groups()
    host = re.sub(r":(?:80|443)?$", "", host.lower())
    name, colon, port = host.partition(":")
    key = ",".join(reversed(name.split("."))) + colon + port + ")" + (rest or "/")
    return re.sub(r"[\s\x00-\x20]", lambda m: "".join(f"%{x:02X}" for x in m.group().encode()), key)


def _full_key(url: str | None, page_id: int | None) -> str:
    """The URL key and a sortable id, so every capture has its own place in the order."""
    return f"{url_key(url)} {'9' * 20 if page_id is None else format(page_id + (1 << 63), '020d')}"


def _open(base: str):
    """File system and path of a URI that executors and driver share."""
    return fs.FileSystem.from_uri(base) if "://" in base or base.startswith("file:") else (fs.LocalFileSystem(), base)


def _record(page_id, url, digest, size, refers, payload: bytes) -> bytes:
    kind = "response" if refers is None else "revisit"
    head = [b"WARC/1.1", f"WARC-Type: {kind}".encode(), f"WARC-Record-ID: <urn:page:{page_id}>".encode(),
            b"WARC-Target-URI: " + re.sub(r"[\r\n]", " ", url or "").encode(),
            f"WARC-Payload-Digest: sha1:{digest}".encode()]
    if refers is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers}>".encode(),
                 b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        payload = b""
    head += [f"X-Payload-Length: {size}".encode(), f"Content-Length: {len(payload)}".encode()]
    c = zlib.compressobj(4, zlib.DEFLATED, 31)
    return c.compress(b"\r\n".join([*head, b"", payload]) + b"\r\n\r\n") + c.flush()


def write_archives(pages: DataFrame, scratch: Scratch, min_bytes: int = 0) -> DataFrame:
    """Writes a record per page and returns the captures ``key, file, offset, length`` (a written table).

    Pages with equal payloads of at least ``min_bytes`` are one response (the smallest id) and revisits.  The rows of
    a payload that a third of all pages share are dealt over salted tasks.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        html.alias("html"), F.octet_length(html).cast("long").alias("size"),
                        payload_digest(html).alias("digest"), null_last(F.col("page_id").cast("long")).alias("id"))
    first = (rows.where(F.col("size") >= min_bytes).groupBy("digest", "size")
             .agg(F.min("id").alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    rows = salted_join(rows, first, ["digest", "size"], "id")
    refers = F.when(F.col("keeper") < F.col("id"), F.col("keeper"))
    base = scratch.path

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(base)
        out, name, at = None, "", 0
        try:
            for b in batches:
                keys, files, offsets, lengths = [], [], [], []
                for page_id, url, text, size, digest, refers_to in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        system.create_dir(f"{root}/warc", recursive=True)
                        out = system.open_output_stream(f"{root}/warc/{name}", compression=None)
                    data = _record(page_id, url, digest, size, refers_to, text.encode())
                    out.write(data)
                    keys.append(_full_key(url, page_id))
                    files.append(name)
                    offsets.append(at)
                    lengths.append(len(data))
                    at += len(data)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.string()), pa.array(files, pa.string()), pa.array(offsets, pa.int64()),
                     pa.array(lengths, pa.int64())], ["key", "file", "offset", "length"])
        finally:
            if out is not None:
                out.close()

    captures = rows.select("page_id", "url", "html", "size", "digest", refers.alias("refers")).mapInArrow(run, _CAPTURE)
    return scratch.save(captures, "captures")


def write_index(captures: DataFrame, scratch: Scratch, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Writes the blocks and their sparse directories; returns ``first, last, file, blocks``, one row an index file."""
    base = scratch.path
    n = max(1, partitions(captures.sparkSession))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(base)
        out, name, at, lines, directory, last = None, "", 0, [], [], ""

        def flush() -> None:
            nonlocal at, lines
            data = zlib.compress("\n".join(lines).encode(), 6)
            out.write(data)
            directory.append((lines[0].rsplit(" ", 3)[0], at, len(data)))
            at, lines = at + len(data), []

        for b in batches:
            for key, file, offset, length in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if out is None:
                    name = uuid.uuid4().hex
                    system.create_dir(f"{root}/index", recursive=True)
                    out = system.open_output_stream(f"{root}/index/{name}.cdx", compression=None)
                lines.append(f"{key} {file} {offset} {length}")
                last = key
                if len(lines) >= block_lines:
                    flush()
        if out is not None:
            if lines:
                flush()
            out.close()
            with system.open_output_stream(f"{root}/index/{name}.dir", compression=None) as d:
                d.write(zlib.compress("\n".join(f"{k} {a} {z}" for k, a, z in directory).encode()))
            yield pa.RecordBatch.from_arrays([pa.array([directory[0][0]]), pa.array([last]), pa.array([name]),
                                              pa.array([len(directory)], pa.int64())], ["first", "last", "file", "blocks"])

    ordered = captures.repartitionByRange(n, "key").sortWithinPartitions("key")
    return scratch.save(ordered.mapInArrow(run, "first string, last string, file string, blocks long"), "files")


def lookup(spark: SparkSession, urls: DataFrame, scratch: Scratch) -> DataFrame:
    """Captures of the given ``url`` values: two binary searches and a block read for each key and index file.

    The list of index files has one row per range partition of the index, a number set by the session, so it is small
    enough to send to every task.  A URL with very many captures lies in several files, each read by another task.
    """
    files = sorted((r["first"], r["last"], r["file"]) for r in scratch.load("files").collect())
    firsts, lasts = [f[0] for f in files], [f[1] for f in files]
    base = scratch.path

    def route(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys, names = [], []
        for k in {url_key(u) + " " for u in b.column("url").to_pylist()}:
            for i in range(bisect_left(lasts, k), bisect_right(firsts, k + "~")):
                keys.append(k)
                names.append(files[i][2])
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(names, pa.string())], ["key", "file"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(base)
        name, source, directory, heads, block_at, block = None, None, [], [], -1, []
        for b in batches:
            found = []
            for key, file in zip(b.column("key").to_pylist(), b.column("file").to_pylist(), strict=True):
                if file != name:
                    name, block_at = file, -1
                    with system.open_input_file(f"{root}/index/{name}.dir") as d:
                        directory = [x.rsplit(" ", 2) for x in zlib.decompress(d.read()).decode().split("\n")]
                    heads = [x[0] for x in directory]
                    if source is not None:
                        source.close()
                    source = system.open_input_file(f"{root}/index/{name}.cdx")
                for i in range(max(0, bisect_right(heads, key) - 1), bisect_right(heads, key + "~")):
                    if i != block_at:
                        source.seek(int(directory[i][1]))
                        block = zlib.decompress(source.read(int(directory[i][2]))).decode().split("\n")
                        block_at = i
                    for j in range(bisect_left(block, key), bisect_left(block, key + "~")):
                        found.append(block[j].rsplit(" ", 3))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.string()),
                 pa.array([int(x[2]) for x in found], pa.int64()), pa.array([int(x[3]) for x in found], pa.int64())],
                ["key", "file", "offset", "length"])

    wanted = map_texts(urls.select(F.col("url").cast("string").alias("url")).distinct(), route, "key string, file string")
    wanted = wanted.distinct().repartition(max(1, partitions(spark)), "file").sortWithinPartitions("file", "key")
    return wanted.mapInArrow(search, _CAPTURE)


def _parse(data: bytes) -> tuple:
    """Page id, payload length, digest, type and reference of one record; a response's payload is checked."""
    record = zlib.decompress(data, 31)
    head, _, body = record.partition(b"\r\n\r\n")
    fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
    payload = body[: int(fields[b"Content-Length"])]
    digest, size = fields[b"WARC-Payload-Digest"].decode().removeprefix("sha1:"), int(fields[b"X-Payload-Length"])
    kind = fields[b"WARC-Type"].decode()
    text = None
    if kind == "response":
        digest, size = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
        text = payload.decode()

    def page(name: bytes) -> int | None:
        x = fields[name].removeprefix(b"<urn:page:").removesuffix(b">") if name in fields else b"None"
        return None if x == b"None" else int(x)

    return page(b"WARC-Record-ID"), size, digest, kind, page(b"WARC-Refers-To"), fields[b"WARC-Target-URI"].decode(), text


_READ = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, "
         "payload string")


def read_records(captures: DataFrame, scratch: Scratch) -> DataFrame:
    """Range-reads the records of ``captures`` in archive order; neighbouring ranges are read together."""
    base = scratch.path
    n = max(1, partitions(captures.sparkSession))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(base)
        name, source = None, None
        for b in batches:
            spans = list(zip(*(b.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True))
            i = 0
            while i < len(spans):
                file, at, length = spans[i]
                j, end = i + 1, at + length
                while j < len(spans) and spans[j][0] == file and spans[j][1] == end and end - at < READ_BYTES:
                    end += spans[j][2]
                    j += 1
                if file != name:
                    if source is not None:
                        source.close()
                    name, source = file, system.open_input_file(f"{root}/warc/{file}")
                source.seek(at)
                data = source.read(end - at)
                rows = [_parse(data[o - at : o - at + z]) for _, o, z in spans[i:j]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
                        pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()), strict=True)],
                    ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"])
                i = j

    ordered = captures.repartitionByRange(n, "file", "offset").sortWithinPartitions("file", "offset")
    return ordered.mapInArrow(run, _READ)


def archive(pages: DataFrame, min_bytes: int = 0) -> Scratch:
    """Writes archives and index of ``pages`` into a folder of the shared checkpoint folder and returns it."""
    scratch = Scratch(pages.sparkSession, "warc")
    write_index(write_archives(pages, scratch, min_bytes), scratch)
    return scratch
