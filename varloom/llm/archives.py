"""WARC archives written from a table of pages, and read back as a chunked record table.

Pages become rows of (record, chunk number, at most ``CHUNK`` payload bytes). A first pass streams them through running
SHA-256 states and leaves one row a record: page, bytes and digest, no payload. Which records are responses is decided
on those rows: of equal payloads of at least ``least`` bytes the one with the smallest page_id is a response, the
others revisit it. Groups are counted with partial aggregates; only groups of two or more are joined back.
A second pass deals decisions and chunks by record, each record to one task, and streams them in order into archives
of one gzip member a record; revisits write no payload, and a response whose chunks don't give the digest that was decided on fails the job.
So no payload is shuffled by its digest, and beside the page's own cell no step holds a whole record; Arrow batches end at 64 MB.

Reading gives rows of the same kind, each with the bytes and the SHA-256 so far: hash states are carried from chunk
to chunk, and a response whose final digest differs from its header fails the job.

Archives are written under a random name and moved to their final one when complete; the returned table
names the files of the tasks that succeeded, so what a lost task leaves behind is never read. Records are numbered by their
place in the table, which must read the same rows whenever it is evaluated; the number is part of a record's id, so
repeated pages have ids of their own.

Nulls: a null payload is empty; a record without page_id gets no id header and reads back as null, and
is never revisited. Rows equal in id and payload are all responses (or all revisits). Line breaks in
a url are escaped. Empty tables give no archives. Other columns are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, functions as F

from .tables import settled

CHUNK = 1 << 16
ROLL = 1 << 30
DATE = "2000-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILES = pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
PARTS = pa.schema([("file", pa.string()), ("record", pa.int64()), ("chunk", pa.int64()), ("last", pa.bool_()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                   ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("data", pa.binary())])


def chunks(pages: DataFrame) -> DataFrame:
    """One row per chunk of each page's payload: record (the row's number), page_id, url, chunk, last, data."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    p = pages.select(F.monotonically_increasing_id().alias("record"), F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    at = F.expr(f"sequence(0, greatest(CAST(ceil(octet_length(payload) / {CHUNK}) AS INT) - 1, 0))")
    cut = F.transform(at, lambda i: F.struct((i == F.size(at) - 1).alias("last"), F.expr("payload").substr(i * CHUNK + 1, F.lit(CHUNK)).alias("data")))
    p = p.select("record", "page_id", "url", F.posexplode(cut).alias("chunk", "c"))
    return p.select("record", "page_id", "url", F.col("chunk").cast("bigint").alias("chunk"), "c.last", "c.data")


def digests(parts: DataFrame) -> DataFrame:
    """record, page_id, url, payload_bytes, payload_digest of each record, by running states over its chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, size = hashlib.sha256(), 0
        for b in batches:
            rows, bytes_, sums = [], [], []
            for i, (last, data) in enumerate(zip(b.column("last").to_pylist(), b.column("data"))):
                state.update(data.as_buffer())
                size += data.as_buffer().size
                if last:
                    rows.append(i)
                    bytes_.append(size)
                    sums.append(state.hexdigest())
                    state, size = hashlib.sha256(), 0
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(c).take(at) for c in ("record", "page_id", "url")] + [pa.array(bytes_, pa.int64()), pa.array(sums, pa.string())],
                                             names=["record", "page_id", "url", "payload_bytes", "payload_digest"])

    return parts.mapInArrow(run, "record bigint, page_id bigint, url string, payload_bytes bigint, payload_digest string")


def decide(found: DataFrame, least: int = 100) -> DataFrame:
    """``digests`` rows with record_type and refers_to."""
    found = settled(found)
    groups = found.filter(F.col("payload_bytes") >= least).groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    groups = groups.filter("n > 1 AND first IS NOT NULL").select("payload_digest", "first")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return found.join(groups, "payload_digest", "left").select(
        "record", "page_id", "url", "payload_bytes", "payload_digest", F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("first")).alias("refers_to"))


def _urn(page: int | None, digest: str, record: int | None = None) -> str:
    return f"<urn:page:{page}:{digest[:32]}{'' if record is None else f':{record}'}>"


def _head(r: dict) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % r["payload_bytes"]
    there = r["payload_bytes"] if r["record_type"] == "response" else 0
    lines = ["WARC/1.1", f"WARC-Type: {r['record_type']}", f"WARC-Record-ID: {_urn(r['page_id'], r['payload_digest'], r['record'])}", f"WARC-Date: {DATE}",
             "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha256:{r['payload_digest']}", f"Content-Length: {len(http) + there}"]
    if r["page_id"] is not None:
        lines.append(f"WARC-X-Page-ID: {r['page_id']}")
    if r["url"] is not None:
        lines.append("WARC-Target-URI: " + r["url"].replace("\r", "%0D").replace("\n", "%0A"))
    if r["refers_to"] is not None:
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {_urn(r['refers_to'], r['payload_digest'])}", f"WARC-X-Refers-To-Page: {r['refers_to']}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


def write(pages: DataFrame, folder: str, least: int = 100) -> DataFrame:
    """Write the pages as archives in ``folder`` (a shared place); a table of the files."""
    parts = chunks(pages)
    told = decide(digests(parts), least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, path = pafs.FileSystem.from_uri(folder)
        where.create_dir(path, recursive=True)
        done, out, name, n, size, pack = [], None, "", 0, 0, None
        head, state = {}, None
        try:
            for b in batches:
                for r in b.to_pylist():
                    if r["chunk"] < 0:
                        head, state = r, hashlib.sha256()
                        if out is not None and size >= ROLL:
                            out.close()
                            where.move(f"{path}/{name}.part", f"{path}/{name}")
                            done.append((name, n, size))
                            out = None
                        if out is None:
                            name, n, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                            out = where.open_output_stream(f"{path}/{name}.part", compression=None)
                        pack = zlib.compressobj(1, wbits=31)
                        size += out.write(pack.compress(_head(r))) or 0
                        continue
                    if r["record"] != head.get("record"):
                        raise RuntimeError("chunks without a decision: the table was read differently the second time")
                    state.update(r["data"])
                    if head["record_type"] == "response":
                        size += out.write(pack.compress(r["data"])) or 0
                    if r["last"]:
                        if state.hexdigest() != head["payload_digest"]:
                            raise RuntimeError("another payload than was decided on: the table was read differently the second time")
                        size += out.write(pack.compress(b"\r\n\r\n") + pack.flush()) or 0
                        n += 1
            if out is not None:
                out.close()
                where.move(f"{path}/{name}.part", f"{path}/{name}")
                done.append((name, n, size))
                out = None
        finally:
            if out is not None:
                out.close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{x[0]}" for x in done]), pa.array([x[1] for x in done], pa.int64()), pa.array([x[2] for x in done], pa.int64())], schema=FILES)

    rows = told.withColumn("chunk", F.lit(-1).cast("bigint")).unionByName(parts.select("record", "chunk", "last", "data"), allowMissingColumns=True)
    rows = rows.repartition("record").sortWithinPartitions("record", "chunk")
    return settled(rows.mapInArrow(run, "file string, records bigint, bytes bigint"))


def read(files: DataFrame, data: bool = True) -> DataFrame:
    """The archives' records as chunk rows; bytes and digest are those up to the chunk's end, for a revisit its header's.

    With ``data`` false only a record's last row is given, without its bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for b in batches:
            for uri in b.column("file").to_pylist():
                where, path = pafs.FileSystem.from_uri(uri)
                with where.open_input_stream(path, compression=None) as raw, gzip.GzipFile(fileobj=raw) as f:
                    for row in _parse(uri, f, data):
                        rows.append(row)
                        held += len(row[-1] or b"") + 200
                        if held > 8 << 20:
                            yield _batch(rows)
                            rows, held = [], 0
        if rows:
            yield _batch(rows)

    return files.select("file").mapInArrow(run, "file string, record bigint, chunk bigint, last boolean, page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, data binary")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), PARTS.types)], schema=PARTS)


def _fields(f: gzip.GzipFile) -> dict[str, str]:
    out = {}
    while (line := f.readline().decode().rstrip("\r\n")):
        k, _, v = line.partition(":")
        out[k.lower()] = v.strip()
    return out


def _parse(uri: str, f: gzip.GzipFile, data: bool) -> Iterator[tuple]:
    record = -1
    while (version := f.readline()):
        if not version.startswith(b"WARC/"):
            raise ValueError(f"{uri}: no record at {f.tell()}")
        record += 1
        h = _fields(f)
        at, length = f.tell(), int(h["content-length"])
        f.readline()
        http = _fields(f)
        left = length - (f.tell() - at)
        page, refers = (int(h[k]) if k in h else None for k in ("warc-x-page-id", "warc-x-refers-to-page"))
        kind, told = h["warc-type"], h["warc-payload-digest"].partition(":")[2]
        lead = (page, h.get("warc-target-uri"), kind, refers)
        if kind == "revisit":
            yield (uri, record, 0, True, *lead, int(http["content-length"]), told, b"" if data else None)
        else:
            state, size, k = hashlib.sha256(), 0, 0
            while True:
                part = f.read(min(CHUNK, left))
                if len(part) < min(CHUNK, left):
                    raise ValueError(f"{uri}: record {record} is cut short")
                state.update(part)
                size, left = size + len(part), left - len(part)
                if not left and state.hexdigest() != told:
                    raise ValueError(f"{uri}: record {record} has another digest than its header")
                if data or not left:
                    yield (uri, record, k, not left, *lead, size, state.hexdigest(), part if data else None)
                if not left:
                    break
                k += 1
        if f.read(4) != b"\r\n\r\n":
            raise ValueError(f"{uri}: record {record} does not end where its length says")
