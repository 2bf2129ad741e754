"""WARC archives: write captures as request, response or revisit, and metadata records; read and assemble them."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from agrimill.llm import files
from agrimill.llm.common import shared_path, stored

# Fixed values of the format.
VERSION, PROFILE = "WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "record_type string, record_id string, concurrent_to string, target_uri string, refers_to_uri string, payload_digest string, payload_bytes long, fields map<string,string>"
BLOCK = 1 << 20


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(kind: str, number: str, headers: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{number}>"), ("WARC-Date", "1970-01-01T00:00:00Z"), *headers, ("Content-Length", str(len(block)))])
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(f"{VERSION}\r\n{head}\r\n".encode() + block + b"\r\n\r\n") + packer.flush()


def _line(value: str | None) -> str:
    """A header's value in one line."""
    return (value or "").replace("\\", "\\\\").replace("\r", "\\r").replace("\n", "\\n").strip()


def with_revisits(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """Rows k, u, payload, original, original_url: whether, and whose, payload repeats.

    Of equal payloads of at least `least` bytes the one with the largest key is the original, which is null here for it and
    for every payload below that size. Rows that share the largest key are all originals; so are rows without a key whose
    payload no keyed row has; a null key is never the largest. Only digests are grouped, pre-aggregated for a hot payload,
    and only those met more than once are joined back.
    """
    rows = pages.select(F.col(key).cast("long").alias("k"), F.col(url).cast("string").alias("u"), F.coalesce(F.col(html).cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("sha", F.sha1(F.col("payload").cast("binary")))
    seen = rows.where(F.octet_length("payload") >= least).groupBy("sha").agg(F.max(F.struct("k", "u")).alias("top"), F.count(F.lit(1)).alias("n"))
    # A payload met once needs no join; those met more often are few against all pages. A null key is below all others.
    tops = seen.where("n > 1 and top.k is not null").select("sha", F.col("top.k").alias("original"), F.col("top.u").alias("original_url"))
    tops = stored(tops, "originals")
    joined = rows.join(tops, "sha", "left")
    other = F.col("original").isNotNull() & ~F.col("k").eqNullSafe(F.col("original"))
    return joined.select("k", "u", "payload", "sha", F.when(other, F.col("original")).alias("original"), F.when(other, F.col("original_url")).alias("original_url"))


def write_warc(rows: DataFrame, folder: str | None = None, level: int = 3) -> DataFrame:
    """Write three records for each row of `with_revisits`; returns the stored list of files (file, records).

    A capture's request and metadata name its response or revisit as concurrent. The metadata carry the key. A revisit
    has the HTTP head with the payload's length, its digest, and where the original was found, but no payload. Every
    record is a gzip member. Record ids are made for each attempt of a task, so no two records share one.
    """
    spark = rows.sparkSession
    folder = folder or shared_path(spark, "warc")
    files.make_folder(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, out, n = files.new_name(folder, TaskContext.get().partitionId(), ".warc.gz"), None, 0
        stem = uuid.uuid4()
        for batch in batches:
            keys, urls, shas, originals, places = (batch.column(i).to_pylist() for i in (0, 1, 3, 4, 5))
            payloads = batch.column(2)
            for i, k in enumerate(keys):
                if out is None:
                    store, local = files.opened(name)
                    out = store.open_output_stream(local)
                payload = payloads[i].as_py().encode()
                ids = [str(uuid.UUID(int=(stem.int + 3 * n + j) % (1 << 128))) for j in range(3)]
                target = _line(urls[i])
                sha = ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(shas[i])).decode())
                near, uri = ("WARC-Concurrent-To", f"<urn:uuid:{ids[0]}>"), ("WARC-Target-URI", target)
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
                http = ("Content-Type", "application/http; msgtype=response")
                if originals[i] is None:
                    main = _record("response", ids[0], [uri, sha, http], head + payload, level)
                else:
                    main = _record("revisit", ids[0], [uri, sha, ("WARC-Profile", PROFILE), ("WARC-Refers-To-Target-URI", _line(places[i])), http], head, level)
                request = _record("request", ids[1], [near, uri, ("Content-Type", "application/http; msgtype=request")], f"GET {target} HTTP/1.1\r\n\r\n".encode(), level)
                fields = "" if k is None else f"key: {k}\r\n"
                out.write(request + main + _record("metadata", ids[2], [near, uri, ("Content-Type", "application/warc-fields")], fields.encode(), level))
                n += 1
        if out is None:
            return
        out.close()
        yield pa.RecordBatch.from_pydict({"file": [name], "records": pa.array([3 * n], pa.int64())})

    return stored(rows.select("k", "u", "payload", "sha", "original", "original_url").mapInArrow(write, "file string, records long"), "warc-files")


def _members(stream) -> Iterator[bytes]:
    """Gzip members of a stream, each whole."""
    data, unpack, parts = b"", zlib.decompressobj(31), []
    while True:
        data = data or stream.read(BLOCK)
        if not data:
            if parts:
                raise ValueError("the archive ends inside a record")
            return
        parts.append(unpack.decompress(data))
        data = unpack.unused_data
        if unpack.eof:
            yield b"".join(parts)
            unpack, parts = zlib.decompressobj(31), []


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of a record."""
    head, _, rest = member.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    size = int(headers["content-length"])
    if not lines[0].startswith("WARC/") or len(rest) < size:
        raise ValueError("broken record")
    return headers, rest[:size]


def read_warc(listed: DataFrame, payload: bool = True) -> DataFrame:
    """One row for each record of the listed archives; with `payload` the HTTP payload too.

    A response's digest is made anew and must equal the one in its head. A file is read as a stream, record after record.
    """
    schema = RECORD + ", payload binary" * payload

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = None
        for batch in batches:
            for name in batch.column(0).to_pylist():
                store, local = files.opened(name)
                rows, held = [], 0
                with store.open_input_stream(local) as stream:
                    for member in _members(stream):
                        h, block = parse_record(member)
                        kind, fields, body = h["warc-type"], None, None
                        size = sha = None
                        if kind in ("response", "revisit"):
                            http, _, body = block.partition(b"\r\n\r\n")
                            size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
                            sha = h["warc-payload-digest"].removeprefix("sha1:")
                            if kind == "response" and (len(body) != size or digest(body) != sha):
                                raise ValueError(f"payload of {h['warc-record-id']} does not match its digest")
                        elif kind == "metadata":
                            fields = [tuple(x.split(": ", 1)) for x in block.decode().split("\r\n") if x]
                        rows.append((kind, h["warc-record-id"], h.get("warc-concurrent-to"), h.get("warc-target-uri"), h.get("warc-refers-to-target-uri"), sha, size, fields) + ((body,) if payload else ()))
                        held += len(body or b"") if payload else 200
                        if held > 8 * BLOCK or len(rows) >= 20_000:
                            yield _batch(rows, payload)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows, payload)

    # A task for each file; left to itself, Spark would put so few rows in one task.
    return listed.select("file").repartition(max(1, listed.count())).mapInArrow(read, schema)


def _batch(rows: list[tuple], payload: bool) -> pa.RecordBatch:
    types = [pa.string()] * 6 + [pa.int64(), pa.map_(pa.string(), pa.string())] + [pa.binary()] * payload
    names = ["record_type", "record_id", "concurrent_to", "target_uri", "refers_to_uri", "payload_digest", "payload_bytes", "fields"] + ["payload"] * payload
    return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows), types)], names=names)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row for each capture: record_id, response, request, metadata, joined through concurrent-to ids.

    `response` is the response or revisit record. A capture without a request or metadata has null there; of several, the
    one with the smallest id is taken. Records that name no capture present are left out, as they belong to none.
    """
    main = records.where(F.col("record_type").isin("response", "revisit"))
    main = main.select("record_id", F.struct(*[c for c in records.columns if c not in ("concurrent_to", "fields")]).alias("response"))
    near = records.where(F.col("record_type").isin("request", "metadata") & F.col("concurrent_to").isNotNull())

    def least(kind: str, *columns: str):
        row = F.struct("record_id", *columns)
        return F.min_by(F.when(F.col("record_type") == kind, row), F.when(F.col("record_type") == kind, F.col("record_id"))).alias(kind)

    sides = near.groupBy(F.col("concurrent_to").alias("record_id")).agg(least("request", "target_uri"), least("metadata", "target_uri", "fields"))
    return main.join(sides, "record_id", "left").select("record_id", "response", "request", "metadata")


def originals(captures: DataFrame) -> DataFrame:
    """Captures with `refers_to`: for a revisit the key of the response with the same payload digest, else null.

    Only digests that a revisit names are joined. Captures that are no revisit meet none of them; their join key is their
    own record id, so that they are spread over all tasks and not gathered under a null.
    """
    keyed = captures.withColumn("key", F.col("metadata")["fields"]["key"].cast("long"))
    revisit = F.col("response.record_type") == "revisit"
    named = keyed.groupBy(F.col("response.payload_digest").alias("_d")).agg(
        F.max(F.when(~revisit, F.col("key"))).alias("refers_to"), F.bool_or(revisit).alias("_named")
    )
    meets = F.when(revisit, F.col("response.payload_digest")).otherwise(F.col("record_id"))
    return keyed.join(named.where("_named").drop("_named"), meets == F.col("_d"), "left").drop("_d")
