"""WARC archives written and read as a table of record chunks.

A payload travels as rows of record identifier, chunk number and bytes, from the split of the
text to the bytes in the file and back, so no Python worker holds a whole record. Both the
writer and the reader carry the digest from chunk to chunk; the writer refuses a payload whose
digest differs from the one in its header.

Of records with equal payloads of ``least`` bytes or more the one with the largest identifier
is a response and the others are revisits that refer to it.

Archives are compressed record by record, a gzip member each. Every task writes its own file
under a name of its own and reports it; only reported files are archives, so what a lost or
repeated task left behind is never read. Files go through Arrow's file systems by their URI
(local, HDFS, S3, GCS).

Defined results: a null payload is an empty one; a null url is an empty target; rows with a
null identifier are records without one, each on its own: they neither refer to others nor are
referred to; repeated rows are separate records, and each row with the largest identifier of its
payload is a response; other columns are ignored, whatever their names; an empty table gives no
archives.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wirecount.llm.common import map_batches, text_of
from wirecount.operators.lookup import lookup_join

CHUNK, LEVEL = 1 << 18, 4
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DATE = "2024-01-01T00:00:00Z"
CHUNKS = ("record_id string, page_id long, url string, record_type string, digest string, "
          "payload_bytes long, refers_to long, chunk int, last boolean, data binary")
MANIFEST = "path string, records long, bytes long"


def base32(sha1_hex: Column) -> Column:
    """Upper-case base32 of a hexadecimal SHA-1."""
    def letters(i):
        five = F.conv(F.substr(sha1_hex, i * 5 + 1, F.lit(5)), 16, 10).cast("int")
        return F.concat(*(F.substr(F.lit(ALPHABET), F.shiftright(five, 15 - 5 * k).bitwiseAND(31)
                                   + 1, F.lit(1)) for k in range(4)))

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), letters), "")


def with_references(pages: DataFrame, key: str = "page_id", url: str = "url",
                    payload: str = "html", least: int = 0) -> DataFrame:
    """Records to write: ``page_id, url, body, digest, bytes, refers_to``.

    Payloads are told apart by digest and length. Leaders of copies are found by an aggregate
    with a map-side step. Where they fit a measured broadcast no payload is shuffled; beyond that
    they are joined back over salts, so copies of one payload that make up a third of the table
    are spread over tasks.
    """
    body = F.encode(text_of(payload), "UTF-8")
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"), text_of(url).alias("url"),
        body.alias("body"), F.octet_length(body).cast("long").alias("bytes"),
        F.sha1(body).alias("sha"))
    known = (F.col("bytes") >= least) & F.col("page_id").isNotNull()
    # Records that cannot be copies have a null here, which meets nothing.
    rows = rows.withColumn("same", F.when(known, F.struct("sha", "bytes")))
    leaders = (
        rows.where(known).groupBy("same").agg(
            F.max("page_id").alias("leader"), F.count("*").alias("n"))
        .where("n > 1").select("same", "leader"))
    joined = lookup_join(rows, leaders, ["same"], "left", spread_by=["page_id", "url"])
    refers = F.when(F.col("leader") != F.col("page_id"), F.col("leader"))
    return joined.select("page_id", "url", "body", base32(F.col("sha")).alias("digest"),
                         "bytes", refers.alias("refers_to"))


def chunk_rows(records: DataFrame, size: int = CHUNK) -> DataFrame:
    """Records as rows of ``size`` bytes, those of a record together and in order."""
    body = F.when(F.col("refers_to").isNull(), F.col("body")).otherwise(F.lit(b""))
    numbers = F.sequence(F.lit(0), F.floor(F.greatest(F.octet_length(body) - 1, F.lit(0)) / size)
                         .cast("int"))
    split = records.select(
        F.uuid().alias("record_id"), "page_id", "url", "digest", "bytes", "refers_to",
        body.alias("body"), F.explode(numbers).alias("chunk"))
    return split.select(
        "record_id", "page_id", "url", "digest", "bytes", "refers_to", "chunk",
        (F.octet_length("body") <= (F.col("chunk") + 1) * size).alias("last"),
        F.octet_length("body").alias("stored"),
        F.substr("body", F.col("chunk") * size + 1, F.lit(size)).alias("data"))


def _line(text: str) -> str:
    """A header value: no line breaks, so no text can add a header."""
    return " ".join(text.split())


def _head(record_id, page_id, url, digest, size, refers_to, stored) -> bytes:
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {size}\r\n\r\n").encode()
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: <urn:uuid:{record_id}>", f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {_line(url)}", f"WARC-Payload-Digest: sha1:{digest}",
             "Content-Type: application/http;msgtype=response",
             f"Content-Length: {len(http) + stored}"]
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        lines.append("WARC-Profile: "
                     "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"X-Refers-To-Page-Id: {refers_to}")
    return "\r\n".join([*lines, "", ""]).encode() + http


def _b32(digest) -> str:
    return base64.b32encode(digest.digest()).decode()


def write(records: DataFrame, folder: str, size: int = CHUNK) -> DataFrame:
    """Write ``records`` (see ``with_references``) as one archive per task below ``folder``.

    Returns the manifest, ``path, records, bytes``. It is lazy: store it once and read the
    archives that the stored manifest names.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = out = member = digest = None
        count = 0
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[:-1]]
            data = batch.column(batch.num_columns - 1)
            for i, row in enumerate(zip(*columns)):
                record_id, page_id, url, wanted, payload, refers_to, chunk, last, stored = row
                if out is None:
                    system, root = fs.FileSystem.from_uri(folder)
                    system.create_dir(root, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    path = f"{folder}/{name}"
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                if chunk == 0:
                    member = zlib.compressobj(LEVEL, wbits=31)
                    out.write(member.compress(
                        _head(record_id, page_id, url, wanted, payload, refers_to, stored)))
                    digest = hashlib.sha1()
                part = data[i].as_buffer()
                out.write(member.compress(part))
                digest.update(part)
                if last:
                    if refers_to is None and _b32(digest) != wanted:
                        raise ValueError(f"payload of record {record_id} changed on its way")
                    out.write(member.compress(b"\r\n\r\n") + member.flush())
                    count += 1
        if out is not None:
            total = out.tell()
            out.close()
            yield pa.RecordBatch.from_pydict(
                {"path": [path], "records": [count], "bytes": [total]},
                schema=pa.schema([("path", pa.string()), ("records", pa.int64()),
                                  ("bytes", pa.int64())]))

    return map_batches(chunk_rows(records, size), run, MANIFEST)


def read(spark: SparkSession, manifest: DataFrame, size: int = CHUNK,
         data: bool = True) -> DataFrame:
    """The records of the archives in ``manifest`` as chunk rows.

    ``digest`` and ``payload_bytes`` stand in the last chunk of a record: computed over the
    chunks for a response, as its header states for a revisit. ``data=False`` reads and digests
    the payloads without returning their bytes.
    """
    schema = pa.schema([
        ("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
        ("record_type", pa.string()), ("digest", pa.string()), ("payload_bytes", pa.int64()),
        ("refers_to", pa.int64()), ("chunk", pa.int32()), ("last", pa.bool_()),
        ("data", pa.binary())])

    def chunks(path: str):
        system, inner = fs.FileSystem.from_uri(path)
        packed = io.BufferedReader(system.open_input_stream(inner, compression=None), 1 << 20)
        with packed, gzip.open(packed) as f:
            while (line := _read_line(f)) is not None:
                if not line:
                    continue
                if not line.startswith("WARC/"):
                    raise ValueError(f"{path}: no record where one should begin")
                head, _ = _headers(f)
                status = f.readline()
                if not status.startswith(b"HTTP/"):
                    raise ValueError(f"{path}: record without response")
                http, length = _headers(f)
                left = int(head["content-length"]) - len(status) - length
                kind = head["warc-type"]
                ids = [head["warc-record-id"].removeprefix("<urn:uuid:").rstrip(">"),
                       int(head["x-page-id"]) if "x-page-id" in head else None,
                       head["warc-target-uri"], kind]
                refers = head.get("x-refers-to-page-id")
                refers = int(refers) if refers is not None else None
                digest, number, total = hashlib.sha1(), 0, 0
                while True:
                    part = f.read(min(size, left))
                    if len(part) < min(size, left):
                        raise ValueError(f"{path}: record is cut off")
                    left -= len(part)
                    total += len(part)
                    digest.update(part)
                    said, length = None, None
                    if not left:
                        stated = head["warc-payload-digest"].removeprefix("sha1:")
                        said = _b32(digest) if kind == "response" else stated
                        if said != stated:
                            raise ValueError(f"{path}: payload does not match its digest")
                        length = total if kind == "response" else int(http["content-length"])
                    yield (*ids, said, length, refers, number, not left, part if data else None)
                    number += 1
                    if not left:
                        break

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for row in chunks(path):
                    rows.append(row)
                    held += len(row[-1] or b"")
                    if len(rows) >= 1000 or held >= 8 << 20:
                        yield _batch(rows, schema)
                        rows, held = [], 0
        if rows:
            yield _batch(rows, schema)

    # One archive is one task's work, wherever its row of the manifest was written.
    paths = manifest.select("path")
    tasks = max(spark.sparkContext.defaultParallelism,
                int(spark.conf.get("spark.sql.shuffle.partitions")))
    return map_batches(paths.repartition(tasks, "path"), run, CHUNKS)


def _batch(rows, schema):
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _read_line(f) -> str | None:
    """A line without its end; None at the end of the file."""
    line = f.readline()
    return line.decode().rstrip("\r\n") if line else None


def _headers(f) -> tuple[dict[str, str], int]:
    """Header fields up to the empty line, and the bytes they take with it."""
    found, size = {}, 0
    while line := f.readline():
        size += len(line)
        name, _, value = line.decode().strip().partition(":")
        if not name:
            break
        found[name.strip().lower()] = value.strip()
    return found, size
