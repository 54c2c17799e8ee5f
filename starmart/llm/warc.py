"""WARC archives with the index first.

Writing: every row becomes a record of its own gzip member.  The first row
(smallest page_id) of equal payloads of at least ``min_bytes`` bytes is a
response; the others are revisits that name it and carry no payload.  Each
task writes files of about ``file_bytes`` under names of its own attempt, and
returns one index row per record: file, offset, length, URL and payload
digest.  The index is written once as Parquet; files of failed attempts are
in no index row and so are never read.

Reading: the wanted index rows are sorted by file and offset, neighbours less
than ``gap`` bytes apart are read in one range of at most ``span`` bytes, and
records are parsed from the bytes that their index row names.

Null html is an empty payload; a null URL is written as an empty target.  Rows
of null page_id are records but nobody's original.  Repeated rows are records
each; those that share the smallest page_id of their payload are all
responses.  Files are reached through the file system of the shared folder's
URI, by tasks only.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import cut
from starmart.session import scratch_dir

FILE_BYTES = 64 << 20
GAP, SPAN = 64 << 10, 8 << 20
MIN_BYTES = 0
INDEX = "page_id long, url string, record_type string, refers_to long, digest string, file string, offset long, length long"
_DATE = "2000-01-01T00:00:00Z"  # archives of equal rows are equal


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One gzip member holding a response or revisit record."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    body = head + (payload if refers_to is None else b"")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_name(page_id)}",
             f"WARC-Date: {_DATE}", "WARC-Target-URI: " + "".join((url or "").split()), f"WARC-Payload-Digest: sha1:{digest}",
             "Content-Type: application/http; msgtype=response"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {_name(refers_to)}",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines.append(f"Content-Length: {len(body)}")
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n", 6, mtime=0)


def parse(member: bytes) -> dict:
    """Headers and payload of one record."""
    data = gzip.decompress(member)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    body = rest[:int(fields["Content-Length"])]
    if rest[len(body):] != b"\r\n\r\n":
        raise ValueError("a WARC record is not whole")
    ident = lambda x: int(x[len("<urn:page:"):-1]) if x and x != _name(None) else None
    payload, digest = body.partition(b"\r\n\r\n")[2], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and base32_sha1(payload) != digest:
        raise ValueError("a payload differs from its digest")
    return {"page_id": ident(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"], "record_type": fields["WARC-Type"],
            "refers_to": ident(fields.get("WARC-Refers-To")), "digest": digest,
            "payload": payload if fields["WARC-Type"] == "response" else None}


def write(pages: DataFrame, min_bytes: int = MIN_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Archives of ``pages`` (page_id, url, html), and their index."""
    folder = scratch_dir(pages.sparkSession, "warc")
    if "://" not in folder and folder.startswith("file:"):
        folder = folder[len("file:"):]
    rows = pages.select(F.col("page_id").cast("long"), "url", F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("key", F.unhex(F.sha2("payload", 256)))
    first = (rows.where((F.octet_length("payload") >= min_bytes) & F.col("page_id").isNotNull())
             .groupBy("key").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    roles = rows.join(first, "key", "left").select(
        "page_id", "url", "payload",
        F.when(F.col("first") != F.coalesce("page_id", F.col("first") - 1), F.col("first")).alias("refers_to"))

    def archive(batches):
        store, root = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
        store.create_dir(root, recursive=True)
        out, name, at = None, None, 0
        try:
            for batch in batches:
                index = []
                for row in batch.to_pylist():
                    if out is None or at >= file_bytes:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    digest = base32_sha1(row["payload"])
                    member = record(row["page_id"], row["url"], row["payload"], digest, row["refers_to"])
                    out.write(member)
                    index.append((row["page_id"], row["url"], "response" if row["refers_to"] is None else "revisit",
                                  row["refers_to"], digest, f"{folder}/{name}", at, len(member)))
                    at += len(member)
                if index:
                    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*index, strict=True), kinds, strict=True)],
                                                     names=[c.split()[0] for c in INDEX.split(", ")])
        finally:
            if out is not None:
                out.close()

    return cut(roles.mapInArrow(archive, INDEX), "warc-index")


def ranges(wanted: list[tuple[int, int]], gap: int = GAP, span: int = SPAN) -> list[tuple[int, int, list[int]]]:
    """Sorted (offset, length) coalesced: (start, end, positions in wanted)."""
    out: list[tuple[int, int, list[int]]] = []
    for k, (offset, length) in enumerate(wanted):
        if out and offset - out[-1][1] <= gap and offset + length - out[-1][0] <= span:
            out[-1] = (out[-1][0], max(out[-1][1], offset + length), [*out[-1][2], k])
        else:
            out.append((offset, offset + length, [k]))
    return out


def read(selected: DataFrame) -> DataFrame:
    """The records of the selected index rows: page_id, url, record_type,
    refers_to, digest, payload (null for revisits)."""
    def fetch(batches):
        for batch in batches:
            rows = batch.to_pylist()
            lo = 0
            while lo < len(rows):
                hi = lo
                while hi < len(rows) and rows[hi]["file"] == rows[lo]["file"]:
                    hi += 1
                part, uri = rows[lo:hi], rows[lo]["file"]
                store, path = fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)
                with store.open_input_file(path) as f:
                    for start, end, members in ranges([(r["offset"], r["length"]) for r in part]):
                        data = f.read_at(end - start, start)
                        found = [parse(data[part[k]["offset"] - start:part[k]["offset"] - start + part[k]["length"]]) for k in members]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([r[c] for r in found], t) for c, t in (
                                ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                                ("refers_to", pa.int64()), ("digest", pa.string()), ("payload", pa.binary()))],
                            names=["page_id", "url", "record_type", "refers_to", "digest", "payload"])
                lo = hi

    tasks = int(selected.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (selected.select("file", "offset", "length").repartition(tasks, "file").sortWithinPartitions("file", "offset")
            .mapInArrow(fetch, "page_id long, url string, record_type string, refers_to long, digest string, payload binary"))


def resolved(index: DataFrame) -> DataFrame:
    """Every record with the length and digest of its full payload, a
    revisit's taken from the response it names."""
    back = cut(read(index).select("page_id", "record_type", "refers_to", "digest", "payload")
               .withColumn("payload_bytes", F.octet_length("payload").cast("long")).drop("payload"), "warc-records")
    first = (back.where("record_type = 'response' and page_id is not null")
             .groupBy(F.col("page_id").alias("refers_to"), "digest").agg(F.max("payload_bytes").alias("of_first")))
    return (back.join(first, ["refers_to", "digest"], "left")
            .select("page_id", F.coalesce("payload_bytes", "of_first").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
                    "record_type", "refers_to"))
