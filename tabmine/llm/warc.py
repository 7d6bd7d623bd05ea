"""Operator 4: WARC archives, one gzip member per record.

Tasks write archives of bounded size under the shared folder and report them in a
manifest; only archives named there count, so a lost task leaves nothing but an
unread file.  The reader goes through an archive from start to end: members are
decompressed step by step, records are framed by Content-Length, and block and payload digests
are verified."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmine.llm.common import small_side
from tabmine.session import cut_lineage, ensure_checkpoint_dir

# fixed values of the WARC 1.1 format
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = b"\r\n"
ARCHIVE_BYTES = 256 << 20
STEP = 1 << 16
MANIFEST = "archive string, records bigint, bytes bigint"
RECORDS = ("record_id string, url string, record_type string, refers_to string, payload_bytes bigint, "
           "payload_digest string, payload binary")


def digest(data: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _store(uri: str):
    """File system and path of a folder or file, whatever store it is in."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri) if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def record(record_id: str, url: str, payload: bytes, refers_to: str | None) -> bytes:
    """One record as a gzip member: a response with its payload, or a revisit with the head only."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if refers_to else head + payload
    fields = [("WARC-Type", "revisit" if refers_to else "response"), ("WARC-Record-ID", f"<{record_id}>"),
              ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)),
              ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
              ("WARC-Block-Digest", f"sha1:{digest(block)}")]
    if refers_to:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{refers_to}>")]
    lines = ["WARC/1.1", *[f"{k}: {v}" for k, v in fields], f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + block + CRLF + CRLF) + packer.flush()


def members(stream, step: int = STEP):
    """Content of every gzip member, decompressed ``step`` bytes of input at a time."""
    rest, d, out = b"", None, []
    while True:
        data = rest or stream.read(step)
        rest = b""
        if not data:
            if d is not None:
                raise ValueError("archive ends inside a member")
            return
        d = d or zlib.decompressobj(31)
        out.append(d.decompress(data))
        if d.eof:
            yield b"".join(out)
            rest, d, out = d.unused_data, None, []


def parse(member: bytes) -> dict:
    """Fields and payload of one record; its framing and digests must hold."""
    end = member.index(CRLF + CRLF)
    version, *lines = member[:end].decode().split("\r\n")
    field = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    n, start = int(field["content-length"]), end + 4
    block = member[start:start + n]
    if not version.startswith("WARC/1.") or len(block) != n or member[start + n:] != CRLF + CRLF:
        raise ValueError(f"broken framing of {field.get('warc-record-id')}")
    if field["warc-block-digest"] != f"sha1:{digest(block)}":
        raise ValueError(f"block digest of {field['warc-record-id']} does not hold")
    _, _, payload = block.partition(CRLF + CRLF)
    if field["warc-type"] == "response" and field["warc-payload-digest"] != f"sha1:{digest(payload)}":
        raise ValueError(f"payload digest of {field['warc-record-id']} does not hold")
    return field | {"payload": payload if field["warc-type"] == "response" else None}


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages(record_id, url, payload, refers_to)`` as archives under ``folder``; returns the manifest."""
    def run(batches):
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        out = name = None
        n = size = 0
        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    name, n, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                data = record(r["record_id"], r["url"] or "", r["payload"], r["refers_to"])
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= archive_bytes:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pylist([{"archive": name, "records": n, "bytes": size}])
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"archive": name, "records": n, "bytes": size}])

    return cut_lineage(pages.select("record_id", "url", "payload", "refers_to").mapInArrow(run, MANIFEST))


def read_archives(manifest: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """Every record of the archives named in ``manifest``, one sequential reader per
    archive.  Revisits have no payload of their own: their ``payload_bytes`` is null."""
    def run(batches):
        store, root = _store(folder)
        for pdf in batches:
            for name, expected in zip(pdf["archive"], pdf["records"], strict=True):
                rows, n, held = [], 0, 0
                with store.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for member in members(stream):
                        f = parse(member)
                        body, n = f["payload"], n + 1
                        rows.append((f["warc-record-id"][1:-1], f["warc-target-uri"], f["warc-type"],
                                     f.get("warc-refers-to", "<>")[1:-1] or None, None if body is None else len(body),
                                     f["warc-payload-digest"].removeprefix("sha1:"), body if with_payload else None))
                        held += len(member)
                        if held > 4 << 20 or len(rows) >= 5000:
                            yield _frame(rows)
                            rows, held = [], 0
                if n != expected:
                    raise ValueError(f"{name}: {n} records, the manifest says {expected}")
                if rows:
                    yield _frame(rows)

    return manifest.repartition(max(1, manifest.count())).mapInPandas(run, RECORDS)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = [c.split()[0] for c in RECORDS.split(", ")]
    return pd.DataFrame(rows, columns=names).astype({"payload_bytes": "Int64"})


def round_trip(pages: DataFrame, folder: str | None = None, least: int = 0, id_col: str = "page_id",
               payload_col: str = "html", url_col: str = "url") -> DataFrame:
    """Write one record per row and read all back:
    ``(id, payload_bytes, payload_digest, record_type, refers_to, url)``.

    Of equal payloads of at least ``least`` bytes the row with the smallest id is the response, the
    others are revisits of it; smaller payloads are all responses.  Null payloads are empty.
    Rows that repeat the smallest id are responses as well.  Rows without an id are
    revisits if an equal payload has an id, else responses.  Null urls come back empty, white
    space in urls percent-encoded.  Other columns are ignored."""
    spark = pages.sparkSession
    folder = folder or f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    rows = pages.select(F.col(id_col).cast("bigint").alias("_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("_h", F.sha1("payload"))
    again = cut_lineage(rows.where(F.octet_length("payload") >= least).groupBy("_h").agg(
        F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_h", "_first"))
    rows = rows.join(small_side(again), "_h", "left")
    same = F.col("_first").isNotNull() & ((F.col("_id") != F.col("_first")) | F.col("_id").isNull())
    rows = rows.select(F.coalesce(F.concat(F.lit("urn:x-page:"), F.col("_id")), F.lit("urn:x-page:none")).alias("record_id"),
                       "url", "payload", F.when(same, F.concat(F.lit("urn:x-page:"), F.col("_first"))).alias("refers_to"))
    back = cut_lineage(read_archives(write_archives(rows, folder), folder, with_payload=False).drop("payload"))
    number = lambda c: F.expr(f"try_cast(substring({c}, 12) AS bigint)")
    sizes = cut_lineage(back.where("refers_to IS NOT NULL").select("payload_digest").distinct()
                        .join(back.where("refers_to IS NULL").groupBy("payload_digest").agg(
                            F.min("payload_bytes").alias("_size")), "payload_digest"))
    return back.join(small_side(sizes), "payload_digest", "left").select(
        number("record_id").alias(id_col), F.coalesce("payload_bytes", "_size").alias("payload_bytes"), "payload_digest",
        "record_type", number("refers_to").alias("refers_to"), "url")
