"""WARC archives with revisit resolution.

``resolve``: each record's header (key, payload digest, payload length) is
shuffled by payload digest, pre-aggregated to the largest key of each digest
(the original), and joined back: records with equal payloads of at least
``min_bytes`` bytes become revisits of that original. The hot-digest case is
one partial aggregate and an equi-join whose large side Spark may split.

``write_archives``: each task writes its records to one archive, one gzip
member per record with fresh headers; only responses carry a payload.
``read_archives``: each task streams archives record by record, checks every
stored payload against its digest, and returns one row per record.

Defined results: a null payload is empty; a null key is smaller than any
other; repeated rows with the largest key are all responses; an empty table
gives no archive and no rows. ``refers_to`` is null for responses.
"""

from __future__ import annotations

import base64
import datetime as dt
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm import store
from riskloom.llm.frames import written
from riskloom.session import shared_dir

# Fixed values of the format.
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = T.StructType([T.StructField("archive", T.StringType(), False), T.StructField("n_records", T.LongType(), False),
                         T.StructField("n_bytes", T.LongType(), False)])
RECORD = T.StructType([
    T.StructField("key", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("payload_bytes", T.LongType(), False), T.StructField("payload_digest", T.StringType(), False),
    T.StructField("record_type", T.StringType(), False), T.StructField("refers_to", T.LongType()),
    T.StructField("archive", T.StringType(), False), T.StructField("payload", T.BinaryType())])
_NAMES = [f.name for f in RECORD.fields]
_ROWS_PER_BATCH_BYTES = 8 << 20

def resolve(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html",
            min_bytes: int = 1000) -> DataFrame:
    """(key, url, payload, payload_bytes, payload_digest, record_type, refers_to), one row per page."""
    body = F.coalesce(F.encode(F.col(f"`{payload}`"), "UTF-8"), F.lit("").cast("binary"))
    records = pages.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{url}`").cast("string").alias("url"),
                           body.alias("payload")).withColumns({
                               "payload_bytes": F.octet_length("payload").cast("long"),
                               "payload_digest": F.sha1("payload")})
    originals = (records.where(F.col("payload_bytes") >= min_bytes).groupBy(F.col("payload_digest").alias("__digest"))
                 .agg(F.max("key").alias("__original"), F.count(F.lit(1)).alias("__n"))
                 .where("__n > 1 and __original is not null"))
    header = F.when(F.col("payload_bytes") >= min_bytes, F.col("payload_digest"))
    joined = records.join(originals, header == F.col("__digest"), "left")
    revisit = F.col("__original").isNotNull() & ~F.col("key").eqNullSafe(F.col("__original"))
    return joined.select("key", "url", F.when(~revisit, F.col("payload")).alias("payload"), "payload_bytes",
                         "payload_digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                         F.when(revisit, F.col("__original")).alias("refers_to"))

def _record_id(key, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{key}/{digest}')}>"

def _header_value(text: str) -> str:
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", text)

def _sha1(hex_digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()

def encode_record(row: dict, date: str) -> bytes:
    """One record; ``row`` as from ``resolve``."""
    body = row["payload"] or b""
    block = body
    head = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", _record_id(row["key"], row["payload_digest"])),
            ("WARC-Date", date), ("WARC-Target-URI", _header_value(row["url"] or "")),
            ("Content-Type", "text/html; charset=utf-8"), ("WARC-Payload-Digest", _sha1(row["payload_digest"])),
            ("X-Payload-Length", str(row["payload_bytes"]))]
    if row["key"] is not None:
        head.append(("X-Page-Id", str(row["key"])))
    if row["record_type"] == "revisit":
        block = b""
        head += [("WARC-Profile", SAME_PAYLOAD), ("X-Refers-To-Page-Id", str(row["refers_to"])),
                 ("WARC-Refers-To", _record_id(row["refers_to"], row["payload_digest"]))]
    head.append(("WARC-Block-Digest", _sha1(hashlib.sha1(block).hexdigest())))
    head.append(("Content-Length", str(len(block))))
    text = VERSION + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return text.encode() + block + b"\r\n\r\n"

def decode_record(raw: bytes, archive: str) -> dict:
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"{archive}: not a record: {lines[0]!r}")
    h = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = rest[:int(h["Content-Length"])]
    if _sha1(hashlib.sha1(block).hexdigest()) != h["WARC-Block-Digest"]:
        raise ValueError(f"{archive}: block digest of {h['WARC-Record-ID']} differs")
    digest = base64.b32decode(h["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    response = h["WARC-Type"] == "response"
    if response and hashlib.sha1(block).hexdigest() != digest:
        raise ValueError(f"{archive}: payload digest of {h['WARC-Record-ID']} differs")
    number = lambda k: int(h[k]) if k in h else None
    return {"key": number("X-Page-Id"), "url": h["WARC-Target-URI"], "payload_bytes": number("X-Payload-Length"),
            "payload_digest": digest, "record_type": h["WARC-Type"], "refers_to": number("X-Refers-To-Page-Id"),
            "archive": archive, "payload": block if response else None}

def write_archives(records: DataFrame, folder: str | None = None, level: int = 6) -> DataFrame:
    """Write one .warc.gz per task; returns the manifest of written archives."""
    folder = folder or shared_dir(records.sparkSession, "warc")
    date = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri, out, n, size = store.attempt_uri(folder, "part", ".warc.gz"), None, 0, 0
        try:
            for batch in batches:
                for lo in range(0, batch.num_rows, 256):
                    for row in batch.slice(lo, 256).to_pylist():
                        out = out or store.create(uri)
                        member = gzip.compress(encode_record(row, date), level, mtime=0)
                        out.write(member)
                        n, size = n + 1, size + len(member)
        finally:
            if out:
                out.close()
        if n:
            yield pa.RecordBatch.from_pydict({"archive": [uri], "n_records": [n], "n_bytes": [size]})
    return written(records.mapInArrow(run, MANIFEST), "warc-manifest")

def members(stream, block: int = 1 << 20) -> Iterator[bytes]:
    """Gzip members of a stream, one at a time."""
    left = b""
    while True:
        z, parts = zlib.decompressobj(31), []
        while not z.eof:
            left = left or stream.read(block)
            if not left:
                if parts:
                    raise ValueError("archive ends inside a record")
                return
            parts.append(z.decompress(left))
            left = z.unused_data
        yield b"".join(parts)

def read_archives(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives in the manifest."""
    names = [x for x in _NAMES if with_payload or x != "payload"]
    schema = T.StructType([f for f in RECORD.fields if f.name in names])
    types = pa.schema([("key", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                       ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                       ("archive", pa.string())] + [("payload", pa.binary())] * with_payload)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                rows, size = [], 0
                with store.random_access(uri) as f:
                    for raw in members(f):
                        row = decode_record(raw, uri)
                        rows.append({k: row[k] for k in names})
                        size += 200 + len(row["payload"] or b"") * with_payload
                        if size > _ROWS_PER_BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema=types)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=types)
    files = manifest.select("archive")
    return files.repartition(max(1, min(files.count(), 4096)), "archive").mapInArrow(run, schema)

def with_resolved_payload(records: DataFrame) -> DataFrame:
    """Give each revisit the payload of the response it refers to (null if that is not among the records)."""
    originals = records.where("record_type = 'response'").groupBy(
        F.col("key").alias("__key"), F.col("payload_digest").alias("__digest")).agg(F.first("payload").alias("__payload"))
    return records.join(originals, (F.col("refers_to") == F.col("__key")) & (F.col("payload_digest") == F.col("__digest")),
                        "left").withColumn("payload", F.coalesce("payload", "__payload")).drop("__key", "__digest", "__payload")
