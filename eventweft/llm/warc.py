"""WARC archives: a writer of one gzip member per record, and a splittable reader.

Writing: equal payloads are grouped by their digest, aggregated on the map side and joined back under a
salt; of a group the row with the largest id is a response record, the others revisit it. Tasks write
archives straight to the shared folder under names of their own attempt; only files named in the
committed manifest count, so a lost executor leaves no trace in the result.

Reading: the manifest gives byte ranges of ``SPLIT`` bytes. A task scans its range for the gzip magic,
takes a candidate for a member if it decodes to a WARC header and to exactly the bytes that the header
states, and owns the records that start inside its range; the last one is read to its end beyond it. A
member that begins inside another's stored (uncompressed) bytes would be taken too; text never holds
the magic, since it isn't valid UTF-8.

Defined results: NULL html is an empty payload; NULL url leaves out the target; a NULL id is smaller than
any other; rows that tie on the largest id of their payload are all responses; repeated rows give one
record each; empty tables give no archive and no rows. Columns other than page_id, url and html are not
read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import record_batch, scratch, table

SPLIT = 32 << 20
FILE_BYTES = 1 << 28
SALTS = 8
LEVEL = 5
#: Members are decoded in pieces of at most this size.
PIECE = 1 << 20
CHUNK = 1 << 18
DATE = "2024-01-01T00:00:00Z"
MAGIC = b"\x1f\x8b\x08"

MANIFEST = "path string, bytes long, records long"
RECORDS = (
    "path string, position long, record_type string, record_id string, target_uri string, "
    "payload_digest string, payload_bytes long, refers_to string, digest_ok boolean"
)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_name(page_id: object) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def member(page_id: object, url: str | None, payload: bytes, refers_to: object, revisit: bool) -> bytes:
    """One record as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_name(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url))
    lines.append(f"WARC-Payload-Digest: sha1:{digest_of(payload)}")
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {record_name(refers_to)}")
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + pack.flush()


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, html, refers_to, is_revisit."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", "html", F.sha1(payload).alias("digest"))
    groups = rows.groupBy("digest").agg(F.max("page_id").alias("top"), F.count("*").alias("n")).filter("n > 1")
    groups = groups.select("digest", "top", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salt = F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int").alias("salt")
    known = rows.select("*", salt).join(groups, ["digest", "salt"], "left")
    revisit = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    return known.select("page_id", "url", "html", F.when(revisit, F.col("top")).alias("refers_to"), revisit.alias("is_revisit"))


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Writes archives below ``folder`` and returns their manifest, itself written and read again."""
    spark = pages.sparkSession

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        part = TaskContext.get().partitionId()
        out, name, size, count = None, "", 0, 0
        done: list[tuple[str, int, int]] = []
        for batch in batches:
            columns = [batch.column(n) for n in ("page_id", "url", "html", "refers_to", "is_revisit")]
            for row in zip(*columns):
                page_id, url, html, refers_to, revisit = (v.as_py() for v in row)
                data = member(page_id, url, (html or "").encode(), refers_to, revisit)
                if out is None:
                    name = f"part-{part:06d}-{uuid.uuid4().hex}.warc.gz"
                    out, size, count = store.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= FILE_BYTES:
                    out.close()
                    done.append((name, size, count))
                    out = None
        if out is not None:
            out.close()
            done.append((name, size, count))
        yield record_batch([
            ("path", [f"{folder}/{n}" for n, _, _ in done], pa.string()),
            ("bytes", [s for _, s, _ in done], pa.int64()),
            ("records", [c for _, _, c in done], pa.int64()),
        ])

    path = f"{folder}-manifest"
    with_revisits(pages).mapInArrow(save, MANIFEST).write.parquet(path)
    return spark.read.schema(MANIFEST).parquet(path)


def parse_header(data: bytes) -> dict[str, str] | None:
    """Fields of a WARC header, or None if it is none."""
    lines = data.split(b"\r\n")
    if not re.fullmatch(rb"WARC/1\.[0-9]", lines[0]):
        return None
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.decode("latin-1").lower()] = value.strip().decode("utf-8", "replace")
    needed = ("warc-type", "warc-record-id", "content-length")
    return fields if all(n in fields for n in needed) and fields["content-length"].isdigit() else None


def read_member(file: pa.NativeFile, position: int) -> tuple[dict[str, str], bytes, int] | None:
    """Header, block and end of the member at ``position``; None if there is no whole record."""
    file.seek(position)
    unpack, out, header, fed = zlib.decompressobj(31), bytearray(), -1, 0
    fields = None
    while not unpack.eof:
        data = unpack.unconsumed_tail
        if not data:
            data = file.read(CHUNK)
            fed += len(data)
        try:
            piece = unpack.decompress(data, PIECE)
        except zlib.error:
            return None
        if not data and not piece and not unpack.eof:
            return None
        seen = len(out)
        out += piece
        if fields is None:
            # of any length: only what begins as a record is decoded further
            if not bytes(out[:7]) == b"WARC/1."[: len(out[:7])]:
                return None
            header = out.find(b"\r\n\r\n", max(0, seen - 3))
            if header >= 0:
                fields = parse_header(bytes(out[:header]))
                if fields is None:
                    return None
        if fields is not None and len(out) > header + 8 + int(fields["content-length"]):
            return None
    if fields is None:
        return None
    block = bytes(out[header + 4 : -4])
    if len(block) != int(fields["content-length"]) or not out.endswith(b"\r\n\r\n"):
        return None
    return fields, block, position + fed - len(unpack.unused_data)


def records_in(file: pa.NativeFile, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Records that start in [start, end)."""
    at = start
    while at < end:
        file.seek(at)
        window = file.read(min(CHUNK, end - at) + len(MAGIC) - 1)
        found = window.find(MAGIC)
        if found < 0 or at + found >= end:
            at += max(1, len(window) - len(MAGIC) + 1)
            continue
        at += found
        got = read_member(file, at)
        if got is None:
            at += 1
            continue
        yield at, got[0], got[1]
        at = got[2]


def read(manifest: DataFrame, split: int = SPLIT, payload: bool = False) -> DataFrame:
    """The records of all archives of a manifest, with their payloads if asked for."""
    total = manifest.agg(F.sum("bytes"), F.count("*")).first()
    spots = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split).cast("long")))
    ranges = manifest.select("path", "bytes", spots.alias("start")).repartition(max(1, (total[0] or 0) // split + (total[1] or 0)))

    kind = RECORDS + (", payload binary" if payload else "")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [p.split()[0] for p in kind.split(", ")]
        kinds = [pa.string(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.bool_(), pa.binary()]
        for batch in batches:
            for path, start, size in zip(*(batch.column(n).to_pylist() for n in ("path", "start", "bytes"))):
                store, inner = fs.FileSystem.from_uri(path)
                rows = []
                with store.open_input_file(inner) as file:
                    for at, fields, block in records_in(file, start, min(start + split, size)):
                        http, _, body = block.partition(b"\r\n\r\n")
                        stated = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
                        if fields["warc-type"] == "revisit":
                            length = re.search(rb"(?im)^content-length:\s*([0-9]+)", http)
                            size_, digest, fine = int(length[1]) if length else None, stated, None
                        else:
                            digest = digest_of(body)
                            size_, fine = len(body), stated is None or stated == digest
                        rows.append((path, at, fields["warc-type"], fields["warc-record-id"], fields.get("warc-target-uri"), digest, size_, fields.get("warc-refers-to"), fine, body if payload else None))
                yield record_batch([(n, [r[k] for r in rows], kinds[k]) for k, n in enumerate(names)])

    return ranges.mapInArrow(scan, kind)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = read(write(pages, scratch(spark, "warc")))
    kind = pages.schema["page_id"].dataType.simpleString()

    def page(column: str) -> F.Column:
        return F.expr(f"try_cast(regexp_extract({column}, ':x-page:(-?[0-9]+)>', 1) AS {kind})")

    return found.select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page("refers_to").alias("refers_to"), "digest_ok",
    )


OP1_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS h FROM p),
t AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM d)
SELECT page_id, n AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(h, 5 * (i // 4) + 1, 5))::INT >> (15 - 5 * (i % 4))) & 31)::INT, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to,
  CASE WHEN page_id IS NOT DISTINCT FROM top THEN TRUE END AS digest_ok
FROM t
"""
