"""WARC archives as seekable Zstandard bundles: independent frames, a seek table at the end, and an index by record."""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoframe.llm.common import bounded, cut, stored, table, text_bytes

#: Payloads of at least so many bytes are stored once; later ones are revisits.
LEAST_SHARED = 100
#: A frame is closed beyond so many bytes of records, a bundle beyond so many compressed bytes.
FRAME, BUNDLE = 1 << 18, 1 << 24
# Fixed values of the public seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1

WARC_DATE = "2024-01-01T00:00:00Z"


def record(record_id: int | None, uri: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC/1.1 record. A revisit has no payload and names the response that has it."""
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<urn:page:{'' if record_id is None else record_id}>",
        "WARC-Date": WARC_DATE,
        "WARC-Target-URI": re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri or ""),
        "WARC-Payload-Digest": f"sha256:{hashlib.sha256(payload).hexdigest()}",
        "X-Payload-Length": str(len(payload)),
        "Content-Type": "text/html; charset=utf-8",
    }
    if refers_to is not None:
        head |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": f"<urn:page:{refers_to}>"}
    body = payload if refers_to is None else b""
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + f"Content-Length: {len(body)}\r\n\r\n").encode() + body + b"\r\n\r\n"


def read_record(data: bytes, offset: int) -> tuple[dict[str, str], bytes, int]:
    """(head, body, end) of the record at an offset; raises ValueError if there is none."""
    stop = data.find(b"\r\n\r\n", offset)
    lines = data[offset:stop].decode().split("\r\n")
    if stop < 0 or lines[0] != "WARC/1.1":
        raise ValueError(f"no record at {offset}")
    head = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    end = stop + 4 + int(head["Content-Length"])
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError(f"the record at {offset} has no end")
    return head, data[stop + 4 : end], end + 4


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The skippable frame that lists (compressed, plain) sizes, without checksums."""
    body = b"".join(struct.pack("<II", *x) for x in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(bundle: bytes) -> list[tuple[int, int]]:
    """(offset, compressed size) of each frame, from the last bytes of a bundle alone."""
    count, flags, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != SEEKABLE or flags:
        raise ValueError("no seek table without checksums")
    sizes = [struct.unpack("<II", bundle[k : k + 8]) for k in range(len(bundle) - 9 - 8 * count, len(bundle) - 9, 8)]
    out, at = [], 0
    for packed, _ in sizes:
        out.append((at, packed))
        at += packed
    return out


def read_frame(bundle: bytes, frame: tuple[int, int]) -> bytes:
    return zstandard.ZstdDecompressor().decompress(bundle[frame[0] : frame[0] + frame[1]])


def mark_revisits(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """(page_id, url, html, refers_to): of equal payloads of ``least`` bytes the smallest page_id is the response, others refer to it.

    Only ids and digests are grouped and joined, by digest; what they tell comes back to the payloads by
    id, without a shuffle of these if there are few revisits. Null html is empty; a page without id is a
    response of its own; of repeated rows with one id none refers to another.
    """
    given = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    digest = given.withColumn("digest", F.unhex(F.sha2("html", 256)))
    ids = digest.where((F.octet_length("html") >= least) & F.col("page_id").isNotNull()).select("page_id", "digest")
    first = cut(ids.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n"))
    revisits = cut(ids.join(bounded(first), "digest").where("page_id <> refers_to").distinct())
    return digest.join(bounded(revisits), ["page_id", "digest"], "left").select("page_id", "url", "html", "refers_to")


def write_bundles(marked: DataFrame, frame_bytes: int = FRAME, bundle_bytes: int = BUNDLE) -> DataFrame:
    """(bundle, data, index): seekable bundles of the records of mark_revisits, with (page_id, frame, offset) of each record.

    Records are grouped into frames that decompress on their own; a bundle is one binary value that
    can be written out as a .warc.zst file as it is. A task holds one bundle at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        packer = zstandard.ZstdCompressor(level=3, write_content_size=True)
        part, number = TaskContext.get().partitionId(), 0
        parts: list[bytes] = []
        frames: list[tuple[int, int]] = []
        index: list[dict] = []
        held = bytearray()

        def close_frame() -> None:
            if held:
                parts.append(packer.compress(bytes(held)))
                frames.append((len(parts[-1]), len(held)))
                held.clear()

        def bundle() -> pa.RecordBatch:
            close_frame()
            out = pa.RecordBatch.from_pylist([{"bundle": f"{part:06d}-{number:06d}", "data": b"".join(parts) + seek_table(frames), "index": list(index)}], schema)
            for x in (parts, frames, index):
                x.clear()
            return out

        for batch in batches:
            for page, url, html, refers in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), text_bytes(batch.column(2)), batch.column(3).to_pylist()):
                index.append({"page_id": page, "frame": len(frames), "offset": len(held)})
                held += record(page, url, html, refers)
                if len(held) >= frame_bytes:
                    close_frame()
                    if sum(map(len, parts)) >= bundle_bytes:
                        yield bundle()
                        number += 1
        if index:
            yield bundle()

    schema = pa.schema([("bundle", pa.string()), ("data", pa.binary()), ("index", pa.list_(pa.struct([("page_id", pa.int64()), ("frame", pa.int64()), ("offset", pa.int64())])))])
    return marked.select("page_id", "url", "html", "refers_to").mapInArrow(run, "bundle string, data binary, index array<struct<page_id:long,frame:long,offset:long>>")


def read_bundles(bundles: DataFrame) -> DataFrame:
    """(page_id, url, record_type, refers_to, payload, digest, payload_bytes) of every record, reached by the index and the seek table."""

    def number(x: str | None) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?\d+)>", x or "")
        return int(found[1]) if found else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, index in zip(batch.column(0), batch.column(1)):
                data, out, last, plain = data.as_py(), [], None, b""
                frames = read_seek_table(data)
                for entry in index.as_py():
                    if entry["frame"] != last:
                        if out:
                            yield pa.RecordBatch.from_pylist(out, schema)
                        out, last = [], entry["frame"]
                        plain = read_frame(data, frames[last])
                    head, body, _ = read_record(plain, entry["offset"])
                    if number(head["WARC-Record-ID"]) != entry["page_id"]:
                        raise ValueError(f"the index leads to {head['WARC-Record-ID']} for {entry['page_id']}")
                    kind, digest = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha256:")
                    if kind == "response" and hashlib.sha256(body).hexdigest() != digest:
                        raise ValueError(f"record {entry['page_id']} is damaged")
                    out.append({"page_id": entry["page_id"], "url": head["WARC-Target-URI"], "record_type": kind, "refers_to": number(head.get("WARC-Refers-To")), "payload": body if kind == "response" else None, "payload_digest": digest, "payload_bytes": int(head["X-Payload-Length"])})
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema)

    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64())])
    return bundles.select("data", "index").mapInArrow(run, "page_id long, url string, record_type string, refers_to long, payload binary, payload_digest string, payload_bytes long")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    bundles = stored(write_bundles(mark_revisits(table(spark, sf_dir, "pages"))), "warc")
    return read_bundles(bundles).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP10_SQL = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {LEAST_SHARED} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {LEAST_SHARED} AND page_id <> first THEN first END AS refers_to
FROM f
"""
