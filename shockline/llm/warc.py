"""WARC archives with a splittable reader (operator 6).

Every record is a gzip member of its own, so a task that scans a byte range looks for the magic of a
member, checks each candidate by inflating it up to the WARC version line and headers, and owns the
records that start inside its range, reading past the end of the range for the last one.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_input, scratch_path, table, written
from .files import make_folder, opened, put

GZIP = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
FILE_BYTES, SPLIT_BYTES, STEP = 64 << 20, 8 << 20, 1 << 20
#: Tasks that read; with more byte ranges than that a task reads several, one after the other.
MOST_TASKS = 100_000
MANIFEST = "path string, bytes long, records long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def member(data: bytes, level: int = 1) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def field(value: str) -> str:
    """A header value: no line ends, no other controls."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response with its payload, or a revisit that names the response and has none."""
    body = b"" if refers_to is not None else payload
    lines = [
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {field(url)}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head = "\r\n".join([*lines, f"Content-Length: {len(body)}", "", ""]).encode("utf-8", "replace")
    return VERSION + head + body + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """A whole inflated record; fails if the payload doesn't have the digest that the header states."""
    head, found, rest = data.partition(b"\r\n\r\n")
    if not found or not head.startswith(VERSION):
        raise ValueError("not a WARC record")
    h = dict(x.split(": ", 1) for x in head[len(VERSION) :].decode().split("\r\n"))
    n = int(h["Content-Length"])
    body, kind = rest[:n], h["WARC-Type"]
    page = h["WARC-Record-ID"][10:-1]
    stated = h["WARC-Payload-Digest"].removeprefix("sha1:")
    if len(body) != n or kind == "response" and digest(body) != stated:
        raise ValueError(f"damaged record {page}")
    return {
        "page_id": None if page == "none" else int(page), "url": h.get("WARC-Target-URI"), "payload_bytes": int(h["X-Payload-Length"]), "payload_digest": stated,
        "record_type": kind, "refers_to": int(h["WARC-Refers-To"][10:-1]) if kind == "revisit" else None, "payload": body if kind == "response" else None,
    }


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record for each row of pages (page_id, url, html); returns the manifest of the archives.

    Of rows with equal payloads of at least min_bytes, those with the largest page_id (ties: all of
    them) are responses and the others revisit it. A null html has an empty payload. A null page_id is
    smaller than any other; where only such rows share a payload, all are responses. Repeated rows
    give a record each. Payloads of any length are written whole. Further columns are ignored. An empty
    table gives no archive. An archive's name has its task's attempt, so a task that runs again writes
    archives of its own; the manifest names those of the attempt that counts.
    """
    make_folder(folder)
    rows = as_input(pages, {"page_id": "long", "url": "string", "html": "string"}).withColumn("payload", F.coalesce(F.col("html").cast("binary"), F.lit(b""))).drop("html")
    rows = rows.withColumn("sha", F.unhex(F.sha1("payload")))
    same = rows.where(F.length("payload") >= min_bytes).groupBy("sha").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1 and last is not null").drop("n")
    rows = rows.join(same, "sha", "left").withColumn("refers_to", F.expr("if(last is null or page_id <=> last, null, last)"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, attempt, number, held, size = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId(), 0, [], 0

        def close() -> pd.DataFrame:
            path = f"{folder}/part-{part:06d}-{number:04d}-{attempt}.warc.gz"
            put(path, b"".join(held))
            return pd.DataFrame({"path": [path], "bytes": [size], "records": [len(held)]})

        for b in batches:
            for page, none, url, payload, refers, first in zip(b["page_id"], b["no_page"], b["url"], b["payload"], b["refers_to"], b["first"], strict=True):
                held.append(member(record(None if none else int(page), url, bytes(payload), None if first else int(refers))))
                size += len(held[-1])
                if size >= file_bytes:
                    yield close()
                    number, held, size = number + 1, [], 0
        if held:
            yield close()

    flat = rows.select(
        F.coalesce("page_id", F.lit(0)).alias("page_id"), F.col("page_id").isNull().alias("no_page"), "url", "payload",
        F.coalesce("refers_to", F.lit(0)).alias("refers_to"), F.col("refers_to").isNull().alias("first"),
    )
    return written(flat.mapInPandas(run, MANIFEST), "warc_manifest")


def members(uri: str, start: int, end: int) -> Iterator[bytes]:
    """Inflated records that start in [start, end) of a file, whatever bytes the range begins with."""
    store, path = opened(uri)
    with store.open_input_file(path) as f:
        size, base, held = f.size(), start, b""

        def more() -> bool:
            nonlocal held
            got = f.read_at(min(STEP, size - base - len(held)), base + len(held)) if base + len(held) < size else b""
            held += got
            return bool(got)

        at = 0  # within held
        while base + at < end:
            if len(held) - at < STEP:
                held, base, at = held[at:], base + at, 0
                more()
            found = held.find(GZIP, at)
            if found < 0 or base + found >= end:
                if found >= 0 or base + len(held) >= min(end + len(GZIP), size):
                    return
                at = max(at, len(held) - len(GZIP) + 1)
                if not more():
                    return
                continue
            z, out, to = zlib.decompressobj(31), [], found
            try:
                while not z.eof:
                    if to >= len(held) and not more():
                        if b"".join(out[:2]).startswith(VERSION):
                            raise ValueError("the archive ends within a record")
                        raise zlib.error("no record")
                    chunk = held[to : to + STEP]
                    out.append(z.decompress(chunk))
                    to += len(chunk)
                    if sum(map(len, out)) >= len(VERSION) and not b"".join(out[:2]).startswith(VERSION):
                        raise zlib.error("no record")
                data = b"".join(out)
                if not data.startswith(VERSION):
                    raise zlib.error("no record")
            except zlib.error:  # the magic's bytes by chance
                at = found + 1
                continue
            at = to - len(z.unused_data)
            yield data


def read_archives(manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """All records of the archives: a task for each byte range, payloads checked against their digests."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, start, end in zip(b["path"], b["start"], b["end"], strict=True):
                held, size = [], 0
                for data in members(path, int(start), int(end)):
                    held.append(parse(data))
                    size += len(data)
                    if size > 4 << 20:
                        yield frame(held)
                        held, size = [], 0
                if held:
                    yield frame(held)

    def frame(rows: list[dict]) -> pd.DataFrame:
        return pd.DataFrame(rows).astype({"page_id": "Int64", "refers_to": "Int64"})

    splits = manifest.withColumn("start", F.explode(F.sequence(F.lit(0), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes))))
    splits = splits.select("path", "start", F.least(F.col("start") + split_bytes, "bytes").alias("end"))
    # the number is stated, as adaptive execution would put all of these small rows into one task
    n = manifest.agg(F.sum(F.ceil(F.col("bytes") / split_bytes))).first()[0] or 1
    return splits.repartition(min(int(n), MOST_TASKS), "path", "start").mapInPandas(run, RECORD)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_archives(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return read_archives(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
