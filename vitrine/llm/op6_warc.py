"""WARC archives with a Zstandard dictionary in a leading skippable frame, a frame for each record.

A page whose payload equals that of another (``MIN_SHARED`` bytes or more) is written
once: the page with the smallest id as ``response``, the others as ``revisit`` records that
refer to it and hold no payload.  Equal payloads are found by their SHA-256 in a thin
aggregate; only digests that occur twice or more are joined back, and the join is
split where one payload is that of a large part of the pages.

Every partition becomes one archive.  Its writer holds back the first records (``SAMPLE_BYTES``),
builds the dictionary from them, writes it as a skippable frame of type 0xD, and then every record
as a frame of its own, so a reader that knows an offset needs the dictionary and one frame.  Each frame
is followed by a skippable frame of one byte, the line feed that the file writer sets (see ``frames``).

Defined cases: a null html is an empty payload; a null url leaves the target out; pages that share
the smallest id and the payload are all responses; pages without an id are never referred to; an empty table
gives no archives and no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.common import table
from vitrine.llm.frames import read_files, write_chunks
from vitrine.session import scratch_path

MIN_SHARED = 100
DICTIONARY_BYTES, SAMPLE_BYTES, MIN_SAMPLES = 32 * 1024, 2 * 1024 * 1024, 16
LEVEL = 3
#: Fixed values of the formats: skippable frame types (dictionary; padding), magic number of a frame.
DICTIONARY_FRAME, PADDING_FRAME, FRAME = 0x184D2A5D, 0x184D2A50, 0xFD2FB528
#: A skippable frame of one byte; the writer's line feed is that byte.
PAD = struct.pack("<II", PADDING_FRAME, 1)
DATE = "2026-01-01T00:00:00Z"


def first_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Pages with payload digest and size, and ``first_id``: the page that holds the payload, where several share it."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    keyed = pages.select(F.col(id_col).alias("page_id"), F.col("url").alias("url") if "url" in pages.columns else F.lit(None).cast("string").alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("size"))
    shared = keyed.filter(F.col("size") >= MIN_SHARED).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return keyed.join(shared, "digest", "left")


def record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record.  ``X-Page-Id`` and ``X-Payload-Length`` carry what a revisit cannot show."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}"]
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page: {refers_to}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += [f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary from archived records; none if they are too few or too much alike to train on."""
    if len(samples) < MIN_SAMPLES:
        return b""
    try:
        # No sample counts for more than 16 KB, so that one long page does not fill the dictionary.
        return zstandard.train_dictionary(DICTIONARY_BYTES, [s[:16384] for s in samples], level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b""


def archive_chunks(records: Iterator[bytes]) -> Iterator[bytes]:
    """The chunks of one archive file: the dictionary's frame, then a frame for each record."""
    held: list[bytes] = []
    size, writer = 0, None

    def opened() -> Iterator[bytes]:
        nonlocal writer
        dictionary = build_dictionary(held)
        if dictionary:
            yield struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary + PAD
        writer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None, write_checksum=True)
        for r in held:
            yield writer.compress(r) + PAD
        held.clear()

    for r in records:
        if writer is not None:
            yield writer.compress(r) + PAD
            continue
        held.append(r)
        size += len(r)
        if size >= SAMPLE_BYTES:
            yield from opened()
    if held:
        yield from opened()


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", html_col: str = "html") -> None:
    """Write the archives of ``pages`` under ``path``."""

    def chunks(batches):
        def records():
            for b in batches:
                for page_id, url, payload, digest, first in zip(b["page_id"], b["url"], b["payload"], b["digest"], b["first_id"]):
                    yield record(page_id, url, payload, digest, None if first is None or first == page_id else first)

        held, size = [], 0
        for chunk in archive_chunks(records()):
            held.append(chunk)
            size += len(chunk)
            if size > 4 << 20:
                yield pd.DataFrame({"chunk": held})
                held, size = [], 0
        if held:
            yield pd.DataFrame({"chunk": held})

    # Ids travel as text: pandas has no whole numbers with gaps.
    rows = first_pages(pages, id_col, html_col).select(F.col("page_id").cast("string"), "url", "payload", "digest", F.col("first_id").cast("string"))
    write_chunks(rows.mapInPandas(chunks, "chunk binary"), path)


def frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame that starts at ``at`` ends: its header, its blocks, its checksum."""
    flags = data[at + 4]
    pos = at + zstandard.frame_header_size(bytes(data[at : at + 18]))
    while True:
        head = int.from_bytes(data[pos : pos + 3], "little")
        pos += 3 + (1 if (head >> 1) & 3 == 1 else head >> 3)
        if head & 1:
            return pos + (4 if flags & 4 else 0)


def read_records(content: bytes) -> Iterator[bytes]:
    """The records of an archive."""
    data, at, dictionary = memoryview(content), 0, None
    reader = zstandard.ZstdDecompressor()
    while at < len(data):
        magic, size = struct.unpack("<II", data[at : at + 8])
        if magic & 0xFFFFFFF0 == PADDING_FRAME:
            if magic == DICTIONARY_FRAME:
                dictionary = zstandard.ZstdCompressionDict(bytes(data[at + 8 : at + 8 + size]))
                reader = zstandard.ZstdDecompressor(dict_data=dictionary)
            at += 8 + size
        elif magic == FRAME:
            end = frame_end(data, at)
            yield reader.decompress(data[at:end])
            at = end
        else:
            raise ValueError(f"no frame at {at}")


def parse(raw: bytes) -> tuple:
    """(page id, payload bytes, payload digest, type, refers to) of a record; a response's payload must have its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    digest, size, kind = fields["WARC-Payload-Digest"].removeprefix("sha256:"), int(fields["X-Payload-Length"]), fields["WARC-Type"]
    if kind == "response":
        payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]
        if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    return fields.get("X-Page-Id"), size, digest, kind, fields.get("X-Refers-To-Page")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """What the archives under ``path`` hold, a row for each record."""

    def rows(batches):
        for b in batches:
            for content in b["content"]:
                found = [parse(raw) for raw in read_records(content)]
                yield pd.DataFrame(found, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return read_files(spark, path).mapInPandas(rows, "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string")


def op6_warc(spark, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    pages = table(spark, sf_dir, "pages")
    write_archives(pages, path)
    kind = dict(pages.dtypes)["page_id"]
    return read_archives(spark, path).withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
k AS (SELECT page_id, strlen(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_id FROM k)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first_id IS NULL OR page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first_id IS NULL OR page_id IS NOT DISTINCT FROM first_id THEN NULL ELSE first_id END AS refers_to
FROM f
"""

QUERIES = {"op6_warc": op6_warc}
ORACLES = {"op6_warc": SQL}
