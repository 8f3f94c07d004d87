"""WARC archives: segmented records with chunked bodies, written and reassembled.

A record's block that exceeds ``segment_bytes`` is written as a first record and
continuation records, which may lie in other archives.  Reading groups them by the
id of the first record, orders them by segment number, verifies the total length
and decodes the chunked transfer framing.  Records in one piece are not shuffled.

Archives are written by Spark's text writer with the record end mark as line
separator, so they reach any file system Spark knows; reading takes them as binary
files.  An archive holds a bounded number of records of bounded size.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = b"\r\n"
END = "\r\n\r\n"
SEGMENT_BYTES = 8 << 10
CHUNK_BYTES = 4 << 10
RECORDS_PER_ARCHIVE = 10_000
# Payloads shorter than this are stored again rather than referred to.
LEAST_REVISIT = 100
# Fixed values of the WARC format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"

FIELDS = (
    "record_id string, record_type string, page_id {kind}, url string, payload_digest string, "
    "payload_bytes long, refers_to {kind}, origin_id string, segment long, total_length long, block binary"
)


def chunked(payload: bytes, size: int) -> bytes:
    parts = []
    for a in range(0, len(payload), size):
        part = payload[a : a + size]
        parts += [b"%x" % len(part), CRLF, part, CRLF]
    parts.append(b"0\r\n\r\n")
    return b"".join(parts)


def dechunk(body: bytes) -> bytes | None:
    """Payload of a chunked body; ``None`` if the framing is broken."""
    parts, at = [], 0
    while True:
        line = body.find(CRLF, at)
        if line < 0:
            return None
        try:
            size = int(body[at:line].split(b";")[0], 16)
        except ValueError:
            return None
        at = line + 2
        if size == 0:
            return b"".join(parts)
        if at + size + 2 > len(body) or body[at + size : at + size + 2] != CRLF:
            return None
        parts.append(body[at : at + size])
        at += size + 2


def _head(fields: list[tuple]) -> bytes:
    lines = ["WARC/1.1", *[f"{name}: {value}" for name, value in fields if value is not None]]
    return "\r\n".join(lines).encode() + b"\r\n\r\n"


def _one_line(value):
    return None if value is None else " ".join(str(value).split())


def write_records(segment_bytes: int, chunk_bytes: int):
    """Record texts of page rows, without the end mark that the writer adds."""

    def run(batches):
        row = 0
        for batch in batches:
            out = []
            for r in range(batch.num_rows):
                page, url, payload, digest, refers, refers_url, part = (batch.column(i)[r].as_py() for i in range(7))
                row += 1
                name = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}|{digest}|{part}|{row}')}>"
                about = [
                    ("WARC-Record-ID", name),
                    ("WARC-Target-URI", _one_line(url)),
                    ("WARC-Date", "2020-01-01T00:00:00Z"),
                    ("WARC-Payload-Digest", f"sha256:{digest}"),
                    ("WARC-X-Page-Id", _one_line(page)),
                    ("WARC-X-Payload-Length", len(payload)),
                    ("Content-Type", "application/http; msgtype=response"),
                ]
                if refers is not None:
                    block = HTTP_HEAD + CRLF
                    more = [
                        ("WARC-Type", "revisit"),
                        ("WARC-Profile", REVISIT_PROFILE),
                        ("WARC-Refers-To-Target-URI", _one_line(refers_url)),
                        ("WARC-X-Refers-To-Page-Id", _one_line(refers)),
                    ]
                else:
                    block = HTTP_HEAD + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload, chunk_bytes)
                    more = [("WARC-Type", "response")]
                pieces = [block[a : a + segment_bytes] for a in range(0, len(block), segment_bytes)]
                if len(pieces) > 1:
                    more.append(("WARC-Segment-Number", 1))
                out.append(_head([*more, *about, ("Content-Length", len(pieces[0]))]) + pieces[0])
                for number, piece in enumerate(pieces[1:], 2):
                    own = [
                        ("WARC-Type", "continuation"),
                        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}|{number}')}>"),
                        ("WARC-Date", "2020-01-01T00:00:00Z"),
                        ("WARC-Segment-Origin-ID", name),
                        ("WARC-Segment-Number", number),
                        ("WARC-Segment-Total-Length", len(block) if number == len(pieces) else None),
                        ("Content-Length", len(piece)),
                    ]
                    out.append(_head(own) + piece)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    return run


def with_references(pages: DataFrame, least_bytes: int = LEAST_REVISIT) -> DataFrame:
    """Pages with payload and digest, and the page each one revisits (null: none)."""
    html = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", html.alias("payload"), F.sha2(html, 256).alias("digest"))
    long_enough = F.octet_length("payload") >= least_bytes
    named = F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))
    firsts = (
        rows.where(long_enough)
        .groupBy("digest")
        .agg(F.min(named).alias("_first"), F.count("*").alias("n"))
        .where("n > 1 AND _first IS NOT NULL")
        .select("digest", F.col("_first.page_id").alias("_id"), F.col("_first.url").alias("_url"))
    )
    later = F.col("_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_id"))
    return rows.join(firsts, "digest", "left").select(
        "page_id", "url", "payload", "digest",
        F.when(later, F.col("_id")).alias("refers_to"),
        F.when(later, F.col("_url")).alias("refers_url"),
    )


def write_warc(
    pages: DataFrame,
    folder: str,
    segment_bytes: int = SEGMENT_BYTES,
    chunk_bytes: int = CHUNK_BYTES,
    compression: str = "gzip",
) -> None:
    """Write ``page_id, url, html`` rows as WARC records.

    Of pages with one payload of 100 bytes or more the smallest id is stored and the
    others become revisit records.  Null pages have empty payloads.  Rows that repeat
    the smallest id are each stored; rows with a null id are revisits of the smallest
    id, or stored if all ids are null.  An empty table writes no record.
    """
    rows = with_references(pages).withColumn("_part", F.spark_partition_id())
    (
        rows.mapInArrow(write_records(segment_bytes, chunk_bytes), "value binary")
        .select(F.col("value").cast("string"))
        .write.option("lineSep", END)
        .option("compression", compression)
        .option("maxRecordsPerFile", RECORDS_PER_ARCHIVE)
        .text(folder)
    )


def archive_bytes(raw: bytes) -> bytes:
    """Content of an archive, whether plain, gzip, or one gzip member per record."""
    if raw[:2] != b"\x1f\x8b":
        return raw
    parts = []
    while raw:
        member = zlib.decompressobj(31)
        parts.append(member.decompress(raw))
        raw = member.unused_data
    return b"".join(parts)


# What a number in a header may be; anything else is malformed.
NUMBER = re.compile("[0-9]{1,18}")
# Segment number of a record with a malformed header: no record has such a segment.
MALFORMED = -1


def parse_archive(data: bytes):
    """Header fields (names in lower case) and block of each record.

    A record whose length is malformed ends where the next one begins.
    """
    at = 0
    while True:
        at = data.find(b"WARC/", at)
        if at < 0:
            return
        stop = data.find(b"\r\n\r\n", at)
        if stop < 0:
            return
        head = {}
        for line in data[at:stop].split(CRLF)[1:]:
            name, _, value = line.partition(b":")
            head[name.strip().lower().decode()] = value.strip().decode("utf-8", "replace")
        stated = head.get("content-length", "0")
        if NUMBER.fullmatch(stated):
            size = int(stated)
        else:
            after = data.find(END.encode() + b"WARC/", stop + 4)
            size = (after if after >= 0 else len(data)) - stop - 4
        yield head, data[stop + 4 : stop + 4 + size]
        at = stop + 4 + size


def read_records(segmented: bool, id_type):
    """Records of the archives: either those in segments or those in one piece."""

    def number(head, name):
        value = head.get(name)
        return int(value) if value is not None and NUMBER.fullmatch(value) else None

    def identity(head, name):
        if pa.types.is_string(id_type):
            return head.get(name)
        value = head.get(name, "")
        sign = -1 if value.startswith("-") else 1
        return sign * int(value.removeprefix("-")) if NUMBER.fullmatch(value.removeprefix("-")) else None

    def malformed(head):
        """Whether a number or an id is given that is none."""
        if not NUMBER.fullmatch(head.get("content-length", "0")):
            return True
        ids = ("warc-x-page-id", "warc-x-refers-to-page-id")
        numbers = ("warc-x-payload-length", "warc-segment-number", "warc-segment-total-length")
        return any(n in head and identity(head, n) is None for n in ids) or any(
            n in head and number(head, n) is None for n in numbers
        )

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0
                for head, block in parse_archive(archive_bytes(content.as_buffer().to_pybytes())):
                    if ("warc-segment-number" in head) != segmented:
                        continue
                    name = head.get("warc-record-id")
                    rows.append(
                        (
                            name,
                            head.get("warc-type"),
                            identity(head, "warc-x-page-id"),
                            head.get("warc-target-uri"),
                            head.get("warc-payload-digest", "").removeprefix("sha256:") or None,
                            number(head, "warc-x-payload-length"),
                            identity(head, "warc-x-refers-to-page-id"),
                            head.get("warc-segment-origin-id", name),
                            MALFORMED if malformed(head) else number(head, "warc-segment-number") or 1,
                            number(head, "warc-segment-total-length"),
                            block,
                        )
                    )
                    held += len(block)
                    if held > 4 << 20:
                        yield _records(rows, id_type)
                        rows, held = [], 0
                if rows:
                    yield _records(rows, id_type)

    return run


def _records(rows: list, id_type):
    text, number = pa.string(), pa.int64()
    types = [text, text, id_type, text, text, number, id_type, text, number, number, pa.binary()]
    names = [part.split()[0] for part in FIELDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)


def assemble_rows(with_payload: bool):
    """Join the segments of a record and decode its body."""

    def block_of(parts, total):
        known = {}
        for part in parts:
            known.setdefault(part["segment"], part["block"])
        if sorted(known) != list(range(1, len(known) + 1)):
            return None
        block = b"".join(known[n] for n in range(1, len(known) + 1))
        if len(known) > 1 and total != len(block) or len(known) == 1 and total not in (None, len(block)):
            return None
        return block

    def run(batches):
        for batch in batches:
            names = ["record_id", "record_type", "page_id", "url", "payload_digest", "payload_bytes", "refers_to"]
            columns = {n: batch.column(n) for n in names}
            digests, sizes, complete, payloads = [], [], [], []
            for i in range(batch.num_rows):
                block = block_of(batch.column("parts")[i].as_py(), batch.column("total_length")[i].as_py())
                stated, size = columns["payload_digest"][i].as_py(), columns["payload_bytes"][i].as_py()
                payload = None
                if block is not None and columns["record_type"][i].as_py() != "revisit":
                    head, _, body = block.partition(b"\r\n\r\n")
                    payload = dechunk(body) if b"transfer-encoding: chunked" in head.lower() else body
                if columns["record_type"][i].as_py() == "revisit":
                    digests.append(stated), sizes.append(size), complete.append(block is not None)
                elif payload is None:
                    digests.append(None), sizes.append(None), complete.append(False)
                else:
                    digest = hashlib.sha256(payload).hexdigest()
                    digests.append(digest), sizes.append(len(payload)), complete.append(stated in (None, digest))
                payloads.append(payload if with_payload else None)
            columns["payload_digest"] = pa.array(digests, pa.string())
            columns["payload_bytes"] = pa.array(sizes, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*columns.values(), pa.array(complete, pa.bool_()), pa.array(payloads, pa.binary())],
                [*names, "complete", "payload"],
            )

    return run


def read_warc(spark: SparkSession, folder: str, id_type: str = "bigint", with_payload: bool = True) -> DataFrame:
    """Reassembled records: ids, type, url, payload, its size and digest, ``complete``.

    ``complete`` is false, and payload, size and digest are null, if a segment is
    missing, the total length differs, a number in a header is malformed or the framing
    is broken; it is false, too, if the payload does not have the stated digest.  A
    segment found twice counts once.  An archive is held whole by the task that reads
    it: foreign ones have to fit into memory.
    """
    files = spark.read.format("binaryFile").load(folder).select("content")
    arrow = pa.string() if id_type == "string" else pa.int64()
    shape = FIELDS.format(kind=id_type)
    facts = ["record_id", "record_type", "page_id", "url", "payload_digest", "payload_bytes", "refers_to"]
    single = files.mapInArrow(read_records(False, arrow), shape).select(
        *facts, "total_length", F.array(F.struct("segment", "block")).alias("parts")
    )
    pieces = files.mapInArrow(read_records(True, arrow), shape)
    # A group is one record, which has to fit into memory whatever its segments are.
    grouped = pieces.groupBy("origin_id").agg(
        F.max(F.when(F.col("segment") == 1, F.struct(*facts))).alias("_head"),
        F.max("total_length").alias("total_length"),
        F.collect_list(F.struct("segment", "block")).alias("parts"),
    ).select("_head.*", "total_length", "parts")
    out = ", ".join(f"{n} {id_type if n in ('page_id', 'refers_to') else 'long' if n == 'payload_bytes' else 'string'}" for n in facts)
    return single.unionAll(grouped).mapInArrow(assemble_rows(with_payload), f"{out}, complete boolean, payload binary")
