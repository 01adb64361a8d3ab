"""WARC archives as a table of chunks.

A payload is cut into rows of record, chunk number and at most ``CHUNK`` bytes. Each row carries
the SHA-1 of the payload up to its end, so a reader checks a record as its chunks pass
and never holds more than one of them. A chunk becomes one WARC record: the first a
``response``, the others ``continuation`` segments, as the format foresees for long payloads.

Equal payloads of some size are stored once: the record with the largest id is the response, the
others are ``revisit`` records that refer to it and have no payload.

Records have the headers that the format demands: type, id, date, length, and the profile of a revisit. Archives,
ours and others' of version 1.0 or 1.1, are read in pieces that end at the next version, and a record takes as many
pieces as its Content-Length asks for, so a payload may hold anything. Only where an uncompressed file is split between
tasks can a version inside a payload be taken for a record's begin; so chunks of ours end inside any version that the
payload holds, and inside a version at their own end. Files hold a bounded number of bytes,
each compressed one being one task's work; compressed, they are one member, so other readers take them from the start. The payload
arrives in a task as one value; what is made of it is never larger than a chunk.

Records of others need none of our headers: what is missing is null, and is taken as right in ``verified``.
The body of an HTTP response is its payload, and its digest may be in base 32.

Defined cases: a null payload is empty; a null id is less than any other; of repeated rows one
is the response; line breaks in a URL are escaped, and so is the point of a version at its end; extra columns of any
name are ignored; payloads may be of any length; an empty table gives an archive without records.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acctpulse.llm.tables import FILE, KEY, ROW, keep

CHUNK = 1 << 20
LEAST_BYTES = 1000
MAGIC = "WARC/1.1\r\n"
VERSION = "WARC/1."
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A file holds at most so many bytes, and chunks above SMALL are written to files of their own.
FILE_BYTES, SMALL = 512 << 20, 64 << 10
BATCH_BYTES = 4 << 20
SAME = ["payload_bytes", "payload_digest", "_acct_hash"]


def describe(records: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Row key, ``record_id``, ``url``, payload facts, ``record_type`` and what is referred to.

    ``records`` has the row key, ``record_id``, ``url`` and ``payload`` (text or bytes).
    """
    payload = F.coalesce(F.col("payload").cast("binary"), F.lit(b""))
    facts = records.select(
        *KEY, "record_id",
        F.octet_length(payload).cast("bigint").alias("payload_bytes"),
        F.sha1(payload).alias("payload_digest"),
        F.xxhash64(payload).alias("_acct_hash"),
    )
    facts = keep(facts, "payload-facts")
    largest = F.max(F.struct("record_id", FILE, ROW)).alias("to")
    stored = (
        facts.where(F.col("payload_bytes") >= least_bytes)
        .groupBy(*SAME)
        .agg(largest, F.count("*").alias("n"))
        .where(F.col("n") > 1)
        .drop("n")
    )
    itself = (F.col("to")[FILE] == F.col(FILE)) & (F.col("to")[ROW] == F.col(ROW))
    revisit = F.col("to").isNotNull() & ~itself
    return facts.join(stored, SAME, "left").select(
        *KEY, "record_id", "payload_bytes", "payload_digest",
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(revisit, F.col("to")).alias("to"),
    )


def _cut(payload: memoryview, chunk: int, magic: bytes) -> Iterator[tuple[int, int]]:
    """Where chunks begin and end; never with a whole ``magic`` inside one or all but its line end last."""
    start, version = 0, magic.removesuffix(b"\r\n")
    while True:
        end = min(len(payload), start + chunk)
        found = bytes(payload[start:end]).find(magic)
        if found >= 0:
            end = start + found + len(magic) // 2
        elif bytes(payload[max(start, end - len(version)) : end]) == version:
            end -= len(version) // 2
        yield start, end
        start = end
        if start >= len(payload):
            return


def chunk_table(records: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """All columns but ``payload``, and ``chunk_no``, ``last``, ``chunk``, ``running_digest``.

    A task holds one batch of chunks, at most ``BATCH_BYTES`` and a chunk, beside its input.
    """
    names = [c for c in records.columns if c != "payload"]
    magic = MAGIC.encode()
    kind = pa.schema([("chunk_no", pa.int64()), ("last", pa.bool_()), ("chunk", pa.binary()),
                      ("running_digest", pa.string())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, made, size = [], [], 0

            def flush(batch=batch):
                left = batch.select(names).take(pa.array(rows, pa.int64()))
                right = pa.RecordBatch.from_pylist(made, kind)
                return pa.RecordBatch.from_arrays(
                    [*left.columns, *right.columns], [*names, *kind.names]
                )

            for i, value in enumerate(batch.column("payload")):
                payload = memoryview(value.as_buffer() or b"")
                digest = hashlib.sha1()
                for no, (start, end) in enumerate(_cut(payload, chunk, magic)):
                    digest.update(payload[start:end])
                    rows.append(i)
                    made.append({"chunk_no": no, "last": end == len(payload),
                                 "chunk": bytes(payload[start:end]),
                                 "running_digest": digest.hexdigest()})
                    size += end - start
                    if size >= BATCH_BYTES:
                        yield flush()
                        rows, made, size = [], [], 0
            if rows:
                yield flush()

    given = records.withColumn("payload", F.coalesce(F.col("payload").cast("binary"), F.lit(b"")))
    kinds = ", ".join(f"`{c}` {given.schema[c].dataType.simpleString()}" for c in names)
    return given.mapInArrow(
        cut, f"{kinds}, chunk_no bigint, last boolean, chunk binary, running_digest string"
    )


def _uri(row: Column | None, record_id: Column, file: Column, at: Column) -> Column:
    name = F.concat_ws(":", F.coalesce(record_id.cast("string"), F.lit("")), F.hex(file), at)
    uri = F.concat(F.lit("<urn:record:"), name, F.lit(">"))
    return uri if row is None else F.when(row.isNotNull(), uri)


def _header(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")))


def write_archive(
    chunks: DataFrame, path: str, chunk: int = CHUNK, compression: str = "gzip",
    content_type: str = "text/html; charset=utf-8", date: Column | None = None,
) -> None:
    """Writes a record per chunk of at most ``chunk`` bytes, dated now unless ``date`` is given."""
    first = F.col("chunk_no") == 0
    uri = _uri(None, F.col("record_id"), F.col(FILE), F.col(ROW))
    to = F.col("to")
    kind = F.when(first, F.col("record_type")).otherwise(F.lit("continuation"))
    segment = F.when(~(first & F.col("last")), F.col("chunk_no") + 1)
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20]", "%20")
    url = F.regexp_replace(url, r"WARC/1\.1\z", "WARC/1%2E1")
    head = F.concat_ws(
        "",
        F.lit(MAGIC),
        _header("WARC-Type", kind),
        _header("WARC-Record-ID", F.when(first, uri).otherwise(
            F.concat(F.regexp_replace(uri, ">$", "#"), F.col("chunk_no"), F.lit(">")))),
        _header("WARC-Date", F.date_format(F.current_timestamp() if date is None else date, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        _header("WARC-Profile", F.when(first & (F.col("record_type") == "revisit"), F.lit(PROFILE))),
        _header("WARC-Segment-Origin-ID", F.when(~first, uri)),
        _header("WARC-Segment-Number", segment),
        _header("WARC-Segment-Total-Length", F.when(~first & F.col("last"), F.col("payload_bytes"))),
        _header("WARC-Target-URI", F.when(first, url)),
        _header("WARC-Refers-To", F.when(first, _uri(to, to["record_id"], to[FILE], to[ROW]))),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _header("X-Payload-Length", F.col("payload_bytes")),
        _header("X-Running-Digest", F.concat(F.lit("sha1:"), F.col("running_digest"))),
        _header("X-Last-Segment", F.col("last")),
        _header("Content-Type", F.when(first & (F.col("record_type") == "response"), F.lit(content_type))),
        _header("Content-Length", F.octet_length("chunk")),
        F.lit("\r\n"),
    )
    # Bytes of any kind pass through the text writer unchanged.
    record = F.concat(head.cast("binary"), F.col("chunk")).cast("string")
    rows = chunks.select(record.alias("value"), (F.octet_length("chunk") > SMALL).alias("large"))
    for large in (False, True):
        most = max(1, FILE_BYTES // (chunk if large else SMALL))
        part = rows.where(F.col("large") == large).drop("large")
        writer = part.write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", most)
        writer.option("compression", compression).mode("append").text(path)
        if not large and chunk <= SMALL:
            break


RECORD = pa.schema([
    ("record", pa.string()), ("chunk_no", pa.int64()), ("last", pa.bool_()),
    ("record_type", pa.string()), ("url", pa.string()), ("refers_to", pa.string()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("running", pa.string()),
    ("whole", pa.bool_()), ("size", pa.int64()), ("payload", pa.binary()),
])


def _hex(digest: str | None) -> str | None:
    """A SHA-1 in hex, if it is given in hex or base 32."""
    kind, _, value = (digest or "").partition(":")
    if kind.lower() != "sha1":
        return None
    return base64.b32decode(value.upper()).hex() if len(value) == 32 else value.lower()


def _record(head: bytes, block: bytes) -> dict:
    """A row from a record's header and block."""
    lines = re.sub(rb"\r\n[ \t]+", b" ", head).decode("utf-8", "replace").split("\r\n")
    field = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    size, number = int(field["content-length"]), field.get("warc-segment-number")
    whole, block = len(block) >= size, block[:size]
    if field.get("content-type", "").startswith("application/http") and number in (None, "1"):
        block = block.partition(b"\r\n\r\n")[2]
    total = field.get("x-payload-length") or field.get("warc-segment-total-length")
    if number is None and total is None and field["warc-type"] != "revisit":
        total = len(block)
    told = field.get("x-last-segment")
    return {
        "record": field.get("warc-segment-origin-id", field.get("warc-record-id")),
        "chunk_no": int(number or 1) - 1,
        "last": told == "true" if told else number is None or "warc-segment-total-length" in field,
        "record_type": field["warc-type"], "url": field.get("warc-target-uri"),
        "refers_to": field.get("warc-refers-to"),
        "payload_bytes": None if total is None else int(total),
        "payload_digest": _hex(field.get("warc-payload-digest")),
        "running": _hex(field.get("x-running-digest")),
        "whole": whole, "size": len(block), "payload": block,
    }


#: A piece of an archive that begins a record; what comes before is the rest of a block.
BEGIN = re.compile(rb"[01]\r\n(?:[!-9;-~]+:[^\r\n]*(?:\r\n[ \t][^\r\n]*)*\r\n)+\r\n")
LENGTH = re.compile(rb"\r\ncontent-length:[ \t]*(\d+)", re.I)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per WARC record (chunk); ``whole`` says that its length is as announced."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, parts, have, need = b"", [], 0, 0
        out, held = [], 0
        for batch in batches:
            for value in batch.column("value"):
                piece = value.as_py()
                if head and have < need:  # a version inside the block
                    parts.append(VERSION.encode() + piece)
                    have += len(parts[-1])
                    continue
                begins = BEGIN.match(piece)
                length = begins and LENGTH.search(piece, 0, begins.end())
                if not length:
                    continue
                if head:
                    out.append(_record(head, b"".join(parts)))
                    held += have
                head, parts, need = begins[0], [piece[begins.end() :]], int(length[1])
                have = len(parts[0])
                if held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(out, RECORD)
                    out, held = [], 0
        if head:
            out.append(_record(head, b"".join(parts)))
        yield pa.RecordBatch.from_pylist(out, RECORD)

    lines = spark.read.option("lineSep", VERSION).text(path).where(F.col("value") != "")
    kinds = ("record string, chunk_no bigint, last boolean, record_type string, url string, "
             "refers_to string, payload_bytes bigint, payload_digest string, running string, "
             "whole boolean, size bigint, payload binary")
    return lines.select(F.col("value").cast("binary")).mapInArrow(parse, kinds)


def verified(records: DataFrame) -> DataFrame:
    """One row per archived record, with ``verified``: all chunks there, in order, digests right.

    Records of one chunk are checked where they are read. The chunks of a longer one meet in a task,
    sorted, and pass through one running digest.
    """
    names = ["record", "record_type", "url", "refers_to", "payload_bytes", "payload_digest"]
    single = (F.col("chunk_no") == 0) & F.col("last")
    right = F.when(F.col("record_type") == "revisit", F.lit(True)).otherwise(
        F.coalesce(F.sha1("payload") == F.col("payload_digest"), F.lit(True))
        & F.coalesce(F.col("size") == F.col("payload_bytes"), F.lit(True))
    )
    short = records.where(single).select(*names, (F.col("whole") & right).alias("verified"))

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, digest, size, fine, next_no, ended = None, None, None, 0, True, 0, False

        def done():
            good = fine and ended and first["payload_bytes"] in (None, size)
            good = good and first["payload_digest"] in (None, digest.hexdigest())
            row = {k: first[k] for k in names} | {"verified": bool(good)}
            return pa.RecordBatch.from_pylist([row], pa.schema(
                [RECORD.field(k) for k in names] + [("verified", pa.bool_())]))

        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in RECORD.names}
                if row["record"] != now:
                    if now is not None:
                        yield done()
                    now, first, digest = row["record"], row, hashlib.sha1()
                    size, fine, next_no, ended = 0, row["chunk_no"] == 0, 0, False
                digest.update(row["payload"])
                size += row["size"]
                fine = fine and row["chunk_no"] == next_no and row["whole"]
                fine = fine and row["running"] in (None, digest.hexdigest())
                next_no, ended = next_no + 1, row["last"]
                first = {k: v for k, v in first.items() if k != "payload"}
                if first["payload_bytes"] is None:  # others tell it with the last segment
                    first["payload_bytes"] = row["payload_bytes"]
        if now is not None:
            yield done()

    long = (
        records.where(~single)
        .repartition("record")
        .sortWithinPartitions("record", "chunk_no")
        .select(*RECORD.names)
        .mapInArrow(follow, "record string, record_type string, url string, refers_to string, "
                            "payload_bytes bigint, payload_digest string, verified boolean")
    )
    return short.unionByName(long)


def id_of(uri: Column) -> Column:
    """The record id in a record's name; null if it had none."""
    text = F.regexp_extract(uri, r"^<urn:record:(-?\d*):", 1)
    return F.when(text != "", text.cast("bigint"))


def archive(
    records: DataFrame, path: str, chunk: int = CHUNK, compression: str = "gzip"
) -> None:
    """Describes, deduplicates, cuts and writes ``records`` (row key, record_id, url, payload)."""
    facts = describe(records)
    payload = F.when(F.col("record_type") == "response", F.col("payload").cast("binary"))
    whole = records.select(*KEY, "url", "payload").join(facts, KEY)
    chunks = chunk_table(whole.withColumn("payload", payload), chunk)
    write_archive(chunks, path, chunk, compression)
