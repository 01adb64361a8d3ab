import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from acctpulse.llm import warc
from acctpulse.llm.tables import KEY, with_row_key

RECORDS = "record_id bigint, url string, payload binary"


def round_trip(spark, path, data, chunk=50, **how):
    records = with_row_key(spark.createDataFrame(data, RECORDS).coalesce(1))
    warc.archive(records, path, chunk, **how)
    return warc.verified(warc.read_records(spark, path)).withColumn(
        "id", warc.id_of(F.col("record"))).withColumn("to", warc.id_of(F.col("refers_to")))


def payloads():
    rng = random.Random(3)
    magic = warc.MAGIC.encode()
    return [
        (1, "http://a/x y\r\nz", b"short"), (2, None, b""), (3, "u", None),
        (4, "u", bytes(rng.randrange(256) for _ in range(1234))),
        (5, "u", b"a" * 49 + magic + b"b" * 60 + magic + magic), (6, "u", b"\r\n\r\n" * 40),
        (7, "u", magic), (8, "u", b"x" * 50), (9, "u", b"x" * 100),
    ]


def test_round_trip_keeps_every_byte_and_digest(spark, tmp_path):
    data = payloads()
    plain = round_trip(spark, str(tmp_path / "plain"), data, compression="none")
    got = {r["id"]: r for r in round_trip(spark, str(tmp_path / "w"), data).collect()}
    assert plain.where("verified").count() == len(data)
    assert len(got) == len(data)
    for i, _, payload in data:
        payload = payload or b""
        assert got[i]["verified"] and got[i]["payload_bytes"] == len(payload)
        assert got[i]["payload_digest"] == hashlib.sha1(payload).hexdigest()
    chunks = warc.read_records(spark, str(tmp_path / "w")).collect()
    joined = {}
    for c in sorted(chunks, key=lambda c: c["chunk_no"]):
        joined[c["record"]] = joined.get(c["record"], b"") + bytes(c["payload"])
        assert c["whole"] and c["size"] <= 50
        assert c["running"] == hashlib.sha1(joined[c["record"]]).hexdigest()
    assert sorted(joined.values()) == sorted((p or b"") for _, _, p in data)


def test_a_version_at_the_end_of_a_payload_a_chunk_or_a_url(spark, tmp_path):
    version = warc.MAGIC.encode().strip()
    data = [
        (1, "u", b"page " + version), (2, "u", b"a" * 42 + version + b"c" * 60), (3, "u", version),
        (4, "u", b"a" * 42 + version), (5, "http://a/WARC/1.1", b"page"), (6, "u", version * 20),
        (7, "u", b"a" * 42 + version + b"\r\n" + version),
    ]
    path = str(tmp_path / "w")
    got = {r["id"]: r for r in round_trip(spark, path, data).collect()}
    assert len(got) == len(data) and all(r["verified"] for r in got.values())
    for i, _, payload in data:
        assert got[i]["payload_digest"] == hashlib.sha1(payload).hexdigest()
    assert got[5]["url"] == "http://a/WARC/1%2E1"
    joined = {}
    for c in sorted(warc.read_records(spark, path).collect(), key=lambda c: c["chunk_no"]):
        joined[c["record"]] = joined.get(c["record"], b"") + bytes(c["payload"])
    assert sorted(joined.values()) == sorted(p for _, _, p in data)


def test_equal_payloads_are_revisited(spark, tmp_path):
    big, small = b"y" * 1000, b"y" * 999
    data = [(1, "u", big), (3, "u", big), (2, "u", big), (4, "u", small), (5, "u", small),
            (3, "u", big), (None, "u", big)]
    got = round_trip(spark, str(tmp_path / "w"), data, 400).collect()
    assert all(r["verified"] for r in got)
    kinds = sorted((r["id"] or 0, r["record_type"], r["to"]) for r in got)
    assert [k for k in kinds if k[1] == "response"] == [
        (3, "response", None), (4, "response", None), (5, "response", None)]
    assert [k for k in kinds if k[1] == "revisit"] == [(i, "revisit", 3) for i in (0, 1, 2, 3)]


def test_a_changed_or_missing_chunk_is_noticed(spark, tmp_path):
    round_trip(spark, str(tmp_path / "w"), payloads())
    records = warc.read_records(spark, str(tmp_path / "w"))
    long = warc.id_of(F.col("record")) == 4
    lost = warc.verified(records.where(~(long & (F.col("chunk_no") == 2)))).where(long)
    assert [r["verified"] for r in lost.collect()] == [False]
    other = F.when(long & (F.col("chunk_no") == 1), F.reverse(F.hex("payload")).cast("binary"))
    changed = records.withColumn("payload", F.coalesce(other, F.col("payload")))
    assert [r["verified"] for r in warc.verified(changed).where(long).collect()] == [False]


def test_files_are_warc(spark, tmp_path):
    round_trip(spark, str(tmp_path / "w"), [(1, "u", b"abc")])
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in sorted((tmp_path / "w").glob("part-*")))
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")
    assert raw.endswith(b"\r\n\r\nabc\r\n\r\n")


def foreign(version, records):
    """An archive as other writers make it: a gzip member a record, only the headers of the format."""
    out = b""
    for fields, block in records:
        head = f"WARC/{version}\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items())
        out += gzip.compress(f"{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n")
    return out


@pytest.mark.parametrize("version", ["1.0", "1.1"])
def test_an_archive_of_another_writer(spark, tmp_path, version):
    import base64

    date = {"WARC-Date": "2020-01-02T03:04:05Z"}
    body = b"<html>WARC/1.0\r\nWARC-Type: no\r\n\r\nWARC/1.1\r\n WARC/1." + b"z" * 50_000
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
    b32 = "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode()
    wrong = "sha1:" + hashlib.sha1(b"other").hexdigest()
    records = [
        ({"WARC-Type": "warcinfo", "WARC-Record-ID": "<urn:uuid:0>", **date, "Content-Type": "application/warc-fields"}, b"software: x\r\n"),
        ({"WARC-Type": "request", "WARC-Record-ID": "<urn:uuid:1>", **date, "Content-Type": "application/http; msgtype=request"}, b"GET / HTTP/1.1\r\n\r\n"),
        ({"warc-type": "response", "WARC-Record-ID": "<urn:uuid:2>", **date, "WARC-Target-URI": "http://a/",
          "WARC-Payload-Digest": b32, "Content-Type": "application/http; msgtype=response"}, http + body),
        ({"WARC-Type": "response", "WARC-Record-ID": "<urn:uuid:3>", **date, "WARC-Payload-Digest": wrong}, b"page"),
        ({"WARC-Type": "revisit", "WARC-Record-ID": "<urn:uuid:4>", **date, "WARC-Refers-To": "<urn:uuid:2>"}, b""),
        ({"WARC-Type": "response", "WARC-Record-ID": "<urn:uuid:5>", **date, "WARC-Segment-Number": 1}, b"one "),
        ({"WARC-Type": "continuation", "WARC-Record-ID": "<urn:uuid:6>", **date, "WARC-Segment-Origin-ID": "<urn:uuid:5>",
          "WARC-Segment-Number": 2, "WARC-Segment-Total-Length": 8}, b"two "),
    ]
    (tmp_path / "a.warc.gz").write_bytes(foreign(version, records))
    read = warc.read_records(spark, str(tmp_path / "a.warc.gz"))
    rows = {(r.record[10:-1], r.chunk_no): r for r in read.collect()}
    assert len(rows) == len(records) and all(r.whole for r in rows.values())
    assert bytes(rows["2", 0].payload) == body and rows["2", 0].payload_bytes == len(body) and rows["2", 0].url == "http://a/"
    told = {r.record[10:-1]: (r.record_type, r.verified) for r in warc.verified(read).collect()}
    assert told == {
        "0": ("warcinfo", True), "1": ("request", True), "2": ("response", True), "3": ("response", False),
        "4": ("revisit", True), "5": ("response", True),
    }


def test_mandatory_headers_and_whole_chunks(spark, tmp_path):
    big = bytes(random.Random(1).randrange(256) for _ in range(3 << 20)) + b"WARC/1."
    data = [(1, "u", big), (2, "u", big), (3, "u", b"small")]
    path = str(tmp_path / "w")
    got = {r["id"]: r for r in round_trip(spark, path, data, chunk=warc.CHUNK).collect()}
    assert all(r["verified"] for r in got.values()) and got[2]["payload_bytes"] == len(big)
    assert (got[1]["record_type"], got[1]["to"]) == ("revisit", 2)
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in sorted((tmp_path / "w").glob("part-*")))
    heads = [h.split(b"\r\n\r\n")[0] for h in raw.split(b"WARC/1.1\r\n")[1:]]
    assert len(heads) == 6
    for head in heads:
        names = {line.split(b":")[0] for line in head.split(b"\r\n")}
        assert names >= {b"WARC-Type", b"WARC-Record-ID", b"WARC-Date", b"Content-Length"}
        assert (b"WARC-Profile" in names) == (b"WARC-Type: revisit" in head)


def test_extra_columns_of_clashing_names(spark, tmp_path):
    records = with_row_key(spark.createDataFrame(payloads(), RECORDS).selectExpr(
        "*", "1 as chunk", "2 as last", "3 as record_type", "'x' as payload_digest", "4 as to", "5 as n", "6 as payload_bytes"))
    warc.archive(records, str(tmp_path / "w"), 50)
    told = warc.verified(warc.read_records(spark, str(tmp_path / "w"))).collect()
    assert len(told) == len(payloads()) and all(r.verified for r in told)


def test_empty_table(spark, tmp_path):
    assert round_trip(spark, str(tmp_path / "w"), []).count() == 0


@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_chunks_of_any_size(spark, chunk):
    records = with_row_key(spark.createDataFrame(payloads(), RECORDS).withColumn("extra", F.lit(1)))
    chunks = warc.chunk_table(records, chunk)
    assert set(chunks.columns) > {"extra", *KEY, "chunk_no", "running_digest"}
    ends = chunks.where("last").collect()
    assert {r["record_id"]: r["running_digest"] for r in ends} == {
        i: hashlib.sha1(p or b"").hexdigest() for i, _, p in payloads()}
