from __future__ import annotations

import base64
import hashlib
import random
import time
import uuid

import pytest
import zstandard
from pyspark.sql import functions as F

from sessionlake.llm import warc

PAGE = "page_id long, url string, html string"


def rows_of(spark, pages, size=warc.ARCHIVE_BYTES):
    df = spark.createDataFrame(pages, PAGE).withColumn("payload", F.lit("own")).withColumn("salt", F.lit("own"))
    archives = warc.write_archives(warc.with_revisits(df), size)
    return warc.read_archives(archives).collect()


def check(rows, pages):
    payload = {}
    for i, _, html in pages:
        data = (html or "").encode()
        if len(data) >= warc.MIN_REVISIT and i is not None:
            payload[data] = min(i, payload.get(data, i))
    want = []
    for i, _, html in pages:
        data = (html or "").encode()
        refers = payload.get(data)
        refers = None if refers == i else refers
        want.append((str(i), len(data), hashlib.sha256(data).hexdigest(), "response" if refers is None else "revisit", refers, data if refers is None else None))
    got = [(str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], r["payload"] and bytes(r["payload"]) if r["record_type"] == "revisit" else bytes(r["payload"])) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_round_trip(spark):
    pages = [(i, f"http://h/{i}?ä\r\nX: y", f"<p>{i // 3}</p>" * (i % 40)) for i in range(300)]
    pages += [(900, None, None), (901, "", ""), (901, "", ""), (5, "u", "z" * 100), (4, "u", "z" * 100), (4, "u", "z" * 100), (6, "u", "z" * 99), (7, "u", "z" * 99)]
    pages += [(None, "u", "z" * 100), (None, None, "q" * 200), (None, None, "q" * 200), (910, "u", "\r\n\r\n" * 50), (911, "u", "é" * 300_000)]
    for size in (warc.ARCHIVE_BYTES, 2000):
        check(rows_of(spark, pages, size), pages)
    assert rows_of(spark, []) == []


def test_real_files_read_like_tables(spark, tmp_path):
    records = [warc.record_bytes(i, "http://x", b"abc" * i, hashlib.sha256(b"abc" * i).hexdigest(), "response", None) for i in range(50)]
    (tmp_path / "a.warc.zst").write_bytes(warc.archive_bytes(records))
    (tmp_path / "b.warc.zst").write_bytes(warc.archive_bytes(records[:1]))
    (tmp_path / "c.warc.zst").write_bytes(b"")
    files = spark.read.format("binaryFile").load(str(tmp_path))
    rows = warc.read_archives(files, "path", "content").collect()
    assert sorted(r["page_id"] for r in rows) == sorted([*range(50), 0])


def test_frames_and_dictionary():
    records = [b"record %d " % i * 30 for i in range(200)]
    data = warc.archive_bytes(records)
    assert int.from_bytes(data[:4], "little") == warc.DICTIONARY_FRAME
    assert list(warc._frames(data)) == records
    # the dictionary in a compressed form, other skippable frames, no dictionary at all
    size = int.from_bytes(data[4:8], "little")
    held = zstandard.ZstdCompressor().compress(data[8 : 8 + size])
    packed = data[:4] + len(held).to_bytes(4, "little") + held + data[8 + size :]
    assert list(warc._frames(packed)) == records
    skip = (0x184D2A50).to_bytes(4, "little") + (3).to_bytes(4, "little") + b"xyz"
    assert list(warc._frames(data + skip)) == records
    assert list(warc._frames(zstandard.ZstdCompressor().compress(records[0]))) == records[:1]
    for broken in (data[:-1], data[: size // 2], data + b"x", data + b"notaframe", data[:-5] + b"\0\0\0\0\0"):
        with pytest.raises(warc.BadArchive):
            list(warc._frames(broken))


def test_decoding_is_linear():
    rng = random.Random(1)
    records = [rng.randbytes(4096) for _ in range(16_384)]
    press = zstandard.ZstdCompressor(1)
    data = b"".join(press.compress(r) for r in records)  # 64 MB
    start = time.monotonic()
    assert sum(len(r) for r in warc._frames(data)) == 4096 * len(records)
    assert time.monotonic() - start < 2


def test_frames_of_every_kind_of_header():
    rng = random.Random(2)
    sizes = [0, 1, 255, 256, 65_791, 65_792, 300_000]
    made = []
    for size in sizes:
        raw = rng.randbytes(size // 2) + b"a" * (size - size // 2)
        for options in ({}, {"write_checksum": True}, {"write_content_size": False}):
            made.append((raw, zstandard.ZstdCompressor(3, **options).compress(raw)))
            stream = zstandard.ZstdCompressor(3, **options).compressobj()
            made.append((raw, stream.compress(raw) + stream.flush()))
    assert list(warc._frames(b"".join(f for _, f in made))) == [r for r, _ in made]


def test_files_written_from_tasks_are_read_back(spark, tmp_path):
    pages = [(i, f"http://h/{i}", f"<p>{i // 3}</p>" * 30) for i in range(60)]
    archives = warc.write_archives(warc.with_revisits(spark.createDataFrame(pages, PAGE).repartition(4)), 5000)
    for folder in (str(tmp_path / "plain"), f"file://{tmp_path}/uri"):
        for _ in range(2):  # a task that runs again writes the same files
            written = warc.write_files(archives, folder).collect()
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
        assert sorted(r["path"].rpartition("/")[2] for r in files.collect()) == sorted(r["path"].rpartition("/")[2] for r in written)
        assert sum(r["records"] for r in written) == 60 and len(written) > 4
        check(warc.read_archives(files, "path", "content").collect(), pages)


def test_revisits_refer_to_records_that_are_there(spark):
    pages = [(i, f"http://h/{i}", "<p>same</p>" * 30) for i in range(5)] + [(9, "http://h/9", "other" * 30)]
    archives = warc.write_archives(warc.with_revisits(spark.createDataFrame(pages, PAGE)))
    records = warc.read_records(archives).collect()
    ids = {r["record_id"] for r in records if r["record_type"] == "response"}
    revisits = [r for r in records if r["record_type"] == "revisit"]
    assert len(revisits) == 4 and {r["refers_to"] for r in revisits} <= ids and len({r["record_id"] for r in records}) == 6


def standard_archive():
    """What other tools write: a record of the file, requests, metadata, sha1 digests in base32."""
    body = b"<html>standard</html>"
    sha1 = base64.b32encode(hashlib.sha1(body).digest()).decode()
    http = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n" + body

    def record(kind, n, block, **more):
        head = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{uuid.UUID(int=n)}>", "WARC-Date": "2024-01-01T00:00:00Z", **{k.replace("_", "-"): v for k, v in more.items()}}
        lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
        return f"WARC/1.0\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"

    return [
        record("warcinfo", 1, b"software: x\r\nformat: WARC 1.0\r\n", Content_Type="application/warc-fields"),
        record("request", 2, b"GET / HTTP/1.1\r\nHost: h\r\n\r\n", Content_Type="application/http; msgtype=request", WARC_Target_URI="http://h/"),
        record("response", 3, http, Content_Type="application/http; msgtype=response", WARC_Payload_Digest=f"sha1:{sha1}", WARC_Target_URI="http://h/"),
        record("metadata", 4, b"fetchTimeMs: 3\r\n", WARC_Block_Digest="blake3:unknown"),
        record("revisit", 5, b"HTTP/1.1 200 OK\r\n\r\n", Content_Type="application/http; msgtype=response", WARC_Payload_Digest=f"sha1:{sha1}", WARC_Profile=warc.PROFILE, WARC_Refers_To="<urn:uuid:3>"),
        record("resource", 6, body, WARC_Payload_Digest=f"SHA256:{hashlib.sha256(body).hexdigest()}"),
    ]


def test_a_standard_archive(spark):
    records = standard_archive()
    data = b"".join(map(zstandard.ZstdCompressor().compress, records))
    df = spark.createDataFrame([("a", bytearray(data)), ("none", None)], "archive string, content binary")
    rows = {r["record_type"]: r for r in warc.read_records(df).collect()}
    assert sorted(rows) == ["metadata", "request", "resource", "response", "revisit", "warcinfo"]
    assert bytes(rows["response"]["payload"]) == b"<html>standard</html>" == bytes(rows["resource"]["payload"])
    assert {k: r["digest_checked"] for k, r in rows.items()} == {
        "metadata": False, "request": False, "resource": True, "response": True, "revisit": False, "warcinfo": False,
    }
    assert rows["revisit"]["payload"] is None and rows["revisit"]["refers_to"] == "<urn:uuid:3>" and rows["warcinfo"]["number"] == 0
    assert rows["response"]["headers"]["warc-target-uri"] == "http://h/" and rows["response"]["problem"] is None
    pages = warc.read_archives(df).collect()
    assert [(r["page_id"], r["record_type"], r["payload_bytes"]) for r in pages] == [(None, "response", 21), (None, "revisit", None)]


def test_bad_records_are_set_aside_on_request(spark):
    records = standard_archive()
    bad = [records[0], records[2].replace(b"standard", b"stendard"), b"no record", records[3]]
    press = zstandard.ZstdCompressor().compress
    df = spark.createDataFrame(
        [("mixed", bytearray(b"".join(map(press, bad)))), ("cut", bytearray(press(records[0]) + press(records[3])[:-2]))], "archive string, content binary"
    )
    rows = warc.read_records(df, aside=True).collect()
    mixed = sorted((r["number"], r["problem"] is None, bytes(r["block"]) if r["problem"] else None) for r in rows if r["archive"] == "mixed")
    assert mixed == [(0, True, None), (1, False, bad[1]), (2, False, bad[2]), (3, True, None)]
    cut = [(r["number"], r["record_type"], r["problem"] is None) for r in rows if r["archive"] == "cut"]
    assert sorted(cut, key=repr) == [(0, "warcinfo", True), (None, None, False)]
    for name in ("mixed", "cut"):
        with pytest.raises(Exception, match="BadArchive"):
            warc.read_records(df.where(F.col("archive") == name)).collect()


def test_bad_records_are_found():
    good = warc.record_bytes(1, "u", b"payload", hashlib.sha256(b"payload").hexdigest(), "response", None)
    assert warc.checked_record(good)["payload"] == b"payload" and warc.checked_record(good)["digest_checked"]
    revisit = warc.record_bytes(2, "u", b"payload", hashlib.sha256(b"payload").hexdigest(), "revisit", 1)
    assert warc.checked_record(revisit)["refers_to"] == warc.checked_record(good)["record_id"]
    cases = [
        good.replace(b"WARC/1.1", b"WARC/9.9"), good.replace(b"payload\r\n", b"paylord\r\n"), good[:-1], good + b"x",
        good.replace(b"WARC-Date: ", b"Other: "), good.replace(b"X-Payload-Length: 7", b"X-Payload-Length: 8"),
        good.replace(b"Content-Type: app", b"Content Type app"), b"", b"\r\n\r\n", revisit.replace(b"WARC-Profile", b"X-Profile"),
    ]
    for record in cases:
        with pytest.raises(warc.BadArchive):
            warc.checked_record(record)
