"""WARC archives compressed with Zstandard: one frame per record, the dictionary in front.

An archive is a skippable frame that holds the dictionary, then one frame for
each record. ``write_archives`` makes archives of pages as rows of (archive,
content), and ``write_files`` puts them into files from the tasks.
``read_records`` reads the records of any archive, of such rows or of the
``binaryFile`` reader, after checking each header, length and digest that it
can; ``read_archives`` gives the pages of records made here.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.arrow import small_batches

# Fixed values of the formats: the frame marks of Zstandard, the skippable mark
# that announces a dictionary, and the profile of a revisit of equal payload.
FRAME = 0xFD2FB528
DICTIONARY_FRAME = 0x184D2A5D
DICTIONARY = 0xEC30A437
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"

#: Smallest payload that a revisit may stand for.
MIN_REVISIT = 100

#: Payload bytes gathered into one archive; a larger page is an archive of its own.
ARCHIVE_BYTES = 4 << 20

#: Size of an archive's dictionary, and the pieces the trainer looks at.
DICTIONARY_BYTES = 16 << 10

#: Parts that the pages of one payload are spread over when they meet its first page.
SALTS = 32

RECORD = (
    "archive string, number long, record_type string, record_id string, date string, url string, refers_to string, "
    "digest string, digest_checked boolean, headers map<string,string>, block binary, payload binary, problem string"
)
ARCHIVE = "archive string, content binary, records long"


class BadArchive(ValueError):
    """An archive that breaks the format."""


def _salt() -> Column:
    return F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """Pages with payload (UTF-8 of html; NULL: empty), its length and digest, and what they revisit.

    Of equal payloads of ``min_bytes`` or more the smallest page_id is the
    response and the others refer to it. Rows that repeat that page_id are
    responses too. Rows without page_id refer to the smallest one there is; if
    there is none they are responses. Payloads are grouped by digest after a
    count within each task; a payload that many pages share is salted.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    named = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"))
    digested = named.select(
        "*", F.length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest")
    )
    large = digested.where(F.col("payload_bytes") >= min_bytes)
    first = (
        large.groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND first_id IS NOT NULL")
        .select("payload_digest", "first_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    other = ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return (
        digested.withColumn("salt", _salt())
        .join(first, ["payload_digest", "salt"], "left")
        .withColumn("refers_to", F.when(F.col("first_id").isNotNull() & other, F.col("first_id")))
        .withColumn("record_type", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit"))
        .select("page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to")
    )


def record_id(page_id: int | None, digest: str) -> str:
    """The id of a page's response: that of the page and its payload."""
    name = "none" if page_id is None else page_id
    return f"<urn:page:{name}:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name} {digest}')}>"


def record_bytes(page_id, url, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    """One WARC record: header, blank line, block, two line ends. A revisit has an id of its own and refers to the response's."""
    target = quote(url, safe="!#$%&'()*+,/:;=?@[]~-._") if url is not None else None
    block = HTTP_HEAD + (payload if kind == "response" else b"")
    own = record_id(page_id, digest if kind == "response" else f"{target} {digest}")
    head = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", own),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Payload-Length", len(payload)),
        ("WARC-Refers-To", record_id(refers_to, digest) if kind == "revisit" else None),
        ("WARC-Profile", PROFILE if kind == "revisit" else None),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", len(block)),
    ]
    lines = [f"{k}: {v}".encode() for k, v in head if v is not None]
    return VERSION + b"\r\n" + b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def _dictionary(records: list[bytes]) -> bytes:
    """A dictionary trained on the archive's own records, or their bytes where they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(r[:1024] for r in records)[:DICTIONARY_BYTES]


def archive_bytes(records: list[bytes], level: int = 3) -> bytes:
    """Records as one archive."""
    held = _dictionary(records)
    parts = [struct.pack("<II", DICTIONARY_FRAME, len(held)), held]
    press = zstandard.ZstdCompressor(level, dict_data=zstandard.ZstdCompressionDict(held), write_content_size=True)
    parts += map(press.compress, records)
    return b"".join(parts)


def write_archives(rows: DataFrame, archive_size: int = ARCHIVE_BYTES) -> DataFrame:
    """Rows of ``with_revisits`` as archives: (archive, content, number of records).

    Each task writes archives of about ``archive_size`` bytes, so memory does
    not grow with the table. A task that runs again writes the same archives.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made, held, size = TaskContext.get().partitionId(), 0, [], 0

        def full() -> pa.RecordBatch:
            row = {"archive": f"part-{part:05d}-{made:05d}.warc.zst", "content": archive_bytes(held), "records": len(held)}
            return pa.RecordBatch.from_arrays(
                [pa.array([row["archive"]]), pa.array([row["content"]], pa.binary()), pa.array([row["records"]], pa.int64())],
                names=list(row),
            )

        for batch in batches:
            for r in batch.to_pylist():
                kind = r["record_type"]
                one = record_bytes(r["page_id"], r["url"], r["payload"], r["payload_digest"], kind, r["refers_to"])
                if held and size + len(one) > archive_size:
                    yield full()
                    made, held, size = made + 1, [], 0
                held.append(one)
                size += len(one)
        if held:
            yield full()

    return small_batches(rows).mapInArrow(run, ARCHIVE)


def write_files(archives: DataFrame, folder: str) -> DataFrame:
    """Write archives to files of their names in a folder that all executors reach: (path, bytes, records).

    ``folder`` is a path or a URI that pyarrow's file systems know. A file gets
    its name when it is whole, and a task that runs again writes the same files,
    so what is there is never half an archive. Files are written as the rows
    that come back are; take them before reading the folder.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder if "://" in folder else folder.replace("file:", "", 1))
        store.create_dir(root, recursive=True)
        for batch in batches:
            names, sizes = batch.column(0).to_pylist(), []
            for name, content in zip(names, batch.column(1).to_pylist(), strict=True):
                # the reader of folders passes over names with an underscore in front
                own = f"{root}/_{name}.{uuid.uuid4().hex}"
                with store.open_output_stream(own) as out:
                    out.write(content)
                store.move(own, f"{root}/{name}")
                sizes.append(len(content))
            columns = [pa.array([f"{folder}/{n}" for n in names], pa.string()), pa.array(sizes, pa.int64()), batch.column(2)]
            yield pa.RecordBatch.from_arrays(columns, ["path", "bytes", "records"])

    return small_batches(archives).select("archive", "content", "records").mapInArrow(run, "path string, bytes long, records long")


def _frame_end(view: memoryview, at: int) -> int:
    """Where the frame that begins at ``at`` ends, from its header and the sizes of its blocks."""
    if len(view) < at + 5:
        raise BadArchive(f"the frame at byte {at} is cut off")
    about = view[at + 4]
    single, has_sum = about >> 5 & 1, about >> 2 & 1
    place = at + 5 + (1 - single) + (0, 1, 2, 4)[about & 3] + (single, 2, 4, 8)[about >> 6]
    last = 0
    while not last:
        if len(view) < place + 3:
            raise BadArchive(f"the frame at byte {at} is cut off")
        block = int.from_bytes(view[place : place + 3], "little")
        last, kind, size = block & 1, block >> 1 & 3, block >> 3
        if kind == 3:
            raise BadArchive(f"the frame at byte {at} is damaged: a block of no kind")
        place += 3 + (1 if kind == 1 else size)
    place += 4 * has_sum
    if place > len(view):
        raise BadArchive(f"the frame at byte {at} is cut off")
    return place


def _frames(content: bytes) -> Iterator[bytes]:
    """Decode an archive record by record, with the dictionary of its leading skippable frame."""
    at, held = 0, None
    if len(content) >= 8 and struct.unpack_from("<I", content)[0] == DICTIONARY_FRAME:
        size = struct.unpack_from("<I", content, 4)[0]
        at, raw = 8 + size, content[8 : 8 + size]
        if len(raw) < size:
            raise BadArchive("the dictionary is cut off")
        if raw[:4] == struct.pack("<I", FRAME):  # the dictionary may itself be compressed
            raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
        held = zstandard.ZstdCompressionDict(raw)
    unpack = zstandard.ZstdDecompressor(dict_data=held)
    view = memoryview(content)
    while at < len(content):
        if len(content) - at < 8:
            raise BadArchive(f"{len(content) - at} bytes are left over")
        mark = struct.unpack_from("<I", content, at)[0]
        if mark in SKIPPABLE:
            at += 8 + struct.unpack_from("<I", content, at + 4)[0]
            continue
        if mark != FRAME:
            raise BadArchive(f"no frame at byte {at}")
        end, one = _frame_end(view, at), unpack.decompressobj()
        try:
            record = one.decompress(view[at:end])
        except zstandard.ZstdError as e:
            raise BadArchive(f"the frame at byte {at} is damaged: {e}") from e
        if not one.eof:
            raise BadArchive(f"the frame at byte {at} is cut off")
        at = end
        yield record
    if at != len(content):
        raise BadArchive("the last frame is cut off")


def parse_record(record: bytes) -> dict:
    """Header fields, in lower case, and block of one record; raises BadArchive if it breaks the format."""
    head, found, rest = record.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or lines[0] not in (b"WARC/1.0", b"WARC/1.1"):
        raise BadArchive(f"no WARC record: {lines[0][:20]!r}")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not re.fullmatch(rb"[!#$%&'*+.^_`|~0-9A-Za-z-]+", name):
            raise BadArchive(f"bad header line {line[:60]!r}")
        fields[name.decode().lower()] = value.strip().decode()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise BadArchive(f"{name} is missing")
    if not fields["content-length"].isdigit() or len(rest) != int(fields["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise BadArchive(f"content-length {fields['content-length']} but {len(rest) - 4} bytes")
    return fields | {"block": rest[:-4]}


def _digest_is(named: str, data: bytes) -> bool | None:
    """Whether a digest ``algorithm:value`` is that of the data; None for an algorithm that is not known here."""
    algorithm, _, value = named.partition(":")
    if algorithm.lower() not in ("sha1", "sha256", "md5", "sha512"):
        return None
    held = hashlib.new(algorithm.lower(), data, usedforsecurity=False).digest()
    return value.lower() in (held.hex(), base64.b32encode(held).decode().lower(), base64.b32encode(held).decode().lower().rstrip("="))


def checked_record(record: bytes) -> dict:
    """Any record as a row of ``RECORD``, but for its archive and number; raises BadArchive for one that breaks the format.

    The payload is the body of a response's or request's HTTP message, else the
    block; a revisit has none. Block and payload digests of algorithms that are
    known are checked, as is the payload length that ``record_bytes`` adds.
    """
    fields = parse_record(record)
    block, kind = fields.pop("block"), fields["warc-type"]
    http = fields.get("content-type", "").replace(" ", "").lower().startswith("application/http")
    payload = None if kind == "revisit" else block.partition(b"\r\n\r\n")[2] if http else block
    checked = []
    for name, data in (("warc-block-digest", block), ("warc-payload-digest", payload)):
        if name in fields and data is not None:
            checked.append(_digest_is(fields[name], data))
            if checked[-1] is False:
                raise BadArchive(f"{name} of {fields['warc-record-id']} is that of other bytes")
    size = fields.get("x-payload-length")
    if size is not None and (not size.isdigit() or (payload is not None and len(payload) != int(size))):
        raise BadArchive(f"payload of {fields['warc-record-id']} has another length")
    if kind == "revisit" and "warc-profile" not in fields:
        raise BadArchive("a revisit without a profile")
    return {
        "record_type": kind, "record_id": fields["warc-record-id"], "date": fields["warc-date"], "url": fields.get("warc-target-uri"),
        "refers_to": fields.get("warc-refers-to"), "digest": fields.get("warc-payload-digest"), "digest_checked": any(checked),
        "headers": list(fields.items()), "block": block, "payload": payload, "problem": None,
    }


_SCHEMA = pa.schema([
    ("archive", pa.string()), ("number", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()), ("date", pa.string()),
    ("url", pa.string()), ("refers_to", pa.string()), ("digest", pa.string()), ("digest_checked", pa.bool_()),
    ("headers", pa.map_(pa.string(), pa.string())), ("block", pa.binary()), ("payload", pa.binary()), ("problem", pa.string()),
])

#: Bytes of records that go back from a task at a time.
OUT_BYTES = 8 << 20


def _rows(title: str | None, data: bytes, aside: bool) -> Iterator[dict]:
    """The records of one archive; with ``aside`` a row with ``problem`` for each bad one, and one for what cannot be decoded."""
    number = 0
    try:
        for number, record in enumerate(_frames(data)):
            try:
                yield {"archive": title, "number": number} | checked_record(record)
            except (BadArchive, UnicodeDecodeError) as e:
                if not aside:
                    raise BadArchive(f"record {number} of {title}: {e}") from e
                yield {"archive": title, "number": number, "block": record, "problem": str(e)}
    except BadArchive as e:
        if not aside:
            raise
        yield {"archive": title, "number": None, "problem": str(e)}


def read_records(archives: DataFrame, name: str = "archive", content: str = "content", aside: bool = False) -> DataFrame:
    """All records of archives of any types, one row each with the columns of ``RECORD``.

    ``number`` counts an archive's records. Raises for an archive that is cut off
    or damaged, a record whose header or length is wrong, or a block or payload
    that is not that of its digest; with ``aside`` such a record is a row with
    ``problem`` and its raw bytes in ``block``, and what follows a damaged frame
    a row without number. An archive of no bytes or NULL has no records.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for title, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows, size = [], 0
                for row in _rows(title, data or b"", aside):
                    rows.append(row)
                    size += len(row.get("block") or b"")
                    if size > OUT_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, _SCHEMA)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _SCHEMA)

    return archives.select(F.col(name).cast("string"), F.col(content)).mapInArrow(run, RECORD)


def read_archives(archives: DataFrame, name: str = "archive", content: str = "content") -> DataFrame:
    """The pages of records that ``record_bytes`` made: page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload, archive.

    Records of other types are left out; a revisit has no payload. Raises as
    ``read_records`` does.
    """
    found = read_records(archives, name, content).where("record_type IN ('response', 'revisit')")
    page = F.regexp_extract("record_id", r"^<urn:page:(-?\d+):", 1).try_cast("long")
    refers = F.regexp_extract("refers_to", r"^<urn:page:(-?\d+):", 1)
    return found.select(
        page.alias("page_id"), "url", "record_type", F.when(F.col("record_type") == "revisit", refers.try_cast("long")).alias("refers_to"),
        F.coalesce(F.element_at("headers", "x-payload-length").cast("long"), F.length("payload").cast("long")).alias("payload_bytes"),
        F.regexp_replace("digest", "^sha256:", "").alias("payload_digest"), "payload", "archive",
    )
