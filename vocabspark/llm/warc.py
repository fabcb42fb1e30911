"""WARC archives: written with revisits for repeated payloads, read back by a salvaging reader.

Writing. Each page becomes one record in a gzip member of its own. Of equal payloads of at least
``REVISIT_BYTES``, the one with the largest page id is a ``response`` and the others are ``revisit``
records that name it. Spark's text writer puts the members into the files as they are: its line end is the
NUL byte that a member ends in, and a member without one is followed by NUL padding, which gzip
allows. So archives go through Spark's commit protocol to any file system it knows.

Reading. A file is read record by record, compressed or not. Every check that fails (gzip
checksum, version line, header, length, end of record, block and payload digest) makes the reader search for
the next place where a member or a version line begins a record that passes all of them. What lies between is
a quarantined gap: it is logged with its bytes' positions and the first reason.

Defined cases. A null html is the empty payload. A page id may be null: such a record has an empty name, and
counts as smaller than all others. Rows that tie for the largest page id of a payload are all responses. A
null url gives a record without target; white space and control characters in a url are percent-encoded.
Empty tables give archives without records, empty files neither records nor gaps. Other
columns of the table are not read. A record that lies whole inside a damaged one is read as a record. The reader
holds one file in memory (the writer's files hold ``RECORDS_PER_FILE`` records at most), and Spark reads none above 2 GB.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocabspark.llm.words import chunks

REVISIT_BYTES = 1000
RECORDS_PER_FILE = 10_000
LEVEL = 6
# A capture time, where the table has none.
NO_DATE = "1970-01-01T00:00:00Z"

_MADE = "page_id long, url string, n_bytes long, digest string, same string, member binary"
_MADE_ARROW = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("n_bytes", pa.int64()),
    ("digest", pa.string()), ("same", pa.string()), ("member", pa.binary()),
])
READ = (
    "path string, kind string, start long, end long, reason string, type string, record_id string, target_uri string, "
    "date string, refers_to string, payload_bytes long, payload_digest string, payload binary"
)
_READ_ARROW = pa.schema([
    ("path", pa.string()), ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("reason", pa.string()),
    ("type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("date", pa.string()),
    ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
])
_BATCH_BYTES = 4 << 20


# --- one record -----------------------------------------------------------------------------------


def record_name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def sha1_label(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def sha1_hex(label: str) -> str | None:
    """Hex form of a labelled SHA-1, which may be written in base 32 or in hex."""
    kind, _, value = label.partition(":")
    if kind.lower() != "sha1":
        return None
    if re.fullmatch("[0-9A-Fa-f]{40}", value):
        return value.lower()
    return base64.b32decode(value.upper()).hex() if re.fullmatch("[A-Za-z2-7]{32}", value) else None


def _uri(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f\x85\xa0  ]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)


def http_head(n_bytes: int) -> bytes:
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % n_bytes


def record(kind: str, page_id: int | None, url: str | None, digest: bytes, block: bytes, more: list[tuple[str, str]], date: str) -> bytes:
    """A whole record, uncompressed."""
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_name(page_id)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", _uri(url)))
    fields += [
        *more,
        ("WARC-Payload-Digest", sha1_label(digest)),
        ("WARC-Block-Digest", sha1_label(hashlib.sha1(block).digest())),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return b"".join((head.encode(), block, b"\r\n\r\n"))


def member(data: bytes) -> bytes:
    """A gzip member without its last byte if that is NUL, as the writer's line end supplies it."""
    deflate = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    packed = deflate.compress(data) + deflate.flush()
    return packed[:-1] if packed.endswith(b"\0") else packed


# --- writing --------------------------------------------------------------------------------------


def _responses(date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "html"):
                rows = []
                for page_id, url, html in zip(*(part.column(name).to_pylist() for name in ("page_id", "url", "html"))):
                    payload = (html or "").encode()
                    digest = hashlib.sha1(payload).digest()
                    whole = record("response", page_id, url, digest, http_head(len(payload)) + payload, [], date)
                    # Small payloads are never revisited; a key of their own keeps them apart.
                    same = hashlib.sha256(payload).hexdigest() if len(payload) >= REVISIT_BYTES else f"{page_id} {url}"
                    rows.append((page_id, url, len(payload), digest.hex(), same, member(whole)))
                columns = zip(*rows)
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _MADE_ARROW)], schema=_MADE_ARROW)

    return run


def _finished(date: str):
    """The members to write: responses as they are, revisits made here."""

    def revisit(row: dict) -> bytes:
        more = [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", record_name(row["holder"])),
            ("WARC-Refers-To-Date", date),
        ]
        if row["holder_url"] is not None:
            more.append(("WARC-Refers-To-Target-URI", _uri(row["holder_url"])))
        head, digest = http_head(row["n_bytes"]), bytes.fromhex(row["digest"])
        return member(record("revisit", row["page_id"], row["url"], digest, head, more, date))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "member"):
                out = [row["member"] or revisit(row) for row in part.to_pylist()]
                yield pa.record_batch([pa.array(out, pa.binary())], names=["member"])

    return run


def write(pages: DataFrame, path: str, date: str = NO_DATE) -> None:
    """Write ``page_id``, ``url`` and ``html`` as archives into a new folder.

    What a page must know is whether its payload has a holder other than itself; only payloads that occur
    more than once are in the joined table, and compressed members, not pages, are shuffled.
    """
    pages = pages.select(F.col("page_id").cast("long"), "url", "html")
    made = pages.mapInArrow(_responses(date), _MADE)
    payload = F.col("html").cast("binary")
    holders = (
        pages.where(F.octet_length("html") >= REVISIT_BYTES)
        .groupBy(F.sha2(payload, 256).alias("same"))
        .agg(F.max(F.struct("page_id", "url")).alias("held"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("same", F.col("held.page_id").alias("holder"), F.col("held.url").alias("holder_url"))
    )
    repeats = F.col("holder").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("holder"))
    joined = made.join(holders, "same", "left").withColumn("member", F.when(~repeats, F.col("member")))
    done = joined.drop("same").mapInArrow(_finished(date), "member binary")
    lines = done.select(F.col("member").cast("string").alias("value"))
    lines.write.option("lineSep", "\0").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


# --- reading --------------------------------------------------------------------------------------


class Damaged(ValueError):
    """A check that failed."""


_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r?\n")
_VERSION = re.compile(rb"WARC/1\.[01]")
_FEED = 1 << 16


def _unpacked(data: memoryview, at: int) -> tuple[bytes, int]:
    """The content of the gzip member that begins here, and where it ends."""
    inflate, out = zlib.decompressobj(31), []
    while not inflate.eof:
        if at >= len(data):
            raise Damaged("member cut short")
        fed = data[at : at + _FEED]
        try:
            out.append(inflate.decompress(fed))
        except zlib.error:
            raise Damaged("not a gzip member or wrong checksum") from None
        at += len(fed)
    return b"".join(out), at - len(inflate.unused_data)


def _head(data: bytes, at: int) -> tuple[dict[str, str], int]:
    stop = data.find(b"\r\n\r\n", at)
    if stop < 0:
        raise Damaged("header cut short")
    first, *lines = bytes(data[at:stop]).split(b"\r\n")
    fields = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line without name")
        fields.setdefault(name.strip().lower().decode("utf-8", "replace"), value.strip().decode("utf-8", "replace"))
    return {"": first.decode("utf-8", "replace"), **fields}, stop + 4


def _whole_number(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch("[0-9]{1,18}", text) else None


def _checked(label: str | None, content: bytes, what: str) -> str | None:
    """The hex SHA-1 that a label states, which must be that of the content."""
    stated = sha1_hex(label) if label else None
    if stated and hashlib.sha1(content).hexdigest() != stated:
        raise Damaged(f"{what} digest differs")
    return stated


def parse(data: bytes, at: int) -> tuple[dict, int]:
    """The record that begins here, and where it ends; ``Damaged`` if a check fails."""
    if not _VERSION.match(data, at):
        raise Damaged("no version line")
    fields, begin = _head(data, at)
    length = _whole_number(fields.get("content-length"))
    if length is None:
        raise Damaged("no length")
    end = begin + length
    if end + 4 > len(data):
        raise Damaged("record cut short")
    if data[end : end + 4] != b"\r\n\r\n":
        raise Damaged("no end of record")
    block = data[begin:end]
    _checked(fields.get("warc-block-digest"), block, "block")
    payload, size = block, length
    if fields.get("content-type", "").startswith("application/http"):
        try:
            http, body = _head(block, 0)
        except Damaged:
            http, body = {}, 0
        payload, size = block[body:], length - body
        if fields.get("warc-type") == "revisit":
            payload, size = None, _whole_number(http.get("content-length"))
    label = fields.get("warc-payload-digest")
    digest = sha1_hex(label) if label else None
    if payload is not None:
        _checked(label, payload, "payload")
        digest = digest or hashlib.sha1(payload).hexdigest()
    found = {
        "type": fields.get("warc-type"),
        "record_id": fields.get("warc-record-id"),
        "target_uri": fields.get("warc-target-uri"),
        "date": fields.get("warc-date"),
        "refers_to": fields.get("warc-refers-to"),
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": payload,
    }
    return found, end + 4


def _records_at(data: bytes, view: memoryview, at: int) -> tuple[list[dict], int]:
    if not data.startswith(b"\x1f\x8b", at):
        found, end = parse(data, at)
        return [found], end
    content, end = _unpacked(view, at)
    found, inside = [], 0
    while inside < len(content):
        one, inside = parse(content, inside)
        found.append(one)
    return found, end


def salvage(data: bytes) -> Iterator[dict]:
    """Records and gaps of an archive, in order. Every byte but padding belongs to one of them."""
    view, at, bad, why = memoryview(data), 0, None, None
    padding = re.compile(rb"[\x00\r\n]*")
    while bad is not None or (at := padding.match(data, at).end()) < len(data):
        try:
            if at >= len(data):
                found, end = [], at
            else:
                found, end = _records_at(data, view, at)
        except Damaged as damage:
            if bad is None:
                bad, why = at, str(damage)
            following = _START.search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if bad is not None:
            yield {"kind": "gap", "start": bad, "end": at, "reason": why}
            bad = None
        for one in found:
            yield {"kind": "record", "start": at, "end": end, **one}
        at = end


def _reader(payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                out, held = [], 0
                for row in salvage(content.as_py() or b""):
                    if not payloads:
                        row.pop("payload", None)
                    out.append({"path": path, **row})
                    held += 500 + len(row.get("payload") or b"")
                    if held > _BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(out, schema=_READ_ARROW)
                        out, held = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=_READ_ARROW)

    return run


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records and gaps of all archives under a path; ``kind`` tells which a row is."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(_reader(payloads), READ)


def records(found: DataFrame) -> DataFrame:
    """The records with ``page_id`` and the ``page_id`` they refer to, where the names tell."""

    def page(name: str):
        return F.regexp_extract(name, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")

    kept = found.where("kind = 'record'")
    return kept.select(page("record_id").alias("page_id"), page("refers_to").alias("refers_page"), *kept.columns)


def quarantine(found: DataFrame, path: str) -> DataFrame:
    """Append the gaps to a log in the shared folder and return the whole log."""
    gaps = found.where("kind = 'gap'").select("path", "start", "end", "reason")
    gaps.write.mode("append").parquet(path)
    return found.sparkSession.read.schema(gaps.schema).parquet(path)
