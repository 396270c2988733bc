"""Legacy ARC archives and their conversion to WARC.

An ARC file starts with a version block, whose own lines name the fields of every record's header
line: version 1 has URL, address, date, type and length, version 2 adds result code, checksum,
location, offset and file name. Records are found by header line and declared length alone; their
content may hold anything. The converter makes a WARC record of each: a name-based identifier from
archive, place, URL, date and digest, the date in ISO form, the type (response for HTTP content,
resource otherwise), and the digests of block and payload. Of records with equal payloads the first one
by page and place is a response, the others are revisits of it, which keep the HTTP header alone and
name the response's identifier; a reader finds the response's page and payload size by that identifier.

A record is a gzip member of its own. A task joins members to archives of about `ARCHIVE_BYTES`, and an
archive is one row for Spark's text writer, cast from binary, so bytes of any encoding come through;
the writer's line end is a zero byte, which gzip takes as padding. So archives can lie in any store
Spark reaches, and a lost task is written again. Readers unpack one record at a time, by `Unpacked`, which
costs a small member less than `gzip.GzipFile` does; Spark's reader of binary files takes archives of up
to 2 GB packed.

Defined cases: null content is empty; equal empty payloads are revisits like any others unless
`least_bytes` says otherwise; a null page comes after all others; a header line that cannot be parsed,
or a length beyond the file's end, raises with the file's name, or is passed over, line by line up to
the next header line, with `damaged="skip"`; a date that is none becomes the archive's own, a shorter one
starts its month, day or hour; lines between records are skipped; repeated rows are records of their own,
with identifiers of their own. Extra columns are ignored. An empty table gives no records.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from datetime import datetime
from functools import lru_cache
from posixpath import basename
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import staged
from tablewright.session import scratch_path

ARCHIVE_BYTES = 1 << 25
BATCH_BYTES = 1 << 23
#: Packed bytes are taken by so many.
PACKED_BYTES = 1 << 14
#: A line longer than this is no header line.
LINE_BYTES = 1 << 16
#: Keys with more than one in this many of all copies are broadcast, so this many at most.
HOT_KEYS = 4096

#: Fields of a record's header line, by version of the archive; fixed by the format.
FIELDS = {
    1: ("url", "ip", "date", "type", "length"),
    2: ("url", "ip", "date", "type", "code", "checksum", "location", "offset", "file", "length"),
}


def member(record: bytes) -> bytes:
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress(record) + pack.flush()


def only_column(batch: pa.RecordBatch) -> Iterator[bytes]:
    return (value.as_py() for value in batch.column(0))


def write_archives(rows: DataFrame, path: str, first: bytes = b"", end: bytes = b"", archive_bytes: int = ARCHIVE_BYTES,
                   records: Callable[[pa.RecordBatch], Iterator[bytes]] = only_column) -> None:
    """Write the records of all rows, by default the one binary column, as archives of about
    `archive_bytes` packed (or one record), each starting with `first`; `end` follows every record."""
    head = member(first) if first else b""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for record in records(batch):
                packed = member(record + end)
                if parts and size + len(packed) > archive_bytes:
                    yield row(parts)
                    parts, size = [], 0
                parts.append(packed)
                size += len(packed)
        if parts:
            yield row(parts)

    def row(parts: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([b"".join([head, *parts])], pa.binary())], names=["value"])

    (rows.mapInArrow(run, "value binary").select(F.col("value").cast("string")).write
     .option("lineSep", "\0").option("maxRecordsPerFile", 1).text(path))


def write_arc(pages: DataFrame, path: str, version: int = 1, key: str = "page_id", url: str = "url",
              body: str = "html", date: str = "20240101000000", archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write rows as ARC records with an HTTP header. `body` is text, stored as UTF-8, or binary."""
    extra = {1: [], 2: ["200", "-", "-", "0", "archive.arc"]}[version]
    data = F.coalesce(F.col(f"`{body}`").cast("binary"), F.lit(b""))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length(data).cast("string"), F.lit("\r\nX-Page-Id: "),
                    F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")), F.lit("\r\n\r\n"))
    # a header line is split at blanks, so none may stand inside a field
    place = F.regexp_replace(F.coalesce(F.nullif(F.col(f"`{url}`"), F.lit("")), F.lit("about:blank")), r"\s", "%20")
    line = F.concat_ws(" ", place, F.lit("0.0.0.0"), F.lit(date), F.lit("text/html"), *map(F.lit, extra),
                       (F.octet_length(http) + F.octet_length(data)).cast("string"))
    records = pages.select(F.concat(F.concat(line, F.lit("\n"), http).cast("binary"), data).alias("value"))
    names = {1: "URL IP-address Archive-date Content-type Archive-length",
             2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
    block = f"{version} 0 tablewright\n{names[version]}\n"
    first = " ".join(["filedesc://archive.arc", "0.0.0.0", date, "text/plain", *extra, str(len(block))]) + f"\n{block}\n"
    write_archives(records, path, first.encode(), b"\n", archive_bytes)


class Unpacked(io.RawIOBase):
    """Gzip members unpacked as they are read; zero bytes behind a member are padding. A member's content
    is given before its checksum is known; a wrong one raises at the next read, as with `gzip`."""

    def __init__(self, data: bytes) -> None:
        self.data, self.view = data, memoryview(data)
        self.at, self.told, self.stream, self.check, self.size = 0, 0, None, 0, 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def begin(self) -> bool:
        """Pass over padding and the header of the next member, if there is one."""
        data, at = self.data, self.at
        while at and data[at:at + 1] == b"\0":
            piece = data[at:at + PACKED_BYTES]
            at += len(piece) - len(piece.lstrip(b"\0"))
        if at >= len(data):
            self.at = at
            return False
        if data[at:at + 3] != b"\x1f\x8b\x08"[:len(data) - at]:
            raise OSError("no gzip member")
        flags = data[at + 3] if at + 3 < len(data) else 0
        at += 10
        if flags & 4:
            at += 2 + int.from_bytes(data[at:at + 2], "little")
        for text in (8, 16):
            if flags & text:
                at = data.find(b"\0", at) + 1 or len(data) + 1
        at += flags & 2
        if at > len(data):
            raise EOFError("the last member has no end")
        self.at, self.stream, self.check, self.size = at, zlib.decompressobj(-15), 0, 0
        return True

    def end(self) -> None:
        stated = self.data[self.at:self.at + 8]
        if len(stated) < 8:
            raise EOFError("the last member has no end")
        if stated != struct.pack("<II", self.check, self.size & 0xFFFFFFFF):
            raise OSError("a member differs from its checksum")
        self.at, self.stream = self.at + 8, None

    def readinto(self, room: memoryview) -> int:
        made = b""
        while not made:
            if self.stream is not None and self.stream.eof:
                self.end()
            if self.stream is None and not self.begin():
                return 0
            piece = self.view[self.at:self.at + PACKED_BYTES]
            made = self.stream.decompress(piece, len(room))
            ended = self.stream.eof
            self.at += len(piece) - len(self.stream.unused_data if ended else self.stream.unconsumed_tail)
            if not (made or piece or ended):
                raise EOFError("the last member has no end")
        self.check, self.size = zlib.crc32(made, self.check), self.size + len(made)
        room[:len(made)] = made
        self.told += len(made)
        return len(made)

    def seek(self, place: int, whence: int = io.SEEK_SET) -> int:
        if whence not in (io.SEEK_SET, io.SEEK_CUR):
            raise io.UnsupportedOperation("the end is not known")
        place += self.told * (whence == io.SEEK_CUR)
        if place < self.told:
            self.at, self.told, self.stream = 0, 0, None
        while self.told < place and self.readinto(memoryview(bytearray(min(place - self.told, PACKED_BYTES)))):
            pass
        return self.told


def opened(data: bytes) -> BinaryIO:
    """The archive unpacked as it is read, whether one gzip stream, a member a record, or plain."""
    return io.BufferedReader(Unpacked(data)) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)


def arc_date(date: str, instead: str = "19700101000000") -> str:
    """Date of 14 digits; a shorter one is filled up, what is no date gives `instead`."""
    if re.fullmatch(r"[0-9]{4}([0-9]{2}){0,5}", date):
        whole = int(date + "00000101000000"[len(date):])
        days, seconds = divmod(whole, 1_000_000)
        try:
            datetime(days // 10_000, days // 100 % 100, days % 100, seconds // 10_000, seconds // 100 % 100, seconds % 100)
        except ValueError:
            return instead
        return f"{whole:014}"
    return instead


def arc_records(data: bytes, name: str = "", damaged: str = "raise") -> Iterator[tuple[dict, bytes, int]]:
    """Header fields, content and place of the records of one archive, without its version block."""
    archive, fields, made, lost = opened(data), None, "", False
    try:
        while line := archive.readline(LINE_BYTES):
            if not line.strip():
                continue
            after = archive.tell()
            parts = line.decode("utf-8", "replace").strip().split(" ")
            if fields is None:  # the version block says how the lines of this archive read
                if not parts[0].startswith("filedesc:") or not parts[-1].isdecimal():
                    raise ValueError(f"{name}: no version block")
                version = archive.read(int(parts[-1])).split(b" ", 1)[0]
                if not version.isdigit() or int(version) not in FIELDS:
                    raise ValueError(f"{name}: version {version[:10]!r} is not known")
                fields, made = FIELDS[int(version)], arc_date(parts[2] if len(parts) > 2 else "")
                continue
            head = header_line(parts, fields, lost) if line.endswith(b"\n") else None
            content = archive.read(int(head["length"])) if head else b""
            if head and len(content) == int(head["length"]):
                lost, head["date"] = False, arc_date(head["date"], made)
                yield head, content, after - len(line)
            elif damaged == "skip":
                lost = True
                archive.seek(after)
            elif head:
                raise ValueError(f"{name}: the record at byte {after - len(line)} ends beyond the file")
            else:
                raise ValueError(f"{name}: no header line at byte {after - len(line)}")
    except (EOFError, OSError, zlib.error) as broken:
        if damaged != "skip":
            raise ValueError(f"{name}: cannot be unpacked") from broken


def header_line(parts: list[str], fields: tuple, lost: bool) -> dict | None:
    """The fields of a header line. Where the place was `lost`, a URL's scheme and a date must be there."""
    if len(parts) < len(fields) or not parts[-1].isdecimal():
        return None
    head = dict(zip(fields[1:], parts[1 - len(fields):], strict=True))
    head["url"] = " ".join(parts[:len(parts) - len(fields) + 1])  # stray blanks belong to the URL
    if lost and not (re.match(r"[A-Za-z][\w+.-]*:", head["url"]) and arc_date(head["date"], "")):
        return None
    return head


def http_parts(content: bytes) -> tuple[bytes, bytes]:
    """HTTP header (with its empty line) and payload; no header where there is none."""
    if not content.startswith(b"HTTP/"):
        return b"", content
    end = re.search(rb"\r?\n\r?\n", content)
    return (content[:end.end()], content[end.end():]) if end else (content, b"")


def sha1_text(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


@lru_cache
def header_pattern(name: bytes) -> re.Pattern:
    return re.compile(rb"(?im)^" + re.escape(name) + rb":[ \t]*(.*?)\r?$")


def header_value(header: bytes, name: bytes) -> str | None:
    found = header_pattern(name).search(header)
    return found[1].decode("utf-8", "replace") if found else None


def header_values(header: bytes) -> dict[bytes, str]:
    """What `header_value` gives for each name, in lower case, from one walk over the header."""
    made: dict[bytes, str] = {}
    for line in header.split(b"\n"):
        name, colon, value = line.partition(b":")
        if colon:
            made.setdefault(name.lower(), value.lstrip(b" \t").removesuffix(b"\r").decode("utf-8", "replace"))
    return made


def batched(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of bounded bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 256 + sum(len(v) for v in row.values() if isinstance(v, (bytes, str)))
        if size > BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    yield pa.RecordBatch.from_pylist(held, schema)


def archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    for batch in batches:
        for name, content in zip(batch.column(0), batch.column(1), strict=True):
            yield name.as_py(), content.as_py()


def page_number(header: bytes) -> int | None:
    page = header_value(header, b"X-Page-Id")
    return int(page) if page and re.fullmatch(r"-?\d{1,18}|-?[1-8]\d{18}", page) else None


def read_arc(spark: SparkSession, path: str, payloads: bool = True, damaged: str = "raise") -> DataFrame:
    """file, at, url, ip, date (14 digits), type, page_id, size, payload_digest, payload_sha256 (hex) and,
    with `payloads`, header and payload."""
    schema = pa.schema([("file", pa.string()), ("at", pa.int64()), ("url", pa.string()), ("ip", pa.string()),
                        ("date", pa.string()), ("type", pa.string()), ("page_id", pa.int64()), ("size", pa.int64()),
                        ("payload_digest", pa.string()), ("payload_sha256", pa.string()),
                        *([("header", pa.binary()), ("payload", pa.binary())] if payloads else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batched((found(name, *record) for name, content in contents(batches)
                        for record in arc_records(content, name, damaged)), schema)

    def found(name: str, head: dict, block: bytes, at: int) -> dict:
        header, payload = http_parts(block)
        row = {"file": name, "at": at, "page_id": page_number(header), "size": len(payload),
               "payload_digest": sha1_text(payload), "payload_sha256": hashlib.sha256(payload).hexdigest(),
               **{field: head[field] for field in ("url", "ip", "date", "type")}}
        return row | {"header": header, "payload": payload} if payloads else row

    return archives(spark, path).mapInArrow(
        run, "file string, at long, url string, ip string, date string, type string, page_id long, size long, "
             "payload_digest string, payload_sha256 string" + (", header binary, payload binary" if payloads else ""))


def look_up(rows: DataFrame, facts: DataFrame, key: str, unlike: Column) -> DataFrame:
    """`rows` with the column `fact` of the table `facts` (one row per `key`, with the number of its
    `copies`), null where there is none. Keys with more than one in `HOT_KEYS` of all copies are
    broadcast, `HOT_KEYS` at most; their rows go on under the value `unlike`, which is no key, and so
    do not meet in one task."""
    total = facts.agg(F.sum("copies")).first()[0] or 0
    often = F.col("copies") * HOT_KEYS > total
    hot = facts.where(often).select(F.col(key).alias("_hot"), F.col("fact").alias("_often"))
    cold = facts.where(~often).select(F.col(key).alias("_cold"), F.col("fact").alias("_seldom"))
    marked = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left").withColumn(
        "_by", F.when(F.col("_hot").isNull(), F.col(key)).otherwise(unlike))
    return (marked.join(cold, F.col("_by") == F.col("_cold"), "left")
            .withColumn("fact", F.coalesce("_often", "_seldom")).drop("_hot", "_often", "_by", "_cold", "_seldom"))


def iso(date: str) -> str:
    return f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"


def record_id(file: str, at: int, url: str, date: str, digest: str) -> str:
    return uuid.uuid5(uuid.NAMESPACE_URL, f"{basename(file)} {at} {url} {date} {digest}").urn


def warc_record(row: dict) -> bytes:
    """One record without the lines behind it. `fact` is the response that the row repeats, if any."""
    header, digest, first = row["header"], row["payload_digest"], row["fact"]
    again = first is not None and (first["file"], first["at"]) != (row["file"], row["at"])
    block = header if again else header + row["payload"]
    lines = ["WARC/1.0", f"WARC-Type: {'revisit' if again else 'response' if header else 'resource'}",
             f"WARC-Record-ID: <{record_id(row['file'], row['at'], row['url'], row['date'], digest)}>",
             f"WARC-Date: {iso(row['date'])}", f"WARC-Target-URI: {row['url']}", f"WARC-IP-Address: {row['ip']}",
             f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{sha1_text(block)}"]
    if again:
        named = record_id(first["file"], first["at"], first["url"], first["date"], digest)
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <{named}>", f"WARC-Refers-To-Target-URI: {first['url']}",
                  f"WARC-Refers-To-Date: {iso(first['date'])}"]
    lines += [f"Content-Type: {'application/http; msgtype=response' if header else row['type']}",
              f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def converted(batch: pa.RecordBatch) -> Iterator[bytes]:
    """The records of the rows of a batch; one content at a time becomes a Python value."""
    header, payload = batch.column("header"), batch.column("payload")
    for at, row in enumerate(batch.drop_columns(["header", "payload"]).to_pylist()):
        yield warc_record(row | {"header": header[at].as_py(), "payload": payload[at].as_py()})


def convert_arc(spark: SparkSession, arc: str, warc: str, least_bytes: int = 0, damaged: str = "raise",
                archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Convert all archives under `arc` to WARC archives under `warc`.

    Which record is the response of its payload is settled on digests alone; payloads are moved
    once, with their own records."""
    first = F.struct(F.col("page_id").isNull().alias("unknown"), "page_id", "file", "at", "url", "date", "size")
    facts = staged(
        read_arc(spark, arc, False, damaged).groupBy("payload_sha256")
        .agg(F.min(first).alias("fact"), F.count("*").alias("copies"))
        .where((F.col("copies") > 1) & (F.col("fact.size") >= least_bytes)), "firsts")
    records = look_up(read_arc(spark, arc, True, damaged), facts, "payload_sha256", F.concat_ws(" ", "file", "at"))

    write_archives(records, warc, end=b"\r\n\r\n", archive_bytes=archive_bytes, records=converted)


def warc_records(data: bytes, name: str = "") -> Iterator[tuple[bytes, bytes]]:
    """Header and block of the records of one archive, by their declared lengths."""
    archive = opened(data)
    while line := archive.readline(LINE_BYTES):
        if line in (b"\r\n", b"\n"):
            continue
        at, lines = archive.tell() - len(line), []
        while line not in (b"\r\n", b"\n", b""):
            lines.append(line)
            line = archive.readline()
        header = b"".join(lines)
        size = header_value(header, b"Content-Length") or ""
        if not header.startswith(b"WARC/") or not size.isdecimal():
            raise ValueError(f"{name}: no record at byte {at}")
        block = archive.read(int(size))
        if len(block) < int(size):
            raise ValueError(f"{name}: the record at byte {at} ends beyond the file")
        yield header, block


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: record_id, record_type, url, page_id, payload_bytes, payload_digest, refers_to (the
    page of the record that a revisit names), refers_to_id, intact (the block, and of a response the payload,
    have the digests its header states). A revisit has the payload size of the record it names; where that
    is not among the archives, page and size are null."""
    schema = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()), ("page_id", pa.int64()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to_id", pa.string()),
                        ("intact", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batched((found(*record) for name, content in contents(batches)
                        for record in warc_records(content, name)), schema)

    def found(header: bytes, block: bytes) -> dict:
        (http, payload), said = http_parts(block), header_values(header)
        kind, named, own = said.get(b"warc-type"), said.get(b"warc-refers-to"), sha1_text(payload)
        stated = said.get(b"warc-payload-digest", "").removeprefix("sha1:")
        fine = said.get(b"warc-block-digest", "").removeprefix("sha1:") in ("", sha1_text(block))
        if kind != "revisit":
            fine = fine and stated in ("", own)
        return {"record_id": said[b"warc-record-id"].strip("<>"), "record_type": kind,
                "url": said.get(b"warc-target-uri"), "page_id": page_number(http),
                "payload_bytes": None if kind == "revisit" else len(payload),
                "payload_digest": stated or own,
                "refers_to_id": named.strip("<>") if named else None, "intact": fine}

    rows = staged(archives(spark, path).mapInArrow(
        run, "record_id string, record_type string, url string, page_id long, payload_bytes long, "
             "payload_digest string, refers_to_id string, intact boolean"), "warc_rows")
    again = F.col("record_type") == "revisit"
    wanted = rows.where(again).groupBy("refers_to_id").agg(F.count("*").alias("copies"))
    named = (rows.where(~again).groupBy(F.col("record_id").alias("refers_to_id"))
             .agg(F.min(F.struct("page_id", "payload_bytes")).alias("fact")))
    found_rows = look_up(rows.where(again), staged(wanted.join(named, "refers_to_id"), "named"), "refers_to_id",
                         F.col("record_id"))
    whole = found_rows.withColumn("payload_bytes", F.col("fact.payload_bytes")).withColumn("refers_to", F.col("fact.page_id"))
    return whole.drop("fact").unionByName(rows.where(~again).withColumn("refers_to", F.lit(None).cast("long")))


def op2_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through ARC archives of both versions into WARC archives and back."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    odd = F.pmod(F.xxhash64("page_id"), F.lit(2)) == 1
    write_arc(pages.where(odd), f"{arc}/v=1", 1)
    write_arc(pages.where(~odd | odd.isNull()), f"{arc}/v=2", 2)
    convert_arc(spark, f"{arc}/v=*", warc)
    return read_warc(spark, warc).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# SHA-1 has no base-32 form in the checking engine, so five bits at a time are looked up.
OP2_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
     b AS (SELECT page_id, t, list_transform(range(8), lambda i:
               CAST('0x' || substr(h, CAST(i * 5 + 1 AS INTEGER), 5) AS BIGINT)) AS w FROM p),
     d AS (SELECT page_id, t, array_to_string(list_transform(range(32), lambda k:
               substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                      CAST(((w[CAST(k // 4 + 1 AS INTEGER)] >> CAST(15 - 5 * (k % 4) AS INTEGER)) & 31) + 1 AS INTEGER), 1)), '')
               AS payload_digest FROM b)
SELECT page_id, CAST(octet_length(encode(t)) AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = min(page_id) OVER (PARTITION BY t) THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = min(page_id) OVER (PARTITION BY t) THEN NULL ELSE min(page_id) OVER (PARTITION BY t) END AS refers_to
FROM d
"""
