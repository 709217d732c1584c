"""Web archives (WARC 1.1, a gzip member for each record) written by tasks and read back by byte ranges.

A file is read in ranges of bytes, each in a task of its own, without an index. A task looks for the magic bytes of a
gzip member in its range. They may also stand within compressed data, so a candidate counts only if it decodes to the
header of a record, to its own end with the right checksum, and if the file ends there or the next member begins. From
the first record on the others follow by themselves. A task owns the records that begin in its range, and reads the
last one beyond it. So each record is read once, however the ranges are cut.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.tables import shared_folder, written

#: Payloads shorter than this are stored each time; a record that points to another would be as long.
LEAST_BYTES = 100
#: Bytes of a file that a task reads, and of a file before the next one is begun.
RANGE_BYTES, FILE_BYTES = 32 << 20, 1 << 30
#: Longest header of a record or of its HTTP message, bytes read at once, and bytes unpacked at once.
HEADER_BYTES, BLOCK, PIECE = 1 << 20, 1 << 20, 1 << 16
#: Compression of members, 0 to 9.
LEVEL = 6

# Fixed values of the format.
MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "<urn:page:{}>"
_PAGE = r"^<urn:page:(-?[0-9]+)>$"


# Records --------------------------------------------------------------------------------------------------------


def _member(fields: list[tuple[str, bytes]], body: bytes) -> bytes:
    """A record as a gzip member of its own."""
    head = b"".join(name.encode() + b": " + value + b"\r\n" for name, value in (*fields, ("Content-Length", b"%d" % len(body))))
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return pack.compress(b"WARC/1.1\r\n" + head + b"\r\n" + body + b"\r\n\r\n") + pack.flush()


def _field(value: str) -> bytes:
    """A value on one line: spaces and control characters as in addresses, %20 and the like."""
    return re.sub(rb"[\x00-\x20\x7f]", lambda x: b"%%%02X" % x[0][0], value.encode())


def page_record(page_id, url: str | None, payload: bytes | None, size: int, digest: str, date: str, first_id=None, first_url: str | None = None) -> bytes:
    """A page as a response, or without a payload as a revisit of page ``first_id``; ``size`` and ``digest`` are of the
    full payload either way."""
    named = "" if page_id is None else page_id
    fields = [("WARC-Type", b"revisit" if payload is None else b"response"), ("WARC-Record-ID", _ID.format(named).encode()), ("WARC-Date", date.encode())]
    if url is not None:
        fields.append(("WARC-Target-URI", _field(url)))
    fields.append(("WARC-Payload-Digest", b"sha256:" + digest.encode()))
    if payload is None:
        fields += [("WARC-Profile", PROFILE.encode()), ("WARC-Refers-To", _ID.format(first_id).encode())]
        if first_url is not None:
            fields.append(("WARC-Refers-To-Target-URI", _field(first_url)))
    fields.append(("Content-Type", b"application/http; msgtype=response"))
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    return _member(fields, http + (payload or b""))


def info_record(name: str, date: str) -> bytes:
    fields = [("WARC-Type", b"warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>".encode()), ("WARC-Date", date.encode())]
    fields += [("WARC-Filename", _field(name)), ("Content-Type", b"application/warc-fields")]
    return _member(fields, b"format: WARC File Format 1.1\r\n")


class NotARecord(ValueError):
    """What begins here is no record, or one that is damaged."""


class Window:
    """Bytes of a file by place; a block of it is held."""

    def __init__(self, source):
        self.source, self.first, self.block = source, 0, b""

    def at(self, place: int, count: int) -> bytes:
        begin = place - self.first
        if not 0 <= begin < len(self.block) or begin + count > len(self.block) and len(self.block) == BLOCK:
            self.first, self.block, begin = place, self.source.read_at(BLOCK, place), 0
        return self.block[begin : begin + count]


class Member:
    """The gzip member at a place of a file, unpacked in pieces."""

    def __init__(self, window: Window, place: int):
        self.window, self.place, self.data, self.held = window, place, b"", b""
        self.expand = zlib.decompressobj(31)

    def _piece(self) -> bytes:
        """The next bytes; none at the end of the member."""
        while not self.expand.eof:
            if not self.data:
                self.data = self.window.at(self.place, PIECE // 4)
                self.place += len(self.data)
                if not self.data:
                    raise NotARecord("the member is cut short")
            try:
                piece = self.expand.decompress(self.data, PIECE)
            except zlib.error as error:
                raise NotARecord(str(error)) from error
            self.data = self.expand.unconsumed_tail
            if piece:
                return piece
        return b""

    def header(self) -> list[bytes]:
        """The lines up to an empty one."""
        while (end := self.held.find(b"\r\n\r\n")) < 0:
            piece = self._piece()
            if not piece or len(self.held) > HEADER_BYTES:
                raise NotARecord("no end of the header")
            self.held += piece
        lines, self.held = self.held[:end].split(b"\r\n"), self.held[end + 4 :]
        return lines

    def parts(self, count: int) -> Iterator[bytes]:
        """The next ``count`` bytes."""
        while count:
            part = self.held or self._piece()
            if not part:
                raise NotARecord("the record is longer than its member")
            part, self.held = part[:count], part[count:]
            count -= len(part)
            yield part

    def end(self) -> int:
        """Read on to the end, where the checksum is looked at: the place after the member."""
        while self.held or not self.expand.eof:
            self.held = self._piece()
        return self.place - len(self.expand.unused_data)


def _fields(lines: list[bytes]) -> dict[str, str]:
    out, last = {}, None
    for line in lines:
        if line[:1] in (b" ", b"\t") and last:  # a value that goes on
            out[last] += " " + line.strip().decode(errors="replace")
            continue
        name, _, value = line.partition(b":")
        last = name.strip().lower().decode(errors="replace")
        out[last] = value.strip().decode(errors="replace")
    return out


def _length(fields: dict[str, str]) -> int:
    text = fields.get("content-length", "")
    if not text.isascii() or not text.isdigit():
        raise NotARecord("no content length")
    return int(text)


def record_at(window: Window, place: int, payloads: bool) -> tuple[dict, int]:
    """The record whose member begins at ``place``, and where the next one begins.

    The payload is what the HTTP message carries, or the whole block where there is none. Its length and digest are
    worked out from what is read; those of a revisit are what its header says.
    """
    member = Member(window, place)
    first, *rest = member.header()
    if not first.startswith(b"WARC/"):
        raise NotARecord("no WARC version")
    fields = _fields(rest)
    left = _length(fields)
    http = None
    if fields.get("content-type", "").startswith("application/http") and left:
        message = b""
        for part in member.parts(left):
            message += part
            if (end := message.find(b"\r\n\r\n")) >= 0:
                member.held = message[end + 4 :] + member.held
                break
            if len(message) > HEADER_BYTES:
                raise NotARecord("no end of the HTTP header")
        else:
            raise NotARecord("no end of the HTTP header")
        http, left = _fields(message[:end].split(b"\r\n")[1:]), left - end - 4
    size, digest, kept = left, hashlib.sha256(), []
    for part in member.parts(left):
        digest.update(part)
        if payloads:
            kept.append(part)
    kind, stated = fields.get("warc-type"), fields.get("warc-payload-digest", "").removeprefix("sha256:")
    found = digest.hexdigest()
    if kind == "revisit":
        size, found = _length(http or {}), stated
    elif kind == "response" and re.fullmatch("[0-9a-f]{64}", stated) and stated != found:
        raise NotARecord("the payload isn't what its digest says")
    record = {
        "at": place, "record_type": kind, "record_id": fields.get("warc-record-id"), "url": fields.get("warc-target-uri"),
        "date": fields.get("warc-date"), "payload_bytes": size, "payload_digest": found, "refers_to": fields.get("warc-refers-to"),
        "payload": b"".join(kept) if payloads and kind != "revisit" else None,
    }
    return record, member.end()


def _next_magic(window: Window, place: int, end: int) -> int:
    """The first place from ``place`` on, and before ``end``, that a member may begin at; else ``end``."""
    while place < end:
        data = window.at(place, BLOCK // 2)
        if (k := data.find(MAGIC)) >= 0:
            return min(place + k, end)
        if len(data) < len(MAGIC):
            return end
        place += len(data) - len(MAGIC) + 1  # they may stand across two blocks
    return end


def records(source, begin: int, end: int, payloads: bool = False) -> Iterator[dict]:
    """Records of a file whose members begin from ``begin`` on and before ``end``.

    A damaged record raises, except in the bytes before the first record of a range, where nothing tells it from
    compressed data.
    """
    window = Window(source)
    place = begin
    if begin:
        while (place := _next_magic(window, place, end)) < end:
            try:
                _, after = record_at(window, place, False)
                if window.at(after, len(MAGIC)) in (b"", MAGIC):
                    break
            except NotARecord:
                pass
            place += 1
    while place < end and window.at(place, 1):
        record, place = record_at(window, place, payloads)
        yield record


# Tables ---------------------------------------------------------------------------------------------------------


def marked(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """``pages`` (page_id, url, html) as page_id, url, payload (null for revisits), payload_bytes, payload_digest,
    first_id and first_url (of the response that a revisit refers to, else null).

    Of equal payloads of ``least`` bytes or more the smallest page_id is the response, in each row that has it; rows
    without page_id revisit it too, and are responses where no row has one. The firsts are found by sums on the map
    side; only those of payloads that occur again are joined back, in a join whose hot keys Spark splits.
    """
    html = F.coalesce(pages["html"], F.lit(""))
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].alias("url"), html.cast("binary").alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"))
    again = (
        rows.filter(F.col("payload_bytes") >= least)
        .groupBy(F.col("payload_digest").alias("its_digest"))
        .agg(F.min("page_id").alias("first_id"), F.min_by("url", "page_id").alias("first_url"), F.count("*").alias("n"))
        .filter((F.col("n") > 1) & F.col("first_id").isNotNull())
        .drop("n")
    )
    joined = rows.join(again, (F.col("payload_digest") == F.col("its_digest")) & (F.col("payload_bytes") >= least), "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        "page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "payload_bytes", "payload_digest",
        F.when(revisit, F.col("first_id")).alias("first_id"), F.when(revisit, F.col("first_url")).alias("first_url"),
    )


def write_warc(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", least: int = LEAST_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record for each row of ``pages`` (page_id, url, html) to archives below ``folder``; a null html is empty.
    Returns the files: path, n_records, n_bytes.

    ``folder`` is a URI that executors reach. A task writes files of new names and tells them when done, so files of
    tasks that were lost or run twice are in no listing. ``date`` is when the pages were fetched.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, top = pyarrow.fs.FileSystem.from_uri(folder)
        stream, name, count, size = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            stream.close()
            return pa.RecordBatch.from_pylist([{"path": f"{folder}/{name}", "n_records": count, "n_bytes": size}], schema=schema)

        for batch in batches:
            for row in zip(*(batch.column(k) for k in range(7))):
                page_id, url, payload, length, digest, first_id, first_url = (x.as_py() for x in row)
                if stream is None:
                    files.create_dir(top, recursive=True)
                    name, count = f"{uuid.uuid4().hex}.warc.gz", 0
                    stream = files.open_output_stream(f"{top}/{name}", compression=None)
                    head = info_record(name, date)
                    stream.write(head)
                    size = len(head)
                record = page_record(page_id, url, payload, length, digest, date, first_id, first_url)
                stream.write(record)
                count, size = count + 1, size + len(record)
                if size >= file_bytes:
                    yield closed()
                    stream = None
        if stream is not None:
            yield closed()

    schema = pa.schema([("path", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())])
    return written(marked(pages, least).mapInArrow(write, "path string, n_records long, n_bytes long"))


def read_warc(files: DataFrame, range_bytes: int = RANGE_BYTES, payloads: bool = False) -> DataFrame:
    """Read archives (path, n_bytes) by ranges of ``range_bytes``, each in a task: path, at, record_type, record_id,
    url, date, payload_bytes, payload_digest, refers_to, and payload (null without ``payloads``, and of revisits)."""
    ranges = files.select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("n_bytes") - 1, F.lit(0)), F.lit(range_bytes).cast("long"))).alias("begin"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, begin in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, name = pyarrow.fs.FileSystem.from_uri(path)
                with system.open_input_file(name) as source:
                    rows, held = [], 0
                    for record in records(source, begin, begin + range_bytes, payloads):
                        rows.append(record | {"path": path})
                        held += len(record["payload"] or b"")
                        if len(rows) >= 4096 or held >= BLOCK:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    texts = [(x, pa.string()) for x in ("record_type", "record_id", "url", "date")]
    schema = pa.schema([("path", pa.string()), ("at", pa.int64()), *texts, ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string()), ("payload", pa.binary())])
    out = "path string, at long, record_type string, record_id string, url string, date string, payload_bytes long, payload_digest string, refers_to string, payload binary"
    return ranges.repartition(max(1, ranges.count())).mapInArrow(read, out)


def page_of(record_id: Column) -> Column:
    """The page_id in a record's id, or null."""
    found = F.regexp_extract(record_id, _PAGE, 1)
    return F.when(found != "", found).cast("long")


def round_trip(pages: DataFrame, folder: str | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to archives and read them back: page_id, payload_bytes, payload_digest,
    record_type, refers_to (a page_id, or null). A row for each input row; other columns are left out."""
    found = read_warc(write_warc(pages, folder or shared_folder(pages.sparkSession)), range_bytes)
    return found.filter(F.col("record_type").isin("response", "revisit")).select(
        page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_of(F.col("refers_to")).alias("refers_to")
    )


SQL = f"""
WITH stored AS (
  SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS n FROM pages),
firsts AS (
  SELECT payload, min(page_id) AS first_id FROM stored WHERE n >= {LEAST_BYTES} GROUP BY payload)
SELECT page_id, n::BIGINT AS payload_bytes, sha256(payload) AS payload_digest,
       CASE WHEN first_id IS NULL OR first_id IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id IS DISTINCT FROM page_id THEN first_id END::BIGINT AS refers_to
FROM stored LEFT JOIN firsts USING (payload)
"""
