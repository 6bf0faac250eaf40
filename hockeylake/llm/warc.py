"""WARC archives: writing with revisit records, and a reader that salvages damaged files."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hockeylake.llm.common import new_path, stash

_GZIP, _VERSION = b"\x1f\x8b\x08", b"WARC/1."
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = (
    "path string, offset long, length long, record_type string, uri string, page_id long, refers_to long, payload_digest string, payload_bytes long, payload binary"
)


def record_bytes(page_id: int | None, uri: str, payload: bytes, digest: str, size: int, refers_to: int | None) -> bytes:
    """A response record, or without its payload a revisit of another page's response."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (b"" if revisit else payload)
    name = "null" if page_id is None else page_id
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {''.join(c for c in uri if c > ' ')}",
        *([f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"] if revisit else []),
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def _member(record: bytes, level: int) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(record) + c.flush()


def _write(batches: Iterator[pa.RecordBatch], folder: str, most: int, level: int) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
    held: list[bytes] = []
    size = rows = 0

    def flush() -> pa.RecordBatch:
        # A name of its own for each attempt: what a lost task left behind is never listed.
        name = f"{uuid.uuid4().hex}.warc{'.gz' if level else ''}"
        with system.open_output_stream(f"{root}/{name}", compression=None) as out:
            for x in held:
                out.write(x)
        return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([size], pa.int64()), pa.array([rows], pa.int64())], names=["path", "bytes", "records"])

    for batch in batches:
        c = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        for i in range(batch.num_rows):
            page, uri, html, digest, n, to = (c[k][i].as_py() for k in ("page_id", "url", "html", "payload_digest", "payload_bytes", "refers_to"))
            record = record_bytes(page, uri or "", (html or "").encode(), digest, n, to)
            record = _member(record, level) if level else record
            if held and size + len(record) > most:
                yield flush()
                held, size, rows = [], 0, 0
            held.append(record)
            size, rows = size + len(record), rows + 1
    if held:
        yield flush()


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 100) -> DataFrame:
    """``(page_id, url, html, payload_digest, payload_bytes, refers_to)``.

    Of pages with equal payloads of at least ``least`` bytes all but the smallest id refer to it; html is null for them.
    Rows that repeat the smallest id itself, and rows with null id where none of the group has one, are responses.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("payload_bytes", F.octet_length("html").cast("long")).withColumn("payload_digest", F.sha2("html", 256))
    groups = stash(
        rows.filter(F.col("payload_bytes") >= least).groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"),
        "payloads",
    )
    refers = F.when(F.coalesce(F.col("page_id") != F.col("first"), F.col("first").isNotNull()), F.col("first"))
    return rows.join(groups, "payload_digest", "left").withColumn("refers_to", refers).withColumn("html", F.when(F.col("refers_to").isNull(), F.col("html"))).drop("first")


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 100, file_bytes: int = 16 << 20, level: int = 3) -> DataFrame:
    """Write a record for each page to WARC files under ``folder`` and return their list ``(path, bytes, records)``.

    The folder is one that all executors see (a URI that pyarrow opens, or a shared path). A task
    writes files of about ``file_bytes``, each record a gzip member of its own (level 0: plain), and
    holds one file in memory. The list names the files of tasks that ended well and no others.

    Null html is an empty payload, a null url an empty one, an empty table gives an empty list.
    Repeated rows are written each. Other columns are not read.
    """
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
    system.create_dir(root, recursive=True)
    return stash(
        with_revisits(pages, id_col, url_col, html_col, least).mapInArrow(lambda it: _write(it, folder, file_bytes, level), "path string, bytes long, records long"),
        "archives",
    )


def _headers(raw: bytes) -> dict[str, str]:
    out = {}
    for line in raw.decode("utf-8", "replace").split("\r\n")[1:]:
        key, colon, value = line.partition(":")
        if colon:
            out[key.strip().lower()] = value.strip()
    return out


#: A record's headers end within so many bytes, else the record is damaged. Bytes that are read, or scanned, at once.
HEADER_BYTES, _SLICE = 1 << 20, 1 << 16


def _whole(text: str | None) -> int | None:
    """A number of up to 18 digits, as 64 bits hold; anything else is none."""
    return int(text) if text and re.fullmatch(r"-?[0-9]{1,18}", text) else None


class _Plain:
    """Bytes of a file from an offset on."""

    def __init__(self, file, at: int, size: int):
        self.file, self.at, self.size = file, at, size

    def get(self, off: int, n: int) -> bytes:
        n = min(n, self.size - self.at - off)
        return self.file.read_at(n, self.at + off) if n > 0 else b""

    peek = get


class _Member:
    """What a gzip member at an offset unpacks to, slice by slice; ``end`` is where it ends well, ``fault`` why it does not."""

    def __init__(self, file, at: int, size: int):
        self.file, self.pos, self.size = file, at, size
        self.d, self.buffer, self.tail, self.end, self.fault = zlib.decompressobj(31), bytearray(), b"", None, ""

    def get(self, off: int, n: int) -> bytes:
        while len(self.buffer) < off + n and self.end is None and not self.fault:
            data = self.tail or self.file.read_at(min(_SLICE, self.size - self.pos), self.pos)
            if not data:
                self.fault = "member does not end"
                break
            if not self.tail:
                self.pos += len(data)
            try:
                self.buffer += self.d.decompress(data, 16 * _SLICE)
            except zlib.error as e:
                self.fault = str(e)[:60]
            self.tail = self.d.unconsumed_tail
            if self.d.eof:
                self.end = self.pos - len(self.d.unused_data)
        return bytes(self.buffer[off : off + n])

    def peek(self, off: int, n: int) -> bytes:
        """``get`` without keeping what is far ahead: a length is checked before its bytes are held."""
        if off <= len(self.buffer) + 16 * _SLICE:
            return self.get(off, n)
        d, pos, tail, at, held = self.d.copy(), self.pos, self.tail, len(self.buffer), b""
        while at - len(held) <= off + n:
            if at >= off + n or d.eof:
                break
            data = tail or self.file.read_at(min(_SLICE, self.size - pos), pos)
            if not data:
                break
            pos += 0 if tail else len(data)
            try:
                found = d.decompress(data, 16 * _SLICE)
            except zlib.error:
                break
            tail = d.unconsumed_tail
            at += len(found)
            held = (held + found)[-(at - off) :] if at > off else b""
        return held[:n]

    def drop(self, n: int) -> None:
        del self.buffer[:n]


def _digest_fits(said: str, data: bytes) -> bool:
    """Whether a digest header is that of the bytes; one of a kind that is not known, or none, fits."""
    kind, _, want = said.partition(":")
    if kind.lower() == "sha1":
        return want.upper() == base64.b32encode(hashlib.sha1(data).digest()).decode() or want.lower() == hashlib.sha1(data).hexdigest()
    return kind.lower() != "sha256" or want.lower() == hashlib.sha256(data).hexdigest()


def parse_record(source) -> tuple[dict | None, int, str]:
    """``(record, its length, "")`` of the record that ``source`` begins with, or ``(None, 0, what failed)``."""
    if source.get(0, len(_VERSION)) != _VERSION:
        return None, 0, "no version line"
    head, want = b"", 2048
    while (stop := head.find(b"\r\n\r\n")) < 0 and want <= HEADER_BYTES and (len(head) == want // 2 or not head):
        head, want = source.get(0, want), 2 * want
    if stop < 0:
        return None, 0, "headers do not end"
    head, start = _headers(head[:stop]), stop + 4
    n = _whole(head.get("content-length"))
    if n is None:
        return None, 0, "no content length"
    if n < 0 or source.peek(start + n, 4) != b"\r\n\r\n":
        return None, 0, "content length is wrong"
    block = source.get(start, n)
    if not _digest_fits(head.get("warc-block-digest", ""), block):
        return None, 0, "block digest differs"
    http, _, payload = block.partition(b"\r\n\r\n")
    whole = head.get("warc-type") != "revisit"
    digest = head.get("warc-payload-digest", "")
    if whole and not _digest_fits(digest, payload):
        return None, 0, "payload digest differs"
    size = len(payload) if whole else _whole(_headers(b"\r\n" + http).get("content-length", "0"))
    if size is None or size < 0:
        return None, 0, "no payload length"
    digest = digest.partition(":")[2]
    page = lambda k: _whole(head.get(k, "").removeprefix("<urn:page:").removesuffix(">"))
    return {"record_type": head.get("warc-type"), "uri": head.get("warc-target-uri"), "page_id": page("warc-record-id"), "refers_to": page("warc-refers-to"), "payload_digest": hashlib.sha256(payload).hexdigest() if whole else digest, "payload_bytes": size, "payload": payload if whole else None}, start + n + 4, ""


def _next_of(source, at: int, marks: tuple[bytes, ...]) -> int:
    """The offset of the first of ``marks`` at or after ``at``, or -1."""
    while data := source.get(at, _SLICE + 16):
        found = [x for x in (data.find(m) for m in marks) if x >= 0]
        if found:
            return at + min(found)
        if len(data) <= _SLICE:
            return -1
        at += _SLICE
    return -1


def _unpacked(member: _Member) -> Iterator[dict | str]:
    """Records of a member, and what failed where a version line had to be searched for."""
    while True:
        record, n, fault = parse_record(member)
        if record:
            yield record
            member.drop(n)
        elif not member.get(0, 1):
            return
        else:
            yield fault
            member.drop(1)
            while (at := (data := member.get(0, _SLICE + 16)).find(_VERSION)) < 0:
                if len(data) <= _SLICE:
                    return
                member.drop(_SLICE)  # what was searched is not held
            member.drop(at)


def salvage(data) -> Iterator[tuple[int, int, dict | None, str]]:
    """``(offset, length, record, "")`` for every record of an archive and ``(offset, length, None, reason)`` for every byte gap.

    ``data`` is bytes or a file with ``read_at`` and ``size``. Plain records and gzip members may mix, and a member may hold many records. After a check fails
    (member CRC, lengths, digests) the reader looks for the next member or version line that yields a record that passes, and reports
    the bytes between as one gap. Every byte belongs to a record or to a gap. Of several records in a
    member all have its offset, and the last its length. Those that a damaged member holds and that
    pass are given with length 0, and its bytes are a gap. One record is held at a time.
    """
    file = pa.BufferReader(data) if isinstance(data, bytes) else data
    size = file.size()
    at, gap, why = 0, -1, ""
    while at < size:
        begins, end, fault, held = file.read_at(min(8, size - at), at), at, "no member or version line", []

        def flushed(length: int, at: int = at, held: list = held) -> Iterator[tuple[int, int, dict | None, str]]:
            nonlocal gap
            if held and gap >= 0:
                if at > gap:
                    yield gap, at - gap, None, why
                gap = -1
            while held:
                yield at, length, held.pop(), ""

        if begins.startswith(_GZIP):
            member, fault = _Member(file, at, size), ""
            for x in _unpacked(member):
                if isinstance(x, str):
                    fault = fault or x
                else:
                    yield from flushed(0)
                    held.append(x)
            fault = fault or member.fault or ("" if held else "no record in the member")
            if not fault:
                end = member.end
                yield from flushed(end - at)
            else:
                yield from flushed(0)
        elif begins.startswith(_VERSION):
            record, n, fault = parse_record(_Plain(file, at, size))
            if record:
                held.append(record)
                end = at + n
                yield from flushed(n)
        if end > at:
            at = end
        else:
            if gap < 0:
                gap, why = at, fault
            step = _next_of(_Plain(file, at + 1, size), 0, (_GZIP, _VERSION))
            at = size if step < 0 else at + 1 + step
    if gap >= 0:
        yield gap, size - gap, None, why


def _read(batches: Iterator[pa.RecordBatch], keep_payload: bool) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    names = [x.split()[0] for x in RECORDS.split(", ")]
    schema = pa.schema(list(zip([*names, "gap"], [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.string()], strict=True)))
    for batch in batches:
        for path in batch.column(0).to_pylist():
            system, at = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
            rows, size = [], 0
            with system.open_input_file(at) as file:
                for offset, length, record, why in salvage(file):
                    row = {"path": path, "offset": offset, "length": length, "gap": why or None} | (record or {})
                    if not keep_payload:
                        row["payload"] = None
                    rows.append(row)
                    size += len(row.get("payload") or b"") + 200
                    if size > 8_000_000:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)


def read_warc(spark: SparkSession, archives: DataFrame, keep_payload: bool = True) -> DataFrame:
    """The records and byte gaps of the archives whose paths are in ``archives.path``.

    Columns: path, offset, length, record_type, uri, page_id, refers_to, payload_digest, payload_bytes,
    payload (null for revisits) and gap: null for records, and for a quarantined byte range the
    reason. A task reads its archives in slices and holds one record, and rows of about 8 MB. Null
    paths are skipped; a path that is listed twice is read twice; an empty list gives an empty result.
    """
    paths = archives.select("path").filter("path is not null")
    return paths.repartition(max(1, min(paths.count(), 10_000))).mapInArrow(lambda it: _read(it, keep_payload), f"{RECORDS}, gap string")


def warc_round_trip(pages: DataFrame, **how) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and return what reading them back gives, a row for each page.

    Nulls, ties, repeated rows and empty tables are treated as by ``write_warc`` and ``read_warc``.
    """
    spark = pages.sparkSession
    archives = write_warc(pages, new_path(spark, "warc"), **how)
    return read_warc(spark, archives, keep_payload=False).filter("gap is null").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "path", "offset")
