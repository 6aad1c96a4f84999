"""WARC archives: writer with payload-digest revisits, and a salvage reader.

Writing: one record per page.  Pages of equal payload share a SHA-1; the one
with the smallest id is a ``response``, later ones are ``revisit`` records without payload that
refer to it.  A task writes its pages to files of about ``ARCHIVE_BYTES`` under names of its
own attempt; the manifest is a Parquet table that Spark commits, so
files of lost attempts are never read.  In ``.gz`` files each record is a gzip member.

Reading: a record must pass its checks -- member CRC and length, version line,
headers (folded lines are joined), block length, closing line breaks, payload digest.  After a failed check the
reader searches for the next gzip member that opens with a version line (plain
files: the next version line), resumes there, and logs the bytes between as a quarantined
gap with the reason.  Memory holds one record, not one file.  No size makes a record damaged: headers end
where their empty line stands, and a member is unpacked as far as its own Content-Length goes.

Rows: null and empty payloads have 0 bytes and are equal payloads; a null url is
left out of the record; a null page id is written as missing, and record ids that are no 64-bit page
ids read as null; equal page ids that are smallest are all responses; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arlark.llm.common import SharedFiles, shared_uri, staged

#: A new file is begun when one has this many bytes.
ARCHIVE_BYTES = 64 << 20
STEP = 1 << 16

VERSION = b"WARC/1."
#: Lengths and page ids as they may stand in headers; a page id has 64 bits.
LENGTH, PAGE = re.compile("[0-9]{1,18}"), re.compile("-?[0-9]{1,19}")
MEMBER = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ROW = pa.schema([
    ("kind", pa.string()), ("file", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("reason", pa.string()),
    ("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
ROW_DDL = ("kind string, file string, start long, stop long, reason string, record_type string, page_id long, url string, "
           "payload_bytes long, payload_digest string, refers_to long, payload binary")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
                date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One record as bytes; ``refers_to`` makes it a revisit (HTTP head only)."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(f"%{b:02X}" if b < 0x21 or b == 0x7F else chr(b) for b in url.encode())
                    .encode("latin-1").decode())
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:x-page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class Damaged(Exception):
    """A failed check; the message is the gap's reason."""


class SalvageReader:
    """Iterates ("record", start, stop, fields) and ("gap", start, stop, reason) over one archive."""

    def __init__(self, source, size: int | None = None):
        self.source = source
        if size is None:
            source.seek(0, 2)
            size = source.tell()
        self.size = size
        self.gzipped = not self._at(0, len(VERSION)) == VERSION and self._members_first()

    def _at(self, offset: int, length: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(max(0, min(length, self.size - offset)))

    def _members_first(self) -> bool:
        """Whether a member that opens with a version line comes before any plain version line."""
        member = self._next_member(0)
        if member in (0, None):
            return member == 0
        line = self._find(b"\n" + VERSION, 0)
        return line is None or member < line

    def _find(self, mark: bytes, start: int) -> int | None:
        while start < self.size:
            part = self._at(start, STEP + len(mark) - 1)
            k = part.find(mark)
            if k >= 0:
                return start + k
            start += STEP
        return None

    def _member(self, start: int, enough: int | None = None) -> tuple[bytes, int]:
        """Decompressed bytes and end of the member at ``start`` (its first ``enough`` bytes only, if given)."""
        unpack, out, at, most = zlib.decompressobj(31), bytearray(), start, None
        try:
            while not unpack.eof:
                part = unpack.unconsumed_tail or self._at(at, STEP)
                if not part:
                    raise Damaged("member cut short")
                if part is not unpack.unconsumed_tail and not unpack.unconsumed_tail:
                    at += len(part)
                seen = max(0, len(out) - 3)
                out += unpack.decompress(part, STEP)
                if enough is not None and len(out) >= enough:
                    break
                if most is None and not unpack.eof and (border := out.find(b"\r\n\r\n", seen)) >= 0:
                    most = border + 8 + int(self._headers(bytes(out[:border]))["content-length"])
                if most is not None and len(out) > most:
                    raise Damaged("block length is wrong")
        except zlib.error as e:
            raise Damaged("member fails its checks") from e
        return bytes(out), at - len(unpack.unused_data)

    @staticmethod
    def _headers(head: bytes) -> dict[str, str]:
        lines = head.decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/1."):
            raise Damaged("no version line")
        out, name = {}, None
        for line in lines[1:]:
            if line[:1] in (" ", "\t") and name is not None:
                out[name] = f"{out[name]} {line.strip()}".strip()
                continue
            name, colon, value = line.partition(":")
            if not colon:
                raise Damaged("header without a colon")
            name = name.strip().lower()
            out[name] = value.strip()
        for needed in ("warc-type", "warc-record-id", "content-length"):
            if needed not in out:
                raise Damaged(f"no {needed}")
        if not LENGTH.fullmatch(out["content-length"]):
            raise Damaged("content-length is no number")
        return out

    def _record(self, data: bytes) -> dict:
        """Fields of a whole record, checked."""
        border = data.find(b"\r\n\r\n")
        if border < 0:
            raise Damaged("no end of headers")
        headers = self._headers(data[:border])
        length = int(headers["content-length"])
        block = data[border + 4:border + 4 + length]
        if len(block) != length or data[border + 4 + length:] != b"\r\n\r\n":
            raise Damaged("block length is wrong")
        http, _, payload = block.partition(b"\r\n\r\n")
        digest = headers.get("warc-payload-digest", "").partition(":")[2]
        kind = headers["warc-type"]
        size = next((int(v) for line in http.decode("latin-1").split("\r\n") for n, c, v in [line.partition(":")]
                     if c and n.strip().lower() == "content-length" and LENGTH.fullmatch(v.strip(" \t"))), len(payload))
        if kind == "response":
            if digest and base32_sha1(payload) != digest:
                raise Damaged("payload digest is wrong")
            if size != len(payload):
                raise Damaged("payload length is wrong")
        return {"record_type": kind, "page_id": self._page(headers["warc-record-id"]), "url": headers.get("warc-target-uri"),
                "payload_bytes": size, "payload_digest": digest or base32_sha1(payload),
                "refers_to": self._page(headers.get("warc-refers-to", "")), "payload": payload if kind == "response" else None}

    @staticmethod
    def _page(urn: str) -> int | None:
        """The page id of a record id; None for other ids and beyond 64 bits."""
        name = urn.strip("<>").rpartition(":")[2]
        number = int(name) if PAGE.fullmatch(name) else None
        return number if number is not None and -(1 << 63) <= number < 1 << 63 else None

    def _plain_head(self, start: int) -> bytes:
        """The header lines of the uncompressed record at ``start``, read on until they end or cannot be headers."""
        head, line = bytearray(), 0
        while True:
            part = self._at(start + len(head), STEP)
            if not part:
                raise Damaged("no end of headers")
            seen = max(0, len(head) - 3)
            head += part
            if not head.startswith(VERSION):
                raise Damaged("no version line")
            border = head.find(b"\r\n\r\n", seen)
            if border >= 0:
                return bytes(head[:border])
            last = head.rfind(b"\r\n", seen)
            if last >= line:
                if any(b":" not in h and h[:1] not in (b" ", b"\t") for h in head[line:last].split(b"\r\n")[0 if line else 1:]):
                    raise Damaged("header without a colon")
                line = last + 2

    def _plain(self, start: int) -> tuple[bytes, int]:
        """Bytes and end of the uncompressed record at ``start``."""
        head = self._plain_head(start)
        stop = start + len(head) + 4 + int(self._headers(head)["content-length"]) + 4
        if stop > self.size:
            raise Damaged("record cut short")
        return self._at(start, stop - start), stop

    def _next_member(self, start: int) -> int | None:
        """The next member that opens with a version line."""
        while (found := self._find(MEMBER, start)) is not None:
            try:
                if self._member(found, enough=len(VERSION))[0].startswith(VERSION):
                    return found
            except (Damaged, ValueError):
                pass
            start = found + 1
        return None

    def _next(self, start: int) -> int:
        """Where the next plausible record begins, at or after ``start``; the end of the file if none does."""
        if self.gzipped:
            found = self._next_member(start)
        else:
            # a version line stands at the start of a line
            found = self._find(b"\n" + VERSION, max(0, start - 1))
            found = None if found is None else found + 1
        return self.size if found is None else found

    def __iter__(self):
        at = 0
        while at < self.size:
            try:
                data, stop = self._member(at) if self.gzipped else self._plain(at)
                yield "record", at, stop, self._record(data)
            except (Damaged, ValueError) as e:
                stop = self._next(at + 1)
                yield "gap", at, stop, str(e)
            at = stop


def write_warc(pages: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html", least_revisit_bytes: int = 0, gzipped: bool = True,
               archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write every row as a record under ``path``; returns the manifest (root, file, records).

    Digests are aggregated first (id and digest only), then joined back, so
    payloads are shuffled once and a payload shared by many pages is a skewed join side
    that adaptive execution splits.
    """
    spark = pages.sparkSession
    path = path or shared_uri(spark, "warc")
    SharedFiles(path).make()
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"),
                        F.unhex(F.sha1(payload)).alias("sha1"))
    firsts = rows.groupBy("sha1").agg(F.min("page_id").alias("first_id"))
    marked = rows.join(firsts, "sha1").withColumn("refers_to", F.when(
        (F.col("page_id") > F.col("first_id")) & (F.octet_length("payload") >= least_revisit_bytes), F.col("first_id")))
    marked = marked.select("page_id", "url", "payload", "sha1", "refers_to")
    suffix = ".warc.gz" if gzipped else ".warc"

    def run(batches):
        files, out, name, written, records, done = SharedFiles(path), None, None, 0, 0, []
        for batch in batches:
            for page_id, url, text, sha1, refers_to in zip(*[batch.column(c).to_pylist() for c in range(5)]):
                if out is None:
                    name, written, records = f"{uuid.uuid4().hex}{suffix}", 0, 0
                    out = files.write(name)
                data = make_record(page_id, url, text.encode(), base64.b32encode(sha1).decode(), refers_to)
                data = gzip_member(data) if gzipped else data
                out.write(data)
                written, records = written + len(data), records + 1
                if written >= archive_bytes:
                    out.close()
                    done.append((name, records))
                    out = None
        if out is not None:
            out.close()
            done.append((name, records))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done]), pa.array([d[1] for d in done], pa.int64())],
                                             names=["file", "records"])

    manifest = staged(marked.mapInArrow(run, "file string, records long").repartition(1), "warc-manifest")
    return manifest.withColumn("root", F.lit(path))


def read_warc(files: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records and gaps of the archives (root, file): ``kind`` is 'record' or 'gap' (start, stop, reason)."""
    width = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        for batch in batches:
            for item in batch.to_pylist():
                with SharedFiles(item["root"]).read(item["file"]) as source:
                    rows, held = [], 0
                    for kind, start, stop, found in SalvageReader(source):
                        row = {"kind": kind, "file": item["file"], "start": start, "stop": stop}
                        if kind == "gap":
                            row["reason"] = found
                        else:
                            row |= found
                            if not with_payload:
                                row["payload"] = None
                            held += len(row["payload"] or b"") + len(row["url"] or "")
                        rows.append(row)
                        if len(rows) >= 5000 or held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=ROW)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=ROW)

    return files.select("root", "file").repartition(width, "file").mapInArrow(run, ROW_DDL)


def page_records(read: DataFrame) -> DataFrame:
    return read.where(F.col("kind") == "record").drop("kind", "reason")


def quarantined(read: DataFrame) -> DataFrame:
    """The byte gaps that were skipped: file, start, stop, reason."""
    return read.where(F.col("kind") == "gap").select("file", "start", "stop", "reason")


def oracle_sql() -> str:
    """DuckDB text of the registered query: digests and first ids straight from the pages."""
    return """
WITH hashed AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
firsts AS (SELECT hex, min(page_id) AS first_id FROM hashed GROUP BY hex)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (1 + ((('0x' || substr(hex, 1 + 10 * (i // 8)::INT, 10))::UBIGINT >> (35 - 5 * (i % 8))::UBIGINT) & 31::UBIGINT))::INT, 1)), '')
         AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM hashed JOIN firsts USING (hex)"""
