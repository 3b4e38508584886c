"""WARC archives: a writer that stores equal payloads once, and a salvaging reader.

Writer: every page becomes a record in ``part-NNNNN-KKK.warc.gz``, one gzip member each. Of pages
with equal payloads of at least ``least_revisit`` bytes the one with the smallest id is a response
record with the payload, the others are revisit records that refer to it. Only (id, digest) rows
are shuffled to find them, with partial aggregation, so a payload shared by a third of all pages
costs no more than any other.

Reader: walks a file member by member (or record by record where it isn't compressed) and checks
the gzip checksum, version line, header, length, closing blank lines and block digest. Where a check
fails it searches for the next gzip magic or version line that begins a wholly valid member or
record, goes on there, and returns the bytes between as a gap row with the reason. Files are
read through a memory map, or ranged reads on remote stores; one record is held at a time, also
where many share a large gzip member, which is read twice: for its checksum, then for its records.
Field names are compared without case, folded lines are joined, and block digests are checked as they
are labelled (md5 or sha, in hex or base 32).

Edge cases: a null html is an empty payload; pages that share the smallest id are all responses; a
null id never is smallest and refers to the smallest one there is; line breaks in a url are
percent-encoded; an empty file has neither records nor gaps; an empty table writes no file.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain, islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import files
from .common import stored

VERSION = b"WARC/1.1"
_START = re.compile(rb"WARC/1\.\d\r\n")
_MAGIC = b"\x1f\x8b\x08"
_CHUNK = 1 << 20
_KEEP = 1 << 25          # inflated bytes of a member that are kept rather than inflated again
_HEADER = 1 << 24        # bytes of a header at most
_LONGEST = (1 << 31) - 1024  # bytes of a block at most: what one Arrow value holds
_DIGESTS = ("md5", "sha1", "sha256", "sha384", "sha512")
# Field names of the format, by their lower case.
_NAMES = {n.lower(): n for n in (
    "WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length", "Content-Type",
    "WARC-Concurrent-To", "WARC-Block-Digest", "WARC-Payload-Digest", "WARC-IP-Address",
    "WARC-Refers-To", "WARC-Refers-To-Target-URI", "WARC-Refers-To-Date", "WARC-Target-URI",
    "WARC-Truncated", "WARC-Warcinfo-ID", "WARC-Filename", "WARC-Profile",
    "WARC-Identified-Payload-Type", "WARC-Segment-Number", "WARC-Segment-Origin-ID",
    "WARC-Segment-Total-Length", "Page-ID", "Refers-To-Page-ID")}
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = pa.schema([
    ("path", pa.string()), ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
    ("inner_start", pa.int64()), ("inner_end", pa.int64()), ("reason", pa.string()),
    ("warc_type", pa.string()), ("headers", pa.map_(pa.string(), pa.string())),
    ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("payload", pa.binary())])
RECORD_DDL = ("path string, kind string, start long, end long, inner_start long, inner_end long, "
              "reason string, warc_type string, headers map<string,string>, payload_bytes long, "
              "payload_sha256 string, payload binary")


# ---- writing -------------------------------------------------------------------------------


def _clean(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str,
                 refers_to: int | None, date: str = "2024-01-01T00:00:00Z") -> bytes:
    """One record, uncompressed. A revisit holds the HTTP header only."""
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = head if refers_to is not None else head + payload
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page_id}:{digest}")
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<urn:uuid:{name}>", "WARC-Date": date,
        "WARC-Target-URI": _clean(url or "about:blank"),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if page_id is not None:
        fields["Page-ID"] = str(page_id)
    if refers_to is not None:
        first = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{refers_to}:{digest}")
        fields |= {"WARC-Profile": _PROFILE, "WARC-Refers-To": f"<urn:uuid:{first}>",
                   "Refers-To-Page-ID": str(refers_to)}
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items()).encode()
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def member(record: bytes, level: int = 5) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


def revisits(pages: DataFrame, id_col: str, html_col: str, least_revisit: int) -> DataFrame:
    """(id, digest, refers_to) of the pages whose payload an earlier page already has."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    keys = (pages.select(F.col(id_col).cast("long").alias("page_id"),
                         F.sha2(html, 256).alias("digest"), F.octet_length(html).alias("n"))
            .filter(F.col("n") >= least_revisit).select("page_id", "digest"))
    first = (keys.groupBy("digest").agg(F.min("page_id").alias("refers_to"),
                                        F.count(F.lit(1)).alias("copies"))
             .filter("copies > 1 and refers_to is not null").select("digest", "refers_to"))
    return (keys.join(first, "digest")
            .filter(~F.col("page_id").eqNullSafe(F.col("refers_to"))).distinct())


def write_warcs(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                html_col: str = "html", least_revisit: int = 100,
                file_bytes: int = 64 << 20) -> DataFrame:
    """Write all pages below ``folder``; the stored list of files (path, n_records, n_bytes)."""
    again = stored(revisits(pages, id_col, html_col, least_revisit), "warc-revisits").select(
        F.col("page_id").alias("r_id"), F.col("digest").alias("r_digest"), "refers_to")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256))
    rows = rows.join(again, F.col("page_id").eqNullSafe(F.col("r_id"))
                     & (F.col("digest") == F.col("r_digest")), "left")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def members() -> Iterator[bytes]:
            for batch in batches:
                for row in zip(*(batch.column(c).to_pylist() for c in
                                 ("page_id", "url", "html", "digest", "refers_to"))):
                    page, url, html, digest, refers = row
                    yield member(record_bytes(page, url, html.encode(), digest, refers))

        part, todo, k = files.partition_id(), members(), 0
        record = next(todo, None)
        while record is not None:
            path, n, size = f"{folder}/part-{part:05d}-{k:03d}.warc.gz", 0, 0
            with files.written(path) as out:
                while record is not None and (not n or size + len(record) <= file_bytes):
                    out.write(record)
                    n, size = n + 1, size + len(record)
                    record = next(todo, None)
            k += 1
            yield pa.RecordBatch.from_pydict({"path": [path], "n_records": [n], "n_bytes": [size]})

    made = rows.select("page_id", "url", "html", "digest", "refers_to").mapInArrow(
        write, "path string, n_records long, n_bytes long")
    return stored(made, "warc-files")


# ---- reading -------------------------------------------------------------------------------


class Broken(Exception):
    """A check failed; the text says which."""


def _fields(header: bytes) -> dict[str, str]:
    """Named fields of a header. Names are compared without case and known ones given in their
    usual spelling; a line that begins with white space continues the one before."""
    fields: dict[str, str] = {}
    last = None
    for line in header.split(b"\r\n"):
        if line[:1] in (b" ", b"\t"):
            if last is None:
                raise Broken("header line without name")
            fields[last] = f"{fields[last]} {line.decode('utf-8', 'replace').strip()}".strip()
            continue
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise Broken("header line without name")
        last = name.decode("utf-8", "replace").strip()
        last = _NAMES.get(last.lower(), last)
        fields[last] = value.decode("utf-8", "replace").strip()
    return fields


def digest_differs(label: str, data: bytes) -> bool:
    """Does a labelled digest (algorithm:value, in hex or base 32) not fit the data? Labels of
    unknown algorithms prove nothing."""
    kind, colon, value = label.partition(":")
    kind = kind.strip().lower().replace("-", "")
    if not colon or kind not in _DIGESTS:
        return False
    raw = hashlib.new(kind, data).digest()
    value = value.strip()
    return (value.lower() != raw.hex()
            and value.upper().rstrip("=") != base64.b32encode(raw).decode().rstrip("="))


class _Stream:
    """Bytes that arrive in chunks; holds what has not been dropped."""

    def __init__(self, chunks: Iterator[bytes]):
        self.chunks, self.held, self.base, self.ended = chunks, bytearray(), 0, False

    def fill(self, n: int) -> bool:
        """Hold n bytes, if there are as many."""
        while len(self.held) < n and not self.ended:
            chunk = next(self.chunks, None)
            if chunk is None:
                self.ended = True
            else:
                self.held += chunk
        return len(self.held) >= n

    def drop(self, n: int) -> None:
        del self.held[:n]
        self.base += n


def _record(s: _Stream) -> tuple[dict[str, str], bytes, int]:
    """Fields, block and size of the record that the held bytes begin with; Broken if a check fails."""
    s.fill(10)
    if not _START.match(s.held):
        raise Broken("no version line")
    seen = 0
    while (close := s.held.find(b"\r\n\r\n", seen)) < 0:
        seen = max(0, len(s.held) - 3)
        if len(s.held) > _HEADER or not s.fill(len(s.held) + 1):
            raise Broken("header without end")
    fields = _fields(bytes(s.held[s.held.find(b"\r\n") + 2:close]))
    size = fields.get("Content-Length", "")
    if not (size.isascii() and size.isdigit()):
        raise Broken("no content length")
    begin, end = close + 4, close + 4 + int(size)
    if int(size) > _LONGEST or not s.fill(end + 4):
        raise Broken("record ends early")
    if s.held[end:end + 4] != b"\r\n\r\n":
        raise Broken("record doesn't end where its length says")
    block = bytes(s.held[begin:end])
    if digest_differs(fields.get("WARC-Block-Digest", ""), block):
        raise Broken("block digest differs")
    return fields, block, end + 4


def parse_records(chunks: Iterator[bytes]) -> Iterator[tuple]:
    """('record', start, end, fields, block) and ('gap', start, end, reason) over bytes that arrive
    in chunks; one record is held at a time."""
    s, gap, why = _Stream(chunks), None, ""
    while s.fill(1):
        try:
            fields, block, size = _record(s)
        except Broken as e:
            if gap is None:
                gap, why = s.base, str(e)
            at = 1
            while not (found := _START.search(s.held, at)) and not s.ended:
                # A version line may begin in the last bytes.
                s.drop(max(at, len(s.held) - 9))
                at = 0
                s.fill(len(s.held) + 1)
            s.drop(found.start() if found else len(s.held))
            continue
        if gap is not None:
            yield "gap", gap, s.base, why
            gap = None
        yield "record", s.base, s.base + size, fields, block
        s.drop(size)
    if gap is not None:
        yield "gap", gap, s.base, why


class _Window:
    """Reads and searches of a file without loading it."""

    def __init__(self, f: pa.NativeFile):
        self.f, self.size = f, f.size()

    def read(self, at: int, n: int) -> bytes:
        return self.f.read_at(max(0, min(n, self.size - at)), at) if at < self.size else b""

    def find_start(self, at: int) -> int:
        """Next offset from ``at`` where a member or a record could begin; the size if none."""
        while at < self.size:
            data = self.read(at, _CHUNK + 16)
            line = _START.search(data)
            spots = [x for x in (data.find(_MAGIC), line.start() if line else -1) if x >= 0]
            if spots:
                return at + min(spots)
            at += _CHUNK
        return self.size


def _inflated(window: _Window, at: int, ends: list[int]) -> Iterator[bytes]:
    """The bytes of the gzip member at ``at`` in chunks; its end is added to ``ends``."""
    z, pos, first = zlib.decompressobj(31), at, True
    while not z.eof:
        chunk = z.unconsumed_tail
        if not chunk:
            chunk = window.read(pos, _CHUNK)
            if not chunk:
                raise Broken("member ends early")
            pos += len(chunk)
        try:
            data = z.decompress(chunk, _CHUNK)
        except zlib.error as e:
            raise Broken("member doesn't decompress" if "check" not in str(e)
                         else "member checksum differs") from None
        if first and data and not VERSION.startswith(data[:5]) and data[:5] != b"WARC/":
            raise Broken("member holds no record")
        first = first and not data
        if data:
            yield data
    ends.append(pos - len(z.unused_data))


def _member(window: _Window, at: int) -> tuple[Iterator[bytes], int]:
    """Chunks of a member that has been read to its end once, so that its checksum holds; a large
    one is not kept but inflated again."""
    ends: list[int] = []
    kept, size = [], 0
    for data in _inflated(window, at, ends):
        size += len(data)
        if size <= _KEEP:
            kept.append(data)
        else:
            kept.clear()
    return iter(kept) if size <= _KEEP else _inflated(window, at, []), ends[0]


def _plain(window: _Window, at: int) -> tuple[dict[str, str], bytes, int]:
    """The uncompressed record at ``at``."""
    def chunks() -> Iterator[bytes]:
        pos, n = at, 1 << 14
        while data := window.read(pos, n):
            yield data
            pos, n = pos + len(data), _CHUNK
    fields, block, size = _record(_Stream(chunks()))
    return fields, block, at + size


def walk(f: pa.NativeFile) -> Iterator[tuple]:
    """Records and gaps of a file: (kind, start, end, inner start, inner end, reason, fields,
    block); inner offsets count in the decompressed member."""
    window = _Window(f)
    at, gap, why = 0, None, ""
    while at < window.size:
        head = window.read(at, 3)
        try:
            if head == _MAGIC:
                data, end = _member(window, at)
                inner = parse_records(data)
                lead = list(islice(inner, 2))  # a gap is never followed by another one
                if not any(x[0] == "record" for x in lead):
                    raise Broken(lead[0][3] if lead else "member is empty")
                found = ((x[0], at, end, x[1], x[2], *((x[3], None, None) if x[0] == "gap"
                                                       else (None, x[3], x[4])))
                         for x in chain(lead, inner))
            else:
                fields, block, end = _plain(window, at)
                found = iter([("record", at, end, None, None, None, fields, block)])
        except Broken as e:
            if gap is None:
                gap, why = at, str(e)
            at = window.find_start(at + 1)
            continue
        if gap is not None:
            yield "gap", gap, at, None, None, why, None, None
            gap = None
        yield from found
        at = end
    if gap is not None:
        yield "gap", gap, window.size, None, None, why, None, None


def _payload(fields: dict[str, str], block: bytes) -> bytes:
    if "http" in fields.get("Content-Type", "") and block.startswith(b"HTTP/"):
        return block[block.find(b"\r\n\r\n") + 4:]
    return block


def _http_length(block: bytes) -> int | None:
    found = re.search(rb"\r\nContent-Length:[ \t]*(\d+)", block, re.I)
    return int(found[1]) if found else None


def read_warcs(paths: DataFrame, payload: bool = True) -> DataFrame:
    """All records and quarantined gaps of the files named in column ``path``.

    ``payload_bytes`` and ``payload_sha256`` describe the full payload; for a revisit they are what
    its headers say. ``payload=False`` leaves the payload itself out.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with files.opened(path) as f:
                    for kind, start, end, i, j, why, fields, block in walk(f):
                        row = dict.fromkeys(RECORD.names) | {
                            "path": path, "kind": kind, "start": start, "end": end,
                            "inner_start": i, "inner_end": j, "reason": why}
                        if kind == "record":
                            body = _payload(fields, block)
                            row |= {"warc_type": fields.get("WARC-Type"),
                                    "headers": list(fields.items()),
                                    "payload_bytes": len(body),
                                    "payload_sha256": hashlib.sha256(body).hexdigest()}
                            if row["warc_type"] == "revisit":
                                said = fields.get("WARC-Payload-Digest", "")
                                row |= {"payload_bytes": _http_length(block),
                                        "payload_sha256": said[7:] if said.startswith("sha256:")
                                        else None}
                            elif payload:
                                row["payload"] = body
                                held += len(body)
                        rows.append(row)
                        if len(rows) >= 5_000 or held >= 16 << 20:
                            yield pa.RecordBatch.from_pylist(rows, RECORD)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, RECORD)

    spark = paths.sparkSession
    n = max(spark.sparkContext.defaultParallelism,
            int(spark.conf.get("spark.sql.shuffle.partitions")))
    return paths.select("path").repartition(n, "path").mapInArrow(read, RECORD_DDL)
