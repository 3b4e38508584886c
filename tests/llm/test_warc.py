import base64
import hashlib
import io

import pyarrow as pa
from shopgauge.llm import files, warc
from shopgauge.llm.common import scratch

PAGE = "page_id long, url string, html string"


def record(i, body):
    return warc.record_bytes(i, f"http://x/{i}", body, hashlib.sha256(body).hexdigest(), None)


def walked(data):
    return list(warc.walk(pa.BufferReader(data)))


def kinds(data):
    return [(x[0], x[1], x[2]) for x in walked(data)]


def test_round_trip_with_revisits(spark):
    long, other = "<p>é" + "x" * 200, "<p>" + "y" * 200
    rows = [(5, "http://a", long), (2, "http://b\r\nX: 1", long), (9, None, long), (3, "u", "short"),
            (4, "u", "short"), (6, "u", None), (7, "u", ""), (8, "u", other), (8, "u", other),
            (None, "u", long)]
    pages = spark.createDataFrame(rows, PAGE).selectExpr("*", "'x' AS digest", "1 AS n").repartition(3)
    made = warc.write_warcs(pages, scratch(spark, "test"), file_bytes=600)
    got = warc.read_warcs(made).collect()
    assert len(got) == len(rows) and all(r.kind == "record" for r in got)
    want = []
    for i, _, html in rows:
        body = (html or "").encode()
        first = {long: 2, other: 8}.get(html)
        revisit = first is not None and i != first
        want.append((i or -1, len(body), hashlib.sha256(body).hexdigest(),
                     "revisit" if revisit else "response", first if revisit else -1))
    assert sorted((int(r.headers.get("Page-ID", -1)), r.payload_bytes, r.payload_sha256, r.warc_type,
                   int(r.headers.get("Refers-To-Page-ID", -1))) for r in got) == sorted(want)
    empty = warc.write_warcs(pages.limit(0), scratch(spark, "test"))
    assert warc.read_warcs(empty).count() == 0


def test_salvage_of_members():
    parts = [warc.member(record(i, bytes([65 + i]) * 500)) for i in range(5)]
    good = b"".join(parts)
    assert [k for k, _, _ in kinds(good)] == ["record"] * 5
    at = [sum(map(len, parts[:i])) for i in range(6)]
    # A flipped byte loses one record; the gap is that member.
    bad = bytearray(good)
    bad[at[2] + len(parts[2]) // 2] ^= 0xFF
    assert kinds(bytes(bad)) == [("record", at[0], at[1]), ("record", at[1], at[2]),
                                 ("gap", at[2], at[3]), ("record", at[3], at[4]),
                                 ("record", at[4], at[5])]
    # Cut out of the middle, junk in front, and an end that is missing.
    cut = good[:at[1] + 20] + good[at[2]:]
    assert [k for k, _, _ in kinds(cut)] == ["record", "gap", "record", "record", "record"]
    assert kinds(b"junk" + good[:-9])[0] == ("gap", 0, 4)
    assert kinds(good[:-9])[-1] == ("gap", at[4], len(good) - 9)
    assert kinds(b"") == [] and kinds(b"nothing here") == [("gap", 0, 12)]


def test_salvage_of_plain_records_and_of_records_in_one_member():
    parts = [record(i, b"body %d " % i * 30) for i in range(4)]
    bad = bytearray(b"".join(parts))
    bad[len(parts[0]) + len(parts[1]) - 30] ^= 1     # the block digest notices
    assert [k for k, _, _ in kinds(bytes(bad))] == ["record", "gap", "record", "record"]
    inner = walked(warc.member(bytes(bad)))
    assert [x[0] for x in inner] == ["record", "gap", "record", "record"]
    assert inner[1][5] == "block digest differs" and inner[1][3] == len(parts[0])
    mixed = warc.member(parts[0]) + parts[1] + warc.member(parts[2])
    assert [k for k, _, _ in kinds(mixed)] == ["record"] * 3
    assert kinds(parts[0].replace(b"Content-Length", b"Content-Lngth"))[0][0] == "gap"


def other(body, digest="", names=str, fold=False):
    """A record as other writers make it."""
    lines = [("WARC-Type", "resource"), ("WARC-Target-URI", "urn:x"), ("Content-Length", str(len(body))),
             ("X-Note", "one\r\n\ttwo" if fold else "one")]
    if digest:
        lines.append(("WARC-Block-Digest", digest))
    head = "".join(f"{names(k)}: {v}\r\n" for k, v in lines)
    return b"WARC/1.0\r\n" + head.encode() + b"\r\n" + body + b"\r\n\r\n"


def test_records_of_other_writers():
    body = b"some body"
    for algorithm in ("md5", "sha1", "sha256", "SHA-512"):
        raw = hashlib.new(algorithm.replace("-", ""), body).digest()
        for value in (raw.hex(), raw.hex().upper(), base64.b32encode(raw).decode(),
                      base64.b32encode(raw).decode().rstrip("=").lower()):
            good = other(body, f"{algorithm}:{value}", str.lower, fold=True)
            bad = other(body[:-1] + b"X", f"{algorithm}:{value}", str.upper)
            for pack in (bytes, warc.member):
                kind, *_, fields, block = walked(pack(good))[0]
                assert (kind, block, fields["X-Note" if "X-Note" in fields else "x-note"]) == (
                    "record", body, "one two")
                assert fields["WARC-Type"] == "resource"
                got = walked(pack(bad) + pack(good))
                assert [g[0] for g in got] == ["gap", "record"]
                assert got[0][5] == "block digest differs"
    assert walked(other(body, "crc32:00"))[0][0] == "record"
    broken = b"WARC/1.0\r\n folded: first\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    assert walked(broken)[0][5] == "header line without name"


def test_many_records_in_one_member_are_streamed(monkeypatch):
    parts = [record(i, b"body %d " % i * (i * 7 % 50 + 1)) for i in range(300)]
    bad = bytearray(b"".join(parts))
    hit = sum(map(len, parts[:100])) + len(parts[100]) - 8
    bad[hit] ^= 1
    want = [x[:5] for x in walked(warc.member(bytes(bad)))]
    assert [x[0] for x in want].count("record") == 299 and len(want) == 300
    monkeypatch.setattr(warc, "_KEEP", 1000)
    held = []
    fill = warc._Stream.fill

    def watched(self, n):
        out = fill(self, n)
        held.append(len(self.held))
        return out
    monkeypatch.setattr(warc._Stream, "fill", watched)
    for chunk in (64, 777, 1 << 12):
        monkeypatch.setattr(warc, "_CHUNK", chunk)
        data = warc.member(bytes(bad))
        assert [x[:5] for x in walked(data)] == want
        assert [x[:5] for x in walked(data + warc.member(parts[0]))][:-1] == want
    assert max(held) < 2 * (1 << 12) + max(map(len, parts))
    flipped = bytearray(data)
    flipped[-5] ^= 1  # the checksum at the end: no record of the member counts
    assert [x[0] for x in walked(bytes(flipped))] == ["gap"]
    plain = bytes(bad)
    assert [(x[0], x[1], x[2]) for x in walked(plain)] == [(x[0], x[3], x[4]) for x in want]


def test_extra_columns_change_nothing(spark):
    rows = [(i, f"u{i % 3}", "<p>" + "z" * (150 + i % 4)) for i in range(20)]
    pages = spark.createDataFrame(rows, PAGE)
    odd = pages.selectExpr("*", *(f"'x' AS `{c}`" for c in (
        "digest", "n", "refers_to", "r_id", "copies", "path", "headers", "kind")))
    both = [sorted((r.start, r.headers["Page-ID"], r.warc_type, r.payload_sha256) for r in
                   warc.read_warcs(warc.write_warcs(p.coalesce(1), scratch(spark, "test"))).collect())
            for p in (pages, odd)]
    assert both[0] == both[1] and len(both[0]) == 20


def test_a_failed_attempt_leaves_no_file(tmp_path):
    try:
        with files.written(f"file://{tmp_path}/a/b.bin") as out:
            out.write(b"half")
            raise RuntimeError
    except RuntimeError:
        pass
    assert list((tmp_path / "a").iterdir()) == []
    with files.written(f"{tmp_path}/a/b.bin") as out:
        out.write(b"whole")
    with files.opened(f"file://{tmp_path}/a/b.bin") as f:
        assert isinstance(f, pa.MemoryMappedFile) and f.read() == b"whole"
    assert io.BytesIO(b"").read() == b""
