"""Repeated passages removed, by distributed prefix doubling on anchored suffixes.

Every byte of a text that lies in a string of ``least`` bytes which also starts somewhere else, in
another text or in the same one, is removed. The work goes in rounds over (position, rank) pairs;
a position leaves as soon as its string is unique, and the rounds end past ``least`` bytes.

* **Anchors.** Of a window of ``least`` bytes the anchor is the position among its first ``gap``
  whose eight bytes hash lowest, the leftmost of equals. Equal windows have their anchor at the
  same offset, so suffixes need ranks at anchors only, about one byte in gap / 2. The windows that
  share an anchor start in one run of positions, ``lo`` to ``hi`` bytes before it.
* **Round one** doubles the rank of an anchor's first bytes with that of the next as many: Spark
  sorts the pairs (a range shuffle, whose bounds include the position, so that a very frequent
  pair spreads over tasks) and a pass over the sorted rows drops unique pairs.
* **Round two** goes past ``least``: the rank of all bytes of an anchor's windows together, its
  context. Windows of a context that occurs twice are repeated, all of them.
* **Round three** takes contexts that occur once and share their pair with another one, which are
  the ends of repeated passages, and ranks each of their windows, one per offset. A class of
  contexts without such a single one needs no windows. Counts are partial sums by rank; only a
  window counted once hands its position on.

Round one's ranks are 32-bit checks, which can only keep too much; contexts and windows are told
apart by 128-bit digests. Rounds are stored, so that a lost executor costs one round. A text
meets its own marks twice by (id, hash of the text), in two joins.

Edge cases: a null or empty text has no bytes; texts below ``least`` bytes stay as they are; rows
that share id and text repeat each other and are removed alike; rows that share an id only are
judged apart; null ids are ids; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

_SEGMENT = 1 << 20  # windows of a text that are looked at together
_LOCAL = 24  # bits of a place within a segment
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9))


def gap_of(least: int) -> int:
    """Places an anchor can have in a window; offsets take seven bits."""
    if least < 24:
        raise ValueError("least must be 24 bytes or more")
    return min(128, least // 3)


def _segments(texts: list[bytes], least: int) -> Iterator[tuple[bytes, list[tuple[int, int, int]]]]:
    """Texts joined to about _SEGMENT bytes, longer ones cut so that every window is in one
    segment: (bytes, [(start in the bytes, text, place in the text)])."""
    held, parts, size = [], [], 0
    for i, text in enumerate(texts):
        if len(text) < least:
            continue
        for at in range(0, len(text) - least + 1, _SEGMENT):
            piece = text[at:at + _SEGMENT + least - 1]
            held.append(piece)
            parts.append((size, i, at))
            size += len(piece)
            if size >= _SEGMENT:
                yield b"".join(held), parts
                held, parts, size = [], [], 0
    if held:
        yield b"".join(held), parts


def anchors(texts: list[bytes], least: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray,
                                                              np.ndarray, np.ndarray, np.ndarray]]:
    """For each segment its bytes and, of its anchors: text, shift (place in the text less place
    in the segment), anchor, first and last start of its windows (all within the segment)."""
    gap = gap_of(least)
    for data, parts in _segments(texts, least):
        n = len(data)
        value = np.ndarray((n,), "<u8", buffer=data + bytes(8), strides=(1,)).astype(np.uint64)
        value *= _MIX[0]
        value ^= value >> np.uint64(29)
        value *= _MIX[1]
        low = value >> np.uint64(_LOCAL) << np.uint64(_LOCAL)
        low |= np.arange(n, dtype=np.uint64)
        wide = 1
        while 2 * wide <= gap:
            low = np.minimum(low[:-wide], low[wide:])
            wide *= 2
        if wide < gap:
            low = np.minimum(low[:wide - gap], low[gap - wide:])
        starts = [p[0] for p in parts]
        ends = starts[1:] + [n]
        window = np.concatenate([np.arange(a, b - least + 1) for a, b in zip(starts, ends)])
        place = (low[window] & np.uint64((1 << _LOCAL) - 1)).astype(np.int64)
        cut = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (np.diff(window) != 1)])
        last = window[np.r_[cut[1:], len(window)] - 1]
        part = np.searchsorted(starts, place[cut], "right") - 1
        text = np.array([p[1] for p in parts])[part]
        shift = np.array([p[2] - p[0] for p in parts])[part]
        yield data, text, shift, place[cut], window[cut], last


def _texts(column: pa.Array) -> list[bytes]:
    return [b"" if t is None else t.encode() for t in column.to_pylist()]


def _anchor_rows(least: int):
    half = (least - gap_of(least)) // 2

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc, digest = zlib.crc32, hashlib.blake2b
        for batch in batches:
            texts = _texts(batch.column("text"))
            for data, text, shift, at, first, last in anchors(texts, least):
                ranks, names = [], []
                lo, hi = at - last, at - first
                for p, a, b, x, y in zip(at.tolist(), first.tolist(), last.tolist(), lo.tolist(),
                                         hi.tolist()):
                    ranks.append(crc(data[p:p + half]) << 32
                                 | crc(data[p + half:p + 2 * half]))
                    names.append(digest(data[a:b + least], digest_size=16,
                                        salt=bytes((x, y))).digest())
                name = np.frombuffer(b"".join(names), "<i8")
                text = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc").take(text), batch.column("th").take(text),
                     pa.array((at + shift) << 16 | lo << 8 | hi),
                     pa.array(np.array(ranks, np.uint64).view(np.int64)),
                     pa.array(name[::2]), pa.array(name[1::2])],
                    names=["doc", "th", "at", "pair", "f1", "f2"])
    return rows


def _runs(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.Table, np.ndarray,
                                                                            np.ndarray]]:
    """Sorted rows with two flags each: does the row have the value of a neighbour, and does it
    start a value. The ends of a partition, whose neighbours are elsewhere, count as shared."""
    held, before = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        if held is not None:
            now = pa.concat_tables([held, now])
        if now.num_rows > 1:
            out = now.slice(0, now.num_rows - 1)
            yield out, *_flags(now.column(column).to_numpy(), before)
            before = out.column(column)[-1].as_py()
        held = now.slice(now.num_rows - 1)
    if held is not None:
        key = held.column(column).to_numpy()
        yield held, np.array([True]), np.array([before is None or key[0] != before])


def _flags(key: np.ndarray, before: int | None) -> tuple[np.ndarray, np.ndarray]:
    same = key[1:] == key[:-1]
    first = np.array([before is None or key[0] == before])
    shared = same | np.r_[first, same[:-1]]
    start = ~np.r_[before is not None and key[0] == before, same[:-1]]
    return shared, start


def _shared_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, shared, _ in _runs(batches, "pair"):
        yield from rows.filter(pa.array(shared)).to_batches()


def _mixed_classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by pair and count, with a flag: could a window of this context decide? Not if
    the context is alone in its class, nor if the smallest count of the class is above one."""
    first_key, least_count = None, 1
    for rows, shared, start in _runs(batches, "pair"):
        key, count = rows.column("pair").to_numpy(), rows.column("m").to_numpy()
        if first_key is None:
            first_key = key[0]
        run = np.cumsum(start)  # 0: the run that was open before these rows
        least = np.r_[least_count, count[start]][run]
        least_count = int(least[-1])
        needed = (key == first_key) | (shared & (least == 1))
        yield from rows.append_column("open", pa.array(needed)).to_batches()


def _window_rows(least: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = hashlib.blake2b
        for batch in batches:
            names, codes, weights = [], [], []
            for text, marks in zip(_texts(batch.column("text")),
                                   batch.column("marks").to_pylist()):
                for mark in marks:
                    at, single = mark["at"], mark["m"] == 1
                    p, lo, hi = at >> 16, at >> 8 & 255, at & 255
                    for d in range(lo, hi + 1):
                        names.append(digest(text[p - d:p - d + least], digest_size=16,
                                            salt=bytes((d,))).digest())
                    codes += [mark["rid"] << 7 | d if single else -1 for d in range(lo, hi + 1)]
                    weights += [1 if single else 2] * (hi - lo + 1)
                if len(names) >= 50_000:
                    yield _windows(names, codes, weights)
                    names, codes, weights = [], [], []
            if names:
                yield _windows(names, codes, weights)
    return rows


def _windows(names: list[bytes], codes: list[int], weights: list[int]) -> pa.RecordBatch:
    name = np.frombuffer(b"".join(names), "<i8")
    return pa.RecordBatch.from_arrays(
        [pa.array(name[::2]), pa.array(name[1::2]), pa.array(codes, pa.int64()),
         pa.array(weights, pa.int64())], names=["w1", "w2", "code", "weight"])


def _spans(marks: list[dict], least: int) -> np.ndarray:
    """Covered runs [start, end) of one text from its marks."""
    unique = {m["at"]: (m["low"], m["high"]) for m in marks if m["low"] is not None}
    starts, ends = [], []
    for at in {m["at"] for m in marks}:
        p, lo, hi = at >> 16, at >> 8 & 255, at & 255
        low, high = unique.get(at, (0, 0))
        bits = (low & (1 << 64) - 1) | (high & (1 << 64) - 1) << 64
        if not bits:
            starts.append(p - hi)
            ends.append(p - lo + least)
            continue
        for d in range(lo, hi + 1):
            if not bits >> d & 1:
                starts.append(p - d)
                ends.append(p - d + least)
    if not starts:
        return np.empty((0, 2), np.int64)
    order = np.argsort(starts, kind="stable")
    start, end = np.array(starts)[order], np.maximum.accumulate(np.array(ends)[order])
    new = np.r_[True, start[1:] > end[:-1]]
    return np.stack([start[new], end[np.r_[np.flatnonzero(new)[1:], len(end)] - 1]], 1)


def _cut_rows(least: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, kept, sizes = [], [], []
            for text, marks in zip(_texts(batch.column("text")),
                                   batch.column("marks").to_pylist()):
                found, at, parts = _spans(marks or [], least), 0, []
                for a, b in found.tolist():
                    parts.append(text[at:a])
                    at = b
                kept.append(b"".join([*parts, text[at:]]))
                sizes.append(len(text))
                spans.append([{"start": a, "length": b - a} for a, b in found.tolist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(sizes, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()),
                                                     ("length", pa.int64())]))),
                 pa.array(kept, pa.binary())], names=["doc", "n_bytes", "spans", "kept"])
    return rows


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   least: int = 400) -> DataFrame:
    """doc_id, n_bytes, spans (array of removed start and length, in bytes) and kept (the bytes
    that are left, as binary: a cut can fall inside a character) of every row."""
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"),
                        F.xxhash64(text_col).alias("th"))
    kind = texts.schema["doc"].dataType.simpleString()
    key = f"doc {kind}, th long, at long"

    placed = stored(texts.mapInArrow(_anchor_rows(least), f"{key}, pair long, f1 long, f2 long"),
                    "anchors")
    order = ("pair", "th", "at")
    alike = stored(placed.repartitionByRange(*order).sortWithinPartitions(*order)
                   .mapInArrow(_shared_pairs, placed.schema), "pairs")

    contexts = alike.groupBy("f1", "f2").agg(F.count(F.lit(1)).alias("m"),
                                             F.min(F.struct("th", "at", "pair", "doc")).alias("r"))
    contexts = stored(contexts.select("m", "r.*"), "contexts")
    order = ("pair", "m", "th", "at")
    shape = contexts.schema.add("open", "boolean")
    contexts = (contexts.repartitionByRange(*order).sortWithinPartitions(*order)
                .mapInArrow(_mixed_classes, shape))
    contexts = stored(contexts.withColumn("rid", F.monotonically_increasing_id()), "classes")

    ends = (contexts.filter("open").groupBy("doc", "th")
            .agg(F.collect_list(F.struct("rid", "at", "m")).alias("marks")))
    windows = _with(texts, ends, "inner").mapInArrow(
        _window_rows(least), "w1 long, w2 long, code long, weight long")
    lone = (windows.groupBy("w1", "w2").agg(F.sum("weight").alias("n"), F.max("code").alias("code"))
            .filter("n = 1").select(F.shiftright("code", 7).alias("rid"),
                                    F.col("code").bitwiseAND(127).cast("int").alias("d")))
    none, every = F.lit(0).cast("long"), F.lit(-1).cast("long")
    bit = F.expr("shiftleft(1L, d % 64)")
    lone = stored(lone.groupBy("rid").agg(
        F.bit_or(F.when(F.col("d") < 64, bit).otherwise(none)).alias("low"),
        F.bit_or(F.when(F.col("d") >= 64, bit).otherwise(none)).alias("high")), "windows")

    single = contexts.filter("m = 1").join(lone, "rid", "left").select(
        "doc", "th", "at", *(F.when(F.col("open"), F.coalesce(c, none)).otherwise(every).alias(c)
                             for c in ("low", "high")))
    marks = alike.select("doc", "th", "at", F.lit(None).cast("long").alias("low"),
                         F.lit(None).cast("long").alias("high")).unionByName(single)
    marks = (marks.groupBy("doc", "th")
             .agg(F.collect_list(F.struct("at", "low", "high")).alias("marks")))
    out = _with(texts, marks, "left").mapInArrow(
        _cut_rows(least),
        f"doc {kind}, n_bytes long, spans array<struct<start long, length long>>, kept binary")
    return out.withColumnRenamed("doc", id_col)


def _with(texts: DataFrame, marks: DataFrame, how: str) -> DataFrame:
    """Texts beside their own marks."""
    marks = marks.select(F.col("doc").alias("_doc"), F.col("th").alias("_th"), "marks")
    return texts.join(marks, F.col("doc").eqNullSafe(F.col("_doc"))
                      & (F.col("th") == F.col("_th")), how).select("doc", "text", "marks")
