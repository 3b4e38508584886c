"""Audience segments over the wide tag table: select one segment, export it as text lines, or
evaluate many segments together (in narrow passes).

Every operation here is row-local on the tag table (one row per member): a segment is a filter
and a score expression, so selecting, exporting and batching need no shuffle. An audience is
always whole; only a caller that asks for a page gets one, best score first: by `size` and
`offset`, whose cost grows with the offset, or behind a cursor (`segment_page`), whose cost does not.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Any, Iterable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..fixed import EXPORT_LINE
from ..functions.conditions import compile_conditions


def segment_members(tags: DataFrame, conditions: Iterable) -> DataFrame:
    """Every matching member with its score (no page limit)."""
    matched, score = compile_conditions(conditions, tags.schema)
    return tags.filter(matched).withColumn("score", score)


def segment_select(tags: DataFrame, conditions: Iterable, size: int | None = None,
                   offset: int = 0) -> DataFrame:
    """memberId, phone of every member of the segment, in no order.

    With `size` or `offset`, one page of it: best score first, then by memberId.
    """
    hits = segment_members(tags, conditions)
    if size is not None or offset:
        hits = hits.orderBy(F.desc("score"), F.asc("memberId")).offset(offset)
        if size is not None:
            hits = hits.limit(size)
    return hits.select("memberId", "phone")


def export_lines(selected: DataFrame) -> DataFrame:
    """One text line `[memberId,phone]` per selected member."""
    return selected.select(
        F.format_string(EXPORT_LINE, F.col("memberId").cast("string"), F.col("phone"))
        .alias("line"))


def segment_export(tags: DataFrame, conditions: Iterable) -> DataFrame:
    """One text line for every member of the segment."""
    return export_lines(segment_select(tags, conditions))


# Segments evaluated per pass over the tag table: bounds the size of one projection so its
# generated code stays compact however many segments are requested.
SEGMENTS_PER_PASS = 64


def _batch_pass(tags: DataFrame, segments: list[tuple[str, Iterable]]) -> DataFrame:
    hits = []
    for seg_id, conditions in segments:
        matched, score = compile_conditions(conditions, tags.schema)
        hits.append(F.when(matched, F.struct(F.lit(seg_id).alias("segment_id"),
                                             score.alias("score"))))
    found = F.filter(F.array(*hits), lambda x: x.isNotNull())
    return (tags.select("memberId", "phone", F.explode(found).alias("hit"))
            .select(F.col("hit.segment_id").alias("segment_id"), "memberId", "phone",
                    F.col("hit.score").alias("score")))


def segment_batch(tags: DataFrame, segments: Mapping[str, Iterable],
                  per_pass: int = SEGMENTS_PER_PASS) -> DataFrame:
    """segment_id, memberId, phone, score for many segments at once, complete audiences.

    Each member row is tested against every segment's expression and emits one row per segment
    it belongs to: a narrow pass over the tag table, no join and no shuffle. Segments are taken
    `per_pass` at a time and the passes are unioned, so thousands of segments cost several
    column-pruned reads of the tag table (give a written tag table, see `sinks.write_tags`)
    instead of one oversized expression.
    """
    items = list(segments.items())
    if not items:
        raise ValueError("segment_batch needs at least one segment")
    passes = [_batch_pass(tags, items[i:i + per_pass]) for i in range(0, len(items), per_pass)]
    out = passes[0]
    for p in passes[1:]:
        out = out.unionByName(p)
    return out


@dataclass(frozen=True)
class Cursor:
    """The last row of a page: where the next one starts."""

    score: int
    member_id: Any
    phone: str | None

    @classmethod
    def after(cls, rows: list[Row]) -> Cursor | None:
        """The cursor behind a page's rows; None behind an empty page."""
        return cls(rows[-1]["score"], rows[-1]["memberId"], rows[-1]["phone"]) if rows else None

    def to_text(self) -> str:
        return json.dumps([self.score, self.member_id, self.phone])

    @classmethod
    def from_text(cls, text: str) -> Cursor:
        return cls(*json.loads(text))


def _behind(value: Any, name: str) -> Column:
    """Rows that sort after a value of an ascending column (NULL sorts first)."""
    return F.col(name).isNotNull() if value is None else F.col(name) > F.lit(value)


def segment_page(tags: DataFrame, conditions: Iterable, size: int,
                 after: Cursor | None = None) -> DataFrame:
    """memberId, phone, score of the next `size` members behind a cursor, best score first, then
    by memberId and phone.

    The cursor is a row filter, so every page is one scan with a top-`size` per task and costs
    what the first page costs; nothing before it is sorted or skipped over. The pages together
    hold the audience once, if (memberId, phone) tells the rows apart, as in the tag table.
    """
    hits = segment_members(tags, conditions)
    if after is not None:
        later = F.col("score") < after.score
        same = F.col("score") == after.score
        for name, value in (("memberId", after.member_id), ("phone", after.phone)):
            later = later | (same & _behind(value, name))
            same = same & F.col(name).eqNullSafe(F.lit(value))
        hits = hits.filter(later)
    return (hits.orderBy(F.desc("score"), F.asc("memberId"), F.asc("phone")).limit(size)
            .select("memberId", "phone", "score"))


def pages(tags: DataFrame, conditions: Iterable, size: int) -> Iterator[list[Row]]:
    """The audience page by page; each page is a bounded result at the driver."""
    conditions, cursor = list(conditions), None
    while rows := segment_page(tags, conditions, size, cursor).collect():
        yield rows
        if len(rows) < size:
            return
        cursor = Cursor.after(rows)
