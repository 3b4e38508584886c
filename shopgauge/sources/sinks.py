"""Sinks: the wide tag table and audience exports as text lines.

Writes are idempotent (overwrite): re-running a job replaces its output instead of appending
a second copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..fixed import EXPORT_LINE_SEP


def write_tags(tags: DataFrame, path: str | None = None, table: str | None = None,
               buckets: int | None = None) -> None:
    """Write the tag table as Parquet at `path`, or as a catalog table bucketed by memberId.

    Bucketing by memberId lets later joins and segment batches on memberId read the table
    co-partitioned, without a shuffle.
    """
    writer = tags.write.mode("overwrite")
    if table is not None:
        if buckets:
            writer = writer.bucketBy(buckets, "memberId").sortBy("memberId")
        writer.format("parquet").saveAsTable(table)
    elif path is not None:
        writer.parquet(path)
    else:
        raise ValueError("write_tags needs a path or a table name")


def write_lines(lines: DataFrame, path: str, line_col: str = "line",
                line_sep: str = EXPORT_LINE_SEP) -> None:
    """Write one text line per row (default separator CRLF, as the download format uses)."""
    lines.select(line_col).write.mode("overwrite").option("lineSep", line_sep).text(path)

