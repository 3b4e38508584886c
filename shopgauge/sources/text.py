"""Text-file sources: lines of a (possibly huge, many-file) text input, and delimited fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str, line_col: str = "line",
               line_sep: str | None = None) -> DataFrame:
    """One STRING column per line; splittable, so the scan runs in parallel over file blocks.

    Lines end at LF, CR LF or a lone CR, or at `line_sep` alone if that is given (the export format
    ends lines with CR LF, and a lone CR is part of its text).
    """
    reader = spark.read if line_sep is None else spark.read.option("lineSep", line_sep)
    return reader.text(path).withColumnRenamed("value", line_col)


def delimited_field(line: str | Column, index: int, sep: str = "\t") -> Column:
    """Field `index` (0-based) of a separated line, NULL when the line has too few fields.

    Trailing empty fields do not count, as with a split that drops trailing empty strings:
    `a<TAB>b<TAB>` has two fields, `a<TAB>b<TAB><TAB>d` has four (the third is empty).
    """
    col = F.col(line) if isinstance(line, str) else line
    stripped = F.regexp_replace(col, rf"(?:{_regex_quote(sep)})+\z", "")
    return F.get(F.split(stripped, _regex_quote(sep)), index)


def _regex_quote(sep: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\/" else ch for ch in sep)
