"""Hot words (word cloud): word counts in descending order, top N.

Counting is a grouped count, so Spark combines on the map side before the shuffle (a hot word
costs one row per map task, not one per occurrence), and the top N is a bounded
`TakeOrderedAndProject`, not a global sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed import HOT_FIELD_INDEX, HOT_FIELD_SEP, HOT_TOP_N, WHITESPACE
from ..sources.text import delimited_field


def _top(words: DataFrame, n: int) -> DataFrame:
    return (words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc("word"))
            .limit(n))


def field_words(lines: DataFrame, field: int = HOT_FIELD_INDEX, line_col: str = "line",
                sep: str = HOT_FIELD_SEP) -> DataFrame:
    word = delimited_field(line_col, field, sep)
    return lines.select(word.alias("word")).filter(F.col("word").isNotNull())


def hot_field_top(lines: DataFrame, n: int = HOT_TOP_N, field: int = HOT_FIELD_INDEX,
                  line_col: str = "line", sep: str = HOT_FIELD_SEP) -> DataFrame:
    """Top `n` values of the `field`-th (0-based) separated field; short lines are skipped."""
    return _top(field_words(lines, field, line_col, sep), n)


def hot_field_rejects(lines: DataFrame, field: int = HOT_FIELD_INDEX, line_col: str = "line",
                      sep: str = HOT_FIELD_SEP) -> DataFrame:
    """One row: lines read and lines skipped for having too few fields."""
    word = delimited_field(line_col, field, sep)
    return lines.agg(F.count(F.lit(1)).alias("lines"), F.count_if(word.isNull()).alias("rejected"))


def hot_field_counts(lines: DataFrame, field: int = HOT_FIELD_INDEX, line_col: str = "line",
                     sep: str = HOT_FIELD_SEP) -> DataFrame:
    """word, count, rejected: every value of the field, and one row without a word for the lines
    that are too short to have it."""
    word = delimited_field(line_col, field, sep)
    return (lines.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("count"))
            .withColumn("rejected", F.col("word").isNull()))


def token_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    return (docs.select(F.explode(F.split(F.col(text_col), WHITESPACE)).alias("word"))
            .filter(F.col("word") != ""))


def hot_tokens_top(docs: DataFrame, n: int = HOT_TOP_N, text_col: str = "text") -> DataFrame:
    """Top `n` whitespace-separated tokens over the whole text of every document."""
    return _top(token_words(docs, text_col), n)
