"""Token counts by a two-tier lookup on the map side: no pre-token is ever shuffled one by one.

No piece of the vocabulary has a white space mark after another character, so the library's count
for a text is the sum of its counts for the pre-tokens, a run of spaces with the non-spaces that
follow. Tier one is a broadcast table of the lengths of frequent pre-tokens; tier two is a cache
in each Python worker, filled by the library itself on a miss. Results are exact whatever the
tables hold.

The frequent pre-tokens come from a summary of every partition of the whole corpus (its most
counted pre-tokens, at most ``per_partition``); the summaries are added up and the best
``table_size`` of at most ``longest`` characters are broadcast, a few megabytes at any corpus size.

Edge cases: a null or empty text has no tokens; a text without spaces is one pre-token and is
encoded whole; repeated rows repeat their result; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_UNITS = re.compile(" +[^ ]*")
LONGEST = 64


def _plain(text: str) -> bool:
    """True if single spaces stand between all words."""
    return "  " not in text and text[:1] != " " and text[-1:] != " "


def _units(text: str) -> list[str]:
    """Pre-tokens without the one space that the library puts before a text."""
    text = text.replace("▁", " ")
    if _plain(text):
        return text.split(" ")
    return [u[1:] for u in _UNITS.findall(" " + text)]


class Lengths(dict):
    """Tokens of a pre-token; starts as the broadcast table and asks the library for the rest."""

    def __init__(self, encode, frequent: dict[str, int], limit: int):
        # The library puts no space before an empty text, so one space at a text's end, which is
        # a unit without anything after its space, is counted behind another word.
        end = len(encode("a ")) - len(encode("a"))
        super().__init__(frequent | {"": end})
        self.encode, self.frequent, self.limit = encode, dict(self), limit

    def __missing__(self, unit: str) -> int:
        n = len(self.encode(unit))
        if len(unit) <= LONGEST:
            if len(self) >= self.limit:
                self.clear()
                self.update(self.frequent)
            self[unit] = n
        return n

    def count(self, text: str) -> int:
        return sum(map(self.__getitem__, _units(text))) if text else 0


def _texts(batch: pa.RecordBatch) -> list[str]:
    return ["" if t is None else t for t in batch.column("text").to_pylist()]


def frequent_units(docs: DataFrame, text_col: str = "text", table_size: int = 65_536,
                   per_partition: int = 8_192) -> list[str]:
    """The pre-tokens that the partitions' summaries count most, at most ``table_size``."""
    room = 32 * per_partition

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in _texts(batch):
                if text:
                    seen.update(_units(text))
                    if len(seen) > room:
                        seen = Counter(dict(seen.most_common(room // 4)))
        best = [(u, n) for u, n in seen.most_common(per_partition) if 0 < len(u) <= LONGEST]
        yield pa.RecordBatch.from_pydict(
            {"unit": pa.array([u for u, _ in best], pa.string()),
             "n": pa.array([n for _, n in best], pa.int64())})

    summary = docs.select(F.col(text_col).alias("text")).mapInArrow(
        summarise, "unit string, n long")
    best = (summary.groupBy("unit").agg(F.sum("n").alias("n"))
            .orderBy(F.col("n").desc(), "unit").limit(table_size))
    return [r.unit for r in best.collect()]


_WORKER: dict[str, Lengths] = {}


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id",
                 text_col: str = "text", max_tokens: int = 4096, table_size: int = 65_536,
                 cache_size: int = 500_000) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document.

    ``model_path`` names a sentencepiece model on the driver; its bytes go to the executors.
    """
    import sentencepiece

    with open(model_path, "rb") as f:
        model = f.read()
    here = sentencepiece.SentencePieceProcessor(model_proto=model)
    units = frequent_units(docs, text_col, table_size)
    lengths = bytes(min(len(x), 255) for x in here.encode(units, num_threads=1)) if units else b""
    sent = docs.sparkSession.sparkContext.broadcast((model, units, lengths))
    key = f"{model_path}:{sent._jbroadcast.id()}" if hasattr(sent, "_jbroadcast") else model_path
    types = docs.select(F.col(id_col).alias("doc_id")).schema["doc_id"].dataType

    def lookup() -> Lengths:
        if key not in _WORKER:
            proto, frequent, counts = sent.value
            own = sentencepiece.SentencePieceProcessor(model_proto=proto)
            table = {u: n for u, n in zip(frequent, counts) if n < 255}
            _WORKER.clear()
            _WORKER[key] = Lengths(own.encode, table, cache_size + len(table))
        return _WORKER[key]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = lookup()
        for batch in batches:
            n = pa.array([table.count(t) for t in _texts(batch)], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), n],
                names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")
                       .alias("n_bytes"))
    out = rows.mapInArrow(count, f"doc_id {types.simpleString()}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > max_tokens)
