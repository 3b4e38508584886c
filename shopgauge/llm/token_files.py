"""Token ids as flat binary files with 64-bit document offsets.

Documents are range-partitioned and sorted by id; each partition writes

* ``part-NNNNN.ids``: its documents' ids end to end, unsigned 16-bit little-endian if the
  vocabulary fits, else 32-bit;
* ``part-NNNNN.idx``: the number of documents n, then n + 1 offsets (in ids, from the part's
  start), n document ids, all 64-bit little-endian, and n bytes that are 1 where an id is null.

One manifest row per part is stored beside them. A part's base in the whole sequence is the
prefix sum of the id counts of the parts before it. Readers memory-map the files.

Encoding: a byte-level BPE splits texts into pre-tokens before it merges, and a space between two
non-spaces always starts one. So a text is cut at such spaces and each cut is looked up in a
bounded worker cache; the library encodes what the cache lacks. Texts with other white space
around a space go to the library whole.

Edge cases: a null or empty text is the end id alone; rows that share an id stand together, ordered
by a hash of the text; null ids come first; an empty table writes no part and reads back empty.
Tasks can be repeated: they write the same bytes and rename them into place.
"""

from __future__ import annotations

import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files
from .common import stored

_PUNCTUATION = (".", ",")
_LAST_SIMPLE = "ԯ"  # Latin, Greek and Cyrillic letters that every Unicode table knows


def _byte_marks() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 characters stand for their own byte, the other
    bytes take the code points from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in own)
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


_MARKS = _byte_marks()


class _Whole(Exception):
    """The text can't be cut at this space."""


class Cuts(dict):
    """Packed ids of a cut of a text, without its leading space if ``lead`` is one.

    Two generations bound the memory: a full one becomes the old one, and what is asked for again
    comes back from there.
    """

    def __init__(self, owner: Encoder, lead: str):
        super().__init__()
        self.owner, self.lead, self.old = owner, lead, {}
        self.mark, self.merge, self.packed = lead.translate(_MARKS), owner.merge, owner.packed

    def __missing__(self, cut: str) -> bytes:
        ids = self.old.get(cut)
        if ids is None:
            if cut.isascii() and cut.isalpha():  # as in Encoder.letters, most misses by far
                packed = self.packed
                ids = b"".join([packed[t.id] for t in self.merge(self.mark + cut)])
            else:
                ids = self._ids(cut)
        if len(cut) <= 64:
            if len(self) >= self.owner.limit:
                self.old = dict(self)
                self.clear()
            self[cut] = ids
        return ids

    def _ids(self, cut: str) -> bytes:
        if cut[-1:] in _PUNCTUATION:
            # A mark behind a letter is a pre-token of its own, whatever stands before.
            ids = self.get(cut[:-1])
            if ids is not None and cut[-2:-1].isalpha():
                return ids + self.owner.first[cut[-1]]
            if self._simple(cut[:-1]):
                return self[cut[:-1]] + self.owner.first[cut[-1]]
        if self._simple(cut):
            return self.owner.letters(self.lead + cut)
        if not cut or cut[0].isspace() or cut[-1].isspace():
            raise _Whole
        if "\n" in cut:
            return self._lines(cut)
        return self.owner.library(self.lead + cut)

    @staticmethod
    def _simple(stem: str) -> bool:
        return stem.isalpha() and (stem.isascii() or max(stem) <= _LAST_SIMPLE)

    def _lines(self, cut: str) -> bytes:
        """A line break between two non-spaces is a pre-token of its own."""
        lines = cut.split("\n")
        if any(not x or x[0].isspace() or x[-1].isspace() for x in lines):
            raise _Whole
        first = self.owner.first
        return self.owner.newline.join([self[lines[0]], *(first[x] for x in lines[1:])])


class Encoder:
    """The tokenizers library behind a cache of cuts."""

    def __init__(self, definition: str, dtype: str, limit: int):
        from tokenizers import Tokenizer

        self.tokenizer, self.dtype, self.limit = Tokenizer.from_str(definition), dtype, limit
        self.code = "H" if dtype == "<u2" else "I"
        kind = type(self.tokenizer.pre_tokenizer).__name__
        # Cutting at spaces holds for byte-level pre-tokens without a normalizer only.
        self.cuttable = kind == "ByteLevel" and self.tokenizer.normalizer is None
        self.merge = self.tokenizer.model.tokenize
        # Every id as bytes; the vocabulary bounds the table.
        self.packed = [self._packed([i]) for i in range(self.tokenizer.get_vocab_size())]
        self.first, self.rest = Cuts(self, ""), Cuts(self, " ")
        self.newline = self.library("\n") if self.cuttable else b""

    def _packed(self, ids: list[int]) -> bytes:
        out = array(self.code, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def library(self, text: str) -> bytes:
        return self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def letters(self, word: str) -> bytes:
        """Letters after at most one space are one pre-token: straight to the library's model."""
        marked = word.encode().decode("latin-1").translate(_MARKS)
        return b"".join([self.packed[t.id] for t in self.merge(marked)])

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.cuttable:
            return self.library(text)
        cuts = text.split(" ")
        try:
            if len(cuts) == 1:
                return self.first[text]
            return self.first[cuts[0]] + b"".join(map(self.rest.__getitem__, cuts[1:]))
        except _Whole:
            return self.library(text)


_WORKER: dict[tuple, Encoder] = {}


def write_token_files(docs: DataFrame, tokenizer_path: str, folder: str, id_col: str = "doc_id",
                      text_col: str = "text", end_id: int = 0,
                      cache_size: int = 600_000) -> DataFrame:
    """Write all documents' ids below ``folder``; the stored manifest, one row per part."""
    from tokenizers import Tokenizer

    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    small = Tokenizer.from_str(definition).get_vocab_size() <= 1 << 16 and end_id < 1 << 16
    dtype = "<u2" if small else "<u4"
    sent = docs.sparkSession.sparkContext.broadcast(definition)
    key = (tokenizer_path, dtype, cache_size)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _WORKER:
            _WORKER.clear()
            _WORKER[key] = Encoder(sent.value, dtype, cache_size)
        encode, end = _WORKER[key].encode, np.array([end_id], dtype).tobytes()
        width, part = np.dtype(dtype).itemsize, files.partition_id()
        batch = next((b for b in batches if b.num_rows), None)
        if batch is None:
            return
        name = f"{folder}/part-{part:05d}"
        offsets, owners, nulls = [0], [], []
        with files.written(f"{name}.ids") as out:
            while batch is not None:
                for doc, text in zip(batch.column("doc_id").to_pylist(),
                                     batch.column("text").to_pylist()):
                    ids = encode(text or "") + end
                    out.write(ids)
                    offsets.append(offsets[-1] + len(ids) // width)
                    owners.append(0 if doc is None else doc)
                    nulls.append(doc is None)
                batch = next((b for b in batches if b.num_rows), None)
        with files.written(f"{name}.idx") as out:
            out.write(np.array([len(owners)], "<i8").tobytes())
            out.write(np.array(offsets, "<i8").tobytes())
            out.write(np.array(owners, "<i8").tobytes())
            out.write(np.array(nulls, "u1").tobytes())
        yield pa.RecordBatch.from_pydict(
            {"part": [part], "name": [name], "dtype": [dtype], "n_docs": [len(owners)],
             "n_ids": [offsets[-1]]})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("tie"))
    parts = (rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
             .select("doc_id", "text")
             .mapInArrow(write, "part long, name string, dtype string, n_docs long, n_ids long"))
    return stored(parts, "token-manifest")


def read_token_files(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """One row per document, in the files' order: doc_id, start, n_tokens, ids_crc32."""
    found, base = [], 0
    for r in manifest.orderBy("part").collect():  # one row for each file
        found.append((r["name"], r["dtype"], base))
        base += r["n_ids"]
    if not found:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, dtype, base in zip(*(batch.column(c).to_pylist()
                                           for c in ("name", "dtype", "base"))):
                yield from _documents(name, dtype, base)

    parts = spark.createDataFrame(found, "name string, dtype string, base long")
    return (parts.repartition(max(1, min(len(found), spark.sparkContext.defaultParallelism)),
                              "name")
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def _documents(name: str, dtype: str, base: int,
               rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    width = np.dtype(dtype).itemsize
    with files.opened(f"{name}.idx") as idx, files.opened(f"{name}.ids") as ids:
        n = int(np.frombuffer(idx.read_at(8, 0), "<i8")[0])
        for at in range(0, n, rows):
            k = min(rows, n - at)
            offsets = np.frombuffer(idx.read_at(8 * (k + 1), 8 + 8 * at), "<i8")
            owners = np.frombuffer(idx.read_at(8 * k, 8 * (n + 2 + at)), "<i8")
            nulls = np.frombuffer(idx.read_at(k, 8 * (2 * n + 2) + at), "u1").astype(bool)
            sums = [zlib.crc32(np.frombuffer(ids.read_at(int(b - a) * width, int(a) * width),
                                             dtype).astype("<u4").tobytes())
                    for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(owners, pa.int64(), mask=nulls), pa.array(offsets[:-1] + base),
                 pa.array(np.diff(offsets)), pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])
