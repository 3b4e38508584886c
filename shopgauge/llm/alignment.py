"""Alignment of two tokenizers by pointer jumping, with corpus-wide counts of aligned id pairs.

Both tokenizers encode a text to tokens that lie end to end over the same bytes, a space and the
text. Tokens of the two sides that share bytes are linked; groups are cut where both sides end a
token.

* **Groups.** Every token points to its farthest-right overlapping token: the one of the other
  side that holds its last byte, if that one ends later (a token of side A also goes to one that
  ends with it), else to itself. The successors are doubled (``next = next[next]``) over all tokens
  of many texts at once until nothing moves; then each token names the last token of its group. A
  group of n tokens needs about log2 n doublings.
* **Counts.** A pair's count is the number of documents that hold it linked. Every document's
  distinct pairs and their numbers are stored once, and Spark adds the pairs up, partially in each
  task.
* **Counts back to documents**, in two tiers: the ``frequent`` pairs of the highest counts are
  broadcast, a table of fixed size; a document's other pairs, each rarer than all of those, meet
  their counts in a join. No pair is hot there. Whatever the table holds, results are the same.

Side A is a byte-level BPE of the tokenizers library without a normalizer. If its merges are
numbered in order, the same vocabulary drives tiktoken, which is some times faster; otherwise the
library encodes. Side B is a sentencepiece model, which puts the space before the text itself.
Special tokens' strings in texts are plain text on both sides.

Edge cases: a null or empty text, or one whose joined tokens of a side differ from a space and the
text, has no tokens: zeros, and '' for the digest; rows that share an id are documents of their
own; null ids are ids; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .token_files import _MARKS

_BYTES = 1 << 21  # of texts that are aligned together, but for a single longer one
# The byte-level pre-token pattern of the vocabulary's library, in order.
_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


class ByteLevel:
    """Ids of a byte-level BPE, and the bytes of every id."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        model = json.loads(definition)["model"]
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = True
        pre = self.tokenizer.pre_tokenizer
        if type(pre).__name__ != "ByteLevel" or self.tokenizer.normalizer is not None:
            raise ValueError("side A must be a byte-level BPE without a normalizer")
        byte = {c: b for b, c in _MARKS.items()}
        vocab = model["vocab"]
        self.pieces = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            if all(c in byte for c in token):
                self.pieces[i] = bytes(byte[c] for c in token)
        merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "")
                  for m in model["merges"]]
        order = [vocab.get(m, -1) for m in merges]
        self.fast = None
        if (order == sorted(set(order)) and -1 not in order and pre.use_regex
                and not pre.add_prefix_space and not model.get("dropout")
                and not model.get("ignore_merges")):
            import tiktoken

            ranks = {bytes([byte[c]]): vocab[c] for c in byte if c in vocab}
            ranks |= {self.pieces[i]: i for i in order}
            if len(ranks) == 256 + len(order) and max(ranks[bytes([b])] for b in range(256)) < order[0]:
                self.fast = tiktoken.Encoding("side-a", pat_str=_PATTERN, mergeable_ranks=ranks,
                                              special_tokens={})

    def encode(self, text: str) -> list[int]:
        if self.fast is not None:
            return self.fast.encode_ordinary(text)
        return self.tokenizer.encode(text, add_special_tokens=False).ids


class Pieces:
    """Ids of a sentencepiece model, and the bytes of every id."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pieces = [
            b"" if self.model.is_control(i) or self.model.is_unknown(i)
            else bytes([int(self.model.id_to_piece(i)[3:5], 16)]) if self.model.is_byte(i)
            else self.model.id_to_piece(i).replace("▁", " ").encode()
            for i in range(self.model.vocab_size())]

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


def last_of_group(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """For every token, side A's and then side B's, the place of its group's last token (of side
    B) among side B's. The ends cover the same bytes; both sides end together at the last."""
    n = len(ends_a)
    over_a = np.searchsorted(ends_b, ends_a)  # the B token that holds an A token's last byte
    over_b = np.searchsorted(ends_a, ends_b)
    at = np.arange(len(ends_b))
    after = np.concatenate([n + over_a, np.where(ends_a[over_b] > ends_b, over_b, n + at)])
    while True:
        further = after[after]
        if np.array_equal(further, after):
            return after - n
        after = further


class Aligner:
    """Two encoders, and tables over their ids."""

    def __init__(self, a: ByteLevel, b: Pieces):
        self.a, self.b = a, b
        self.size_a = np.array([len(p) for p in a.pieces])
        self.size_b = np.array([len(p) for p in b.pieces])
        self.n_b = len(b.pieces)
        # Decimal ids behind each separator: A after A, A that opens a group, B after B, first B.
        names = [*([f"{mark}{i}".encode() for i in range(len(p))]
                   for p, marks in ((a.pieces, ",;"), (b.pieces, ",|")) for mark in marks)]
        self.names = [x for part in names for x in part]
        self.offset = np.cumsum([0, len(names[0]), len(names[1]), len(names[2])])

    def ids(self, text: str | None) -> tuple[list[int], list[int]]:
        """Both sides' ids; none if a side does not give the bytes back."""
        if not text:
            return [], []
        whole = " " + text
        want = whole.encode()
        a, b = self.a.encode(whole), self.b.encode(text)
        if (b"".join(map(self.a.pieces.__getitem__, a)) != want
                or b"".join(map(self.b.pieces.__getitem__, b)) != want):
            return [], []
        # An id without bytes (an unknown or control piece) cannot be aligned.
        return a, b

    def align(self, texts: list[str | None]) -> dict[str, list]:
        """Per text: n_a, n_b, n_groups, n_links, groups (the digest's text, in ASCII), and the
        distinct pairs (A id times side B's number of ids, plus B id) with their numbers."""
        found = [self.ids(t) for t in texts]
        n_a, n_b = (np.array([len(f[k]) for f in found], np.int64) for k in (0, 1))
        a = np.fromiter((i for f in found for i in f[0]), np.int64, n_a.sum())
        b = np.fromiter((i for f in found for i in f[1]), np.int64, n_b.sum())
        none = np.zeros(len(texts), np.int64)
        if not len(a):
            return {"n_a": n_a, "n_b": n_b, "n_groups": none, "n_links": none,
                    "groups": [b""] * len(texts), "pairs": np.empty(0, np.int64),
                    "counts": np.empty(0, np.int64), "ends": np.r_[0, none]}
        owner_a, owner_b = (np.repeat(np.arange(len(texts)), n) for n in (n_a, n_b))
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        last = last_of_group(ends_a, ends_b)
        group = np.unique(last[len(a):], return_inverse=True)[1]  # side B's group numbers
        group_a = group[last[:len(a)]]
        n_groups = np.bincount(owner_b[np.r_[np.diff(group) > 0, True]], minlength=len(texts))

        # Links: from the B token that holds an A token's first byte to that with its last.
        first = np.searchsorted(ends_b, ends_a - self.size_a[a], "right")
        n = np.searchsorted(ends_b, ends_a) - first + 1
        left = np.repeat(np.arange(len(a)), n)
        right = np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
        owner = owner_a[left]
        pair = a[left] * self.n_b + b[right]
        order = np.lexsort((pair, owner))
        owner, pair = owner[order], pair[order]
        new = np.flatnonzero(np.r_[True, (np.diff(pair) != 0) | (np.diff(owner) != 0)])
        ends = np.r_[0, np.cumsum(np.bincount(owner[new], minlength=len(texts)))]
        return {"n_a": n_a, "n_b": n_b, "n_groups": n_groups,
                "n_links": np.bincount(owner, minlength=len(texts)),
                "groups": self._groups(a, b, group_a, group, n_a + n_b),
                "pairs": pair[new], "counts": np.diff(np.r_[new, len(pair)]), "ends": ends}

    def _groups(self, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray,
                sizes: np.ndarray) -> list[bytes]:
        """Group by group side A's ids, then side B's, each behind its separator."""
        many_a, many_b = np.bincount(group_a), np.bincount(group_b)
        start = np.cumsum(many_a + many_b) - many_a - many_b
        rank_a = np.arange(len(a)) - (np.cumsum(many_a) - many_a)[group_a]
        rank_b = np.arange(len(b)) - (np.cumsum(many_b) - many_b)[group_b]
        name = np.empty(len(a) + len(b), np.int64)
        name[start[group_a] + rank_a] = a + self.offset[(rank_a == 0).astype(int)]
        name[start[group_b] + many_a[group_b] + rank_b] = b + self.offset[2 + (rank_b == 0)]
        names, at, out = list(map(self.names.__getitem__, name.tolist())), 0, []
        for size in sizes.tolist():
            out.append(b"".join(names[at:at + size])[1:])
            at += size
        return out


def _parts(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Stretches of texts of about _BYTES together."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += 4 * len(text or "")
        if size >= _BYTES:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


_WORKER: dict[tuple, Aligner] = {}


def _aligned(sent, key: tuple):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _WORKER:
            definition, model = sent.value
            _WORKER.clear()
            _WORKER[key] = Aligner(ByteLevel(definition), Pieces(model))
        align = _WORKER[key].align
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, j in _parts(texts):
                got = align(texts[i:j])
                ends = pa.array(got["ends"], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc").slice(i, j - i),
                     *(pa.array(got[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")),
                     pa.array([hashlib.sha256(g).hexdigest() if g else "" for g in got["groups"]]),
                     pa.ListArray.from_arrays(ends, pa.array(got["pairs"], pa.int64())),
                     pa.ListArray.from_arrays(ends, pa.array(got["counts"], pa.int32()))],
                    names=["doc", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs",
                           "counts"])
    return rows


def _first_tier(sent):
    """The frequent pairs' sums, and the pairs that the table lacks."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n_docs, top = (np.frombuffer(x, t) for x, t in zip(sent.value, ("<i8", "<i8", "?")))
        for batch in batches:
            ends = batch.column("pairs").offsets.to_numpy()
            code = batch.column("pairs").values.to_numpy()[ends[0]:ends[-1]]
            times = batch.column("counts").values.to_numpy()[
                batch.column("counts").offsets[0].as_py():][:len(code)].astype(np.int64)
            ends = ends - ends[0]
            owner = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            at = np.minimum(np.searchsorted(pairs, code), max(0, len(pairs) - 1))
            hit = pairs[at] == code if len(pairs) else np.zeros(len(code), bool)
            total, best = (np.zeros(batch.num_rows, np.int64) for _ in range(2))
            np.add.at(total, owner[hit], times[hit] * n_docs[at[hit]])
            np.add.at(best, owner[hit], times[hit] * top[at[hit]])
            miss = np.r_[0, np.cumsum(np.bincount(owner[~hit], minlength=batch.num_rows))]
            rest = pa.StructArray.from_arrays([pa.array(code[~hit]), pa.array(times[~hit])],
                                              names=["pair", "times"])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("row", "doc", "n_a", "n_b", "n_groups", "n_links",
                                             "groups_sha256")),
                 pa.array(best), pa.array(total),
                 pa.ListArray.from_arrays(pa.array(miss, pa.int32()), rest)],
                names=["row", "doc", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best",
                       "count_sum", "rest"])
    return rows


def align_documents(docs: DataFrame, byte_level_path: str, pieces_path: str,
                    id_col: str = "doc_id", text_col: str = "text",
                    frequent: int = 1 << 20) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) and pairs
    (a_id, b_id, n_docs, best: is n_docs the highest of this A id)."""
    spark = docs.sparkSession
    with open(byte_level_path, encoding="utf-8") as f:
        definition = f.read()
    with open(pieces_path, "rb") as f:
        model = f.read()
    n_b = len(Pieces(model).pieces)
    sent = spark.sparkContext.broadcast((definition, model))
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    kind = texts.schema["doc"].dataType.simpleString()
    numbers = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
    aligned = stored(
        texts.mapInArrow(_aligned(sent, (byte_level_path, pieces_path)),
                         f"doc {kind}, {numbers}, pairs array<long>, counts array<int>")
        .withColumn("row", F.monotonically_increasing_id()), "aligned", compression="zstd")

    n_docs = (aligned.select(F.explode("pairs").alias("pair")).groupBy("pair")
              .agg(F.count(F.lit(1)).alias("n_docs")))
    n_docs = stored(n_docs.withColumn("a_id", F.expr(f"pair div {n_b}")), "pair-counts")
    highest = n_docs.groupBy("a_id").agg(F.max("n_docs").alias("most"))  # one row for each A id
    counts = stored(n_docs.join(highest, "a_id").select(
        "pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best")), "pairs")

    table = (counts.orderBy(F.col("n_docs").desc(), "pair").limit(frequent)
             .toArrow().sort_by("pair"))
    hot = spark.sparkContext.broadcast(tuple(
        table.column(c).to_numpy().astype(t).tobytes()
        for c, t in (("pair", "<i8"), ("n_docs", "<i8"), ("best", "?"))))
    first = stored(aligned.mapInArrow(
        _first_tier(hot), f"row long, doc {kind}, {numbers}, n_best long, count_sum long, "
                          "rest array<struct<pair: long, times: long>>"), "first-tier")
    rest = (first.select("row", F.inline("rest")).join(counts, "pair").groupBy("row")
            .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(F.lit(0).cast("long")))
                 .alias("more_best"),
                 F.sum(F.col("times") * F.col("n_docs")).alias("more")))
    out = first.join(rest, "row", "left").select(
        F.col("doc").alias(id_col), "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0).cast("long"))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", F.lit(0).cast("long"))).alias("count_sum"),
        "groups_sha256")
    return out, counts.select(F.expr(f"cast(pair div {n_b} as int)").alias("a_id"),
                              F.expr(f"cast(pair % {n_b} as int)").alias("b_id"), "n_docs", "best")
