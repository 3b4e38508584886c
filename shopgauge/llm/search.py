"""Ranked lexical search by the Best Position Algorithm over impact-ordered lists.

A query set is answered in blocks of items, each block against all documents. Of every text the
terms of the block are counted once and stored with the text's length; N, L and the document
frequencies are sums over that table. Then each task ranks its part of the documents, some
thousand at a time, and hands on the ``k`` best of each item.

Within such a shard every term has a list of its documents by falling impact, the share of the
score that does not depend on the term's weight, and a direct-access table from document to place
in the list. All lists of an item are read from the top in steps. A document that turns up is
looked up in the other lists at once, which scores it in full and marks its place there as seen.
The best position of a list is the last place before which all are seen; no unseen document can
score more than the weighted impacts at the best positions together. Reading stops when that sum
is strictly below the kth score found so far, by this shard or by an earlier one of the same task:
at equality an unseen document could tie and win by its id.

Scores are 64-bit integers; ranks go by score, then ascending document id, ids that are null last.

Edge cases: a null or empty text has no terms and is neither counted nor found, nor does such an
item find anything; rows that share an id are documents of their own and may both be found, items
likewise; an empty table on either side gives no rows; other columns are not read. Memory is
bounded by the shard (``_TABLE`` places) and the block, whatever the data: an item of very many
terms gets a block of its own and smaller shards.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

_BLOCK_TERMS, _BLOCK_ITEMS = 8_192, 1_024
_TABLE = 1 << 25  # places in a shard's direct-access table
_SHARD = 4_096  # documents in a shard at most
_ROOM = 1 << 22  # postings in a shard at most, but for a single document
# ASCII letters, digits and all bytes above ASCII make terms; only A-Z are lower-cased.
_TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order, in UTF-8."""
    return text.encode().translate(_TERM_BYTES).split() if text else []


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sorted(set(terms(t))) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("item"), pa.array(found, pa.list_(pa.binary()))],
            names=["item", "terms"])


def _blocks(items: DataFrame) -> Iterator[list[tuple[int, list[bytes]]]]:
    """Items in blocks of bounded numbers of items and terms, one block at the driver at a time."""
    block, known = [], set()
    for row in items.toLocalIterator():
        own = [bytes(t) for t in row.terms]
        if block and (len(block) >= _BLOCK_ITEMS or len(known.union(own)) > _BLOCK_TERMS):
            yield block
            block, known = [], set()
        block.append((row.row, own))
        known.update(own)
    if block:
        yield block


def _postings(vocabulary: dict[bytes, int]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ids, counts, ends = [], [], [], [0]
            for text in batch.column("text").to_pylist():
                all_terms = terms(text)
                found = Counter(all_terms)
                for term in found.keys() & vocabulary.keys():
                    ids.append(vocabulary[term])
                    counts.append(found[term])
                sizes.append(len(all_terms))
                ends.append(len(ids))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(ends, pa.array(ids, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64()))],
                names=["doc", "n", "ids", "tfs"])
    return rows


def impacts(tf: np.ndarray, n: np.ndarray, all_docs: int, all_terms: int) -> np.ndarray:
    """A posting's score share before the term's weight."""
    m = 100 - 90 + (90 * n * all_docs) // all_terms
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Shard:
    """Impact-ordered lists of some documents, with direct access by document."""

    def __init__(self, n_docs: int, doc: np.ndarray, term: np.ndarray, impact: np.ndarray,
                 n_terms: int):
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact, term = doc[order], impact[order], term[order]
        self.start = np.searchsorted(term, np.arange(n_terms + 1))
        self.place = np.full((n_terms, n_docs), -1, np.int32)  # direct access: document to place
        self.place[term, self.doc] = np.arange(len(term)) - self.start[term]
        self.n_docs = n_docs

    def best(self, own: np.ndarray, weight: np.ndarray, k: int,
             least: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Every document that can be among the k best, with its score; ``least``: the kth score
        that is known from elsewhere, 0 if none. Third: number of documents looked up."""
        size = self.start[own + 1] - self.start[own]
        own, weight, size = own[size > 0], weight[size > 0], size[size > 0]
        start = self.start[own]
        base = np.r_[0, np.cumsum(size)]  # places of all the item's lists, end to end
        seen = np.zeros(base[-1], bool)
        best = np.zeros(len(own), np.int64)  # number of places seen without a gap
        known = np.zeros(self.n_docs, bool)
        docs, scores, kth = [], [], least
        depth, step = 0, 16
        while len(own) and depth < size.max():
            read = np.concatenate([self.doc[s + depth:s + min(depth + step, n)]
                                   for s, n in zip(start, size) if depth < n])
            read = np.unique(read[~known[read]])
            known[read] = True
            depth, step = depth + step, min(2 * step, 1024)
            if len(read):
                place = self.place[own[:, None], read]
                at_list, at_doc = np.nonzero(place >= 0)
                place = place[at_list, at_doc]
                seen[base[at_list] + place] = True
                score = np.zeros(len(read), np.int64)
                np.add.at(score, at_doc, weight[at_list] * self.impact[start[at_list] + place])
                docs.append(read)
                scores.append(score)
                if sum(map(len, docs)) >= k:
                    kept = np.concatenate(scores)
                    kth = max(least, int(np.partition(kept, len(kept) - k)[len(kept) - k]))
            for i in range(len(own)):
                gap = seen[base[i] + best[i]:base[i + 1]]
                best[i] += len(gap) if gap.all() else int(gap.argmin())
            open_lists = best < size
            bound = int((weight * self.impact[start + np.maximum(best, 1) - 1])[open_lists].sum())
            if bound < kth or not open_lists.any():
                break
        if not docs:
            return np.empty(0, np.int64), np.empty(0, np.int64), 0
        docs, scores = np.concatenate(docs), np.concatenate(scores)
        fit = (scores > 0) & (scores >= kth)
        return docs[fit], scores[fit], len(docs)


def _ranked(items: list[tuple[int, np.ndarray, np.ndarray]], n_terms: int, all_docs: int,
            all_terms: int, k: int):
    most = max(1, min(_SHARD, _TABLE // max(1, n_terms)))

    def shard_of(held: list[tuple]) -> tuple[Shard, list]:
        doc_ids = [x[0] for x in held]
        sizes = np.array([len(x[2]) for x in held])
        doc = np.repeat(np.arange(len(held)), sizes)
        n = np.repeat(np.array([x[1] for x in held], np.int64), sizes)
        tf = np.concatenate([x[3] for x in held])
        return Shard(len(held), doc, np.concatenate([x[2] for x in held]),
                     impacts(tf, n, all_docs, all_terms), n_terms), doc_ids

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top: dict[int, list] = {i: [] for i, _, _ in items}
        held, room = [], 0

        def flush():
            shard, doc_ids = shard_of(held)
            for item, own, weight in items:
                best = top[item]
                least = best[-1][0] if len(best) == k else 0
                docs, scores, _ = shard.best(own, weight, k, least)
                best += [(s, doc_ids[d]) for d, s in zip(docs.tolist(), scores.tolist())]
                best.sort(key=lambda x: (-x[0], x[1] is None, x[1]))
                del best[k:]

        for batch in batches:
            flat = [(batch.column(c).offsets.to_numpy(), batch.column(c).values.to_numpy())
                    for c in ("ids", "tfs")]
            ends = flat[0][0]
            for i, (doc, n) in enumerate(zip(batch.column("doc").to_pylist(),
                                             batch.column("n").to_pylist())):
                a, b = ends[i], ends[i + 1]
                if a == b:
                    continue
                if held and (len(held) >= most or room + b - a > _ROOM):
                    flush()
                    held, room = [], 0
                held.append((doc, n, flat[0][1][a:b], flat[1][1][a:b]))
                room += b - a
        if held:
            flush()
        found = [(item, doc, score) for item, best in top.items() for score, doc in best]
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[j] for f in found], pa.int64()) for j in range(3)],
            names=["row", "doc_id", "score"])
    return rows


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", k: int = 10) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the k best documents of each item."""
    spark = docs.sparkSession
    named = items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))
    kind = named.schema["item"].dataType.simpleString()
    named = stored(named.mapInArrow(_item_terms, f"item {kind}, terms array<binary>")
                   .filter("size(terms) > 0")
                   .withColumn("row", F.monotonically_increasing_id()), "items")
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    parts = [_search_block(texts, block, k) for block in _blocks(named.orderBy("item", "row"))]
    if not parts:
        return spark.createDataFrame([], f"{item_col} {kind}, rank int, doc_id long, score long")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.join(named.select("row", F.col("item").alias(item_col)), "row").select(
        item_col, "rank", "doc_id", "score")


def _search_block(texts: DataFrame, block: list[tuple[int, list[bytes]]], k: int) -> DataFrame:
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, own in block for t in own}))}
    index = stored(texts.mapInArrow(_postings(vocabulary),
                                    "doc long, n long, ids array<int>, tfs array<long>"),
                   "postings")
    total = index.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    all_docs, all_terms = total[0], max(1, total[1])
    weight = np.zeros(len(vocabulary), np.int64)
    # One row for each term of the block at most.
    for row in index.select(F.explode("ids").alias("id")).groupBy("id").count().collect():
        weight[row["id"]] = math.floor(1000 * math.log((2 * all_docs + 2) / (2 * row["count"] + 1)))
    wanted = []
    for item, own in block:
        own = np.array([vocabulary[t] for t in own])
        own = own[weight[own] > 0]
        wanted.append((item, own, weight[own]))
    found = index.mapInArrow(_ranked(wanted, len(vocabulary), all_docs, all_terms, k),
                             "row long, doc_id long, score long")
    # The k best of each task, then of a number of tasks together, then of all.
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    found = found.withColumn("share", F.spark_partition_id() % 64)
    for keys in (("row", "share"), ("row",)):
        found = found.withColumn("rank", F.row_number().over(
            Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)
    return stored(found.select("row", "rank", "doc_id", "score"), "found")
