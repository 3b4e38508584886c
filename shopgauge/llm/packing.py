"""Variable-capacity best-fit packing of documents into training sequences.

Documents are spread over tasks by a hash, only (id, length) rows move. Each task sorts a block of
at most ``block_items`` documents by falling length and places each into the open sequence with the
least room that holds it. If none does, a new sequence is opened, at the permitted length of least
cost for each word it can expect to hold: the document's and those that the shorter documents still
ahead can bring.

Which lengths to permit is decided jointly: the block is packed once for every set of lengths with
the longest in it. Every sequence is then downsized to the shortest length that holds its contents,
and the cheapest packing is kept.

The default cost of a sequence of c words is c * (1 + c / 4096): a training step's work has a part
that grows with the words and one that grows with their square, equal at 4,096 words. Under it short
sequences are cheaper for each word, so several lengths are opened; with a cost in proportion to the
length the longest is never worse.

A document longer than the longest sequence is cut into full pieces and a remainder; all pieces
are returned, so the pieces of a document cover it without gap or overlap.

Edge cases: a document without words (null or empty text) takes no room and is returned with a
null sequence; repeated rows are packed as often as they occur; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import files
from .common import n_words

CAPACITIES = (512, 768, 1024, 1536, 2048, 4096)
SCHEMA = ("doc_id long, piece long, piece_start long, n_words long, bin_id long, bin_start long, "
          "bin_capacity long, bin_used long")


def training_cost(c: int) -> float:
    """Work of a step over a sequence of c words, in words of a very short one."""
    return c * (1 + c / 4096)


class _Block:
    """The lengths of a block in falling order, and what is ahead of each place."""

    def __init__(self, lengths: list[int], capacities: tuple[int, ...],
                 cost: Callable[[int], float]):
        self.lengths, self.capacities, self.cost = lengths, capacities, cost
        self.falling = [-n for n in lengths]
        self.sum_from = [*accumulate(reversed(lengths), initial=0)][::-1]

    def final(self, used: int) -> int:
        """The shortest length that holds a sequence's words."""
        return self.capacities[bisect_left(self.capacities, used)]

    def open(self, at: int, sizes: tuple[int, ...]) -> int:
        """The size of least cost for each word it can expect, for the item at a place; the larger
        of equal ones."""
        n = self.lengths[at]

        def price(c: int) -> tuple[float, int]:
            # Items ahead that fit beside this one.
            fitting = max(at + 1, bisect_left(self.falling, n - c))
            fill = min(c, n + self.sum_from[fitting])
            return self.cost(self.final(fill)) / fill, -c
        return min((c for c in sizes if c >= n), key=price)

    def pack(self, sizes: tuple[int, ...]) -> tuple[list[int], list[int], list[int]]:
        """(bin of each item, offset in it, words of each bin) with these sizes permitted."""
        opened: list[int] = []
        used: list[int] = []
        bins, starts = [], []
        rooms: list[int] = []           # distinct rooms of open bins, rising
        by_room: dict[int, list[int]] = {}
        for at, n in enumerate(self.lengths):
            k = bisect_left(rooms, n)
            if k < len(rooms):
                room = rooms[k]
                b = by_room[room].pop()
                if not by_room[room]:
                    del by_room[room], rooms[k]
            else:
                b = len(opened)
                opened.append(self.open(at, sizes))
                used.append(0)
            bins.append(b)
            starts.append(used[b])
            used[b] += n
            room = opened[b] - used[b]
            if room:
                if room not in by_room:
                    by_room[room] = []
                    insort(rooms, room)
                by_room[room].append(b)
        return bins, starts, used


def best_fit(lengths: list[int], capacities: tuple[int, ...],
             cost: Callable[[int], float] = training_cost) -> tuple[list[int], list[int], list[int]]:
    """(bin of each item, offset in it, capacity of each bin) for lengths in falling order: the
    cheapest of the packings with every set of permitted sizes."""
    block, best = _Block(lengths, capacities, cost), None
    *others, longest = capacities
    for k in range(len(others) + 1):
        for some in combinations(others, k):
            bins, starts, used = block.pack((*some, longest))
            final = list(map(block.final, used))
            price = (sum(map(cost, final)), len(final))
            if best is None or price < best[0]:
                best = price, bins, starts, final
    return best[1:]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         length: Column | None = None, capacities: tuple[int, ...] = CAPACITIES,
         cost: Callable[[int], float] = training_cost, block_items: int = 50_000) -> DataFrame:
    """One row per piece of a document: where it lies in the document and in its sequence.

    ``length`` (default: words of the text) measures documents; ``cost`` prices a sequence of a
    given length (default: the work of a training step).
    """
    capacities = tuple(sorted(capacities))
    longest = capacities[-1]

    def one(ids: np.ndarray, sizes: np.ndarray, first: int) -> tuple[pd.DataFrame, int]:
        full, rest = sizes // longest, sizes % longest
        pieces = np.repeat(np.arange(len(ids)), full + (rest > 0))
        piece = np.arange(len(pieces)) - np.repeat(np.cumsum(full + (rest > 0))
                                                   - (full + (rest > 0)), full + (rest > 0))
        n = np.where(piece < full[pieces], longest, rest[pieces])
        order = np.lexsort((piece, ids[pieces], -n))
        pieces, piece, n = pieces[order], piece[order], n[order]
        bins, starts, final = best_fit(n.tolist(), capacities, cost)
        bins, final = np.array(bins, np.int64), np.array(final, np.int64)
        used = np.bincount(bins, n, len(final)).astype(np.int64)
        return pd.DataFrame({
            "doc_id": ids[pieces], "piece": piece, "piece_start": piece * longest, "n_words": n,
            "bin_id": bins + first, "bin_start": starts, "bin_capacity": final[bins],
            "bin_used": used[bins]}), first + len(final)

    def packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, held, count = files.partition_id() << 40, [], 0

        def flush() -> pd.DataFrame:
            nonlocal first, held, count
            rows = pd.concat(held)
            held, count = [], 0
            out, first = one(np.arange(len(rows)), rows["size"].to_numpy(), first)
            at = out["doc_id"].to_numpy()
            return out.assign(doc_id=rows["doc_id"].to_numpy()[at],
                              no_id=rows["no_id"].to_numpy()[at])

        for frame in frames:
            for at in range(0, len(frame), block_items):
                cut = frame.iloc[at:at + block_items]
                if count + len(cut) > block_items:
                    yield flush()
                held.append(cut)
                count += len(cut)
        if count:
            yield flush()

    size = n_words(F.col(text_col)) if length is None else length.cast("long")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(size, F.lit(0).cast("long")).alias("size"))
    spread = F.xxhash64("doc_id", "size")
    # pandas has no null in an integer column, so a flag carries it.
    some = (rows.filter("size > 0").repartition(spread)
            .sortWithinPartitions(spread, "doc_id")
            .select(F.coalesce("doc_id", F.lit(0).cast("long")).alias("doc_id"), "size",
                    F.col("doc_id").isNull().alias("no_id"))
            .mapInPandas(packed, SCHEMA + ", no_id boolean")
            .withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id"))).drop("no_id"))
    none = rows.filter("size <= 0").select(
        "doc_id", F.lit(0).cast("long").alias("piece"), F.lit(0).cast("long").alias("piece_start"),
        F.lit(0).cast("long").alias("n_words"),
        *[F.lit(None).cast("long").alias(c)
          for c in ("bin_id", "bin_start", "bin_capacity", "bin_used")])
    return some.unionByName(none)
