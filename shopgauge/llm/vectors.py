"""Near-duplicate vectors by a subspace pigeonhole join.

Two vectors link if their labels are equal and their cosine is at least ``least``, that is, if
their unit vectors lie within squared distance 2 - 2 * least. A fixed random rotation spreads that
distance evenly, and the rotated vector is split into blocks of ``block_dims`` dimensions. By the
pigeonhole principle a linked pair lies, in at least one block, within that block's share of the
squared distance (its share of the dimensions). So

1. copies (equal label and bytes) are first reduced to the one with the smallest id;
2. each block is range-joined by itself: a grid over its first ``grid_dims`` dimensions sends a
   vector to its home cell and, as a visitor, to every other cell its radius touches; in a cell,
   homes and visitors within the block's radius are candidates;
3. candidates are verified exactly, by the cosine of the original vectors in double precision. A
   pair counts in the first of its blocks that is within budget, so the union over blocks holds
   every pair once without a shuffle of pairs.

Links are counted and joined to forests inside the task: what leaves it is at most one count
and one tie for each row that came in, however many pairs a group of near copies has. A cell with
more than ``cell_rows`` homes is dealt over several tasks (homes by hash, visitors to each), so a
task holds a bounded number of homes and streams visitors past them.

Edge cases: vectors that are null, empty, zero or hold a null or non-finite component, and rows
with a null label, link with nothing; vectors of different length don't link; rows that share an id
are one node; a null id is its own component (null) and kept; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored
from .components import components
from .forest import Forest, matrix, runs

_CHUNK = 2048


def _rotation(dims: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(20240229).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def _blocks(dims: int, block_dims: int) -> list[slice]:
    return [slice(a, min(a + block_dims, dims)) for a in range(0, dims, block_dims)]


def classes(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """id, label and, for vectors that can link, the key of their class of copies and their packed
    components: in single precision if they come so, which loses nothing, else in double."""
    dtype = np.float32 if _is_float(vectors, vector_col) else np.float64
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(label_col).cast("string").alias("label"),
                          F.col(vector_col).cast("array<double>").alias("vector"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, packed = [], []
            for label, v in zip(batch.column("label").to_pylist(), batch.column("vector")):
                key = data = None
                if label is not None and v.is_valid and len(v.values) and not v.values.null_count:
                    x = v.values.to_numpy()
                    if np.isfinite(x).all() and x.any():
                        data = (x + 0.0).astype(dtype).tobytes()
                        key = hashlib.sha1(label.encode() + b"\0" + data).digest()
                keys.append(key)
                packed.append(data)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(keys, pa.binary()),
                 pa.array(packed, pa.binary())], names=["vec_id", "label", "key", "vector"])

    return rows.mapInArrow(pack, "vec_id long, label string, key binary, vector binary")


def _is_float(vectors: DataFrame, vector_col: str) -> bool:
    kind = vectors.select(F.col(vector_col).alias("v")).schema["v"].dataType
    return isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)


def _unit(x: np.ndarray) -> np.ndarray:
    """Unit vectors, scaled first so that no square overflows or vanishes."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _homes(block_dims: int, grid_dims: int, width: float, dtype: type):
    """The home cells alone: (label, cell) of each row and block."""
    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(r) for r in batch.column("vector").to_pylist()])
            for size in np.unique(sizes):
                own = batch.take(pa.array(np.flatnonzero(sizes == size)))
                turned = _turned(own.column("vector"), dtype)
                dims = turned.shape[1]
                for b, at in enumerate(_blocks(dims, block_dims)):
                    home = np.floor(turned[:, at][:, :grid_dims] / width).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [own.column("label"), pa.array(_names(dims, b, home))],
                        names=["label", "cell"])
    return homes


def _turned(vectors: pa.Array, dtype: type) -> np.ndarray:
    raw = matrix(vectors, dtype).astype(np.float64)
    return _unit(raw) @ _rotation(raw.shape[1])


def _names(dims: int, block: int, cells: np.ndarray) -> list[str]:
    return [f"{dims}:{block}:{':'.join(map(str, c))}" for c in cells.tolist()]


def _deal(block_dims: int, grid_dims: int, width: float, distance: float, dtype: type):
    """Rows for the cells: one home row for each block, visitor rows for the other cells."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(r) for r in batch.column("vector").to_pylist()])
            for size in np.unique(sizes):
                own = batch.take(pa.array(np.flatnonzero(sizes == size)))
                turned = _turned(own.column("vector"), dtype)
                dims = turned.shape[1]
                for b, at in enumerate(_blocks(dims, block_dims)):
                    radius = np.sqrt(distance * (at.stop - at.start) / dims) * (1 + 1e-6)
                    y = turned[:, at][:, :grid_dims]
                    home = np.floor(y / width).astype(np.int64)
                    low = np.floor((y - radius) / width).astype(np.int64)
                    high = np.floor((y + radius) / width).astype(np.int64)
                    spans = high - low
                    for step in product(*(range(int(s) + 1) for s in spans.max(0))):
                        cell = low + np.array(step)
                        hit = np.flatnonzero((cell <= high).all(1))
                        if not len(hit):
                            continue
                        cell, visit = cell[hit], (cell[hit] != home[hit]).any(1)
                        part = own.take(pa.array(hit))
                        yield pa.RecordBatch.from_arrays(
                            [part.column("vec_id"), part.column("label"), part.column("copies"),
                             part.column("vector"),
                             pa.array(np.full(len(hit), b), pa.int32()),
                             pa.array(_names(dims, b, cell)), pa.array(visit)],
                            names=["vec_id", "label", "copies", "vector", "block", "cell",
                                   "visit"])

    return deal


def _join(block_dims: int, least: float, distance: float, dtype: type):
    """Links inside one cell: counts and ties."""
    def compare(home, other, same: bool, counts: dict, ties: dict) -> None:
        ids, copies, raw, turned, block = home
        o_ids, o_copies, o_raw, o_turned, _ = other
        dims = turned.shape[1]
        spans = _blocks(dims, block_dims)
        shares = [distance * (s.stop - s.start) / dims * (1 + 1e-6) for s in spans]
        at = spans[block]
        x, y = turned[:, at], o_turned[:, at]
        near = ((x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * (x @ y.T)) <= \
            shares[block] + 1e-12
        i, j = np.nonzero(near)
        # Each pair once: as home and visitor (or two homes) in the order of their ids.
        once = ids[i] < o_ids[j]
        i, j = i[once], j[once]
        for a in range(0, len(i), 1 << 16):
            p, q = i[a:a + (1 << 16)], j[a:a + (1 << 16)]
            u, v = raw[p], o_raw[q]
            cosine = (u * v).sum(1) / np.sqrt((u * u).sum(1) * (v * v).sum(1))
            link = cosine >= least
            p, q = p[link], q[link]
            gap = (turned[p] - o_turned[q]) ** 2
            first = np.ones(len(p), bool)
            for s, share in zip(spans[:block], shares):
                first &= gap[:, s].sum(1) > share
            p, q = p[first], q[first]
            for own, add in ((ids[p], o_copies[q]), (o_ids[q], copies[p])):
                names, where = np.unique(own, return_inverse=True)
                for n, c in zip(names.tolist(), np.bincount(where, add).tolist()):
                    counts[n] = counts.get(n, 0) + int(c)
            for n, m in zip(ids[p].tolist(), o_ids[q].tolist()):
                _tie(ties, n, m)

    def load(batch: pa.RecordBatch):
        raw = matrix(batch.column("vector"), dtype).astype(np.float64)
        raw = raw / np.abs(raw).max(1, keepdims=True)
        return (batch.column("vec_id").to_numpy(), batch.column("copies").to_numpy(), raw,
                _unit(raw) @ _rotation(raw.shape[1]), batch.column("block")[0].as_py())

    def rows(counts: dict, ties: dict) -> Iterator[pa.RecordBatch]:
        stars = [(n, r) for n in ties if (r := _top(ties, n)) != n]
        if counts:
            yield pa.RecordBatch.from_pydict({
                "a": pa.array([*counts, *(n for n, _ in stars)], pa.int64()),
                "b": pa.array([None] * len(counts) + [r for _, r in stars], pa.int64()),
                "n": pa.array([*counts.values(), *([0] * len(stars))], pa.int64())})

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        homes: list = []
        counts: dict = {}
        ties: dict = {}
        for _, batch, new in runs(batches, "group"):
            if new:
                yield from rows(counts, ties)
                homes, counts, ties = [], {}, {}
            visit = batch.column("visit").to_numpy(zero_copy_only=False)
            for flag in (False, True):  # homes are sorted before visitors
                some = batch.filter(pa.array(visit == flag))
                for a in range(0, some.num_rows, _CHUNK):
                    now = load(some.slice(a, _CHUNK))
                    for home in homes:
                        compare(home, now, False, counts, ties)
                        if not flag:
                            compare(now, home, False, counts, ties)
                    if not flag:
                        compare(now, now, True, counts, ties)
                        homes.append(now)
        yield from rows(counts, ties)

    return join


def _top(ties: dict, n: int) -> int:
    while (up := ties.get(n, n)) != n:
        ties[n] = ties.get(up, up)
        n = up
    return n


def _tie(ties: dict, n: int, m: int) -> None:
    a, b = _top(ties, n), _top(ties, m)
    if a != b:
        ties[max(a, b)] = min(a, b)
    ties.setdefault(min(a, b), min(a, b))


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label", least: float = 0.98, block_dims: int = 8,
                 grid_dims: int = 2, width: float = 0.25, cell_rows: int = 8192) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector."""
    distance = 2 - 2 * least
    packed = classes(vectors, id_col, vector_col, label_col)
    all_rows = stored(packed.select("vec_id", "key"), "vec-rows")
    copies = stored(packed.filter("key is not null and vec_id is not null").groupBy("key").agg(
        F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"),
        F.first("label").alias("label"), F.first("vector").alias("vector")), "vec-classes")

    dtype = np.float32 if _is_float(vectors, vector_col) else np.float64
    dealt = copies.select("vec_id", "label", "copies", "vector").mapInArrow(
        _deal(block_dims, grid_dims, width, distance, dtype),
        "vec_id long, label string, copies long, vector binary, block int, cell string, "
        "visit boolean")
    homes = copies.select("label", "vector").mapInArrow(
        _homes(block_dims, grid_dims, width, dtype), "label string, cell string")
    crowded = stored(homes.groupBy("label", "cell").count()
                     .filter(F.col("count") > cell_rows)
                     .select("label", "cell", F.ceil(F.col("count") / cell_rows).alias("salts")),
                     "vec-crowded")
    spread = dealt.join(crowded, ["label", "cell"], "left").withColumn(
        "salts", F.coalesce("salts", F.lit(1)).cast("int"))
    # Homes of a crowded cell are dealt by hash; everyone there visits the other parts.
    own = F.pmod(F.xxhash64("vec_id"), F.col("salts")).cast("int")
    spread = (spread.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
              .withColumn("visit", F.col("visit") | (F.col("salt") != own)))
    grouped = (spread.withColumn("group", F.xxhash64("label", "cell", "salt"))
               .repartition("group").sortWithinPartitions("group", "visit")
               .select("group", "vec_id", "copies", "vector", "block", "visit"))
    found = stored(grouped.mapInArrow(_join(block_dims, least, distance, dtype),
                                      "a long, b long, n long"), "vec-links")

    links = found.filter("b is null").groupBy("a").agg(F.sum("n").alias("far"))
    labels = components(found.filter("b is not null").select("a", "b"))
    of_class = (copies.select("key", F.col("vec_id").alias("rep"), "copies")
                .join(links, F.col("rep") == F.col("a"), "left")
                .join(labels, F.col("rep") == F.col("node"), "left")
                .select("key", (F.col("copies") - 1 + F.coalesce("far", F.lit(0))).alias("n_links"),
                        F.coalesce("component", "rep").alias("component")))
    out = all_rows.join(of_class, "key", "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    return out.select(
        "vec_id", F.when(F.col("vec_id").isNotNull(), F.coalesce("n_links", F.lit(0)))
        .otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
