"""Near-duplicate documents by chosen-path set similarity search.

A document is its set of distinct word shingles; two link if their Jaccard similarity is at least
``least``. Steps:

1. Equal sets are reduced to one representative (the smallest id) by a grouped minimum, so copies
   never meet each other again.
2. Each representative gets a sketch: the low bytes of ``SKETCH`` minwise tokens. ``trees``
   independent trees branch on it recursively. A node of a tree chooses one sketch position, and
   a second one in a quarter of the cases (1 / 0.8 = 1.25 on average), by a hash of its path; the
   children are the values there. Two documents of similarity 0.8 share one child on average at
   every level, unlike ones hardly any, so branches keep similar documents together.
3. Nodes that hold a large share of all documents (more than ``1 / HEAVY`` of them, so their number
   is bounded for every tree and level) are found by counting and branch on the map side, before
   any row moves. There a document whose sketch all but equals the node's leader is tied to the
   leader and leaves the tree: whatever is similar to it is near the leader too, and is tied to it.
4. The remaining nodes are shuffled once and branch further inside a task, down to small nodes that
   are compared exhaustively by sketch. What leaves a task are ties (a forest), never all pairs.
5. Ties join documents to loose clusters (estimates, set well below ``least``). Only their members'
   full sets are gathered, once, cluster by cluster. There all links are verified on full sets
   with an inverted index: the similarities of one document to all others at once, until all that
   is left is one component, which needs no further look. Clusters with more than
   ``block_shingles`` shingles are dealt as pairs of blocks over many tasks.
6. Verified links are joined to components.

Sets are compared by 64-bit hashes of their shingles.

Edge cases: a text with fewer words than a shingle is one shingle of all its words; null texts and
texts without words have an empty set and link with nothing; rows that share an id are one node;
a null id is its own component (null) and kept; an empty table gives an empty result; other columns
are not read. Very long texts cost memory in proportion to their own set.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .components import components
from .forest import Forest, matrix, runs

SKETCH = 64
HEAVY = 1024
HEAVY_LEAST = 4096
DEPTH = 24
SMALL = 96
_LOOSE = 0.2        # an estimate this far below the wanted similarity still ties
_ABSORB = 0.92      # estimate from which a leader stands for a document
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Shingler(dict):
    """64-bit hashes of words in lower case (A-Z only), remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.translate(_LOWER))
        return h

    def shingles(self, text: str | None, size: int) -> np.ndarray:
        """Sorted distinct hashes of the word shingles of a text."""
        found = _WORDS.findall(text or "")
        if not found:
            return np.zeros(0, np.uint64)
        h = np.fromiter(map(self.__getitem__, found), np.uint64, len(found))
        k = min(size, len(h))
        out = h[:len(h) - k + 1].copy()
        for i in range(1, k):
            out = mix(out * _MIX + h[i:len(h) - k + 1 + i])
        # The number of words is part of it: a short text's one shingle is no other's.
        return np.unique(mix(out + np.uint64(k)))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


_SEEDS = np.random.default_rng(7).integers(1, 1 << 63, SKETCH, np.uint64) * np.uint64(2) + \
    np.uint64(1)


def sketch(shingles: np.ndarray) -> bytes:
    """The low byte of each of SKETCH minwise values of a set."""
    least = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        part = shingles[at:at + 4096, None] * _SEEDS
        least = np.minimum(least, ((part ^ (part >> np.uint64(31))) * _MIX).min(0))
    return mix(least).astype(np.uint8).tobytes()


# ---- sets and sketches ---------------------------------------------------------------------


def describe(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """doc_id, n_shingles, set_key (a digest of the set) and sketch of every document."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Shingler()
        for batch in batches:
            n, keys, sketches = [], [], []
            for text in batch.column("text").to_pylist():
                own = words.shingles(text, size)
                n.append(len(own))
                keys.append(hashlib.md5(own.tobytes()).digest() if len(own) else None)
                sketches.append(sketch(own) if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(sketches, pa.binary())],
                names=["doc_id", "n_shingles", "set_key", "sketch"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).alias("text")).mapInArrow(
        make, "doc_id long, n_shingles long, set_key binary, sketch binary")


# ---- chosen paths --------------------------------------------------------------------------


def roots(trees: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(1, trees + 1, dtype=np.uint64) * _MIX)


def children(node: np.ndarray, sketches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, child) for one or two children of each row's node: the values of its sketch at the
    positions that the node's hash chooses."""
    draw = mix(node ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    one = (draw % np.uint64(SKETCH)).astype(np.int64)
    # A second position differs from the first.
    two = (one + 1 + ((draw >> np.uint64(16)) % np.uint64(SKETCH - 1)).astype(np.int64)) % SKETCH
    more = np.flatnonzero((draw >> np.uint64(40)) % np.uint64(4) == 0)
    row = np.concatenate([np.arange(len(node)), more])
    at = np.concatenate([one, two[more]])
    value = sketches[row, at].astype(np.uint64)
    key = at.astype(np.uint64) * np.uint64(256) + value + np.uint64(1)
    return row, mix(node[row] * _MIX + key)


def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity: the share of equal sketch bytes, less what chance makes equal."""
    same = (a == b).mean(-1)
    return (same - 1 / 256) / (1 - 1 / 256)


class Heavy:
    """Nodes known to be heavy: sorted keys with their leader's id and sketch."""

    def __init__(self, rows: list):
        rows = sorted(rows, key=lambda r: r[0])
        self.keys = np.array([r[0] for r in rows], np.int64).view(np.uint64)
        order = np.argsort(self.keys)
        self.keys = self.keys[order]
        self.leader = np.array([r[1] for r in rows], np.int64)[order]
        self.sketch = (np.frombuffer(b"".join(bytes(r[2]) for r in rows), np.uint8)
                       .reshape(-1, SKETCH)[order] if rows else np.zeros((0, SKETCH), np.uint8))

    def find(self, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(is heavy, place) of each node."""
        if not len(self.keys):
            return np.zeros(len(node), bool), np.zeros(len(node), np.int64)
        place = np.minimum(np.searchsorted(self.keys, node), len(self.keys) - 1)
        return self.keys[place] == node, place


def descend(ids: np.ndarray, sketches: np.ndarray, trees: int, heavy: Heavy, loose: float):
    """Walks rows down through heavy nodes.

    Returns (row, node) of the rows that stand at nodes not known as heavy, their depth, and
    (leader, id) ties.
    """
    n = len(ids)
    row = np.tile(np.arange(n), trees)
    node = np.repeat(roots(trees), n)
    out, ties, depth = [], [], 1
    pick, node = children(node, sketches[row])
    row = row[pick]
    while len(row):
        is_heavy, place = heavy.find(node)
        if depth >= DEPTH:
            is_heavy[:] = False
        out.append((row[~is_heavy], node[~is_heavy], np.full((~is_heavy).sum(), depth)))
        row, node, place = row[is_heavy], node[is_heavy], place[is_heavy]
        if not len(row):
            break
        near = alike(sketches[row], heavy.sketch[place])
        tied = (near >= loose) & (ids[row] != heavy.leader[place])
        ties.append(np.stack([heavy.leader[place[tied]], ids[row[tied]]]))
        stay = (near < _ABSORB) | (ids[row] == heavy.leader[place])
        row, node = row[stay], node[stay]
        pick, node = children(node, sketches[row])
        row = row[pick]
        depth += 1
    row, node, at = (np.concatenate(x) for x in zip(*out))
    tie = np.concatenate(ties, axis=1) if ties else np.zeros((2, 0), np.int64)
    return row, node, at, np.unique(tie, axis=1)


def _load(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return (batch.column("doc_id").to_numpy(), matrix(batch.column("sketch"), np.uint8))


def heavy_nodes(reps: DataFrame, trees: int, n_docs: int, loose: float) -> Heavy:
    """All nodes with more than a 1 / HEAVY share of the documents, level by level.

    A level has at most n * trees * 1.25 ** level rows, so at most HEAVY * trees * 1.25 ** level
    heavy nodes; documents that their leader absorbs and dissimilar ones leave on the way, which
    keeps the deeper levels far below that.
    """
    most = max(HEAVY_LEAST, n_docs // HEAVY)
    known: list = []
    found = None
    sent = reps.sparkSession.sparkContext.broadcast
    for depth in range(1, DEPTH + 1):
        table = sent(Heavy(known))

        def count(batches, table=table, depth=depth):
            for batch in batches:
                if not batch.num_rows:
                    continue
                ids, sketches = _load(batch)
                row, node, at, _ = descend(ids, sketches, trees, table.value, loose)
                row, node = row[at == depth], node[at == depth]
                if not len(node):
                    continue
                order = np.lexsort((ids[row], node))
                row, node = row[order], node[order]
                first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
                n = np.diff(np.r_[first, len(node)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[first].view(np.int64)), pa.array(n),
                     pa.array(ids[row[first]]),
                     pa.array([sketches[i].tobytes() for i in row[first]], pa.binary())],
                    names=["node", "n", "doc_id", "sketch"])

        counts = reps.mapInArrow(count, "node long, n long, doc_id long, sketch binary")
        found = (counts.groupBy("node").agg(
            F.sum("n").alias("n"), F.min_by(F.struct("doc_id", "sketch"), "doc_id").alias("lead"))
            .filter(F.col("n") > most).select("node", "lead.doc_id", "lead.sketch").collect())
        if not found:
            break
        known += [tuple(r) for r in found]
    return Heavy(known)


def compare_small(ids: np.ndarray, sketches: np.ndarray, loose: float, forest: Forest,
                  rows: np.ndarray) -> None:
    """Ties all pairs of these rows whose estimate is at least ``loose``."""
    own = sketches[rows]
    need = loose * (1 - 1 / 256) + 1 / 256
    for a in range(0, len(rows), 256):
        same = (own[a:a + 256, None] == own[None, a:]).mean(-1)
        i, j = np.nonzero(np.triu(same >= need, 1))
        for p, q in zip(rows[a + i].tolist(), rows[a + j].tolist()):
            forest.tie(p, q)


def branch(ids: np.ndarray, sketches: np.ndarray, node: int, depth: int, loose: float,
           forest: Forest) -> None:
    """Recursive branching of one node's rows inside a task."""
    todo = [(np.arange(len(ids)), np.uint64(node), depth)]
    while todo:
        rows, node, depth = todo.pop()
        if len(rows) > SMALL:
            # The leader stands for rows that all but equal it, as in heavy nodes.
            near = alike(sketches[rows], sketches[rows[0]])
            for q in rows[(near >= loose)].tolist():
                forest.tie(int(rows[0]), q)
            stay = near < _ABSORB
            stay[0] = True
            rows = rows[stay]
        if len(rows) <= SMALL or depth >= DEPTH:
            compare_small(ids, sketches, loose, forest, rows)
            continue
        pick, child = children(np.full(len(rows), node), sketches[rows])
        order = np.argsort(child, kind="stable")
        pick, child = pick[order], child[order]
        first = np.flatnonzero(np.r_[True, child[1:] != child[:-1]])
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(child)]):
            if b - a > 1:
                todo.append((rows[pick[a:b]], child[a], depth + 1))


def loose_ties(reps: DataFrame, n_docs: int, least: float, trees: int) -> DataFrame:
    """(a, b) ties of documents that may be similar, found by all trees."""
    loose = least - _LOOSE
    table = reps.sparkSession.sparkContext.broadcast(heavy_nodes(reps, trees, n_docs, loose))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                part = batch.slice(a, 4096)
                ids, sketches = _load(part)
                row, node, at, ties = descend(ids, sketches, trees, table.value, loose)
                packed = part.column("sketch").take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node.view(np.int64)), pa.array(at.astype(np.int32)),
                     pa.array(ids[row]), packed, pa.nulls(len(row), pa.int64())],
                    names=["node", "depth", "doc_id", "sketch", "tied"])
                if ties.shape[1]:
                    # Ties found on the way take their own groups, a tree's leader apart.
                    m = ties.shape[1]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(mix(ties[1].view(np.uint64)).view(np.int64)),
                         pa.array(np.zeros(m, np.int32)), pa.array(ties[1]),
                         pa.nulls(m, pa.binary()), pa.array(ties[0])],
                        names=["node", "depth", "doc_id", "sketch", "tied"])

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        out: list[tuple[int, int]] = []

        def finish() -> None:
            if sum(b.num_rows for b in held) > 1:
                both = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                known = both.column("tied").is_valid()
                pairs = both.filter(known)
                out.extend(zip(pairs.column("tied").to_pylist(),
                               pairs.column("doc_id").to_pylist()))
                rows = both.filter(pc.invert(known))
                if rows.num_rows > 1:
                    ids, sketches = _load(rows)
                    order = np.argsort(ids, kind="stable")
                    ids, sketches = ids[order], sketches[order]
                    forest = Forest(len(ids))
                    branch(ids, sketches, int(np.int64(rows.column("node")[0].as_py())
                                              .view(np.uint64)),
                           rows.column("depth")[0].as_py(), loose, forest)
                    out.extend((int(ids[r]), int(ids[i])) for r, i in forest.stars())
            elif held and held[0].column("tied").null_count == 0:
                out.append((held[0].column("tied")[0].as_py(),
                            held[0].column("doc_id")[0].as_py()))
            held.clear()

        for _, batch, new in runs(batches, "node"):
            if new:
                finish()
                if len(out) > 50_000:
                    yield _pairs(out)
                    out = []
            held.append(batch)
        finish()
        if out:
            yield _pairs(out)

    placed = reps.mapInArrow(
        walk, "node long, depth int, doc_id long, sketch binary, tied long")
    return (placed.repartition("node").sortWithinPartitions("node")
            .mapInArrow(nodes, "a long, b long").distinct())


def _pairs(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([p for p, _ in pairs], pa.int64()), pa.array([q for _, q in pairs], pa.int64())],
        names=["a", "b"])


# ---- exact links ---------------------------------------------------------------------------


def verify(sets: list[np.ndarray], least: float) -> list[tuple[int, int]]:
    """A forest of the links of at least ``least`` among these sets.

    One set's similarities to all others come from an inverted index. Sets are looked at from the
    smaller components; once all sets outside one component have been looked at, any link
    between components has been seen.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(ids, kind="stable")
    first = np.concatenate([[0], np.cumsum(np.bincount(ids))])
    listed = owner[order]
    begin = np.cumsum(sizes) - sizes
    forest = Forest(n)
    links: list[tuple[int, int]] = []
    percent = round(least * 100)
    looked = np.zeros(n, bool)

    def look(i: int) -> None:
        looked[i] = True
        own = ids[begin[i]:begin[i] + sizes[i]]
        lengths = first[own + 1] - first[own]
        stops = np.cumsum(lengths)
        spots = np.arange(stops[-1]) + np.repeat(first[own] - (stops - lengths), lengths)
        common = np.bincount(listed[spots], minlength=n)
        union = sizes + sizes[i] - common
        for j in np.flatnonzero(100 * common >= percent * union).tolist():
            if j != i and forest.tie(i, j):
                links.append((i, j))

    look(0)
    while not looked.all():
        root = np.array([forest.root(i) for i in range(n)])
        count = np.bincount(root, minlength=n)
        big = int(count.argmax())
        todo = np.flatnonzero(~looked & (root != big))
        if not len(todo):
            break
        for i in todo[np.argsort(count[root[todo]], kind="stable")][:64].tolist():
            look(i)
    return links


def exact_links(docs: DataFrame, clusters: DataFrame, id_col: str, text_col: str, size: int,
                least: float, block_shingles: int) -> DataFrame:
    """(a, b) verified links, a forest for each block of each loose cluster."""
    weight = clusters.groupBy("component").agg(F.sum("n_shingles").alias("w"))
    blocks = F.ceil(F.col("w") / block_shingles).cast("int")
    members = stored(clusters.join(weight.select("component", blocks.alias("blocks")), "component")
                     .select(F.col("node").alias("m_id"), "component", "blocks"), "near-members")
    texts = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
             .join(members, F.col("doc_id") == F.col("m_id")))
    own = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    # A pair of blocks (i <= j) is a group; a document of block i belongs to `blocks` of them.
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(
        F.least(x, own).alias("i"), F.greatest(x, own).alias("j"))))

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Shingler()
        for batch in batches:
            data = [words.shingles(t, size).tobytes()
                    for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("component"), batch.column("blocks"),
                 pa.array(data, pa.binary())], names=["doc_id", "component", "blocks", "data"])

    sets = texts.select("doc_id", "component", "blocks", "text").mapInArrow(
        full, "doc_id long, component long, blocks int, data binary")
    dealt = sets.select("doc_id", "data", "component", pair.alias("p")).select(
        F.xxhash64("component", "p.i", "p.j").alias("group"), "doc_id", "data")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def finish() -> Iterator[pa.RecordBatch]:
            ids = [i for b in held for i in b.column("doc_id").to_pylist()]
            data = [np.frombuffer(x, np.uint64) for b in held
                    for x in b.column("data").to_pylist()]
            held.clear()
            if len(ids) > 1:
                if found := verify(data, least):
                    yield _pairs([(ids[i], ids[j]) for i, j in found])

        for _, batch, new in runs(batches, "group"):
            if new and held:
                yield from finish()
            held.append(batch)
        if held:
            yield from finish()

    return (dealt.repartition("group").sortWithinPartitions("group")
            .mapInArrow(check, "a long, b long"))


def near_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   size: int = 5, least: float = 0.8, trees: int = 12,
                   block_shingles: int = 1 << 20) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    seen = stored(describe(docs, id_col, text_col, size), "near-sets")
    reps = stored(seen.filter("set_key is not null and doc_id is not null").groupBy("set_key").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"),
        F.first("sketch").alias("sketch")), "near-classes")
    ties = loose_ties(reps.select("doc_id", "sketch"), reps.count(), least, trees)
    clusters = components(ties).join(
        reps.select(F.col("doc_id").alias("r_id"), "n_shingles"), F.col("node") == F.col("r_id"))
    links = exact_links(docs, clusters.select("node", "component", "n_shingles"), id_col, text_col,
                        size, least, block_shingles)
    labels = components(links)
    of_set = reps.select("set_key", F.col("doc_id").alias("rep")).join(
        labels, F.col("rep") == F.col("node"), "left").select(
        "set_key", F.coalesce("component", "rep").alias("component"))
    out = seen.select("doc_id", "n_shingles", "set_key").join(of_set, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
