"""Union-find over the items of one task, and rows of a sorted partition taken group by group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


class Forest:
    """Union-find over 0..n-1 that keeps the smallest index as root."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def tie(self, i: int, j: int) -> bool:
        """True if i and j were apart."""
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        if i > j:
            i, j = j, i
        self.up[j] = i
        return True

    def stars(self) -> list[tuple[int, int]]:
        """(root, item) of every item that isn't a root."""
        return [(r, i) for i in range(len(self.up)) if (r := self.root(i)) != i]


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, pa.RecordBatch, bool]]:
    """Stretches of equal ``key`` in the order of the rows: (key, rows, whether a new key begins)."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
            k = int(keys[a])
            yield k, batch.slice(a, b - a), k != last
            last = k


def matrix(column: pa.Array, dtype) -> np.ndarray:
    """A column of fixed-length byte strings as a matrix, a row each."""
    n = len(column)
    if not n:
        return np.zeros((0, 0), dtype)
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(n, -1)
