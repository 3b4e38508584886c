import random
import re

import numpy as np
from rows import documents, frame, same
from shopgauge.llm import near_text, vectors
from shopgauge.llm.components import components

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    k = min(size, len(w))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()


def classes(ids, linked):
    """Smallest id reachable, by repeated passes."""
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            for x in (a, b):
                if label[x] != low:
                    label[x], changed = low, True
    return label


def brute(rows, size):
    sets = [(r[0], shingles(r[1], size)) for r in rows]
    linked = [(i, j) for n, (i, a) in enumerate(sets) for j, b in sets[:n]
              if a and b and None not in (i, j) and 100 * len(a & b) >= 80 * len(a | b)]
    return sets, classes([i for i, _ in sets if i is not None], linked)


def near_copies(n, seed):
    """Copies of one text with rising numbers of changed words."""
    rand = random.Random(seed)
    base = [f"w{rand.randrange(400)}" for _ in range(120)]
    out = []
    for i in range(n):
        own = list(base)
        for _ in range(rand.randrange(9)):
            own[rand.randrange(len(own))] = f"x{rand.randrange(10 ** 6)}"
        out.append((1000 + i, " ".join(own), "en", "s", 0))
    return out


def test_matches_all_pairs(spark):
    rows = documents() + near_copies(260, 3)
    for size in (2, 5):
        sets, label = brute(rows, size)
        got = near_text.near_documents(frame(spark, rows), size=size).collect()
        assert len(got) == len(rows)
        want = sorted((-1, len(s), -1) if i is None else (i, len(s), label[i]) for i, s in sets)
        assert sorted((-1, r.n_shingles, -1) if r.doc_id is None
                      else (r.doc_id, r.n_shingles, r.component_id) for r in got) == want
        assert all(r.kept == (r.doc_id == r.component_id or r.doc_id is None) for r in got)


def test_blocks_and_heavy_nodes_lose_no_link(spark, monkeypatch):
    rows = near_copies(300, 8)
    _, label = brute(rows, 2)
    monkeypatch.setattr(near_text, "HEAVY_LEAST", 40)  # the driver's choice of heavy nodes
    got = near_text.near_documents(frame(spark, rows), size=2, block_shingles=4000)
    assert {r.doc_id: r.component_id for r in got.collect()} == label


def test_near_text_odd_rows(spark):
    assert near_text.near_documents(frame(spark, [])).count() == 0
    assert same(near_text.near_documents(frame(spark)),
                near_text.near_documents(frame(spark, extra=True)))


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r.node: r.component for r in
           components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}


def test_vectors_match_all_pairs(spark):
    rand = np.random.default_rng(5)
    rows = []
    for c in range(30):
        centre = rand.standard_normal(16)
        for _ in range(9):
            rows.append((len(rows), (centre + rand.standard_normal(16) * 0.07).tolist(), c % 3))
    rows += [(len(rows) + i, rows[4][1], 1) for i in range(3)]
    rows += [(len(rows) + i, v, 1) for i, v in enumerate(
        [None, [], [0.0] * 16, [1.0, None] + [0.0] * 14, [float("nan")] * 16, [1.0] * 8,
         [1e300] * 16, [1e-300] * 16])]
    rows += [(len(rows), rows[0][1], None), (None, rows[0][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    unit = {}
    for i, v, lab in rows:
        if i is not None and lab is not None and v and None not in v and np.isfinite(v).all() \
                and any(v):
            x = np.array(v) / np.abs(v).max()
            unit[i] = (lab, x / np.sqrt((x * x).sum()))
    linked = [(i, j) for i in unit for j in unit if i < j and unit[i][0] == unit[j][0]
              and len(unit[i][1]) == len(unit[j][1]) and unit[i][1] @ unit[j][1] >= 0.98]
    label = classes([r[0] for r in rows if r[0] is not None], linked)
    for cell_rows in (8192, 5):
        got = vectors.near_vectors(df, block_dims=4, cell_rows=cell_rows).collect()
        assert len(got) == len(rows)
        for r in got:
            if r.vec_id is not None:
                assert r.component_id == label[r.vec_id]
                assert r.n_links == sum(r.vec_id in p for p in linked)
                assert r.kept == (r.vec_id == r.component_id)
    assert vectors.near_vectors(df.limit(0)).count() == 0


def test_single_precision_and_extra_columns(spark):
    rand = np.random.default_rng(6)
    rows = []
    for c in range(20):
        centre = rand.standard_normal(16)
        rows += [(len(rows) + k, (centre + rand.standard_normal(16) * 0.06).astype(np.float32).tolist(),
                  c % 2) for k in range(8)]
    rows += [(len(rows), rows[0][1], 0), (len(rows) + 1, [float("inf")] * 16, 0)]
    single = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    odd = single.selectExpr("*", *(f"'x' AS `{c}`" for c in (
        "vector", "key", "copies", "cell", "block", "visit", "salts", "rep", "node", "n_links")))
    double = single.selectExpr("vec_id", "cast(embedding as array<double>) embedding", "label")
    wants = vectors.near_vectors(double)
    assert wants.filter("n_links > 0").count() > 50
    assert same(vectors.near_vectors(single), wants) and same(vectors.near_vectors(odd), wants)
