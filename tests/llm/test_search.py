"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from rows import EN, documents, frame, prose
from shopgauge.llm import search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(docs, items, k=10):
    counts = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in counts]
    n_docs, n_terms = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        own = set(TERM.findall((text or "").translate(LOWER)))
        found = []
        for (doc, c), n in zip(counts, sizes):
            m = 100 - 90 + (90 * n * n_docs) // max(1, n_terms)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m)) for t in own if c[t])
            if score > 0:
                found.append((-score, doc is None, doc))
        for rank, (score, _, doc) in enumerate(sorted(found)[:k], 1):
            out.append((str(item), rank, str(doc), -score))
    return sorted(out)


def run(spark, docs, items, extra=False, k=10):
    left = frame(spark, [(i, t, "en", "s", 1) for i, t in docs], extra)
    right = spark.createDataFrame(items, "item_id long, text string").repartition(2)
    if extra:
        right = right.selectExpr("*", "'x' AS row", "1 AS rank", "2 AS doc_id")
    return sorted((str(r.item_id), r["rank"], str(r.doc_id), r.score)
                  for r in search.search(left, right, k=k).select(
                      "item_id", "rank", "doc_id", "score").collect())


def test_terms():
    for text in ("Ab1_cé É漢 x-y\x7f\x80z A\x00B [", "", "ǅ İ ß", "   "):
        assert [t.decode() for t in search.terms(text)] == TERM.findall(text.translate(LOWER))
    assert search.terms(None) == []


def test_odd_rows(spark, monkeypatch):
    docs = [(r[0], r[1]) for r in documents()]
    items = [(1, prose(EN, 12, 3)), (2, None), (3, ""), (4, "the THE of"), (4, "the of"),
             (None, "word"), (5, "漢字"), (6, "absent terms only"), (7, docs[3][1])]
    want = brute(docs, items)
    assert run(spark, docs, items, extra=True) == want
    monkeypatch.setattr(search, "_BLOCK_TERMS", 20)  # several blocks
    monkeypatch.setattr(search, "_BLOCK_ITEMS", 2)
    assert run(spark, docs, items) == want
    assert run(spark, docs, items, k=2) == brute(docs, items, 2)
    assert run(spark, [], items) == [] == run(spark, docs, [])


def test_ties_go_to_the_smaller_id(spark):
    docs = [(i, "alpha beta" if i % 3 else "alpha gamma") for i in range(100, 0, -1)]
    assert run(spark, docs, [(1, "alpha beta"), (2, "gamma")]) == brute(
        docs, [(1, "alpha beta"), (2, "gamma")])


@pytest.mark.parametrize("seed", range(30))
def test_best_positions_lose_nothing_and_stop_early(seed):
    rand = np.random.default_rng(seed)
    n_docs, n_terms = int(rand.integers(1, 300)), int(rand.integers(1, 12))
    there = rand.random((n_docs, n_terms)) < rand.choice([0.05, 0.4, 1.0])
    doc, term = np.nonzero(there)
    impact = rand.integers(0, rand.choice([3, 1000]), len(doc))
    weight = rand.integers(1, 50, n_terms)
    dense = np.zeros((n_docs, n_terms), np.int64)
    dense[doc, term] = impact
    shard = search.Shard(n_docs, doc, term.astype(np.int32), impact, n_terms)
    scores = dense @ weight
    for k in (1, 5, 10):
        for least in (0, int(np.sort(scores)[-min(k, n_docs)])):
            docs, got, _ = shard.best(np.arange(n_terms), weight, k, least)
            assert (got == scores[docs]).all() and len(set(docs.tolist())) == len(docs)
            order = sorted((-s, d) for d, s in enumerate(scores) if s > 0)[:k]
            want = [(s, d) for s, d in order if -s >= least]
            assert sorted((-s, d) for d, s in zip(docs.tolist(), got.tolist()))[:len(want)] == want


def test_a_clear_winner_ends_the_reading():
    n = 4000
    doc = np.r_[np.arange(n), np.arange(n)]
    term = np.repeat([0, 1], n)
    impact = np.r_[np.arange(n, 0, -1), np.arange(n, 0, -1)] + np.r_[np.full(20, 10_000), np.zeros(n - 20),
                                                                    np.full(20, 10_000), np.zeros(n - 20)]
    shard = search.Shard(n, doc, term, impact.astype(np.int64), 2)
    docs, scores, looked = shard.best(np.array([0, 1]), np.array([1, 1]), 10, 0)
    assert looked < 60 and set(range(10)) <= set(docs.tolist())


def test_random_texts_in_small_shards(spark, monkeypatch):
    rand = random.Random(8)
    monkeypatch.setattr(search, "_SHARD", 7)
    words = [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(rand.choices(words, [1 / (j + 1) for j in range(40)], k=rand.randint(1, 60))))
            for i in range(150)]
    items = [(i, " ".join(rand.sample(words, 8))) for i in range(12)]
    assert run(spark, docs, items) == brute(docs, items)
