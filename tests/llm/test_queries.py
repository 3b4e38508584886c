"""Registered queries against their SQL, and the pipeline against its parts."""

import os
import random
import re
import sys
from collections import Counter

import pytest
from rows import documents, frame

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import corpus_pipeline  # noqa: E402
import __spark_entry__ as E  # noqa: E402
from oracle_check import duck_conn, norm, rows_key  # noqa: E402
from shopgauge.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_all_operators_are_registered():
    names = [re.match(r"op(\d+)_", n) for n in E.queries()]
    assert {int(m[1]) for m in names if m} == set(range(1, 14))
    assert "pipeline" in E.queries() and set(queries.ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((norm(tuple(r)) for r in df.select(*cols).collect()), key=rows_key)
    res = duck_conn(SF).execute(E.oracle_sql()[name])
    names = [c[0] for c in res.description]
    want = sorted((norm(tuple(r[names.index(c)] for c in cols)) for r in res.fetchall()),
                  key=rows_key)
    assert sorted(names) == cols and got == want


@pytest.mark.parametrize("extra", [False, True])
def test_pipeline_stages(spark, extra):
    docs = frame(spark, extra=extra)
    columns, kept = docs.columns, {r[0] for r in documents()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns
        ids = Counter(r.doc_id for r in docs.select("doc_id").collect())
        assert set(ids) <= kept
        if name == "quality rules":
            assert set(range(20)) <= set(ids) and not {22, 23, 24, 25, 29, 30} & set(ids)
        if name == "near duplicates":
            assert 20 not in ids and 5 in ids and max(ids.values()) == 1
            assert None in ids  # a text of its own under no id
        kept = set(ids)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == kept
    empty = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0


def test_near_duplicates_stage_judges_rows(spark):
    rand = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    bases = [" ".join(rand.choices(words, k=60)) for _ in range(8)]

    def near(text):
        own = text.split()
        own[rand.randrange(len(own))] = "edit"
        return " ".join(own)
    one, two = bases[:2]
    texts = [(1, one), (2, one), (2, two), (5, bases[2]), (5, bases[3]), (5, bases[3]), (None, one),
             (None, bases[4]), (None, near(bases[4])), (6, near(bases[2])), (4, near(bases[2])),
             (7, bases[5]), (8, bases[6]), (8, near(bases[6])), (None, None), (9, ""), (9, "")]
    unique = [t for t in texts if t[0] in (1, 4, 6, 7)]
    for rows in (texts, unique, []):
        docs = frame(spark, [(i, t, "en", f"s{n}", n) for n, (i, t) in enumerate(rows)], extra=True)
        got = corpus_pipeline.near_duplicates(spark, docs, SF)
        assert got.columns == docs.columns
        sets = [frozenset(zip(*[(t or "").split()[k:] for k in range(5)])) or (t or "").strip()
                for _, t in rows]
        group = list(range(len(rows)))
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if a and b and 100 * len(a & b) >= 80 * len(a | b):
                    group = [group[j] if g == group[i] else g for g in group]
        members = {}
        for n, g in enumerate(group):
            members.setdefault(g, []).append(n)
        kept = [r.n_chars for r in got.collect()]
        assert len(kept) == len(set(kept)) == len(members)
        for own in members.values():
            left = [rows[n][0] for n in own if n in kept]
            ids = [rows[n][0] for n in own if rows[n][0] is not None]
            assert left == [min(ids) if ids else None]
