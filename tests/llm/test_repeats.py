"""Removal of repeated passages against a brute-force version."""

import random
from collections import Counter

import pytest
from rows import documents, frame
from shopgauge.llm import repeats


def brute(texts, least):
    seen = Counter(t[i:i + least] for t in texts for i in range(len(t) - least + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - least + 1):
            if seen[t[i:i + least]] > 1:
                gone[i:i + least] = b"\1" * least
        spans, at = [], 0
        while (at := gone.find(1, at)) >= 0:
            end = gone.find(0, at) % (len(t) + 1)
            spans.append((at, end - at))
            at = end
        out.append((len(t), tuple(spans), bytes(c for c, g in zip(t, gone) if not g)))
    return out


def check(spark, rows, least, extra=False):
    got = repeats.remove_repeats(frame(spark, rows, extra), least=least).collect()
    want = brute([(r[1] or "").encode() for r in rows], least)
    assert sorted((str(r.doc_id), r.n_bytes, tuple((s.start, s.length) for s in r.spans),
                   bytes(r.kept)) for r in got) == sorted(
        (str(r[0]), *w) for r, w in zip(rows, want))
    return got


def row(i, text):
    return (i, text, "en", "s", 1)


@pytest.mark.parametrize("least", [24, 60, 400])
def test_odd_rows(spark, least):
    check(spark, documents(), least, extra=True)


def test_passages_copies_and_periods(spark):
    rand = random.Random(5)

    def text(n, letters="abcdefgh "):
        return "".join(rand.choice(letters) for _ in range(n))
    hot, other = text(60), text(35)
    rows = [row(i, text(rand.randint(0, 80)) + hot[rand.randint(0, 20):rand.randint(40, 60)]
                + text(rand.randint(0, 90)) + (other if i % 3 else "") + text(20))
            for i in range(60)]
    base = text(300)
    for i in range(60, 90):  # near copies with an edit every few dozen bytes
        b = list(base)
        for _ in range(rand.randint(1, 6)):
            b[rand.randrange(300)] = "é"
        rows.append(row(i, "".join(b)))
    rows += [row(90, "a" * 500), row(91, "ab" * 200 + "c"), row(92, "xyz" * 30),
             row(None, base), row(None, base + text(40)), row(93, text(200, "ab")),
             row(94, text(400, "a" * 60 + "b")), row(95, base), row(95, base), row(95, "one"),
             row(96, "日本語" * 40), row(97, "q" + hot + "q"), row(98, "q" + hot + "z")]
    for least in (24, 31, 48):
        check(spark, rows, least)


def test_texts_longer_than_a_segment(spark, monkeypatch):
    monkeypatch.setattr(repeats, "_SEGMENT", 50)
    rand = random.Random(6)
    whole = "".join(rand.choice("abcd") for _ in range(700))
    texts = [whole, "zz" + whole[100:420], whole[250:] + whole[:90]]
    got, want = [], brute([t.encode() for t in texts], 40)
    for data, text, shift, at, first, last in repeats.anchors([t.encode() for t in texts], 40):
        for t, s, p, a, b in zip(text, shift, at, first, last):
            assert 0 <= p - b <= p - a < repeats.gap_of(40)
            for w in range(a, b + 1):
                got.append((t, w + s))
                assert data[w:w + 40] == texts[t].encode()[w + s:w + s + 40]
    assert sorted(got) == [(i, w) for i, t in enumerate(texts) for w in range(len(t) - 39)]
    assert want[1][1]


def test_runs_over_batches():
    import pyarrow as pa

    rand = random.Random(3)
    for _ in range(60):
        key = sorted(rand.randrange(8) for _ in range(rand.randrange(1, 14)))
        m = [rand.randint(1, 2) for _ in key]
        rows = sorted(zip(key, m))
        cuts = sorted(rand.sample(range(len(rows) + 1), min(3, len(rows))))
        parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
        batches = [pa.RecordBatch.from_pydict({"pair": [k for k, _ in p], "m": [c for _, c in p]},
                                              pa.schema([("pair", pa.int64()), ("m", pa.int64())]))
                   for p in parts]
        got = [x for b in repeats._shared_pairs(iter(batches)) for x in b.column("pair").to_pylist()]
        count = Counter(key)
        want = [k for i, k in enumerate(key) if count[k] > 1 or i in (0, len(key) - 1)]
        assert got == want
        flags = [x for b in repeats._mixed_classes(iter(batches))
                 for x in zip(b.column("pair").to_pylist(), b.column("open").to_pylist())]
        least = {k: min(c for j, c in rows if j == k) for k in key}
        assert flags == [(k, k == rows[0][0] or (least[k] == 1 and (
            count[k] > 1 or i == len(rows) - 1))) for i, (k, _) in enumerate(rows)]


def test_empty_table(spark):
    assert repeats.remove_repeats(frame(spark, [])).count() == 0
