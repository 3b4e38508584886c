import random

import numpy as np

import pytest
from rows import ES, EN, documents, frame, prose, same
from shopgauge.llm import language


def fewest(sample: str, text: str) -> int:
    i = n = 0
    while i < len(text):
        j = i
        while j < len(text) and text[i:j + 1] in sample:
            j += 1
        n, i = n + 1, max(j, i + 1)
    return n


def test_phrases_match_greedy_search():
    rand = random.Random(1)
    samples = {"a": ["abra cadabra", "hello world"], "b": ["lorem ipsum dolor"]}
    model = language.Model(samples, 1000)
    for _ in range(300):
        text = "".join(rand.choice("abcdehlorw  muX,") for _ in range(rand.randint(1, 60)))
        own = language.squeeze(model.fold[language.codes([text])]).tolist()
        symbols, found = model.parse([text])
        for k, name in enumerate(model.names):
            sample = language.squeeze(model.fold[language.codes([t + " " for t in samples[name]])])
            want = fewest("".join(chr(65 + s) for s in sample if s != 2),
                          "".join(chr(65 + s) for s in own))
            assert not symbols[0] or found[k][0] == want


def test_held_out_accuracy_and_odd_rows(spark):
    rows = documents() + [(100 + i, prose(EN if i % 3 else ES, 12 + i, 500 + i),
                           "en" if i % 3 else "es", "s", 0) for i in range(90)]
    docs = frame(spark, rows)
    model = language.learn(docs)
    got = language.identify(docs, model).collect()
    lang = {r[0]: r[2] for r in rows}
    sure = [r for r in got if r.held_out and r.doc_id >= 100]
    assert len(sure) > 20 and all(r.lang_pred == lang[r.doc_id] for r in sure)
    by = {r.doc_id: r for r in got}
    assert {by[i].lang_pred for i in (22, 23, 24, 26)} == {"und"}
    assert all(0 <= r.score <= 1 for r in got)
    assert same(language.identify(docs, model),
                language.identify(frame(spark, rows, extra=True), model))
    kept = {r.doc_id for r in language.in_known_language(docs, model).collect()}
    # The small sample lacks most letter pairs of the menu (30).
    assert kept - {30} == {r[0] for r in rows} - {22, 23, 24, 26, 27, 30}


def test_empty_table_and_label_bound(spark):
    empty = frame(spark, [])
    assert language.identify(empty, language.learn(empty)).count() == 0
    bare = frame(spark, [(1, "some text", None, "s", 1)])
    assert language.identify(bare, language.learn(bare)).first().lang_pred == "und"
    with pytest.raises(ValueError):
        language.Model({f"l{i}": ["x"] for i in range(language.MOST_LANGUAGES + 1)}, 10)


def script(first: int, letters: int, seed: int, n: int, blank: str = "") -> str:
    """Text of a made-up language: words of one to three letters, frequent ones first."""
    rand = random.Random(f"{first} {seed}")
    menu = ["".join(chr(first + rand.randrange(letters)) for _ in range(rand.randint(1, 3)))
            for _ in range(4000)]
    draw = random.Random(n)
    return "".join(menu[int(4000 * draw.random() ** 3)] + (
        "。" if draw.random() < 0.08 else blank) for _ in range(400))


def test_languages_that_share_a_large_script(spark):
    kinds = {"ja": (0x4E00, 3000, 1), "zh": (0x4E00, 3000, 2), "ko": (0xAC00, 2000, 3),
             "ru": (0x430, 32, 4)}
    rows = documents() + [
        (1000 * k + i, script(*kind, i, " " if name in ("ko", "ru") else ""), name, "s", 0)
        for k, (name, kind) in enumerate(kinds.items(), 1) for i in range(120)]
    rows.append((9000, script(0x0E01, 40, 5, 1), None, "s", 0))  # a script without labels
    docs = frame(spark, rows)
    model = language.learn(docs)
    got = {r.doc_id: r for r in language.identify(docs, model).collect()}
    mine = [r for r in rows if r[0] is not None and 1000 <= r[0] < 9000]
    assert sum(got[r[0]].held_out for r in mine) > 100
    assert all(got[r[0]].lang_pred == r[2] for r in mine)
    kept = {r.doc_id for r in language.in_known_language(docs, model).collect()}
    assert {r[0] for r in mine} <= kept and 9000 not in kept
    assert all(i in kept for i in range(20) if i)
    # Every letter of the samples can be told from the others.
    held = sorted({c for r in mine for c in r[1] if c.isalpha()})
    learnt = [c for c in held if model.fold[ord(c)] > 2]
    assert len(learnt) > 3000
    assert len({tuple(model.spell(model.fold[[ord(c)]])[0]) for c in learnt}) == len(learnt)


def test_more_labels_than_one_model_holds(spark):
    names = [f"l{k:03d}" for k in range(language.MOST_LANGUAGES + 6)]
    letters = "abcdefghijklmnopqrstuvwxyz"
    own = {n: ["".join(random.Random(f"{n} {w}").choices(letters, k=6)) for w in range(40)]
           for n in names}
    rows = [(10 * k + i, " ".join(random.Random(i).choices(own[n], k=60)), n, "s", 0)
            for k, n in enumerate(names) for i in range(6)]
    # One id in very many rows must not push the last languages out.
    rows += [(0, rows[0][1], names[0], "s", 0)] * (language.MOST_LANGUAGES * 48)
    docs = frame(spark, rows)
    model = language.learn(docs)
    assert [n for m in model.groups for n in m.names] == names
    got = {r.doc_id: r for r in language.identify(docs, model).collect()}
    assert all(got[r[0]].lang_pred == r[2] for r in rows)
    assert language.in_known_language(docs, model).count() == len(rows)


def test_packed_transitions_are_those_of_all_substrings():
    """Every substring is a path of the automaton, nothing else; two hundred labels stay small."""
    rand = random.Random(3)
    for width, n in ((5, 60), (40, 400), (250, 900)):
        symbols = np.array([rand.randrange(1, width) for _ in range(n)])
        made = language.Automaton(symbols, width)
        inside = {tuple(symbols[i:j]) for i in range(n) for j in range(i + 1, min(n, i + 6) + 1)}

        def walk(piece):
            state = 0
            for s in piece:
                cell = int(made.cells[made.base[state] + s])
                if cell >> 32 != state:
                    return False
                state = cell & 0xFFFFFFFF
            return True
        assert all(map(walk, inside))
        for _ in range(500):
            piece = tuple(rand.randrange(1, width) for _ in range(rand.randint(1, 5)))
            assert walk(piece) == (piece in inside)
        assert (made.cells >= 0).sum() < 3 * n
        assert made.cells.nbytes + made.base.nbytes < 64 * n + 16 * width
