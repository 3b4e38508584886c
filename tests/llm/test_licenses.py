import random
import textwrap

import pytest
from rows import documents, frame, prose, EN
from shopgauge.llm import licenses


def test_families_are_found_and_prose_is_not(spark):
    rows = documents()
    families = sorted(licenses.TEMPLATES)
    for k, name in enumerate(families):
        for j, text in enumerate(licenses.TEMPLATES[name]):
            rows.append((1000 + 100 * k + j, prose(EN, 30, k) + "\n" + text + "\n" + prose(EN, 30, j),
                         "en", name, 0))
    # A notice inside a long paragraph, and words of licences that are no licence.
    rows.append((5000, prose(EN, 300, 1).replace("\n", " ") + " Released under the MIT License. "
                 + prose(EN, 300, 2).replace("\n", " "), "en", "mit", 0))
    rows.append((5001, "You may use the work in this file under any of the terms.", "en", "", 0))
    docs = frame(spark, rows)
    model = licenses.train(docs)
    got = {r.doc_id: r for r in licenses.scan(docs, model).collect()}
    hits = [r for r in rows if r[0] is not None and 1000 <= r[0] <= 5000]
    right = [r for r in hits if r[3] in (got[r[0]].licenses or "").split(",")]
    assert len(right) >= 0.9 * len(hits)
    assert got[5000].license == "mit" and got[5000].overlap >= 0.7
    assert all(got[r[0]].licenses is None for r in rows if r[0] is not None
               and (r[0] < 1000 or r[0] == 5001))
    for plain, family in (("Licensed under CC BY-NC 4.0.", "cc-by-nc-4.0"),
                          ("This work is licensed under the GNU General Public License, version 3.",
                           "gpl-3.0")):
        assert model.judge(licenses.tokens(plain))[0] == family


def test_odd_rows(spark):
    empty = frame(spark, [])
    model = licenses.train(empty)
    assert licenses.scan(empty, model).count() == 0
    got = licenses.scan(frame(spark, [(1, None, None, None, 0), (1, "", None, None, 0)], extra=True),
                        model).collect()
    assert [(r.n_paragraphs, r.licenses) for r in got] == [(0, None)] * 2
    again = [(7, f"line {i}\n\n" + prose(EN, 30, i), None, None, 0) for i in range(30)]
    repeated = licenses.train(frame(spark, again * 3 + [(None, "x", None, None, 0)]), sample_docs=2)
    assert repeated.judge(licenses.tokens("Released under the MIT License."))[0] == "mit"
    p = model.judge(licenses.tokens("Released under the MIT License."))
    assert 0.5 <= p[1] <= 1


GNU = ("This program is free software: you can redistribute it and/or modify it under the terms of the "
       "GNU General Public License as published by the Free Software Foundation, either version 3 of "
       "the License, or (at your option) any later version.")
NOTICES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
           "software and associated documentation files (the \"Software\"), to deal in the Software "
           "without restriction, including without limitation the rights to use, copy, modify, merge, "
           "publish, distribute, sublicense, and/or sell copies of the Software.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are "
           "permitted provided that the following conditions are met:",
    "gpl-3.0": GNU,
    "gpl-2.0": GNU.replace("version 3", "version 2"),
    "agpl-3.0": GNU.replace("GNU General", "GNU Affero General"),
    "lgpl": GNU.replace("GNU General", "GNU Lesser General").replace("program", "library"),
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
           "without fee is hereby granted, provided that the above copyright notice and this "
           "permission notice appear in all copies.",
}


@pytest.mark.parametrize("mark", ["", " * ", "# ", "// ", "dnl "])
def test_wrapped_notices(spark, mark):
    names = sorted(NOTICES)
    blank = "\n" + mark.rstrip() + "\n"
    rows = documents() + [
        (1000 + i, blank.join([mark + "Some file of ours.", "\n".join(
            mark + line for line in textwrap.wrap(NOTICES[name], width)), mark + "More text."]),
         "en", "s", 0) for k, width in enumerate((70, 80)) for i, name in
        enumerate(names, 100 * k)]
    docs = frame(spark, rows)
    got = {r.doc_id: r for r in licenses.scan(docs, licenses.train(docs)).collect()}
    for i, name in enumerate(names):
        for at in (1000 + i, 1100 + i):
            assert (got[at].licenses, got[at].n_paragraphs) == (name, 3)


@pytest.mark.parametrize("one,other", [
    ("apache-2.0", "mit"), ("bsd", "isc"), ("gpl-2.0", "gpl-3.0"), ("cc0-1.0", "mit"),
    ("lgpl", "mpl-2.0"), ("cc-by-sa-4.0", "apache-2.0")])
def test_two_licences_in_one_window(spark, one, other):
    docs = frame(spark, documents())
    model = licenses.train(docs)
    last = {f: t[-1] for f, t in licenses.TEMPLATES.items()}
    rows = [(1, last[one] + " " + last[other], "en", "s", 0),
            (2, last[other] + " Or: " + last[one], "en", "s", 0),
            (3, last[one], "en", "s", 0), (4, last[other], "en", "s", 0)]
    got = {r.doc_id: r for r in licenses.scan(frame(spark, rows), model).collect()}
    both = ",".join(sorted([one, other]))
    assert [got[i].licenses for i in (1, 2, 3, 4)] == [both, both, one, other]
    assert got[1].n_confirmed == 2


# Wordings that are none of the templates.
UNSEEN = {
    "SPDX-License-Identifier: MIT": "mit", "SPDX-License-Identifier: GPL-3.0-or-later": "gpl-3.0",
    "SPDX-License-Identifier: Apache-2.0": "apache-2.0", "SPDX-License-Identifier: LGPL-2.1+": "lgpl",
    "This project is licensed under the MIT License - see the LICENSE file for details": "mit",
    "MIT License": "mit", "The MIT License (MIT)": "mit", "License: MIT License": "mit",
    "This library is distributed under the MIT license.": "mit",
    "Distributed under the terms of the Apache License 2.0": "apache-2.0",
    "Apache License, Version 2.0, January 2004": "apache-2.0",
    "GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007": "gpl-3.0",
    "Licensed under the terms of the GNU Lesser General Public License version 2.1": "lgpl",
    "CC BY-SA 3.0": "cc-by-sa-3.0", "Text is available under CC BY-SA 4.0": "cc-by-sa-4.0",
    "Photos: CC BY-NC 4.0": "cc-by-nc-4.0", "This file is released under the BSD 3-Clause License": "bsd",
    "Code is under the ISC License": "isc", "This code is under the Mozilla Public License 2.0.": "mpl-2.0",
    "The code is released under the GNU Affero General Public License, version 3": "agpl-3.0",
}


def test_notices_in_words_that_were_not_trained_on(spark):
    docs = frame(spark, documents())
    model = licenses.train(docs)
    rows = [(i, prose(EN, 30, i) + "\n\n" + text + "\n\n" + prose(EN, 30, i + 50), "en", "s", 0)
            for i, text in enumerate(UNSEEN)]
    # Names in running text, and words of notices without a licence, are none.
    plain = ["The students of the MIT license their work to whoever asks them for it in time and pay.",
             "Version 3 of the public work was released in June under the old terms of the library.",
             "You need a license to use the general software of this school, the author says so.",
             "My driving license", "Public domain songs", "The source and binary forms of a virus"]
    rows += [(100 + i, t, "en", "s", 0) for i, t in enumerate(plain)]
    got = {r.doc_id: r.licenses for r in licenses.scan(frame(spark, rows), model).collect()}
    assert {t: got[i] for i, t in enumerate(UNSEEN)} == UNSEEN
    assert [got[100 + i] for i in range(len(plain))] == [None] * len(plain)


def test_confirmation_against_counting(spark):
    """What a template confirms has that share of its shingles in the window, counted plainly."""
    model = licenses.train(frame(spark, documents()))
    rand = random.Random(9)
    for _ in range(200):
        family = rand.choice(sorted(licenses.TEMPLATES))
        words = licenses.tokens(rand.choice(licenses.TEMPLATES[family]))
        words = [w for w in words if rand.random() > 0.12]
        words = licenses.tokens(prose(EN, rand.randint(0, 20), 1)) + words + ["tail"] * rand.randint(0, 9)
        for said in model.verdicts(words, 0.5, 0.7)[0]:
            names = licenses.NAMES[said[0]] if len(words) <= licenses.SHORT else []
            best = 0.0
            for t in map(licenses.tokens, licenses.TEMPLATES[said[0]] + names):
                k = min(3, len(t))
                want = {tuple(t[i:i + k]) for i in range(len(t) - k + 1)}
                have = {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}
                best = max(best, len(want & have) / len(want))
            assert best >= 0.7 and said[2] <= best + 1e-9
