"""Rows that every operator must take: nulls, empty and long texts, ties, repeats, odd columns."""

from __future__ import annotations

import random

DOC = "doc_id long, text string, lang string, source string, n_chars long"
EN = "the of and to in is that for it with as was on are be this from by at not".split()
ES = "el la de que y en los se del las por un para con una su al lo como más".split()


def prose(words: list[str], n: int, seed: int) -> str:
    rand = random.Random(seed)
    own = [rand.choice(words) + rand.choice(words) if rand.random() < 0.6 else rand.choice(words)
           for _ in range(n)]
    lines = [" ".join(own[i:i + 15]).capitalize() + "." for i in range(0, n, 15)]
    return "\n".join(lines)


def documents() -> list[tuple]:
    rows = [(i, prose(EN if i % 2 else ES, 40 + 7 * i, i), "en" if i % 2 else "es", f"s{i % 4}", 1)
            for i in range(20)]
    base = rows[5][1]
    rows += [(20, base, "en", "s1", 1), (21, base.replace("the", "teh", 1), "en", None, 1),
             (22, None, None, None, None), (23, "", "en", "s0", 0), (24, " \n\t ", None, "s0", 4),
             (25, "the", "en", "s0", 3), (25, "the", "en", "s0", 3), (26, "12 34 !!", None, "s2", 8),
             (None, prose(EN, 60, 77), "en", "s2", 1), (27, "漢字 仮名 " * 8, None, "s3", 1),
             (28, prose(EN, 6000, 99), "en", "s0", 1),
             (29, "word word " * 40, "en", "s1", 1),
             (30, "Home | News | About | Contact |\n" * 6 + "a b c", "en", "s1", 1)]
    return rows


def frame(spark, rows=None, extra=False):
    df = spark.createDataFrame(documents() if rows is None else rows, DOC).repartition(3)
    if extra:  # names that operators use inside
        for c in ("size", "hash", "kept", "_text", "node", "component", "label", "path", "group"):
            df = df.selectExpr("*", f"'x' AS `{c}`")
    return df


def same(a, b) -> bool:
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
