import re
from collections import Counter

import pytest
from rows import documents, frame, same
from shopgauge.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def figures(text):
    text = text or ""
    w = WORD.findall(text)
    seen = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1
               for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return (len(w), sum(map(len, w)), sum(c in quality.SYMBOLS for c in text),
            len(lines) - len(set(lines)), len(covered), failed)


def test_figures_match_plain_counting(spark):
    rows = documents() + [(100 + i, t, None, None, 0) for i, t in enumerate(
        ["a a a a a a", "a b c d e x a b c d e", "a b c d e f a b c d e f g", "x\r\ny\x0bz\x0cq",
         "é%% ñ##   w", "l1 x.\nl1 x.\n\nl1 x."])]
    got = quality.quality_report(frame(spark, rows)).collect()
    want = sorted((figures(r[1]) for r in rows), key=repr)
    assert sorted(((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                    r.base_failed) for r in got), key=repr) == want
    assert all(not (r.base_failed and r.kept) for r in got)


@pytest.mark.parametrize("line,fails", [
    ("This is a plain line that ends well.", False), ("A line without an end but with words", False),
    ("HEY!! THERE!! WHAT!! NOW!!", True), ("a%%% b### c$$$ d***", True),
    ("Home | News | About | Contact", True), ("About us", True), ("All rights reserved.", True)])
def test_line_rules(spark, line, fails):
    df = spark.createDataFrame([(line,)], "line string")
    assert df.select(quality.line_fails(df.line)).first()[0] is fails


def test_cleaning_keeps_clean_text_and_drops_failing_lines(spark):
    clean = "\n".join(f"Sentence {i} has words{i} that{i} differ{i} from all{i} others{i}."
                      for i in range(5))
    rows = [(1, clean, "en", "s", len(clean)), (2, clean + "\nHome | News | About | Us", "en", "s", 9),
            (3, "Home | News | About | Us |\n" + "a | b | c | d |\n" * 3 + "one two three four.", "en",
             "s", 9), (4, None, None, None, None)]
    got = {r.doc_id: r for r in quality.clean_documents(frame(spark, rows, extra=True)).collect()}
    assert set(got) == {1, 2}
    assert (got[1].text, got[1].n_chars) == (clean, len(clean))
    assert (got[2].text, got[2].n_chars) == (clean, len(clean))


@pytest.mark.parametrize("phrase", quality.BOILERPLATE)
def test_one_stock_phrase_does_not_cost_a_long_line(spark, phrase):
    long = " ".join(f"word{i}" for i in range(150)) + f" {phrase} " + " ".join(
        f"more{i}" for i in range(150)) + "."
    other = " ".join(f"other{i}" for i in range(40)) + "."
    rows = [(1, long, "en", "s", len(long)), (2, f"{long}\n{other}", "en", "s", 9),
            (3, f"{other}\nHere is the {phrase}, with {phrase.title()}.", "en", "s", 9)]
    got = {r.doc_id: r for r in quality.clean_documents(frame(spark, rows, extra=True)).collect()}
    assert {i: r.text for i, r in got.items()} == {1: long, 2: f"{long}\n{other}", 3: other}
    assert got[1].n_chars == len(long)
    assert {r.doc_id: (r.kept, r.n_lines_removed) for r in quality.quality_report(
        frame(spark, rows)).collect()} == {1: (True, 0), 2: (True, 0), 3: (True, 1)}


def test_odd_rows(spark):
    assert quality.quality_report(frame(spark, [])).count() == 0
    assert same(quality.quality_report(frame(spark)), quality.quality_report(frame(spark, extra=True)))
    plan = quality.quality_report(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
