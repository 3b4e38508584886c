"""Quality rules: line-first cleaning, then rejection of documents that lose too much text.

Every line that holds a word is judged by itself:

* punctuation: more than a third as many piled-up marks (``WORD!!``, ``word%%%``) as words;
* navigation: more than one separator for four words (``Home | News | Contact``), or a short
  label (at most ``label_words`` words) without closing punctuation;
* boilerplate: stock phrases of web furniture, in four languages, make up more than a quarter of
  its words, so that a long line doesn't go for one mention.

Failing lines are removed. The document is rejected if less than ``keep_share`` of its words
remain, or if a rule on the whole text fails (under ten words, or more than a fifth of its words
inside 5-word windows that occur twice).

All of it is built-in column functions in narrow projections: no shuffle, no Python.

Edge cases: a null or empty text has no words and fails the base rule; a repeated row gives a
repeated result; a text of one huge line is one array element; an empty table gives an empty
result. ``quality_report`` returns only its own columns; ``clean_documents`` passes every other column
of its input on.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import words

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = "#*$%&|<>"

# Stock phrases of web furniture, in lower case.
BOILERPLATE = [
    # English
    "accept all cookies",
    "all rights reserved",
    "click here to",
    "cookie policy",
    "enable javascript",
    "lorem ipsum",
    "powered by",
    "privacy policy",
    "skip to content",
    "subscribe to our newsletter",
    "terms of service",
    "terms of use",
    "this site uses cookies",
    # Spanish
    "aceptar todas las cookies",
    "aviso legal",
    "haga clic aquí",
    "política de cookies",
    "política de privacidad",
    "todos los derechos reservados",
    "términos de uso",
    # German
    "alle cookies akzeptieren",
    "alle rechte vorbehalten",
    "allgemeine geschäftsbedingungen",
    "diese website verwendet cookies",
    "hier klicken",
    "newsletter abonnieren",
    # French
    "accepter tous les cookies",
    "ce site utilise des cookies",
    "cliquez ici",
    "conditions d'utilisation",
    "mentions légales",
    "politique de confidentialité",
    "tous droits réservés",
]

_WS = r"[\x20\x09-\x0D]"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, also where the body uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _window_hashes(found: Column) -> Column:
    """One 64-bit hash for each 5-word window, in order."""
    return _let(found, lambda ws: F.slice(
        F.transform(ws, lambda word, i: F.xxhash64(
            word, *[F.get(ws, i + k) for k in range(1, WINDOW)])),
        F.lit(1), F.greatest(F.size(ws) - (WINDOW - 1), F.lit(0))))


def _repeat_starts(hashes: Column) -> Column:
    """Sorted positions of the windows whose hash occurs twice or more; null if none does.

    Distinct hashes prove distinct windows, so most texts end at that test; the others sort
    (hash, position) and compare neighbours.
    """
    def paired(order: Column) -> Column:
        found = F.transform(order, lambda x, i: F.when(
            (x["h"] == F.get(order, i - 1)["h"]) | (x["h"] == F.get(order, i + 1)["h"]),
            x["at"]))
        return F.sort_array(F.filter(found, lambda p: p.isNotNull()))

    return F.when(
        F.size(F.array_distinct(hashes)) < F.size(hashes),
        _let(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"),
                                                                    i.alias("at")))), paired))


def _span_words(starts: Column) -> Column:
    """Length of the union of the windows that begin at these sorted positions."""
    def total(at: Column) -> Column:
        steps = F.transform(at, lambda p, i: F.least(
            F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda n, step: n + step)

    return F.coalesce(_let(starts, total), F.lit(0))


def phrases_by_words() -> dict[int, str]:
    """A pattern of the stock phrases of each number of words."""
    found: dict[int, list[str]] = {}
    for phrase in BOILERPLATE:
        found.setdefault(len(phrase.split()), []).append(phrase)
    return {k: _behind_no_letter(own) for k, own in found.items()}


def _behind_no_letter(phrases: list[str]) -> str:
    """A pattern that looks for phrases only where a word can begin."""
    return f"(?:^|[^a-z])(?:{'|'.join(phrases)})"


def _stock_words(lowered: Column) -> Column:
    """How many words of a line belong to stock phrases."""
    return reduce(Column.__add__, [F.regexp_count(lowered, F.lit(pattern)) * k
                                   for k, pattern in phrases_by_words().items()])


def line_fails(line: Column, label_words: int = 3) -> Column:
    """True for a line that one of the three line rules removes."""
    n = F.size(words(line))
    piled = F.regexp_count(line, F.lit(rf"([!?.]{{2,}}|[{SYMBOLS}]{{2,}})(?={_WS}|$)"))
    bars = F.regexp_count(line, F.lit(rf"(?<={_WS}|^)[|»•>](?={_WS}|$)"))
    closed = line.rlike(rf"[.!?:;…\"')”»。！？]{_WS}*$")
    # Most lines hold no phrase and end at the first test.
    stock = F.lower(line).rlike(_behind_no_letter(BOILERPLATE)) & (_stock_words(F.lower(line)) * 4 > n)
    return (piled * 3 > n) | (bars * 4 > n) | ((n <= label_words) & ~closed) | stock


def _judged(docs: DataFrame, id_col: str, text_col: str, keep_share: float,
            rest: list[Column]) -> DataFrame:
    """One row per document: its figures, its cleaned text and the verdict."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    step = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text"), *rest)
    step = step.withColumns({
        "_words": words(F.col("_text")),
        "_lines": F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
    })
    step = step.withColumns({
        "_hashes": _window_hashes(F.col("_words")),
        "_kept_lines": F.filter("_lines", lambda x: ~line_fails(x)),
        "_glued": F.array_join("_words", ""),
    })
    step = step.withColumn("_starts", _repeat_starts(F.col("_hashes")))
    step = step.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length("_glued").cast("long"),
        "n_symbols": (F.length("_glued") - F.length(F.translate("_glued", SYMBOLS, "")))
        .cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": _span_words(F.col("_starts")).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_lines_removed": (F.size("_lines") - F.size("_kept_lines")).cast("long"),
        "text_clean": F.array_join("_kept_lines", "\n"),
        # Keeps a later filter on the verdict above this projection: pushed below it, the filter
        # would evaluate everything a second time.
        "_above": F.monotonically_increasing_id(),
    })
    step = step.withColumn("n_words_left", F.when(
        F.col("n_lines_removed") == 0, F.col("n_words"))
        .otherwise(F.size(words(F.col("text_clean"))).cast("long")))
    step = step.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT))
    return step.withColumn("kept", ~F.col("base_failed") & (
        F.col("n_words_left") >= F.col("n_words") * keep_share))


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   keep_share: float = 0.5) -> DataFrame:
    """Figures and verdict for every document."""
    return _judged(docs, id_col, text_col, keep_share, []).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_lines", "n_lines_removed", "n_words_left")


def clean_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    keep_share: float = 0.5, length_col: str | None = "n_chars") -> DataFrame:
    """The kept documents with their failing lines removed, in the columns of ``docs``.

    A text without a failing line stays byte for byte; ``length_col`` follows a changed text.
    """
    judged = _judged(docs, id_col, text_col, keep_share,
                     [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")])
    changed = F.col("n_lines_removed") > 0
    out = []
    for c in docs.columns:
        old = F.col("_row")[c]
        if c == text_col:
            old = F.when(changed, F.col("text_clean")).otherwise(old)
        elif c == length_col:
            old = F.when(changed, F.length("text_clean").cast(docs.schema[c].dataType)) \
                .otherwise(old)
        out.append(old.alias(c))
    return judged.filter("kept and _above >= 0").select(*out)
