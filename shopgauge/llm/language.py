"""Language identification by cross-parsing entropy.

For each language a suffix automaton of sample text knows every substring of it. A text is parsed
greedily into the longest pieces that a language's automaton contains; the fewer pieces, the
closer the language. Phrases are normalised by log2 of the automaton's sample length and the
symbols parsed, an estimate of the cross entropy in bits a symbol; the least one wins.

Texts are folded to lower-case letters with one separator between words (marks, digits and symbols
are separators; letters the samples lack are single phrases). A letter of the samples is one symbol;
if they hold more than ``MOST_LETTERS``, as with Chinese or Korean, it is one symbol for each byte of
its UTF-8 form, so that no letter is left out and the tables stay narrow. The parse restarts every ``LANE``
symbols, which lets numpy step thousands of stretches of whole texts at once through the
automata.

Learning uses a bounded sample, a documented parameter: for each language ``sample_rows`` labelled
documents drawn by a hash of the id, and at most ``sample_chars`` symbols of them. A ``Model`` holds
at most ``MOST_LANGUAGES`` labels (an error beyond that); ``learn`` makes as many as the labels need,
over one alphabet, each broadcast by itself, and the least entropy over all of them wins.

Edge cases: a null text, or one without letters, is ``und`` with score 0; ties go to the language
whose name sorts first; without any labelled row every text is ``und``; repeated rows repeat their
result; very long texts are parsed in slices; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LANE = 256
SLICE = 1 << 20
MOST_LANGUAGES = 64
MOST_LETTERS = 250  # that are a symbol each; with the three others they fit a byte
UNKNOWN = "und"


def _letters() -> np.ndarray:
    """True for code points that are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")


class Automaton:
    """Suffix automaton of a symbol sequence, its transitions packed into one array.

    A state has a base; its transition by symbol s lies in cell base + s, marked with the state, so
    that the rows of all states interleave. There are less than three transitions and two states for
    each symbol of the sample, whatever the alphabet: about 1 MB for 40,000 symbols.
    """

    def __init__(self, symbols: np.ndarray, width: int):
        length, link, nexts = [0], [-1], [{}]
        last = 0
        for s in symbols.tolist():
            new = len(length)
            length.append(length[last] + 1)
            link.append(0)
            nexts.append({})
            p = last
            while p >= 0 and s not in nexts[p]:
                nexts[p][s] = new
                p = link[p]
            if p >= 0:
                q = nexts[p][s]
                if length[p] + 1 == length[q]:
                    link[new] = q
                else:
                    twin = len(length)
                    length.append(length[p] + 1)
                    link.append(link[q])
                    nexts.append(dict(nexts[q]))
                    while p >= 0 and nexts[p].get(s) == q:
                        nexts[p][s] = twin
                        p = link[p]
                    link[q] = link[new] = twin
            last = new
        base = self._place(nexts, width)
        self.base = np.array(base, np.int32)
        self.cells = np.full(max(base) + width, -1, np.int64)  # mark and target
        for state, row in enumerate(nexts):
            for s, t in row.items():
                self.cells[base[state] + s] = state << 32 | t
        # Where a phrase that begins with a symbol leads; the root, state 0, if none does.
        self.start = np.zeros(width, np.int64)
        for s, t in nexts[0].items():
            self.start[s] = t
        # A symbol that begins no phrase is one by itself; symbol 0 only closes an open one.
        self.lone = (self.start == 0).astype(np.int32)
        self.lone[0] = 0
        self.bits = float(np.log2(max(2, len(symbols))))

    @staticmethod
    def _place(nexts: list[dict], width: int) -> list[int]:
        """A base for every state, so that no two rows share a cell: the fullest rows first, each
        where its cells are free; a row of one transition takes the next free cell."""
        base = [0] * len(nexts)
        taken = bytearray(width + sum(map(len, nexts)) + 4 * width)
        low = front = width  # where the first free cell is; where rows of several look first
        for state in sorted(range(len(nexts)), key=lambda i: -len(nexts[i])):
            row = sorted(nexts[state])
            if not row:
                continue
            if len(row) == 1:
                low = at = taken.find(0, low)
            else:
                at, tried = taken.find(0, front), 0
                while any(taken[at - row[0] + s] for s in row):
                    at, tried = taken.find(0, at + 1), tried + 1
                    if at + 2 * width >= len(taken):
                        taken.extend(bytes(len(taken)))
                if tried > 8:  # the holes that are left go to rows of one
                    front = at
            base[state] = at - row[0]
            for s in row:
                taken[base[state] + s] = 1
            if at + 2 * width >= len(taken):
                taken.extend(bytes(len(taken)))
        return base

    def phrases(self, lanes: np.ndarray) -> np.ndarray:
        """Phrases of each column; the last row must be symbol 0."""
        state = np.zeros(lanes.shape[1], np.int64)
        count = np.zeros(lanes.shape[1], np.int32)
        for row in lanes:
            cell = self.cells.take(self.base.take(state) + row)
            miss = (cell >> 32) != state
            count += miss & (state != 0)
            count += miss * self.lone.take(row)
            state = np.where(miss, self.start.take(row), cell & 0xFFFFFFFF)
        return count


class Model:
    """Automata of all languages over one folded alphabet."""

    def __init__(self, samples: dict[str, list[str]], sample_chars: int,
                 alphabet: set[str] | None = None):
        if len(samples) > MOST_LANGUAGES:
            raise ValueError(f"{len(samples)} languages; the tables are bounded for "
                             f"{MOST_LANGUAGES}")
        self.names = sorted(samples)
        letters = _letters()
        known = sorted(alphabet_of(samples) if alphabet is None else alphabet)
        spelt = len(known) > MOST_LETTERS
        # 0: end of a lane, 1: separator, 2: letter outside the samples, then the alphabet.
        self.fold = np.ones(0x110000, np.uint32 if spelt else np.uint8)
        self.fold[letters] = 2
        for i, c in enumerate(known):
            for form in {c, c.upper(), c.title()}:
                if len(form) == 1:
                    self.fold[ord(form)] = i + 3
        # The symbols of each folded letter, filled up with 0.
        self.spelling, self.width = None, len(known) + 3
        if spelt:
            forms = [c.encode() for c in known]
            place = {b: i + 3 for i, b in enumerate(sorted(set(b"".join(forms))))}
            self.width = len(place) + 3
            self.spelling = np.zeros((len(known) + 3, max(map(len, forms))), np.uint8)
            self.spelling[1, 0] = 1
            self.spelling[2] = 2
            for i, form in enumerate(forms):
                self.spelling[i + 3, :len(form)] = [place[b] for b in form]
        self.automata = []
        for name in self.names:
            sample = squeeze(self.fold[codes([t + " " for t in samples[name]])])[:sample_chars]
            # Unknown letters can't stand in a sample, separators of one symbol can.
            sample = self.spell(sample[sample != 2])[0][:sample_chars]
            self.automata.append(Automaton(sample, self.width))

    def spell(self, sequence: np.ndarray) -> tuple[np.ndarray, np.ndarray | int]:
        """The symbols of folded letters, and how many each letter has."""
        if self.spelling is None:
            return sequence, 1
        rows = self.spelling[sequence]
        return rows[rows > 0], (rows > 0).sum(1)

    def parse(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, phrases by language) of each text."""
        n = len(texts)
        symbols, found = np.zeros(n, np.int64), np.zeros((len(self.names), n), np.int64)
        owner: list[int] = []
        held: list[str] = []
        size = 0

        def flush() -> None:
            nonlocal owner, held, size
            if held:
                self._parse(np.array(owner), held, symbols, found)
            owner, held, size = [], [], 0

        for i, text in enumerate(texts):
            for at in range(0, len(text or ""), SLICE):
                held.append(text[at:at + SLICE])
                owner.append(i)
                size += len(held[-1]) * (1 if self.spelling is None else self.spelling.shape[1])
                if size >= 2 * SLICE:
                    flush()
        flush()
        return symbols, found

    def _parse(self, owner, held, symbols, found) -> None:
        lengths = np.array([len(t) for t in held])
        sequence = self.fold[codes(held)]
        at = np.repeat(np.arange(len(held)), lengths)
        keep = np.ones(len(sequence), bool)
        keep[1:] = (sequence[1:] != 1) | (sequence[:-1] != 1) | (at[1:] != at[:-1])
        sequence, times = self.spell(sequence[keep])
        at = np.repeat(at[keep], times)
        # A text's symbols go to lanes of LANE rows, each closed by symbol 0.
        lengths = np.bincount(at, minlength=len(held))
        has = np.bincount(at, sequence != 1, len(held)) > 0
        lanes = -(-lengths // LANE)
        first = np.cumsum(lanes) - lanes
        place = np.arange(len(sequence)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        matrix = np.zeros((LANE + 1, int(lanes.sum())), np.int32)
        matrix[place % LANE, first[at] + place // LANE] = sequence
        whose = np.repeat(owner, lanes)
        np.add.at(symbols, owner, np.where(has, lengths, 0))
        for k, automaton in enumerate(self.automata):
            np.add.at(found[k], whose, automaton.phrases(matrix))

    @property
    def groups(self) -> list[Model]:
        return [self]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, phrases a symbol) of each text."""
        return predict([self], texts)


class Models:
    """Models over one alphabet, for more labels than one holds."""

    def __init__(self, groups: list[Model]):
        self.groups = groups

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        return predict(self.groups, texts)


def alphabet_of(samples: dict[str, list[str]]) -> set[str]:
    """The letters of all samples, in lower case."""
    seen = set().union(*(t.lower() for texts in samples.values() for t in texts))
    return {c for c in seen if c.isalpha()}


def predict(models: list[Model],
            texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(language, score, phrases a symbol) of each text over all models' languages."""
    parsed = [model.parse(texts) for model in models]
    labels = [name for model in models for name in model.names]
    symbols, found = parsed[0][0], np.concatenate([f for _, f in parsed])
    if not labels:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    size = np.maximum(symbols, 1)
    entropy = found * np.array([[a.bits] for model in models for a in model.automata]) / size
    best = entropy.argmin(0)
    least = entropy.min(0)
    if len(labels) > 1:
        second = np.partition(entropy, 1, axis=0)[1]
        score = np.clip(1 - least / np.maximum(second, 1e-12), 0, 1)
    else:
        score = np.ones(len(texts))
    none = symbols == 0
    names = [UNKNOWN if no else labels[b] for b, no in zip(best, none)]
    return names, np.where(none, 0.0, score), np.where(
        none, 0.0, np.take_along_axis(found, best[None], 0)[0] / size)


def squeeze(sequence: np.ndarray) -> np.ndarray:
    """Runs of separators cut to one."""
    keep = np.ones(len(sequence), bool)
    keep[1:] = (sequence[1:] != 1) | (sequence[:-1] != 1)
    return sequence[keep]


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", sample_rows: int = 48,
          sample_chars: int = 40_000) -> Model | Models:
    """A model of the labelled documents that aren't held out."""
    learnt = docs.filter(~F.coalesce(held_out(id_col), F.lit(False))
                         & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    draw = F.xxhash64(F.col(id_col), F.lit("sample"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(draw, id_col))
    chosen = (learnt.select(F.col(id_col), F.col(lang_col).alias("lang")).withColumn("rank", rank)
              .filter(F.col("rank") <= sample_rows).select(id_col, "lang").distinct().collect())
    ids: dict[str, set] = {}
    for r in chosen:
        if r[0] is not None:
            ids.setdefault(r[1], set()).add(r[0])
    labels = sorted(ids)
    samples: dict[str, list[str]] = {}
    each = F.row_number().over(Window.partitionBy("lang").orderBy("i", F.xxhash64("text")))
    for at in range(0, len(labels), MOST_LANGUAGES):
        group = labels[at:at + MOST_LANGUAGES]
        # Ids can repeat: the bound on rows is a language's own.
        rows = (learnt.filter(F.col(lang_col).isin(group) & F.col(id_col).isin(
            sorted(set().union(*(ids[k] for k in group))))).select(
            F.col(id_col).alias("i"), F.col(lang_col).alias("lang"),
            F.substring(text_col, 1, 4 * sample_chars).alias("text"))
            .withColumn("rank", each).filter(F.col("rank") <= sample_rows)
            .orderBy("lang", "rank").collect())
        for r in rows:
            own = samples.setdefault(r["lang"], [])
            if sum(map(len, own)) < 2 * sample_chars:
                own.append(r["text"])
    names, alphabet = sorted(samples), alphabet_of(samples)
    groups = [Model({k: samples[k] for k in names[at:at + MOST_LANGUAGES]}, sample_chars, alphabet)
              for at in range(0, max(1, len(names)), MOST_LANGUAGES)]
    return groups[0] if len(groups) == 1 else Models(groups)


def identify(docs: DataFrame, model: Model | Models, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score and phrases_per_symbol of every document."""
    spark: SparkSession = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(held_out(id_col), F.lit(False))
                       .alias("held_out"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        _predictor(spark, model, ["doc_id", "held_out"]),
        f"doc_id {kind}, held_out boolean, lang_pred string, score double, "
        "phrases_per_symbol double")


def _predictor(spark: SparkSession, model: Model | Models, carried: list[str]):
    sent = [spark.sparkContext.broadcast(m) for m in model.groups]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, score, rate = predict([m.value for m in sent],
                                         batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carried), pa.array(names, pa.string()),
                 pa.array(score), pa.array(rate)],
                names=[*carried, "lang_pred", "score", "phrases_per_symbol"])

    return judge


def in_known_language(docs: DataFrame, model: Model | Models, text_col: str = "text",
                      most_phrases: float = 0.5) -> DataFrame:
    """The documents in one of the learnt languages, all their columns as they were.

    Rejected: texts without letters, and texts whose best language needs more than
    ``most_phrases`` phrases a symbol, that is, whose letters or letter pairs no sample has.
    """
    sent = [docs.sparkSession.sparkContext.broadcast(m) for m in model.groups]
    place = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, _, rate = predict([m.value for m in sent], batch.column(place).to_pylist())
            good = (np.array(names) != UNKNOWN) & (rate <= most_phrases)
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(keep, docs.schema)
