import random
import zlib

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from rows import documents, frame, same
from shopgauge.llm import packing, token_counts, token_files
from shopgauge.llm.common import scratch
from tokenizers import Tokenizer

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TOKENIZER = Tokenizer.from_file(BPE)
ENCODER = token_files.Encoder(open(BPE, encoding="utf-8").read(), "<u2", 50)
SP = sentencepiece.SentencePieceProcessor(model_file=PIECES)
LENGTHS = token_counts.Lengths(SP.encode, {"the": len(SP.encode("the"))}, 50)
PARTS = st.lists(st.one_of(st.text(max_size=6), st.sampled_from(
    ["the", "tion,", "a.\nB", "\n", "  ", " ", "<|endoftext|>", "<s>", "don't", "日本", "ß.", "▁", "　",
     "12", "%%%", "Ωmega", "\t x"])), max_size=10)


@settings(max_examples=150, deadline=None)
@given(PARTS, st.sampled_from(["", " ", "  "]))
def test_ids_and_counts_equal_the_libraries(parts, between):
    text = between.join(parts).encode("utf-8", "ignore").decode()
    ids = np.array(TOKENIZER.encode(text, add_special_tokens=False).ids, "<u2")
    assert ENCODER.encode(text) == ids.tobytes()
    assert LENGTHS.count(text) == len(SP.encode(text))


def test_thousands_of_line_breaks_without_spaces():
    for line in ("word{}", "{}", "https://example.org/{}?q=a,b.", "日本語の行{}。", "it's", "end."):
        for head in ("", "a ", "a, b\n\n"):
            text = head + "\n".join(line.format(i) for i in range(5000))
            for whole in (text, text + "\n", text + "\r\nx", text + " z"):
                ids = np.array(TOKENIZER.encode(whole, add_special_tokens=False).ids, "<u2")
                assert ENCODER.encode(whole) == ids.tobytes()


def test_token_files_round_trip(spark):
    rows = documents()
    where = scratch(spark, "test")
    docs = frame(spark, rows)
    manifest = token_files.write_token_files(docs, BPE, where)
    got = sorted(token_files.read_token_files(spark, manifest).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i))
    base = 0
    for r in got:
        assert r.start == base
        base += r.n_tokens
    want = sorted((r[0] is not None, r[0], zlib.crc32(np.array(TOKENIZER.encode(
        r[1] or "", add_special_tokens=False).ids + [0], "<u4").tobytes())) for r in rows)
    assert sorted((r.doc_id is not None, r.doc_id, r.ids_crc32) for r in got) == want
    odd = token_files.write_token_files(frame(spark, rows, extra=True).withColumn("tie", F.lit(1)), BPE,
                                        scratch(spark, "test"))
    assert same(token_files.read_token_files(spark, odd), token_files.read_token_files(spark, manifest))
    none = token_files.write_token_files(frame(spark, []), BPE, scratch(spark, "test"))
    assert token_files.read_token_files(spark, none).count() == 0


def test_token_counts(spark):
    rows = documents()
    got = token_counts.token_counts(frame(spark, rows, extra=True), PIECES, max_tokens=100).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted(
        (str(r[0]), len((r[1] or "").encode()), n, n > 100) for r in rows
        for n in [len(SP.encode(r[1] or ""))])
    assert token_counts.token_counts(frame(spark, []), PIECES).count() == 0


def test_units_with_control_characters(spark):
    """A unit with a line break and one with NULs keep their own counts in the broadcast table."""
    texts = ["x\ny x\ny x\ny", "x\0\0y", "x\0\0y x\0\0y \0", "a\rb a\rb", "a\x85b a\u2028b a\x85b",
             "\0\0", "\n", "a\\nb a\\nb"]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    got = token_counts.token_counts(frame(spark, rows).coalesce(1), PIECES).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {i: len(SP.encode(t)) for i, t in enumerate(texts)}


def test_best_fit_prefers_the_fullest_and_downsizes():
    bins, starts, final = packing.best_fit([6, 5, 3, 2], (4, 8), float)
    used = np.bincount(bins, [6, 5, 3, 2])
    assert sorted(zip(used, final)) == [(8, 8), (8, 8)] and starts == [0, 0, 5, 6]
    assert packing.best_fit([3], (4, 8), float)[2] == [4]


def optimum(items, capacities, cost):
    """The least cost of any packing, by trying all."""
    def price(used):
        return cost(next(c for c in capacities if c >= used))
    best = [float("inf")]

    def place(i, used, total):
        if total >= best[0]:
            return
        if i == len(items):
            best[0] = total
            return
        for k in {u: k for k, u in enumerate(used)}.values():
            if (now := used[k] + items[i]) <= capacities[-1]:
                rest = [*used[:k], now, *used[k + 1:]]
                place(i + 1, rest, total + price(now) - price(used[k]))
        place(i + 1, [*used, items[i]], total + price(items[i]))
    place(0, [], 0)
    return best[0]


def test_packing_against_all_packings_of_few_items():
    rand = random.Random(1)
    shares = []
    for _ in range(600):
        capacities = rand.choice([(4, 6, 8, 12, 16, 32), (3, 5, 16), (8, 16), (10,), (5, 7, 11, 13)])
        cost = rand.choice([float, lambda c: c * (1 + c / capacities[-1])])
        items = sorted((rand.randint(1, capacities[-1]) for _ in range(rand.randint(1, 8))),
                       reverse=True)
        final = packing.best_fit(items, capacities, cost)[2]
        shares.append(sum(map(cost, final)) / optimum(items, capacities, cost))
    assert min(shares) >= 1 - 1e-9 and max(shares) <= 1.25
    assert sum(s < 1 + 1e-9 for s in shares) > 0.85 * len(shares)


def test_joint_lengths_cost_less_than_any_one_length():
    rand = random.Random(2)
    items = sorted((min(4096, int(rand.lognormvariate(5.6, 1.1)) + 1) for _ in range(3000)), reverse=True)
    final = packing.best_fit(items, packing.CAPACITIES)[2]
    total = sum(map(packing.training_cost, final))
    assert len(set(final)) >= 3
    block = packing._Block(items, packing.CAPACITIES, packing.training_cost)
    for c in packing.CAPACITIES:  # what doesn't fit goes to the longest
        used = block.pack(tuple(sorted({c, 4096})))[2]
        assert total < sum(packing.training_cost(block.final(u)) for u in used)
    equal = packing.best_fit([512] * 20_000, packing.CAPACITIES)[2]
    assert equal == [512] * 20_000


def test_packing_covers_every_word_once(spark):
    rows = documents()
    got = packing.pack(frame(spark, rows), capacities=(64, 128, 512), block_items=10).collect()
    total = sum(len((r[1] or "").split()) for r in rows)
    assert sum(r.n_words for r in got) == total
    by_bin, by_doc = {}, {}
    for r in got:
        if r.n_words:
            by_bin.setdefault(r.bin_id, []).append(r)
            by_doc.setdefault(r.doc_id, []).append(r)
        else:
            assert r.bin_id is None
    for members in by_bin.values():
        at = 0
        for r in sorted(members, key=lambda r: r.bin_start):
            assert r.bin_start == at
            at += r.n_words
        assert at == members[0].bin_used <= members[0].bin_capacity
        assert members[0].bin_capacity == min(c for c in (64, 128, 512) if c >= at)
    for doc, pieces in by_doc.items():
        if doc != 25:  # a repeated row
            assert sorted(p.piece_start for p in pieces) == [512 * k for k in range(len(pieces))]
    assert packing.pack(frame(spark, [])).count() == 0
    assert same(packing.pack(frame(spark)).select("doc_id", "n_words"),
                packing.pack(frame(spark, extra=True)).select("doc_id", "n_words"))
