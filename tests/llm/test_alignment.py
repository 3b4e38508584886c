"""Alignment of two tokenizers against a pair-by-pair version with the libraries' own ids."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from rows import documents, frame
from shopgauge.llm import alignment
from tokenizers import Tokenizer

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TOKENIZER = Tokenizer.from_file(BPE)
TOKENIZER.encode_special_tokens = True
SP = sentencepiece.SentencePieceProcessor(model_file=PIECES)
SIDE_A = alignment.ByteLevel(open(BPE, encoding="utf-8").read())
ALIGNER = alignment.Aligner(SIDE_A, alignment.Pieces(open(PIECES, "rb").read()))
_OWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE = {chr(b): b for b in _OWN} | {chr(256 + i): b for i, b in enumerate(
    b for b in range(256) if b not in _OWN)}
PARTS = st.lists(st.one_of(st.text(max_size=6), st.sampled_from(
    ["the", "tion,", "a.\nB", "\n", "  ", " ", "<|endoftext|>", "<s>", "don't", "日本", "ß.", "▁", "　",
     "12", "%%%", "Ωmega", "\t x", "'s", "\r\n\r\n", "<0x0A>", "é", "\x00", "﷽", "👩‍👩‍👧"])), max_size=10)


def sides(text):
    """[(id, bytes)] of both sides by the libraries alone, or two empty lists."""
    if not text:
        return [], []
    a = [(i, bytes(BYTE[c] for c in TOKENIZER.id_to_token(i)))
         for i in TOKENIZER.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in SP.encode(text):
        p = SP.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if SP.is_byte(i) else p.replace("▁", " ").encode()))
    want = (" " + text).encode()
    if any(b"".join(x for _, x in side) != want for side in (a, b)):
        return [], []
    return a, b


def spans(side):
    out, at = [], 0
    for i, x in side:
        out.append((i, at, at + len(x)))
        at += len(x)
    return out


def one(text):
    a, b = map(spans, sides(text))
    links = [(i, j) for i, s, e in a for j, t, f in b if max(s, t) < min(e, f)]
    cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
    groups, at = [], 0
    for cut in cuts:
        groups.append("|".join(",".join(str(i) for i, s, e in side if at <= s and e <= cut)
                               for side in (a, b)))
        at = cut
    return len(a), len(b), len(groups), links, ";".join(groups)


def brute(texts):
    found = [one(t) for t in texts]
    count = Counter(p for f in found for p in set(f[3]))
    most = {}
    for (i, _), n in count.items():
        most[i] = max(n, most.get(i, 0))
    return [(n_a, n_b, n_groups, len(links), sum(count[p] == most[p[0]] for p in links),
             sum(count[p] for p in links),
             hashlib.sha256(g.encode()).hexdigest() if g else "")
            for n_a, n_b, n_groups, links, g in found], count, most


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(PARTS.map("".join), PARTS.map(" ".join)), min_size=1, max_size=4))
def test_groups_and_links_of_any_text(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts] + [None]
    got = ALIGNER.align(texts)
    for i, text in enumerate(texts):
        n_a, n_b, n_groups, links, groups = one(text)
        assert (got["n_a"][i], got["n_b"][i], got["n_groups"][i], got["n_links"][i]) == (
            n_a, n_b, n_groups, len(links))
        assert got["groups"][i].decode() == groups
        a, b = got["ends"][i], got["ends"][i + 1]
        assert {divmod(int(p), ALIGNER.n_b): n for p, n in zip(
            got["pairs"][a:b], got["counts"][a:b])} == Counter(links)


def test_the_fast_encoder_is_in_use_and_takes_long_stretches():
    assert SIDE_A.fast is not None
    for text in ("a" * 20_000, " " * 20_000, "ab" * 9_000 + "\n" * 3_000, "日本語" * 4_000, "%" * 9_000,
                 "0123456789" * 2_000):
        assert SIDE_A.encode(text) == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_doubling_reaches_the_end_of_long_groups():
    a = np.arange(2, 2001, 2)  # every token straddles two of the other side
    b = np.r_[np.arange(1, 2000, 2), 2000]
    assert (alignment.last_of_group(a, b) == len(b) - 1).all()
    cuts = alignment.last_of_group(np.array([2, 5, 6]), np.array([1, 2, 4, 6]))
    assert cuts.tolist() == [1, 3, 3, 1, 1, 3, 3]


@pytest.mark.parametrize("frequent", [0, 40, 1 << 20])
def test_documents_and_pairs(spark, frequent):
    rows = documents() + [(31, "one ▁ mark", None, None, 1), (32, "x" * 3000, None, None, 1),
                          (None, None, None, None, None), (33, "ﬁ ① <|endoftext|> <s>", None, "s", 1)]
    docs, pairs = alignment.align_documents(frame(spark, rows, extra=True), BPE, PIECES,
                                            frequent=frequent)
    want, count, most = brute([r[1] for r in rows])
    got = [(str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum,
            r.groups_sha256) for r in docs.collect()]
    assert sorted(got) == sorted((str(r[0]), *w) for r, w in zip(rows, want))
    assert {(r.a_id, r.b_id): (r.n_docs, r.best) for r in pairs.collect()} == {
        p: (n, n == most[p[0]]) for p, n in count.items()}


def test_empty_table(spark):
    docs, pairs = alignment.align_documents(frame(spark, []), BPE, PIECES)
    assert docs.count() == 0 and pairs.count() == 0
