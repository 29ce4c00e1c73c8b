"""Encoding and packing against the libraries and against bounds."""

import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from documents import frame  # noqa: F401

from cuadrante.llm.byte_bpe import decode_documents, encode_documents, read_ranks, words_of
from cuadrante.llm.packing import best_fit, complete_bins, pack, token_pieces

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "=====" * 50, "a" * 333, "naïve — ça \xa0 x\n\n  y\t\tz", "日本語のテキスト です。", "🙂🙂🙃👨‍👩‍👧 x", "don't it's WE'LL 12345 1.5e10", "", " ", "   ", None,
    "a \n b\r\n c \t d  e ", "ab" * 500 + "c d", "İıſK ̀é é", "٣٤٥ Ⅷ ½", "x\x1cy \x1c z", "the the the THE The.", "Σίσυφος ΣΑΣ", "<|endoftext|> <|startoftext|>", "a̱ H̱ b", "word " * 9000,
]


@pytest.fixture(scope="module")
def tiktoken_bpe():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})


@pytest.mark.parametrize("most", [1 << 19, 0])
def test_bpe_is_the_library_s(frame, tiktoken_bpe, most):
    texts = ODD + ODD[:6]
    docs = frame(list(enumerate(texts)))
    encoded = encode_documents(docs, RANKS, public_tokenizers.PATTERN, most=most).cache()
    got = {r["doc_id"]: np.frombuffer(bytes(r["ids"]), "<u4").tolist() for r in encoded.collect()}
    assert got == {i: tiktoken_bpe.encode_ordinary(t or "") for i, t in enumerate(texts)}
    if most:
        back = {r["doc_id"]: bytes(r["text_bytes"]) for r in decode_documents(encoded, RANKS).collect()}
        assert back == {i: (t or "").encode() for i, t in enumerate(texts)}


def test_bpe_of_nothing(frame):
    assert encode_documents(frame([]), RANKS, public_tokenizers.PATTERN, digests=True).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \n\t\r\xa0\x1cab'1.é", max_size=25))
def test_words_can_be_encoded_apart(text):
    import regex

    pattern = regex.compile(public_tokenizers.PATTERN)
    assert "".join(words_of(text)) == text
    assert [m for w in words_of(text) for m in pattern.findall(w)] == pattern.findall(text)


def test_pieces_are_the_library_s(frame):
    tokenizer = Tokenizer.from_file(WORDS)
    rows = list(enumerate(ODD)) + [(None, "the end")]
    out = pack(token_pieces(frame(rows), WORDS, 512), 512).collect()
    by_doc = {}
    for r in out:
        by_doc.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for i, t in rows:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        want = [(k, a, len(ids[a : a + 512]), zlib.crc32(ids[a : a + 512].tobytes())) for k, a in enumerate(range(0, len(ids), 512))]
        assert sorted(by_doc[i]) == want, t
    sequences = {}
    for r in out:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 512
    total = sum(r["length"] for r in out)
    assert len(sequences) == -(-total // 512)


def test_no_documents(frame):
    assert pack(token_pieces(frame([]), WORDS)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_plans_use_every_piece_once(lengths):
    counts = np.bincount(np.array(lengths, int), minlength=41) if lengths else np.zeros(41, int)
    plan = complete_bins(counts, 40, nodes=2000)
    used = np.zeros(41, int)
    for pattern, n in plan:
        assert sum(v * k for v, k in pattern) <= 40 and n > 0
        for v, k in pattern:
            used[v] += k * n
    assert (used == counts).all()
    bins = sum(n for _, n in plan)
    assert -(-sum(lengths) // 40) <= bins <= sum(n for _, n in best_fit(counts, 40))


def test_search_beats_best_fit():
    # Best fit decreasing needs four sequences; 6+4, 5+5 and 3+3+4 fill three.
    counts = np.bincount([6, 5, 5, 4, 4, 3, 3], minlength=11)
    assert sum(n for _, n in complete_bins(counts, 10)) == 3


def test_a_million_equal_pieces():
    counts = np.zeros(4097, int)
    counts[[100, 4096, 3000]] = [1_000_000, 500_000, 20]
    plan = complete_bins(counts)
    assert sum(n for _, n in plan) <= 500_000 + 20 + 25_000 and len(plan) < 50
