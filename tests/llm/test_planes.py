"""Token ids in planes against the tokenizer's library and exact round trips."""

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from documents import frame  # noqa: F401

from cuadrante.llm.queries import QUERIES
from cuadrante.llm.token_planes import BIT_PLANES, BYTE_PLANES, PlaneFile, PlaneReader, from_planes, read_ids, to_planes, write_ids
from cuadrante.llm.word_table import WordTable, before_blanks, between_spaces, text_blocks

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = [
    "a  <|endoftext|> b", "\x1c x\x1c  y\xa0  z é  ü", "naïve — ça 　 x   y", "", "  ", None, "a \n b\r\n c \t d  e ", "don't it's 12345  6", "x" * 100 + " " + "y " * 30,
    "\x00 a\x00 ab\x00\x00 ", "日本語 です。  です", "İıſK ̀é é A̱ H̱", "🙂 🙃  x", "ABC def\nGHI\n\n", "\n", " \n x   y\x85 z", "word " * 9000, "ab" * 5000,
]


def file_of(docs, planes=BYTE_PLANES, block=7):
    file = PlaneFile(3, planes, block)
    for i, ids in docs:
        file.add(pa.array([i], pa.int64()), np.array([len(ids)]), np.array(ids, "<u4"))
    return file.finish() + b"\n"


ids = st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=40)


@settings(max_examples=200, deadline=None)
@given(ids, st.sampled_from([BYTE_PLANES, BIT_PLANES]))
def test_planes_round_trip(numbers, planes):
    a = np.array(numbers, "<u4")
    cut = to_planes(a, planes)
    assert len(cut) == planes and from_planes(cut, len(a)).tolist() == numbers
    if numbers:
        top = max(numbers).bit_length()
        assert all(not p for k, p in enumerate(cut) if k * 32 // planes >= top)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.none() | st.integers(-(2**63), 2**63 - 1), ids), min_size=1, max_size=8), st.sampled_from([BYTE_PLANES, BIT_PLANES]), st.integers(0, 200), st.integers(0, 200))
def test_files_round_trip(docs, planes, a, b):
    reader = PlaneReader(file_of(docs, planes))
    got = [None if reader.none is not None and reader.none[k] else int(d) for k, d in enumerate(reader.doc_ids)]
    assert got == [i for i, _ in docs] and [d.tolist() for d in reader.documents()] == [x for _, x in docs]
    stream = [x for _, own in docs for x in own]
    a, b = min(a, len(stream)), min(b, len(stream))
    assert reader.n_ids == len(stream) and reader.run(a, b).tolist() == stream[a:b]


def test_a_run_unpacks_only_its_blocks(monkeypatch):
    reader = PlaneReader(file_of([(1, list(range(100)))]))
    seen = []
    block = reader.block
    monkeypatch.setattr(reader, "block", lambda k: seen.append(k) or block(k))
    assert reader.run(20, 29).tolist() == list(range(20, 29)) and seen == [2, 3, 4]


def test_damage_is_seen():
    whole = bytearray(file_of([(1, [5] * 20)], block=64))
    with pytest.raises(ValueError):
        PlaneReader(bytes(whole[:-1]))
    reader = PlaneReader(bytes(whole))
    reader.checks = reader.checks + 1
    with pytest.raises(ValueError):
        reader.block(0)


@pytest.mark.parametrize("path, cut, fold", [(BYTES, before_blanks, False), (WORDS, between_spaces, True)])
@pytest.mark.parametrize("places", [2, 1 << 12])
def test_word_tables_give_the_library_s_ids(path, cut, fold, places):
    tokenizer, table = Tokenizer.from_file(path), WordTable(path, cut, fold, places)
    texts = pa.array(ODD * 2)
    for first, stop, data, offsets in text_blocks(texts, 2000):
        ids, ends = table.encode(data, offsets)
        for k in range(first, stop):
            want = tokenizer.encode(texts[k].as_py() or "", add_special_tokens=False).ids
            assert ids[ends[k - first] : ends[k - first + 1]].tolist() == want, texts[k]


TABLES = [WordTable(BYTES, before_blanks, places=256), WordTable(WORDS, between_spaces, True, places=256)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t\r\xa0\x1c\x85　ab'1.éA\x00日", max_size=20), max_size=4))
def test_parts_can_be_encoded_apart(texts):
    for table in TABLES:
        for first, stop, data, offsets in text_blocks(pa.array(texts, pa.string())):
            ids, ends = table.encode(data, offsets)
            for k in range(first, stop):
                assert ids[ends[k - first] : ends[k - first + 1]].tolist() == table.tokenizer.encode(texts[k], add_special_tokens=False).ids


def stream(rows):
    """What must be read, for rows in their order."""
    tokenizer, at, out = Tokenizer.from_file(BYTES), 0, []
    for i, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes()), ids.tobytes()))
        at += len(ids)
    return out


@pytest.mark.parametrize("planes, file_ids", [(BYTE_PLANES, 1 << 22), (BIT_PLANES, 100)])
def test_documents_are_read_back(spark, frame, tmp_path, planes, file_ids):
    rows = [(i * 7919 % 1000, ODD[i % len(ODD)]) for i in range(90)]
    write_ids(frame(rows), str(tmp_path / "ids"), BYTES, planes=planes, block_ids=64, file_ids=file_ids)
    got = read_ids(spark, str(tmp_path / "ids"), with_ids=True).collect()
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"], bytes(r["ids"])) for r in got) == stream(sorted(rows))


def test_null_and_repeated_ids(spark, frame, tmp_path):
    rows = [(5, "same"), (5, "same"), (5, None), (None, "none"), (None, "none"), (-2, "below")]
    write_ids(frame(rows), str(tmp_path / "ids"), BYTES)
    got = sorted(tuple(r)[1:] + (r["doc_id"],) for r in read_ids(spark, str(tmp_path / "ids")).collect())
    assert [g[-1] for g in got] == [None, None, -2, 5, 5, 5] and [g[0] for g in got] == list(np.cumsum([0] + [g[1] for g in got])[:-1])
    assert sorted(g[1:3] for g in got) == sorted((n, crc) for _, _, n, crc, _ in stream(rows))


def test_no_documents(spark, frame, tmp_path):
    write_ids(frame([]), str(tmp_path / "ids"), BYTES)
    assert read_ids(spark, str(tmp_path / "ids")).count() == 0


def test_query(spark):
    d = "/root/testdata/sf0.001"
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{d}/documents.parquet").collect())
    got = QUERIES["op11_token_planes"](spark, d).collect()
    assert sorted(tuple(r[c] for c in ("doc_id", "start", "n_tokens", "ids_crc32")) for r in got) == [s[:4] for s in stream(rows)]
