"""Exact and near duplicates against brute force."""

import random

import numpy as np
import pytest

from documents import frame  # noqa: F401

from cuadrante.llm.exact_dedup import exact_dedup
from cuadrante.llm.near_dedup import _linked, near_dedup
from cuadrante.llm.words import SLICE, text_words


def got(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_exact_cases(frame):
    long = "x" * 300
    rows = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, long + "1"), (6, long + "2"), (7, long + "1"), (8, "A"), (9, "b"), (9, "b"), (None, "c"), (10, "c"), (None, "d"), (None, "d")]
    out = exact_dedup(frame(rows), carry=("text", "label"))
    assert got(out, "doc_id", "keep_id", "group_size", "kept") == sorted(
        [
            (1, 2, 2, False), (2, 2, 2, True), (3, 4, 2, False), (4, 4, 2, True), (5, 7, 2, False), (7, 7, 2, True), (6, 6, 1, True), (8, 8, 1, True),
            (9, 9, 2, True), (9, 9, 2, True), (None, 10, 2, False), (10, 10, 2, True), (None, None, 2, True), (None, None, 2, True),
        ],
        key=str,
    )
    assert {r["label"] for r in out.collect()} == {"x"}


def test_exact_of_nothing(frame):
    assert exact_dedup(frame([])).count() == 0


def test_word_hashes_do_not_depend_on_slices():
    text = " ".join(f"word{i % 977}" for i in range(90_000)).encode()
    assert len(text) > 2 * SLICE
    whole = text_words(np.frombuffer(text, np.uint8))
    parts = [text_words(np.frombuffer(w, np.uint8))[0] for w in text.split(b" ")[:2000]]
    assert len(whole) == 90_000 and (whole[:2000] == np.array(parts)).all()
    one = b"z" * (3 * SLICE)
    assert len(text_words(np.frombuffer(one + b" a", np.uint8))) == 2
    assert (text_words(np.frombuffer("AbÉ\tx".encode(), np.uint8)) == text_words(np.frombuffer("abÉ\nX".encode(), np.uint8))).all()


def brute(rows):
    def words(t):
        return "".join(c.lower() if c.isascii() else c for c in t or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ")

    sets = {}
    for i, t, *_ in rows:
        w = [x for x in words(t) if x]
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                k = len(sets[a] & sets[b])
                if 100 * k >= 85 * (len(sets[a]) + len(sets[b]) - k):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return sorted(((i, len(sets[i]), find(i), find(i) == i) for i in ids), key=str)


def near_corpus():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(4000)]
    base = [rng.choice(vocabulary) for _ in range(150)]
    rows = []
    for i in range(160):  # one wide group: copies with none to many edits
        w = list(base)
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5, 8])):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        rows.append((i, " ".join(w)))
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    for i in range(200, 260):  # a passage that many documents share
        rows.append((i, passage + " " + " ".join(rng.choice(vocabulary) for _ in range(90))))
    for i in range(300, 330):  # pairs of near copies
        w = [rng.choice(vocabulary) for _ in range(120)]
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(w[:-2]).upper())]
    rows += [(900, None), (901, ""), (902, " \t\n"), (903, "one two"), (904, "ONE  two"), (905, "one two three four"), (906, "one two three four five"), (907, "a b c d e a b c d e f")]
    return rows


def test_near_against_brute_force(frame):
    rows = near_corpus()
    assert got(near_dedup(frame(rows)), "doc_id", "n_shingles", "component_id", "kept") == brute(rows)


def test_near_cases(frame):
    text = " ".join(map(str, range(50)))
    rows = [(5, text), (5, text), (3, text + " x"), (None, text), (None, None), (None, "alone among many words here"), (8, None)]
    assert got(near_dedup(frame(rows)), "doc_id", "component_id", "kept") == sorted(
        [(5, 3, False), (5, 3, False), (3, 3, True), (None, 3, False), (None, None, True), (None, None, True), (8, 8, True)], key=str
    )
    assert near_dedup(frame([])).count() == 0


@pytest.mark.parametrize("common, linked", [(17, True), (16, False)])
def test_the_bound_is_included(spark, common, linked):
    a, b = list(range(20)), list(range(common)) + list(range(100, 100 + 0))
    if not linked:
        b = list(range(16)) + [200]
    sets = spark.createDataFrame([(1, a), (2, b)], "rep long, shingles array<long>")
    pairs = spark.createDataFrame([(1, 2)], "x long, y long")
    assert (_linked(pairs, sets, 85).count() == 1) == linked


def test_near_of_ids_with_several_texts(frame):
    rng = random.Random(11)
    a, b, c, d, e = (" ".join(f"w{rng.randrange(5000)}" for _ in range(100)) for _ in range(5))
    rows = [(1, a), (10, a + " x"), (12, a + " x"), (4, b), (10, b + " y"), (13, b + " y"), (2, c), (30, c), (30, d), (31, d + " z"), (35, e), (40, ""), (40, e), (50, "alone one"), (50, "alone two"), (60, None), (None, a), (None, "")]
    own = {1: 1, 10: 1, 12: 1, 4: 1, 13: 1, 2: 2, 30: 2, 31: 2, 35: 35, 40: 35, 50: 50, 60: 60}
    got_rows = near_dedup(frame(rows)).collect()
    assert len(got_rows) == len(rows)
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in got_rows if r["doc_id"] is not None} == {(i, k, i == k) for i, k in own.items()}
    assert sorted(((r["component_id"], r["kept"]) for r in got_rows if r["doc_id"] is None), key=str) == [(1, False), (None, True)]
