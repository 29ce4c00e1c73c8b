"""Phrase collocations against brute force."""

import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from documents import frame  # noqa: F401

from cuadrante.llm import phrases
from cuadrante.llm.hat_trie import HatTrie, Slots, merged, packed_run, unpacked_run
from cuadrante.llm.phrases import collocations, lang_hashes, word_ids, word_places
from cuadrante.llm.word_table import BLOCK

FOLDED = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, least=10, top=2000):
    f = {}
    for text, lang in rows:
        counts = f.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(FOLDED)):
            words = re.findall("[^ \t]+", piece)
            counts.update(tuple(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        n = sum(c for p, c in counts.items() if len(p) == 1)
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in found.items():
            if len(p) == 3:
                for part in (p[:2], p[1:]):
                    longer[part] = max(longer[part], a)
        scored = []
        for p, a in found.items():
            if len(p) == 2 and 100 * longer[p] >= 50 * a:
                continue
            score, _, left, right = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def got(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def check(frame, rows, least=10, top=2000, **limits):
    df = frame([(i, t, lang) for i, (t, lang) in enumerate(rows)])
    assert got(collocations(df, least=least, top=top, **limits)) == brute(rows, least, top)


def random_rows(n=300, seed=5):
    rng = np.random.default_rng(seed)
    words = ["a", "B", "The", "the", "naïve", "日本", "x" * 40, "y" * 24, "z" * 25, "\x00", "\xa0", "<|x|>"] + [f"w{k}" for k in range(30)]
    out = []
    for _ in range(n):
        picked = rng.choice(len(words), rng.integers(0, 40), p=(w := 1 / np.arange(1, len(words) + 1)) / w.sum())
        out.append(("".join(words[k] + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"]) for k in picked), [None, "en", "und", "de"][rng.integers(4)]))
    return out


def test_matches_brute_force(frame):
    check(frame, random_rows())


def test_small_containers_and_many_spills(frame):
    check(frame, random_rows(), burst=8, held=64)


def test_ties_and_a_short_list(frame):
    rows = [(f"p{k} q{k} r{k}. s{k} t{k}", "en") for k in range(30) for _ in range(10)]
    check(frame, rows, top=7)


def test_a_hot_phrase_long_texts_and_repeats(frame):
    rows = [("of the of the of the, " * 2000, "en")] * 3 + [("in all of the " * (BLOCK // 5), "en"), ("one " * 50, "en"), ("a,b;c", "de")]
    check(frame, rows)


def test_nothing_to_count(frame):
    assert collocations(frame([])).count() == 0
    check(frame, [(None, None), ("", "en"), ("...", "en"), ("one two three", "en")])


def test_shared_ids_are_given_away_anew(spark, monkeypatch):
    calls = []

    def count_words(docs, again):
        calls.append(list(again))
        return spark.createDataFrame([(1 if not again else 2, "en", "a", 3), (1, "en", "b", 2)], "id long, lang string, word string, f long")

    monkeypatch.setattr(phrases, "count_words", count_words)
    words, again = phrases.every_word(None)
    assert calls == [[], [1]] and again == [1] and words.count() == 2


def test_ids():
    data = np.frombuffer("one two one zwei ".encode() + b"x" * 30 + b" " + b"x" * 31, np.uint8)
    first, stop, piece, text = word_places(data, np.array([0, 8, len(data)]))
    assert [bytes(data[a:b]).decode() for a, b in zip(first, stop)] == ["one", "two", "one", "zwei", "x" * 30, "x" * 31]
    assert text.tolist() == [0, 0, 1, 1, 1, 1] and piece[1] != piece[2]
    en, de = lang_hashes(["en", "de"])
    ids = word_ids(data, first, stop, np.full(6, en), np.empty(0, np.uint64))
    assert ids[0] == ids[2] and len(set(ids.tolist())) == 5
    assert not set(ids.tolist()) & set(word_ids(data, first, stop, np.full(6, de), np.empty(0, np.uint64)).tolist())
    new = word_ids(data, first, stop, np.full(6, en), ids[:2])
    assert new[0] == new[2] != ids[0] and new[1] != ids[1] and (new[3:] == ids[3:]).all()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 60), unique=True, max_size=30), max_size=12))
def test_slots_number_keys_as_they_come(batches):
    slots, want = Slots(2), {}
    for keys in batches:
        for k in keys:
            want.setdefault(k, len(want))
        assert slots.numbers(np.array(keys, np.uint64)).tolist() == [want[k] for k in keys]
    assert slots.keys[: slots.n].tolist() == list(want)


@settings(max_examples=60, deadline=None)
@given(st.integers(2, 3), st.lists(st.lists(st.integers(0, 12), max_size=40), max_size=6), st.integers(1, 12), st.integers(4, 60))
def test_tries_count_exactly(length, texts, burst, held):
    ids = np.random.default_rng(0).integers(0, 2**64 - 1, 13, dtype=np.uint64)
    trie, runs, want = HatTrie(length, 6, burst, held), {}, Counter()
    for words in texts:
        at = np.arange(max(0, len(words) - length + 1))
        want.update(tuple(words[i : i + length]) for i in at)
        for part, run in trie.add(ids[words] if words else np.empty(0, np.uint64), at):
            runs.setdefault(part, []).append(run)
    for part, run in trie.spill_all():
        runs.setdefault(part, []).append(run)
    number = {int(i): k for k, i in enumerate(ids)}
    have = Counter()
    for part in runs.values():
        columns, sums = merged(part, 1)
        for *p, n in zip(*columns, sums):
            key = tuple(number[int(w)] for w in p)
            assert key not in have
            have[key] = n
    assert have == want


def test_runs_round_trip():
    columns = [np.array([1, 1, 2**64 - 1], np.uint64), np.array([5, 6, 0], np.uint64)]
    back, counts = unpacked_run(packed_run(columns, np.array([1, 2**40, 3])))
    assert [c.tolist() for c in back] == [c.tolist() for c in columns] and counts.tolist() == [1, 2**40, 3]
