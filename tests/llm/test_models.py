"""Classifiers: the parts against plain code, the whole on held-out rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from documents import frame  # noqa: F401

from cuadrante.llm import language, linear, quality, toxicity
from cuadrante.llm.common import held_out

DE = "der die das und ist nicht ein eine mit für auf schön über straße".split()
EN = "the and is not a with for on over street this that these".split()


def sentence(rng, words, n=30):
    return " ".join(rng.choice(words) + rng.choice(["", "", rng.choice("abcdefgh")]) for _ in range(n))


def test_codewords_are_apart():
    for k in (2, 3, 4, 5, 9, 40):
        code = language.codewords(k)
        assert set(np.unique(code)) <= {-1.0, 1.0} and (np.abs(code.sum(axis=0)) < k).all()
        far = min(int((code[a] != code[b]).sum()) for a in range(k) for b in range(a))
        assert far >= max(1, code.shape[1] // 5)
    code = language.codewords(5)
    model = language.Model(list("abcde"), code, np.full(code.shape, 1 / code.shape[1]), np.zeros((1, 15)))
    flipped = 3 * code[2]
    flipped[:3] *= -1  # three wrong bits are mended
    assert language.decode(flipped, model)[0] == 2


def test_languages(frame, spark):
    rng = random.Random(1)
    rows = [(i, sentence(rng, DE if i % 2 else EN), "de" if i % 2 else "en") for i in range(400)]
    rows += [(1000, None, "en"), (1001, "", "de"), (1002, "12 ... !!", "en"), (None, "der die das", "de"), (1003, "der die und", None), (1004, "日本", None)]
    docs = frame(rows)
    model = language.fit_languages(docs.filter(~held_out(F.col("doc_id"), 4, 2)))
    out = {r["doc_id"]: r for r in language.identify(docs, model).collect()}
    assert len(out) == len(rows)
    assert sum(out[i]["lang_pred"] == rows[i][2] for i in range(400)) >= 396
    assert [out[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3 and out[1000]["score"] == 0
    assert out[1003]["lang_pred"] == "de" and out[1004]["lang_pred"] in ("de", "en")
    one = language.fit_languages(docs.filter("lang = 'de'"))
    assert {r["lang_pred"] for r in language.identify(docs, one).collect()} == {"de", "und"}
    none = language.fit_languages(frame([]))
    assert {r["lang_pred"] for r in language.identify(docs, none).collect()} == {"und"}
    assert language.identify(frame([]), model).count() == 0


def test_updates_follow_the_regularised_leader():
    model = linear.Ftrl(3, 1, alpha=0.5, beta=1.0, l1=0.1, l2=0.2)
    seen = [(np.array([0, 2]), np.array([1.0, 2.0]), 1.0), (np.array([0, 1]), np.array([1.0, -1.0]), 0.0), (np.array([0, 2]), np.array([0.5, 1.0]), 1.0)]
    z, n = [0.0] * 3, [0.0] * 3
    for i, x, y in seen:
        model.learn(i, x, np.array([y]))
        w = [0 if abs(z[k]) <= 0.1 else -(z[k] - np.sign(z[k]) * 0.1) / ((1 + n[k] ** 0.5) / 0.5 + 0.2) for k in range(3)]
        p = 1 / (1 + np.exp(-sum(w[k] * v for k, v in zip(i, x))))
        for k, v in zip(i, x):
            g = (p - y) * v
            z[k] += g - ((n[k] + g * g) ** 0.5 - n[k] ** 0.5) / 0.5 * w[k]
            n[k] += g * g
    assert np.allclose(model.z[:, 0], z) and np.allclose(model.n[:, 0], n)


def test_quality(frame, spark):
    rng = random.Random(2)
    rows = [(i, sentence(rng, EN) if i % 4 else " ".join(["Buy!!", "NOW!!", "$$$"] * 12)) for i in range(400)] + [(500, None), (501, ""), (None, "x")]
    docs = frame(rows)
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(300)] + [(None, 1), (7, None), (8, 0), (8, 0)], "doc_id long, label int")
    weights = quality.fit_quality(docs, labels)
    out = {r["doc_id"]: r["score"] for r in quality.score_quality(docs, weights).collect()}
    assert len(out) == len(rows) and all(0 <= s <= 1 for s in out.values())
    assert all((out[i] > 0.3) == (i % 4 != 0) for i in range(300, 400)) and out[500] == out[501]
    assert {r["score"] for r in quality.score_quality(docs, quality.fit_quality(docs, labels.filter("label = 1"))).collect()} == {0.5}
    assert quality.score_quality(frame([]), weights).count() == 0


@pytest.fixture(scope="module")
def toxic(frame, spark):
    rng = random.Random(4)
    bad = "scum vile rotten".split()
    rows = [(i, sentence(rng, EN, 40) + (" " + " ".join(rng.choices(bad, k=3)) if i % 5 == 0 else "")) for i in range(600)] + [(700, None), (701, ""), (None, "scum")]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)] + [(None, 1), (3, None)], "doc_id long, label int")
    docs = frame(rows)
    return docs, toxicity.fit_index(docs, labels), rows


def test_toxicity(toxic, frame):
    docs, index, rows = toxic
    out = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, index).collect()}
    assert len(out) == len(rows)
    assert all((out[i]["score"] >= 0.5) == (i % 5 == 0) for i in range(600))
    assert out[700]["evidence"] == [] and out[700]["score"] == out[701]["score"] < 0.5 and out[None]["score"] > 0.5
    assert {e["label"] for e in out[500]["evidence"]} == {1}
    assert toxicity.score_toxicity(frame([]), index).count() == 0


@pytest.mark.parametrize("common, k", [(2048, 25), (20, 25), (0, 25), (20, 400), (20, 1000)])
def test_nearest_is_exact(monkeypatch, common, k):
    monkeypatch.setattr(toxicity, "COMMON", common)
    monkeypatch.setattr(toxicity, "FEW", 0)
    rng = np.random.default_rng(6)
    examples, terms = 700, 60
    counts = np.where(rng.random((examples, terms)) < 0.08, rng.integers(1, 9, (examples, terms)), 0)
    counts[100:160] = counts[100]  # ties
    counts[counts.sum(axis=1) == 0, 0] = 1
    idf = rng.random(terms) + 0.1
    weight = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0) * idf
    weight /= np.linalg.norm(weight, axis=1, keepdims=True)
    place, t = np.nonzero(counts)
    ids = rng.permutation(examples)
    index = toxicity.opened(np.arange(terms), idf, np.zeros(terms), (counts > 0).sum(axis=1), t.astype(np.int32), counts[place, t], np.zeros(examples, int), ids, 0.1, 1.0, 0.0)
    queries = [(at := np.sort(rng.choice(terms, rng.integers(1, 9), replace=False)), (w := rng.random(len(at))) / np.linalg.norm(w)) for _ in range(300)]
    without = [int(rng.integers(-1, examples)) for _ in queries]
    for (at, w), e, (who, cosine, opened) in zip(queries, without, toxicity.search(index, queries, k, without)):
        scores = dict(zip(ids.tolist(), np.round(weight.astype(np.float32)[:, at].astype(float) @ w, 12)))
        if e >= 0:
            del scores[int(index.doc_id[e])]
        best = sorted((i for i in scores if scores[i] > 0), key=lambda i: (-scores[i], i))[:k]
        assert sorted(index.doc_id[who].tolist()) == sorted(best) and 0 < opened <= 1
        assert np.allclose(cosine, [scores[i] for i in index.doc_id[who].tolist()], atol=1e-6)


def test_blocks_stay_closed():
    """Texts of one vocabulary open no blocks of the other's examples."""
    rng = np.random.default_rng(8)
    side = np.arange(4000) % 2
    t = np.sort(np.array([rng.choice(50, 10, replace=False) + 50 * s for s in side]), axis=1).astype(np.int32)
    index = toxicity.opened(np.arange(100), np.ones(100), np.zeros(100), np.full(4000, 10), t.ravel(), np.ones(40000, int), side, np.arange(4000), 0.5, 1.0, 0.0)
    found = toxicity.search(index, [(np.arange(10), np.full(10, 0.1**0.5))] * 5, 50)
    assert all(opened < 0.6 and not index.label[who].any() for who, _, opened in found)


def test_toxicity_without_labels(toxic, spark):
    docs, _, _ = toxic
    none = toxicity.fit_index(docs, spark.createDataFrame([], "doc_id long, label int"))
    assert all(r["score"] < 0.01 for r in toxicity.score_toxicity(docs, none).collect())


def test_toxicity_of_words_that_one_example_holds(frame, spark):
    rng = random.Random(9)
    rows = [(i, sentence(rng, EN, 40) + (" scum vile" if i % 5 == 0 else "")) for i in range(300)] + [(300, "grobbul snarvik zuzzle wemmit"), (301, "snarvik wemmit grobbul quendle")]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(301)], "doc_id long, label int")
    docs = frame(rows)
    index = toxicity.fit_index(docs, labels)
    assert len(index.doc_id) == 301
    out = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, index).collect()}
    assert [(e["doc_id"], e["label"]) for e in out[301]["evidence"]] == [(300, 1)]
    assert all(r["evidence"] for r in out.values())


def queries_of(index, texts):
    found = toxicity.known_terms([np.frombuffer((t or "").encode(), np.uint8) for t in texts], index.terms)
    return [toxicity.vector(index.idf, *f) for f in found]


def test_terms_of_joined_texts(toxic):
    _, index, rows = toxic
    texts = [t for _, t in rows] + ["word " * 100_000 + "scum", "rotten", "", "a\x00b scum"]
    for text, (at, n) in zip(texts, toxicity.known_terms([np.frombuffer((t or "").encode(), np.uint8) for t in texts], index.terms)):
        terms, counts = np.unique(toxicity.terms_of(np.frombuffer((text or "").encode(), np.uint8)), return_counts=True)
        known = np.isin(terms, index.terms)
        assert (index.terms[at] == terms[known]).all() and (n == counts[known]).all()


@pytest.mark.parametrize("common", [0, 30, 2048])
def test_nearest_of_a_fitted_index_is_exact(toxic, spark, monkeypatch, common):
    docs, _, rows = toxic
    monkeypatch.setattr(toxicity, "COMMON", common)
    fitted = toxicity.fit_index(docs, spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)], "doc_id long, label int"))
    index = toxicity.opened(*fitted)
    dense = np.zeros((len(fitted.label), len(fitted.terms)))
    place = np.repeat(np.arange(len(fitted.label)), fitted.n)
    dense[place, fitted.t] = (1 + np.log(fitted.tf)) * fitted.idf[fitted.t]
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    queries = queries_of(index, [t for _, t in rows[:600:7]])
    for (at, w), (who, cosine, _) in zip(queries, toxicity.search(index, queries, 25)):
        full = dict(zip(fitted.doc_id.tolist(), dense[:, at] @ w))
        assert np.allclose(cosine, sorted(full.values())[::-1][:25], atol=1e-5)
        assert np.allclose(cosine, [full[i] for i in index.doc_id[who].tolist()], atol=1e-5)


def test_votes_and_scores_against_brute_force(toxic):
    """Neighbours, telling terms, votes, calibration and scores from their definitions."""
    docs, fitted, rows = toxic
    examples = [(i, int(i % 5 == 0)) for i in range(400)]
    bags = [dict(zip(*np.unique(toxicity.terms_of(np.frombuffer((t or "").encode(), np.uint8)), return_counts=True))) for _, t in rows]
    df = {}
    for bag in bags:
        for t in bag:
            df[t] = df.get(t, 0) + 1
    known = {t for i, _ in examples for t in bags[i]}
    tell = {}
    for t in known:
        a, b = (sum(t in bags[i] for i, y in examples if y == label) + 0.5 for label in (1, 0))
        c, d = 80 - a + 1, 320 - b + 1
        tell[t] = max(0, abs(np.log(a * d / (b * c))) - toxicity.SURE * np.sqrt(1 / a + 1 / b + 1 / c + 1 / d))

    def unit(bag):
        w = {t: (1 + np.log(n)) * np.log((len(rows) + 1) / (df[t] + 1)) for t, n in bag.items() if t in known}
        norm = np.sqrt(sum(x * x for x in w.values()))
        return {t: x / norm for t, x in w.items()} if norm else w

    units = [unit(bag) for bag in bags]

    def voted(q, without=-1):
        near = []
        for i, y in examples:
            shared = {t: q[t] * x for t, x in units[i].items() if t in q}
            c = sum(shared.values())
            if i != without and c > 0:
                near.append((-c, i, y, sum(x * tell[t] for t, x in shared.items())))
        top, all_ = toxicity.FLOOR * 0.5 * 0.2, toxicity.FLOOR * 0.5
        for c, _, y, told in sorted(near)[: toxicity.K]:
            g = -c / (1.05 - min(-c, 1)) * (toxicity.FLOOR + told / -c)
            top, all_ = top + g * y, all_ + g
        return top / all_

    votes = np.array([voted(units[i], i) for i, _ in examples])
    slope, shift = toxicity._calibrate(votes, np.array([y for _, y in examples]), np.ones(400))
    assert np.isclose(fitted.slope, slope, rtol=1e-3) and np.isclose(fitted.shift, shift, rtol=1e-3)
    out = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, fitted).collect()}
    for (i, _), q in list(zip(rows, units))[::9]:
        assert np.isclose(out[i], 1 / (1 + np.exp(-(slope * voted(q) + shift))), atol=1e-4)


def test_toxicity_of_long_repeated_and_tied_texts(frame, spark):
    rng = random.Random(3)
    rows = [(i % 150, sentence(rng, EN, 30) + (" scum vile" if i % 150 % 5 == 0 else "")) for i in range(300)]  # ids twice
    rows += [(1000, sentence(rng, EN, 60_000) + " scum vile"), (1001, "same text"), (1002, "same text"), (1002, "same text")]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(150)] + [(1000, 1), (1001, 0), (1002, 0)], "doc_id long, label int")
    docs = frame(rows)
    out = toxicity.score_toxicity(docs, toxicity.fit_index(docs, labels)).collect()
    assert len(out) == len(rows) and len({r["score"] for r in out if r["doc_id"] in (1001, 1002)}) == 1
    assert all(0 <= r["score"] <= 1 for r in out)


def test_left_out_votes_run_in_tasks(toxic, spark, monkeypatch):
    docs, fitted, rows = toxic
    labels = [(i, int(i % 5 == 0)) for i in range(400)]
    votes, truth = toxicity.left_out_votes(spark.createDataFrame([(i, y, rows[i][1]) for i, y in labels], "doc_id long, label int, text string"), fitted)
    assert truth.tolist() == [y for _, y in labels]
    index = toxicity.opened(*fitted)
    queries = queries_of(index, [rows[i][1] for i in range(0, 400, 9)])
    own = [int(np.flatnonzero(index.doc_id == i)[0]) for i in range(0, 400, 9)]
    for i, q, (who, cosine, _) in zip(range(0, 400, 9), queries, toxicity.search(index, queries, without=own)):
        assert np.isclose(votes[i], toxicity.vote(index, q, who, cosine), atol=1e-5)
    # The driver itself searches no neighbours.
    monkeypatch.setattr(toxicity, "search", None)
    monkeypatch.setattr(toxicity, "left_out_votes", lambda rows, index: (votes, truth))
    again = toxicity.fit_index(docs, spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, label int"))
    assert np.isclose(again.slope, fitted.slope) and np.isclose(again.shift, fitted.shift)


@pytest.mark.parametrize("worth", [0, 1, 4, 1000])
def test_products_take_only_terms_that_a_group_uses(monkeypatch, worth):
    """Two vocabularies: the product of a group has no rows for the other one's terms, and
    the neighbours and votes are those of all cosines."""
    monkeypatch.setattr(toxicity, "WORTH", worth)
    monkeypatch.setattr(toxicity, "FEW", 0)
    taken, opened = [], toxicity._open
    monkeypatch.setattr(toxicity, "_open", lambda dense, *rest: (taken.append(len(dense)), opened(dense, *rest)))
    rng = np.random.default_rng(11)
    side, idf, tell = np.arange(1000) % 2, rng.random(100) + 0.1, np.maximum(0, rng.random(100) - 0.5)
    t = np.sort(np.array([rng.choice(50, 10, replace=False) + 50 * s for s in side]), axis=1).astype(np.int32)
    tf = rng.integers(1, 9, t.shape)
    weight = np.zeros((1000, 100))
    np.put_along_axis(weight, t, (1 + np.log(tf)) * np.take(idf, t), axis=1)
    weight /= np.linalg.norm(weight, axis=1, keepdims=True)
    index = toxicity.opened(np.arange(100), idf, tell, np.full(1000, 10), t.ravel(), tf.ravel(), side, np.arange(1000), 0.5, 1.0, 0.0)
    queries = [(np.sort(rng.choice(50, 8, replace=False)) + 50 * (i % 2), np.full(8, 8**-0.5)) for i in range(256)]
    queries = queries[::2] + queries[1::2]
    found = toxicity.search(index, queries[:128], 40) + toxicity.search(index, queries[128:], 40)
    assert taken and max(taken) <= (50 if worth < 1000 else 0)
    for (at, w), (who, cosine, _) in zip(queries, found):
        full = weight[:, at] @ w
        assert np.allclose(cosine, np.sort(full)[::-1][:40], atol=1e-6) and np.allclose(cosine, full[index.doc_id[who]], atol=1e-6)
        told = weight[np.ix_(index.doc_id[who], at)] @ (w * tell[at])
        count = cosine / (1.05 - np.minimum(cosine, 1)) * (toxicity.FLOOR + told / cosine)
        rest = toxicity.FLOOR * toxicity.PRIOR_WEIGHT
        assert np.isclose(toxicity.vote(index, (at, w), who, cosine), (count @ index.label[who] + rest * 0.5) / (count.sum() + rest), atol=1e-5)
