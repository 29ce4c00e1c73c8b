"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are words (runs of letters, A-Z made lower) and word beginnings.  Every term of
the sample of labelled documents is indexed; document frequencies are counted over the
whole corpus.  Labels play no part in the cosine: they act in the vote alone, where a
neighbour counts by its closeness and by how much of it comes from terms that tell the
labels apart.

Texts are searched in groups of like ones.  The postings of terms that few examples hold,
or few texts of the group, are summed at once.  Those of the others are cut into blocks of
examples, whose largest weights bound what any example in a block can score; each text
opens the blocks of the largest bounds first, then all that can still reach its nearest
``K``, and no other.  Within a block the postings lie dense, so that one matrix product
scores all texts that open it.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuadrante.llm import linear
from cuadrante.llm.words import SLICE, mix, text_bytes, text_words, word_spans
from cuadrante.llm.worker import lean
from cuadrante.session import pin

PER_LABEL = 6_000  # labelled documents of either label in the index, about
FLOOR = 0.02  # weight in a vote of shared terms that tell nothing
SURE = 2.0  # standard errors taken off a term's log odds ratio
COMMON = 2_048  # terms held by most examples, whose postings lie in blocks
FEW = 16  # terms that no more examples hold have no blocks
BEGINNINGS = (4, 5)  # bytes of a longer word that are a term of their own
K = 400
BLOCK = 64
FIRST_BLOCKS = 4  # opened beyond those that K examples fill
GROUP = 128  # texts searched at once
SEARCHED = 2_048  # texts whose order is made to suit
WORTH = 1.0  # postings an example, of a term in a group, from which a product costs less
CLUSTERS, ROUNDS = 16, 6  # of the order of examples
PRIOR_WEIGHT = 0.5
ERROR = 1.1 * 2.0**-24  # of a single-precision sum of products up to 1 in all, for each that is not 0
POSTING = np.dtype([("example", np.int32), ("weight", np.float32)])

# Letters and all bytes beyond ASCII stay, A-Z lower; the rest parts words.
_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[128:] = np.arange(128, 256)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[65:91] = np.arange(97, 123)


def _terms(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the letter runs of ``b`` and of the beginnings of longer ones, and where
    each starts."""
    b = _LETTERS[b]
    first, last = word_spans(b)
    out, starts = [text_words(b, fold=False)], [first]
    for n in BEGINNINGS:
        at = first[last - first > n]
        code = np.full(len(at), n, np.uint64)
        for k in range(n):
            code = code * np.uint64(256) + b[at + k]
        out.append(mix(code))
        starts.append(at)
    return np.concatenate(out).view(np.int64), np.concatenate(starts)


def terms_of(b: np.ndarray) -> np.ndarray:
    """Hashes of a text's letter runs and of the beginnings of longer ones."""
    return _terms(b)[0]


def known_terms(texts: list[np.ndarray], terms: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text the places of its terms in ``terms`` (ascending) and their counts.
    Short texts are joined, so that whole runs of them are hashed and looked up at once."""
    blank = np.array([32], np.uint8)
    at = 0
    while at < len(texts):
        last, size = at + 1, len(texts[at]) + 1
        while last < len(texts) and size + len(texts[last]) < SLICE:
            size += len(texts[last]) + 1
            last += 1
        part = texts[at:last]
        found, starts = _terms(np.concatenate([x for b in part for x in (b, blank)]))
        ends = np.cumsum([len(b) + 1 for b in part])
        distinct, which = np.unique(found, return_inverse=True)
        place = np.searchsorted(terms, distinct)
        place[place == len(terms)] = 0
        place[terms[place] != distinct if len(terms) else slice(None)] = -1
        place = place[which]
        known = place >= 0
        text = np.searchsorted(ends, starts[known], side="right")
        both, n = np.unique(text * np.int64(len(terms)) + place[known], return_counts=True)
        edges = np.searchsorted(both, np.arange(len(part) + 1) * np.int64(len(terms)))
        for i in range(len(part)):
            yield both[edges[i] : edges[i + 1]] - i * len(terms), n[edges[i] : edges[i + 1]]
        at = last


class Index(NamedTuple):
    """Labelled examples as postings, as the tasks see them; like examples lie together.

    ``terms`` (ascending hashes) have ``idf``; the postings of each are ``first[t]:first[t +
    1]``.  ``column`` has the place of a common term in ``dense``, which holds the weights of
    such a term for all examples (padded to whole blocks), in ``ceiling``, which holds the
    largest of each block, and in ``held``, the share of examples that hold it; it is -1 for
    the other terms.  ``tell`` is how telling each term is; ``told`` holds by example the
    weights times that of common terms that tell something, whose places are in ``place``.
    """

    terms: np.ndarray
    idf: np.ndarray
    column: np.ndarray
    dense: np.ndarray
    ceiling: np.ndarray
    held: np.ndarray
    first: np.ndarray
    posting: np.ndarray
    tell: np.ndarray
    told: np.ndarray
    place: np.ndarray
    label: np.ndarray
    doc_id: np.ndarray
    prior: float
    slope: float
    shift: float


class Examples(NamedTuple):
    """What an index follows from, as the driver keeps it and sends it to the tasks, which
    open it once a worker: ``n`` terms an example, with their places in ``terms`` and counts."""

    terms: np.ndarray
    idf: np.ndarray
    tell: np.ndarray
    n: np.ndarray
    t: np.ndarray
    tf: np.ndarray
    label: np.ndarray
    doc_id: np.ndarray
    prior: float
    slope: float
    shift: float

    def __reduce__(self):
        return opened, tuple(self)


def _weights(t: np.ndarray, place: np.ndarray, tf: np.ndarray, idf: np.ndarray, examples: int) -> np.ndarray:
    """Weights of postings, of length 1 by example."""
    w = np.log(tf, dtype=np.float64)
    w += 1
    w *= idf[t]
    norm = np.sqrt(np.bincount(place, w * w, examples))
    w /= np.where(norm > 0, norm, 1)[place]
    return w.astype(np.float32)


def _alike(dense: np.ndarray) -> np.ndarray:
    """An order of the examples in which those with like common terms lie together."""
    some = dense[np.linspace(0, max(0, len(dense) - 1), min(CLUSTERS, len(dense))).astype(int)]
    closest = np.zeros(len(dense), np.int64)
    for _ in range(ROUNDS if dense.size else 0):
        closest = (dense @ some.T).argmax(axis=1)
        for c in range(len(some)):
            mean = dense[closest == c].sum(axis=0)
            norm = np.sqrt(mean @ mean)
            some[c] = mean / norm if norm else 0
    return np.argsort(closest, kind="stable")


def opened(terms: np.ndarray, idf: np.ndarray, tell: np.ndarray, n: np.ndarray, t: np.ndarray, tf: np.ndarray, label: np.ndarray, doc_id: np.ndarray, prior: float, slope: float, shift: float) -> Index:
    """The index of the examples: weights, blocks and ceilings."""
    examples = len(label)
    place = np.repeat(np.arange(examples, dtype=np.int32), n)
    w = _weights(t, place, tf, idf, examples)
    held = np.bincount(t, minlength=len(terms))
    common = np.argsort(-held, kind="stable")[:COMMON]
    common = np.sort(common[held[common] > FEW])
    column = np.full(len(terms), -1, np.int32)
    column[common] = np.arange(len(common))
    inside = column[t] >= 0
    blocks = -(-examples // BLOCK)
    rows = np.zeros((examples, len(common)), np.float32)
    rows[place[inside], column[t[inside]]] = w[inside]
    order = _alike(rows)
    dense = np.zeros((len(common), blocks * BLOCK), np.float32)
    for at in range(0, examples, 1024):
        dense[:, at : min(examples, at + 1024)] = rows[order[at : at + 1024]].T
    del rows
    rank = np.empty(examples, np.int32)
    rank[order] = np.arange(examples)
    ceiling = np.ascontiguousarray(dense.reshape(len(common), blocks, BLOCK).max(axis=2).T)
    telling = np.flatnonzero(tell[common] > 0)
    told = np.ascontiguousarray((dense[telling, :examples] * tell[common[telling], None].astype(np.float32)).T)
    at = np.full(len(terms), -1, np.int32)
    at[common[telling]] = np.arange(len(telling))
    by = np.argsort(t, kind="stable")
    first = np.concatenate([[0], np.cumsum(held)])
    posting = np.empty(len(by), POSTING)
    posting["example"], posting["weight"] = rank[place[by]], w[by]
    return Index(terms, idf, column, dense, ceiling, held[common] / max(1, examples), first, posting.view(np.int64), tell, told, at, label[order], doc_id[order], prior, slope, shift)


def vector(idf: np.ndarray, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Known terms of a text and their TF-IDF weights, of length 1."""
    w = (1 + np.log(n)) * idf[at]
    norm = np.sqrt(w @ w)
    return at, w / norm if norm else w


def _runs(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the given runs, and the lengths of the runs."""
    n = last - first
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - n), n), n


def search(index: Index, queries: list[tuple[np.ndarray, np.ndarray]], k: int = K, without: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """For each query (terms, weights) the ``k`` examples of largest cosine above 0, their
    cosines and the share of blocks opened; ties for the last places go to the smaller
    id.  ``without`` names an example to leave out for each query (-1: none)."""
    blocks = len(index.ceiling)
    if not blocks:
        return [(np.empty(0, np.int64), np.empty(0), 0.0)] * len(queries)
    asked = np.zeros((len(queries), len(index.dense)), np.float32)
    for i, (t, w) in enumerate(queries):
        column = index.column[t]
        asked[i, column[column >= 0]] = w[column >= 0]
    order = np.argsort((asked @ index.ceiling.T).argmax(axis=1), kind="stable")  # like queries open like blocks
    out = [None] * len(queries)
    for at in range(0, len(order), GROUP):
        group = order[at : at + GROUP]
        out_of = np.array([without[i] for i in group]) if without else np.full(len(group), -1)
        found = _search(index, [queries[i] for i in group], asked[group], k, out_of)
        for i, one in zip(group, found):
            out[i] = one
    return out


def _search(index: Index, group: list[tuple[np.ndarray, np.ndarray]], asked: np.ndarray, k: int, without: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    examples, blocks = len(index.label), len(index.ceiling)
    used = np.count_nonzero(asked, axis=0) * index.held > WORTH
    asked, dense = asked[:, used], index.dense[used]
    summed = np.append(~used, True)  # by column; the last one is that of terms without
    own = np.zeros((len(group), blocks * BLOCK))  # what terms add that are summed
    for i, (t, w) in enumerate(group):
        own[i, :examples] = _sums(index, t, w, summed[index.column[t]])
    error = ERROR * (2 + np.count_nonzero(asked, axis=1))  # adding 0 has none
    bound = asked @ index.ceiling[:, used].T * (1 + error[:, None]) + own.reshape(len(group), blocks, BLOCK).max(axis=2) + error[:, None]
    most = min(blocks, -(-k // BLOCK) + FIRST_BLOCKS)
    done = np.zeros(bound.shape, bool)
    best = np.argpartition(-bound, most - 1, axis=1)[:, :most]
    np.put_along_axis(done, best, True, axis=1)
    score = np.zeros(own.shape, np.float32)
    _open(dense, asked, own, done, score, without)
    least = np.zeros(len(group))
    if most < blocks:  # all others that can still reach the k-th of these
        reached = np.take_along_axis(score.reshape(len(group), blocks, BLOCK), best[:, :, None], axis=1).reshape(len(group), -1)
        least = np.partition(reached, -k, axis=1)[:, -k] - 2 * error
        more = ~done & (bound >= least[:, None])
        _open(dense, asked, own, more, score, without)
        done |= more
    for i, (t, w) in enumerate(group):
        s = score[i]
        who = np.flatnonzero(s >= least[i] if least[i] > 0 else s > 0)
        if len(who) > k:
            last = np.partition(s[who], -k)[-k]
            who = who[s[who] >= last - 2 * error[i]]
        if len(who) > k:  # some are too near to tell: in double precision
            close = np.abs(s[who] - last) <= 2 * error[i]
            sure, close = who[~close], who[close]
            column = index.column[t]
            rest = ~summed[column]
            exact = own[i, close] + w[rest] @ index.dense[np.ix_(column[rest], close)]
            who = np.concatenate([sure, close[np.lexsort((index.doc_id[close], -np.round(exact, 12)))[: k - len(sure)]]])
        who = who[np.argsort(-s[who], kind="stable")]
        yield who, s[who].astype(np.float64), done[i].mean()


def _sums(index: Index, t: np.ndarray, w: np.ndarray, some: np.ndarray) -> np.ndarray:
    """For each example the sum over ``some`` of the query's terms, by their postings."""
    t = t[some]
    place, n = _runs(index.first[t], index.first[t + 1])
    posting = index.posting[place].view(POSTING)  # both parts of a posting are read at once
    return np.bincount(posting["example"], np.repeat(w[some], n) * posting["weight"], len(index.label))


def _open(dense: np.ndarray, asked: np.ndarray, own: np.ndarray, wanted: np.ndarray, score: np.ndarray, without: np.ndarray) -> None:
    """Score the examples of the ``wanted`` blocks of each query.  Blocks that half of the
    queries want are opened for all of them, neighbours in one product, and so marked."""
    whole = wanted.mean(axis=0) > 0.5
    wanted[:, whole] = True
    edge = np.flatnonzero(np.diff(whole, prepend=False, append=False))
    for a, b in zip(edge[::2] * BLOCK, edge[1::2] * BLOCK):
        score[:, a:b] = own[:, a:b] + asked @ dense[:, a:b]
    for block in np.flatnonzero(wanted.any(axis=0) & ~whole):
        inside, who = slice(block * BLOCK, (block + 1) * BLOCK), np.flatnonzero(wanted[:, block])
        score[who, inside] = own[who, inside] + asked[who] @ dense[:, inside]
    at = np.flatnonzero(without >= 0)
    score[at, without[at]] = 0


def vote(index: Index, query: tuple[np.ndarray, np.ndarray], who: np.ndarray, cosine: np.ndarray) -> float:
    """Share of label 1 among the neighbours, each counting by its closeness and by how
    telling the terms are that it shares; few, far or untelling neighbours leave it near
    the share of the labels."""
    if not len(who):
        return float(index.prior)
    t, w = query
    place, tell = index.place[t], index.tell[t]
    common = place >= 0
    asked = np.zeros(index.told.shape[1], np.float32)
    asked[place[common]] = w[common]
    shared = _sums(index, t, w * tell, (tell > 0) & ~common)[who] + index.told[who] @ asked
    count = cosine / (1.05 - np.minimum(cosine, 1.0)) * (FLOOR + shared / cosine)
    rest = FLOOR * PRIOR_WEIGHT
    return float((count @ index.label[who] + rest * index.prior) / (count.sum() + rest))


def _calibrated(index: Index, v: float) -> float:
    return float(linear.probability(index.slope * v + index.shift))


def _calibrate(votes: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through the left-out votes (Newton steps)."""
    x, beta = np.column_stack([votes, np.ones(len(votes))]), np.zeros(2)
    for _ in range(50):
        p = linear.probability(x @ beta)
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (weight * (y - p)) - 1e-3 * beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(beta[0], 0.0)), float(beta[1])


def _term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, label, terms, ns) of the drawn documents."""
    for batch in batches:
        for part in (batch.slice(at, 500) for at in range(0, batch.num_rows, 500)):
            found = [np.unique(terms_of(b), return_counts=True) for b in text_bytes(part.column(2))]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([t for t, _ in found], pa.list_(pa.int64())), pa.array([n.astype(np.int32) for _, n in found], pa.list_(pa.int32()))], names=["doc_id", "label", "terms", "ns"]
            )


def document_counts(docs: DataFrame, terms: np.ndarray) -> np.ndarray:
    """In how many texts of ``docs`` each of the (ascending) terms occurs."""
    sent = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        total = np.zeros(len(known), np.int64)
        for batch in batches:
            for part in (batch.slice(at, 500) for at in range(0, batch.num_rows, 500)):
                for at, _ in known_terms(list(text_bytes(part.column(0))), known):
                    total[at] += 1
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["t", "n"])

    got = docs.select("text").mapInArrow(lean(run), "t int, n long").groupBy("t").agg(F.sum("n").alias("n")).toArrow()
    sent.unpersist()
    out = np.zeros(len(terms), np.int64)
    out[got["t"].to_numpy()] = got["n"].to_numpy()
    return out


def _telling(a: np.ndarray, b: np.ndarray, pos: int, neg: int) -> np.ndarray:
    """How telling terms are that ``a`` of ``pos`` and ``b`` of ``neg`` examples hold: the size
    of the log odds ratio less ``SURE`` standard errors, not below 0."""
    if not pos or not neg:
        return np.zeros(len(a))
    a, b, no_a, no_b = a + 0.5, b + 0.5, pos - a + 0.5, neg - b + 0.5
    return np.maximum(0, np.abs(np.log(a * no_b / (b * no_a))) - SURE * np.sqrt(1 / a + 1 / b + 1 / no_a + 1 / no_b))


def _packed(examples: DataFrame, terms: np.ndarray) -> DataFrame:
    """(doc_id, label, t, tf): the places of all terms and their counts as bytes of 32-bit
    numbers."""
    sent = examples.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (batch.slice(at, 500) for batch in batches for at in range(0, batch.num_rows, 500)):
            t = [np.searchsorted(sent.value, x.values.to_numpy()).astype(np.int32).tobytes() for x in part.column(2)]
            tf = [x.values.to_numpy().tobytes() for x in part.column(3)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(t, pa.binary()), pa.array(tf, pa.binary())], names=["doc_id", "label", "t", "tf"])

    return examples.mapInArrow(run, "doc_id long, label int, t binary, tf binary")


def fit_index(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Examples:
    """An index of about ``per_label`` labelled documents of either label by all their terms.

    ``docs`` is (doc_id, text), ``labels`` (doc_id, label 0 or 1).  Null ids and labels
    are left out; an id with several labels counts with the largest, and repeated rows of a
    drawn document are as many examples.  The frequencies of the terms are those of all
    ``docs``.  Without labels, or with those of one kind, every text gets their share.
    Spark finds the terms and their counts; the driver gets, for the drawn documents
    alone, the packed places of their terms.
    """
    labels = labels.select("doc_id", F.col("label").cast("int").alias("label"))
    everyone = {r["label"]: r["n"] for r in labels.filter("label is not null").groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # two labels
    sample = linear.draw_sample(labels, "label", per_label)
    rows = pin(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text"))
    examples = pin(rows.mapInArrow(_term_rows, "doc_id long, label int, terms array<long>, ns array<int>").filter(F.size("terms") > 0))
    drawn = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    pos, neg = drawn.get(1, 0), drawn.get(0, 0)
    held = examples.select("label", F.explode("terms").alias("term")).groupBy("term").agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b"))
    held = held.toArrow().sort_by("term")  # the sample's terms
    terms = held["term"].to_numpy()
    idf = np.log((docs.count() + 1) / (document_counts(docs, terms) + 1)) if len(terms) else np.empty(0)
    tell = _telling(held["a"].to_numpy(), held["b"].to_numpy(), pos, neg)
    got = _packed(examples, terms).toArrow().sort_by([("doc_id", "ascending"), ("t", "ascending")])  # bounded by the sample
    n = np.array([len(x) // 4 for x in got["t"].to_pylist()], np.int64)
    t, tf = (np.frombuffer(b"".join(got[c].to_pylist()), np.int32) for c in ("t", "tf"))
    share = everyone.get(1, 0) / max(1, sum(everyone.values()))
    index = Examples(terms, idf, tell, n, t, tf, got["label"].to_numpy().astype(np.int64), got["doc_id"].to_numpy(), share, 1.0, 0.0)
    # Votes of each example by the others, weighted back to the labels' own shares; the
    # sampled texts without a term vote as the prior does.
    if not pos or not neg:  # one kind of label, or none: every text gets its share
        return index._replace(slope=0.0, shift=float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    votes, truth = left_out_votes(rows, index)
    weight = np.where(truth == 1, everyone.get(1, 0) / pos, everyone.get(0, 0) / neg)
    slope, shift = _calibrate(votes, truth, weight)
    return index._replace(slope=slope, shift=shift)


def left_out_votes(rows: DataFrame, index: Examples, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """For each of the sampled ``rows`` (doc_id, label, text), in the order of their ids,
    the vote of the other examples and its label."""
    sent = rows.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = sent.value
        place = {int(i): j for j, i in enumerate(ix.doc_id)}
        for batch in batches:
            queries = [vector(ix.idf, *f) for f in known_terms(list(text_bytes(batch.column(2))), ix.terms)]
            found = search(ix, queries, k, [place.get(i, -1) for i in batch.column(0).to_pylist()])
            votes = [vote(ix, q, who, cosine) for q, (who, cosine, _) in zip(queries, found)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(votes, pa.float64())], names=["doc_id", "label", "vote"])

    got = rows.mapInArrow(lean(run), "doc_id long, label int, vote double").toArrow().sort_by([("doc_id", "ascending"), ("vote", "ascending")])  # bounded by the sample
    sent.unpersist()
    return got["vote"].to_numpy(), got["label"].to_numpy()


def score_toxicity(docs: DataFrame, index: Examples, k: int = K, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry``, ``score`` (the chance of label 1), ``evidence``: the ids, labels and cosines
    of the three nearest examples, and ``opened``: the share of the index's blocks that were
    scored.

    Texts that are null, empty or without a term of any example have no neighbours; they
    are scored by the prior alone.  Each row is scored by its own text, so repeated rows
    score alike and an empty table stays empty; columns beside ``carry`` and ``text`` are
    not read.  Long texts are scored whole.
    """
    sent = docs.sparkSession.sparkContext.broadcast(index)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*carry).schema)
    evidence = pa.list_(pa.struct([("doc_id", pa.int64()), ("label", pa.int32()), ("cosine", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = sent.value
        for part in (batch.slice(at, SEARCHED) for batch in batches for at in range(0, batch.num_rows, SEARCHED)):
            texts = part.column(len(carry)).fill_null("").dictionary_encode()  # equal texts are searched once
            queries = [vector(ix.idf, *f) for f in known_terms(list(text_bytes(texts.dictionary)), ix.terms)]
            scores, shown, shares = [], [], []
            for q, (who, cosine, share) in zip(queries, search(ix, queries, k)):
                scores.append(_calibrated(ix, vote(ix, q, who, cosine)))
                shown.append([{"doc_id": int(ix.doc_id[j]), "label": int(ix.label[j]), "cosine": float(c)} for j, c in zip(who[:3], cosine[:3])])
                shares.append(float(share))
            found = (pa.array(scores, pa.float64()), pa.array(shown, evidence), pa.array(shares, pa.float64()))
            yield pa.RecordBatch.from_arrays([*part.columns[: len(carry)], *(f.take(texts.indices) for f in found)], names=[*carry, "score", "evidence", "opened"])

    return docs.select(*carry, F.col("text").alias("_text")).mapInArrow(lean(run), f"{fields}, score double, evidence array<struct<doc_id: long, label: int, cosine: double>>, opened double")
