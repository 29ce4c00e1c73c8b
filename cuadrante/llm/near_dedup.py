"""Near duplicates by MinHash with tensored banding, verified on whole shingle sets.

A table key is a pair of half keys, one from each of two collections of ``HALVES``
half keys; a half key joins ``ROWS`` minhashes.  So HALVES * HALVES tables of 2 * ROWS
minhashes each need 2 * HALVES * ROWS minhashes instead of HALVES times as many.  At
a similarity of 0.85 a pair meets in no table with probability
2 * (1 - 0.85 ** ROWS) ** HALVES, some 2e-5 for the values below.

Nothing is emitted per pair of documents in a bucket.  Texts with one shingle set are
one class from the start.  A class enters tables only with half keys it shares with
another class.  In each bucket the others meet its least member (a star).  Verified
stars are contracted to components, and only buckets that still hold several
components compare members across them, each pair once, and only where an exact bound
lets them be similar: a shingle no other candidate holds cannot be in an intersection.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuadrante.llm.common import bounded
from cuadrante.llm.words import mix, ngrams, shingles, text_bytes, text_words
from cuadrante.llm.worker import lean
from cuadrante.operators.clusters import components
from cuadrante.operators.ranking import sequential_id
from cuadrante.session import pin

HALVES = 12
ROWS = 3
SHINGLE = 5
PERCENT = 85
BLOCK = 4096  # shingles hashed at once

_SEEDS = np.random.default_rng(85).integers(1, 2**63, 2 * HALVES * ROWS, dtype=np.uint64) | np.uint64(1)
_SIGN_SCHEMA = "doc_id long, n_shingles long, d1 long, d2 long, halves array<long>"
_SIGN_ARROW = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("halves", pa.list_(pa.int64()))])
_SETS_SCHEMA = "doc_id long, d1 long, shingles array<long>"
_SETS_ARROW = pa.schema([("doc_id", pa.int64()), ("d1", pa.int64()), ("shingles", pa.list_(pa.int64()))])


def _digest(s: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart, whatever their order."""
    with np.errstate(over="ignore"):
        return int(mix(s).sum(dtype=np.uint64).view(np.int64)), int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64))


def half_keys(s: np.ndarray) -> np.ndarray:
    """The 2 * HALVES half keys of a shingle set."""
    least = np.full(len(_SEEDS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(s), BLOCK):
        h = s[at : at + BLOCK, None] * _SEEDS
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        np.minimum(least, h.min(axis=0), out=least)
    rows = least.reshape(2 * HALVES, ROWS)
    return ngrams(rows.ravel(), ROWS)[::ROWS].view(np.int64)


def _text_shingles(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    for b in text_bytes(texts):
        yield shingles(text_words(b), size)


def _sign(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, d1, d2, halves = [], [], [], []
            for s in _text_shingles(batch.column(1), size):
                counts.append(len(s))
                a, b = _digest(s)
                d1.append(a)
                d2.append(b)
                halves.append(half_keys(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(halves, pa.list_(pa.int64()))], schema=_SIGN_ARROW)

    return lean(run)


def _gather_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, 256) for at in range(0, batch.num_rows, 256)):
                d1, sets = [], []
                for s in _text_shingles(part.column(1), size):
                    d1.append(_digest(s)[0])
                    sets.append(s.view(np.int64))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(d1, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], schema=_SETS_ARROW)

    return lean(run)


def _tables(classes: DataFrame) -> DataFrame:
    """Rows (key, rep, a, b): the tables each class enters; ``a`` and ``b`` hold its
    shared half keys, null elsewhere."""
    halves = classes.select("rep", F.posexplode("halves").alias("i", "half"))
    shared = halves.groupBy("i", "half").agg(F.min("rep").alias("_lo"), F.max("rep").alias("_hi")).filter("_lo < _hi").select("i", "half")
    met = halves.join(shared, ["i", "half"], "left_semi").groupBy("rep").agg(F.map_from_entries(F.array_sort(F.array_distinct(F.collect_list(F.struct("i", "half"))))).alias("_met"))
    sides = met.select(
        "rep",
        *(F.transform(F.sequence(F.lit(start), F.lit(start + HALVES - 1)), lambda i: F.element_at("_met", i)).alias(side) for side, start in (("a", 0), ("b", HALVES))),
    )
    pairs = sides.select("rep", "a", "b", F.posexplode("a").alias("i", "_ha")).filter("_ha is not null")
    pairs = pairs.select("rep", "a", "b", "i", "_ha", F.posexplode("b").alias("j", "_hb")).filter("_hb is not null")
    return pairs.select(F.xxhash64("i", "_ha", "j", "_hb").alias("key"), "rep", "a", "b", "i", "j")


def _first_met(side: str) -> Column:
    """The first place at which two classes share a half key of this side."""
    out = None
    for k in range(HALVES):
        same = F.col(f"x.{side}")[k] == F.col(f"y.{side}")[k]
        out = F.when(same, k) if out is None else out.when(same, k)
    return out


def _may_link(n1: str, u1: str, n2: str, u2: str, percent: int) -> Column:
    """Whether sets of these sizes, with so many shingles of their own, can be similar."""
    most = F.least(F.col(n1) - F.col(u1), F.col(n2) - F.col(u2))
    return 100 * most >= percent * (F.col(n1) + F.col(n2) - most)


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) whose whole sets are similar enough, with the similarity."""
    left = sets.select(F.col("rep").alias("x"), F.col("shingles").alias("_sx"))
    right = sets.select(F.col("rep").alias("y"), F.col("shingles").alias("_sy"))
    common = F.size(F.array_intersect("_sx", "_sy"))
    both = pairs.join(left, "x").join(right, "y").select("x", "y", common.alias("_i"), (F.size("_sx") + F.size("_sy")).alias("_n"))
    both = both.select("x", "y", "_i", (F.col("_n") - F.col("_i")).alias("_u"))
    return both.filter(100 * F.col("_i") >= percent * F.col("_u")).select(F.col("x").alias("l"), F.col("y").alias("r"), (F.col("_i") / F.col("_u")).alias("similarity"))


def near_links(docs: DataFrame, signed: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """Verified links (l, r, similarity) between class representatives that join every
    component: not all links, but none is left out that would join two components.

    ``docs`` is (doc_id, text); ``signed`` the written representatives with their keys.
    """
    tables = pin(_tables(signed.select(F.col("doc_id").alias("rep"), "halves")))
    several = tables.groupBy("key").agg(F.min("rep").alias("_lo"), F.max("rep").alias("_hi")).filter("_lo < _hi").select("key")
    tables = pin(tables.join(several, "key", "left_semi"))

    wanted = pin(tables.select("rep").distinct())
    keyed = signed.select(F.col("doc_id").alias("rep"), "d1")
    texts = docs.join(bounded(wanted), docs["doc_id"] == wanted["rep"], "left_semi")
    sets = texts.mapInArrow(_gather_sets(size), _SETS_SCHEMA).withColumnRenamed("doc_id", "rep")
    sets = pin(sets.join(keyed.join(wanted, "rep", "left_semi"), ["rep", "d1"], "left_semi").dropDuplicates(["rep", "d1"]))
    # Shingles that one candidate alone holds, by candidate.
    held = sets.select("rep", F.explode("shingles").alias("s")).groupBy("s").agg(F.min("rep").alias("rep"), F.count(F.lit(1)).alias("_n"))
    own = held.filter("_n = 1").groupBy("rep").agg(F.count(F.lit(1)).alias("own"))
    sizes = sets.groupBy("rep").agg(F.max(F.size("shingles")).alias("n")).join(own, "rep", "left").select("rep", "n", F.coalesce("own", F.lit(0)).alias("own"))
    sizes = pin(sizes.filter(100 * (F.col("n") - F.col("own")) >= percent * F.col("n")))
    tables = pin(tables.join(bounded(sizes), "rep"))

    heads = tables.groupBy("key").agg(F.min(F.struct("rep", "n", "own")).alias("_h")).select("key", F.col("_h.rep").alias("x"), F.col("_h.n").alias("_nx"), F.col("_h.own").alias("_ux"))
    stars = tables.join(heads, "key").filter(F.col("rep") != F.col("x")).filter(_may_link("n", "own", "_nx", "_ux", percent))
    links = pin(_linked(stars.select("x", F.col("rep").alias("y")).distinct(), sets, percent))

    nodes = sizes.select(F.col("rep").alias("node"), F.col("rep").alias("label"))
    label = components(nodes, links.select("l", "r")).select(F.col("node").alias("rep"), "label")
    tables = tables.join(bounded(pin(label)), "rep")
    split = tables.groupBy("key").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi")).filter("_lo < _hi").select("key")
    rest = pin(tables.join(split, "key", "left_semi"))
    across = (
        (F.col("x.key") == F.col("y.key"))
        & (F.col("x.label") != F.col("y.label"))
        & (F.col("x.rep") < F.col("y.rep"))
        & _may_link("x.n", "x.own", "y.n", "y.own", percent)
        & (_first_met("a") == F.col("x.i"))
        & (_first_met("b") == F.col("x.j"))
    )
    pairs = rest.alias("x").join(rest.alias("y"), across).select(F.col("x.rep").alias("x"), F.col("y.rep").alias("y"))
    return links.unionByName(pin(_linked(pairs, sets, percent)))


def _several_texts(docs: DataFrame, classed: DataFrame, several: DataFrame, percent: int, size: int) -> DataFrame:
    """The result where the ids in ``several`` have rows of different shingle sets.

    Classes are numbered in the order of their least ids, so that two classes with one
    least id are told apart; the classes of one id are linked.
    """
    classes = classed.filter("n_shingles > 0 and doc_id = rep").select("rep", "d1", "d2", "halves").dropDuplicates(["rep", "d1", "d2"])
    classes = pin(sequential_id(classes, ["rep", "d1", "d2"], start=0, name="class"))
    texts = docs.join(classes.select(F.col("rep").alias("doc_id"), "class"), "doc_id").select(F.col("class").alias("doc_id"), "text")
    links = near_links(texts, classes.select(F.col("class").alias("doc_id"), "d1", "halves"), percent, size).select("l", "r")
    rows = pin(classed.select("doc_id", "n_shingles", "rep", "d1", "d2").join(classes.drop("halves"), ["rep", "d1", "d2"], "left"))
    shared = rows.join(several, "doc_id", "left_semi").filter("class is not null")
    least = shared.groupBy("doc_id").agg(F.min("class").alias("l"))
    same = shared.join(least, "doc_id").filter("l <> class").select("l", F.col("class").alias("r"))
    edges = pin(links.unionByName(same).distinct())
    nodes = pin(edges.select(F.col("l").alias("node")).union(edges.select("r")).distinct().select("node", F.col("node").alias("label")))
    labels = components(nodes, edges).select(F.col("node").alias("class"), "label")
    named = labels.join(classes.select(F.col("class").alias("label"), F.col("rep").alias("_name")), "label").select("class", "_name")
    out = pin(rows.join(named, "class", "left").select("doc_id", "n_shingles", F.coalesce("_name", "rep").alias("component_id")))
    # Rows without shingles go with the other rows of their id.
    by_id = out.join(several, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("component_id").alias("_of_id"))
    component = F.coalesce("_of_id", "component_id")
    return out.join(by_id, "doc_id", "left").select("doc_id", "n_shingles", component.alias("component_id"), (component.isNull() | F.col("doc_id").eqNullSafe(component)).alias("kept"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every row.

    Documents are linked when 100 * intersection >= ``percent`` * union of their sets of
    distinct ``size``-word shingles; ``component_id`` is the least id reachable and
    ``kept`` marks the document that has it.

    Null and empty texts have no shingles and stand alone.  Rows that repeat an id
    belong together.  Rows without an id take part in no comparison: they share the
    component of equal texts, or have none and are kept.  Other columns are not looked
    at; an empty table gives no rows.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = pin(docs.mapInArrow(_sign(size), _SIGN_SCHEMA))
    differ = (F.min("d1") != F.max("d1")) | (F.min("d2") != F.max("d2"))
    several = pin(signed.filter("doc_id is not null").groupBy("doc_id").agg(differ.alias("_differ")).filter("_differ").select("doc_id"))
    full = signed.filter("n_shingles > 0")
    copies = full.groupBy("d1", "d2").agg(F.min("doc_id").alias("_rep"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("d1", "d2", "_rep", F.lit(True).alias("_copied"))
    copies = pin(copies)
    classed = signed.join(bounded(copies), ["d1", "d2"], "left")
    classed = classed.withColumn("rep", F.when(F.col("n_shingles") > 0, F.coalesce("_rep", "doc_id")).otherwise(F.col("doc_id")))
    if not several.isEmpty():
        return _several_texts(docs, pin(classed), several, percent, size).withColumnRenamed("doc_id", id_col)
    chosen = pin(classed.filter("n_shingles > 0 and doc_id = rep").select("doc_id", "d1", "halves").dropDuplicates(["doc_id", "d1"]))
    links = near_links(docs, chosen, percent, size)
    ends = links.select(F.col("l").alias("node")).union(links.select("r")).distinct()
    labels = components(pin(ends.select("node", F.col("node").alias("label"))), links.select("l", "r"))
    labels = pin(labels.filter("node <> label").select(F.col("node").alias("rep"), "label"))
    out = classed.select("doc_id", "n_shingles", "rep").join(bounded(labels), "rep", "left")
    component = F.coalesce("label", "rep")
    return out.select(F.col("doc_id").alias(id_col), "n_shingles", component.alias("component_id"), (component.isNull() | F.col("doc_id").eqNullSafe(component)).alias("kept"))
