"""Phrase collocations: which neighbouring words belong together in each language.

A word's id is a 64-bit hash of its language and its letters; ids that two words share
are found and given away anew.  Words, pairs and triples are counted in turn, and each
pass leaves out what cannot be frequent because a part of it is not: frequent parts are
known from a Bloom filter of bounded size, which never misses one.  Counts are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuadrante.llm.common import bounded
from cuadrante.llm.hat_trie import PHRASES, HatTrie, Slots, merged
from cuadrante.llm.word_table import BLOCK, text_blocks
from cuadrante.llm.words import FOLD, mix
from cuadrante.session import pin

MIN_COUNT = 10
TOP = 2000
SHARE = 50  # percent of a phrase's occurrences in a longer one that make it a part of that
KEY_BYTES = 24  # longer words are hashed one by one
WORDS_HELD = 1 << 20  # distinct words of a task, some 150 MB
PART_PHRASES = 1 << 19  # occurrences for each prefix partition
PART_BITS = (4, 16)
FILTER_BITS = (16, 29)  # of a Bloom filter: 64 MB at most
FILTER_ROOM = 32  # bits for an entry, while there is room
SALT_ROWS = 250_000

_KIND = np.zeros(256, np.uint8)  # 0 a word's byte, 1 between words, 2 between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def word_places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where the words of texts begin and end, each one's piece (numbers that rise), and
    its text."""
    kind = _KIND[data]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = kind == 0
    starts, ends = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    edge = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]  # words end with their text
    starts[edge] = inside[1:-1][edge]
    ends[edge - 1] |= inside[1:-1][edge - 1]
    first, stop = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    text = np.searchsorted(offsets, first, side="right") - 1
    return first, stop, np.searchsorted(np.flatnonzero(kind == 2), first) + text, text


def word_ids(data: np.ndarray, first: np.ndarray, stop: np.ndarray, lang: np.ndarray, again: np.ndarray) -> np.ndarray:
    """The id of each word, ``lang`` being a hash of its language.  Ids in ``again`` are
    shared by several words, which get other ones."""
    import xxhash

    width = stop - first
    padded = np.zeros(len(data) + KEY_BYTES + 8, np.uint8)
    padded[: len(data)] = data
    loads = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))  # eight bytes from each byte on
    h = width.astype(np.uint64)
    for k in range(3):  # sums alone would be equal for too many words that are alike
        h = mix(h * _ODD[3] ^ (loads[np.minimum(first + 8 * k, len(loads) - 1)] & _MASK[np.clip(width - 8 * k, 0, 8)]) * _ODD[k])
    for k in np.flatnonzero(width > KEY_BYTES).tolist():
        h[k] = xxhash.xxh3_64_intdigest(data[first[k] : stop[k]].tobytes())
    ids = mix(mix(h) ^ lang)
    if len(again):
        for k in np.flatnonzero(np.isin(ids, again)).tolist():
            ids[k] = xxhash.xxh3_64_intdigest(data[first[k] : stop[k]].tobytes(), seed=int(lang[k]) ^ len(again))
    return ids


def lang_hashes(langs: list[str]) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh3_64_intdigest(x.encode()) for x in langs], np.uint64)


def _cut(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A block as it is, but a long text between pieces."""
    if len(data) <= 2 * BLOCK:
        yield data, offsets
        return
    cuts = np.flatnonzero(_KIND[data] == 2) + 1
    near = np.searchsorted(cuts, np.arange(BLOCK, len(data), BLOCK))
    cuts = np.unique(np.concatenate([[0], cuts[near[near < len(cuts)]], [len(data)]]))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        yield data[a:b], np.array([0, b - a])


def _blocks(batches: Iterator[pa.RecordBatch], again: np.ndarray):
    """Of each block of texts: the bytes, where words begin and end, their pieces, ids and
    languages."""
    for batch in batches:
        langs = batch.column(0).to_pylist()
        known = {x: h for x, h in zip(set(langs), lang_hashes(list(set(langs))))}
        of_text = np.array([known[x] for x in langs], np.uint64)
        for a, b, data, offsets in text_blocks(batch.column(1)):
            for data, offsets in _cut(FOLD[data], offsets):
                first, stop, piece, text = word_places(data, offsets)
                if len(first):
                    yield data, first, stop, piece, word_ids(data, first, stop, of_text[a:b][text], again), text + a, langs


def count_words(docs: DataFrame, again: list[int], held: int = WORDS_HELD) -> DataFrame:
    """``id``, ``lang``, ``word`` and ``f`` of every word of ``docs`` (lang, text)."""
    schema = pa.schema([("id", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])
    shared = np.array(again, np.int64).view(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            n = slots.n
            return pa.RecordBatch.from_arrays([pa.array(slots.keys[:n].view(np.int64)), pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(counts[:n])], schema=schema)

        slots, counts, langs, words = Slots(1 << 12), np.zeros(1 << 12, np.int64), [], []
        for data, first, stop, _, ids, text, lang in _blocks(batches, shared):
            own, one, n = np.unique(ids, return_index=True, return_counts=True)
            before = slots.n
            at = slots.numbers(own)
            new = np.flatnonzero(at >= before)
            w = one[new]
            langs += [lang[t] for t in text[w].tolist()]
            words += [data[a:b].tobytes() for a, b in zip(first[w].tolist(), stop[w].tolist())]
            if slots.n > len(counts):
                counts = np.concatenate([counts, np.zeros(max(slots.n, len(counts)), np.int64)])
            counts[at] += n
            if slots.n >= held:
                yield rows()
                slots, counts, langs, words = Slots(1 << 12), np.zeros(1 << 12, np.int64), [], []
        if slots.n:
            yield rows()

    parts = docs.mapInArrow(run, "id long, lang string, word string, n long")
    # The rows of an id meet in one task, so nothing moves to see which ids are shared.
    return parts.repartition("id").groupBy("id", "lang", "word").agg(F.sum("n").alias("f"))


def every_word(docs: DataFrame) -> tuple[DataFrame, list[int]]:
    """The words with ids of their own, and the hashes that were given away anew for it."""
    again: list[int] = []
    while True:
        words = pin(count_words(docs, again))
        clash = words.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id")
        found = [r["id"] for r in clash.collect()]  # of n words, n * n / 2**65 are expected
        if not found:
            return words, again
        again += found


def bloom_filter(codes: DataFrame) -> np.ndarray:
    """A filter of the 64-bit ``code`` of each row, in words of 64 bits.  Its size follows
    the rows up to a bound; beyond it more codes pass that need not, and none is lost."""
    n = codes.count()
    bits = min(max(int(n * FILTER_ROOM).bit_length(), FILTER_BITS[0]), FILTER_BITS[1])
    mask = (1 << bits) - 1
    place = F.explode(F.array(F.col("code").bitwiseAND(F.lit(mask)), F.shiftrightunsigned("code", 32).bitwiseAND(F.lit(mask)))).alias("p")
    bit = F.expr("shiftleft(1L, cast(p & 63 as int))")
    rows = codes.select(place).groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(bit).alias("b")).toArrow()  # no more than the filter's words
    out = np.zeros(max(1, 1 << bits >> 6), np.uint64)
    out[rows["w"].to_numpy()] = rows["b"].to_numpy().view(np.uint64)
    return out


def may_hold(filled: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Which codes the filter may hold."""
    mask = np.uint64(len(filled) * 64 - 1)
    out = np.ones(len(codes), bool)
    for shift in (0, 32):
        at = (codes >> np.uint64(shift)) & mask
        out &= (filled[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return out


def pair_codes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * _ODD[0] + second * _ODD[1])


def count_phrases(docs: DataFrame, length: int, filled: np.ndarray, again: list[int], part_bits: int, least: int = MIN_COUNT, **limits) -> DataFrame:
    """``i1`` .. ``i<length>`` (word ids), ``f`` and, for pairs, their ``code``, of the
    phrases of ``length`` words that occur ``least`` times or more.

    ``filled`` is the filter of frequent words for pairs, of frequent pairs for triples.
    Tasks count in a trie each; its runs meet by prefix partition and are merged there.
    """
    spark = docs.sparkSession
    shared, sent = np.array(again, np.int64).view(np.uint64), spark.sparkContext.broadcast(filled)
    names = [f"i{k + 1}" for k in range(length)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(runs) -> Iterator[pa.RecordBatch]:
            for part, run in runs:
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([run], pa.binary())], names=["part", "run"])

        trie = HatTrie(length, part_bits, **limits)
        for _, _, _, piece, ids, _, _ in _blocks(batches, shared):
            if length == 2:
                fit = may_hold(sent.value, ids)
                at = np.flatnonzero((piece[1:] == piece[:-1]) & fit[1:] & fit[:-1])
            else:
                fit = np.zeros(max(len(ids) - 1, 0), bool)
                near = np.flatnonzero(piece[1:] == piece[:-1])
                fit[near] = may_hold(sent.value, pair_codes(ids[near], ids[near + 1]))
                at = np.flatnonzero(fit[1:] & fit[:-1])
            for some in range(0, len(at), PHRASES):
                yield from rows(trie.add(ids, at[some : some + PHRASES]))
        yield from rows(trie.spill_all())

    def merge(table: pa.Table) -> pa.Table:
        columns, sums = merged(table["run"].to_pylist(), least)
        out = {n: pa.array(c.view(np.int64)) for n, c in zip(names, columns)} | {"f": pa.array(sums)}
        if length == 2:
            out["code"] = pa.array(pair_codes(*columns).view(np.int64))
        return pa.table(out)

    runs = docs.mapInArrow(count, "part int, run binary")
    ddl = ", ".join(f"{n} long" for n in names) + ", f long" + ", code long" * (length == 2)
    return runs.groupBy("part").applyInArrow(merge, ddl)


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)) in whole numbers."""
    big = {c: f"cast({c} as decimal(19,0))" for c in (a, left, right)}
    square = f"cast({big[a]} * {big[a]} as decimal(31,0))"
    return F.expr(f"({square} * cast(1000000 as decimal(7,0))) div ({big[left]} * {big[right]})").cast("long")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = MIN_COUNT, top: int = TOP, **limits) -> DataFrame:
    """The first ``top`` phrases of two or three words of each language: ``lang``, ``rank``,
    ``phrase``, ``a`` (its occurrences), ``l`` and ``r`` (those of the parts at its weakest
    cut), ``n`` (words of the language) and ``score``.

    A-Z are made lower, pieces end at ``.,;:!?`` and line ends, words at blanks and tabs.
    Phrases occur ``least`` times or more, and not mostly within a longer one.  Null text
    counts as empty, a null language as ``und``; every row counts, also repeated ones; a
    table without words gives no rows; other columns are left out.  ``limits`` are those
    of ``HatTrie``.
    """
    docs = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    words, again = every_word(docs)
    totals = pin(words.groupBy("lang").agg(F.sum("f").alias("n")))
    n = words.agg(F.sum("f")).first()[0] or 0
    part_bits = min(max((n // PART_PHRASES).bit_length(), PART_BITS[0]), PART_BITS[1])
    frequent = pin(words.filter(F.col("f") >= least))
    pairs = pin(count_phrases(docs, 2, bloom_filter(frequent.select(F.col("id").alias("code"))), again, part_bits, least, **limits))
    triples = pin(count_phrases(docs, 3, bloom_filter(pairs.select("code")), again, part_bits, least, **limits))

    one = lambda k: frequent.select(F.col("id").alias(f"i{k}"), F.col("word").alias(f"w{k}"), F.col("f").alias(f"f{k}"), *(["lang"] if k == 1 else []))
    pairs = pin(pairs.join(one(1), "i1").join(one(2), "i2").select("lang", "i1", "i2", "w1", "w2", "f1", "f2", F.col("f").alias("a")))
    left = pairs.select("lang", "i1", "i2", "w1", "w2", "f1", F.col("a").alias("f12"))
    right = pairs.select(F.col("i1").alias("i2"), F.col("i2").alias("i3"), F.col("w2").alias("w3"), F.col("f2").alias("f3"), F.col("a").alias("f23"))
    triples = pin(triples.withColumnRenamed("f", "a").join(left, ["i1", "i2"]).join(right, ["i2", "i3"]))

    cut = triples.withColumns({"s1": _score("a", "f1", "f23"), "s2": _score("a", "f12", "f3")})
    first = F.col("s1") <= F.col("s2")
    threes = cut.select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
        F.when(first, F.col("f1")).otherwise(F.col("f12")).alias("l"), F.when(first, F.col("f23")).otherwise(F.col("f3")).alias("r"), F.least("s1", "s2").alias("score"),
    )
    longer = triples.select("i1", "i2", "a").unionByName(triples.select(F.col("i2").alias("i1"), F.col("i3").alias("i2"), "a")).groupBy("i1", "i2").agg(F.max("a").alias("_most"))
    twos = pairs.join(longer, ["i1", "i2"], "left").filter(F.coalesce(100 * F.col("_most") < SHARE * F.col("a"), F.lit(True)))
    twos = twos.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), _score("a", "f1", "f2").alias("score"))
    kept = pin(threes.unionByName(twos))
    # The best of each share of a language first, so that no task ranks a whole language.
    shares = max(1, kept.count() // SALT_ROWS)
    order = [F.desc("score"), F.desc("a"), "phrase"]
    salted = kept.withColumn("_share", F.pmod(F.xxhash64("phrase"), F.lit(shares)))
    best = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_share").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(bounded(totals), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
