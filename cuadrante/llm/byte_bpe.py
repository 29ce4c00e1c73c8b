"""Byte-level BPE: ranked merges folded by Spark's higher-order functions.

``encoded`` is one expression: it cuts a text by the pattern, folds the merges over
the bytes of each match with a literal rank map, and gives the ids.  Over a corpus it
runs on distinct words, once for each of the ``KEPT_WORDS`` most frequent.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cuadrante.session import pin

BUCKETS = 1 << 16  # of the rank map, so that a look-up does not scan all of it
KEPT_WORDS = 1 << 19
KEPT_CHARS = 64  # longer words are never kept, which bounds what is broadcast
TAIL_WORDS = 400_000  # other words a worker keeps
LONG_BYTES = 500
_PACK = [struct.Struct(f"<{n}I").pack for n in range(32)]
LONG_WORD = 48  # pieces from which neighbouring equal merges are told apart in one pass
DOCS = 250  # encoded at once


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks by token from a file of lines "base64 rank"."""
    lines = (line.split() for line in Path(path).read_bytes().splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in lines}


def rank_map(spark: SparkSession, ranks: dict[bytes, int]) -> Column:
    """A literal array of small maps; a token's place is its hash."""
    tokens = list(ranks)
    table = spark.createDataFrame(pa.table({"t": pa.array([t.decode("latin-1") for t in tokens])}))
    places = {r["t"].encode("latin-1"): r["p"] for r in table.select("t", F.pmod(F.xxhash64("t"), F.lit(BUCKETS)).alias("p")).collect()}  # the vocabulary, already on the driver
    buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for token in tokens:
        buckets[places[token]][token.decode("latin-1")] = ranks[token]
    # Without higher-order functions, so that the planner folds it to a literal.
    return F.from_json(F.lit(json.dumps(buckets, separators=(",", ":"))), "array<map<string,int>>")


def _rank(k: Column, ranks: Column) -> Column:
    """The rank of a piece, null if it has none."""
    return F.try_element_at(F.get(ranks, F.pmod(F.xxhash64(k), F.lit(BUCKETS)).cast("int")), k)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _pair_ranks(pieces: Column, ranks: Column) -> Column:
    """The rank of each pair of neighbours."""
    return F.transform(F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0))), lambda x, i: _rank(F.concat(x, F.get(pieces, i + 1)), ranks))


def _merge_one(p: Column, f: Column, least: Column, ranks: Column) -> Column:
    """The first pair of the least rank becomes one piece; two pairs get new ranks."""
    none = F.array().cast("array<int>")

    def at(k: Column) -> Column:
        def put(m: Column) -> Column:
            left = F.when(k > 1, F.array(_rank(F.concat(F.get(p, k - 2), m), ranks))).otherwise(none)
            right = F.when(k + 1 < F.size(p), F.array(_rank(F.concat(m, F.get(p, k + 1)), ranks))).otherwise(none)
            return F.struct(
                F.concat(F.slice(p, F.lit(1), k - 1), F.array(m), F.slice(p, k + 2, F.size(p))).alias("p"),
                F.concat(F.slice(f, F.lit(1), F.greatest(k - 2, F.lit(0))), left, right, F.slice(f, k + 2, F.size(f) + 1)).alias("f"),
            )

        return _let(F.concat(F.get(p, k - 1), F.get(p, k)), put)

    return _let(F.array_position(f, least).cast("int"), at)


def _merge_all(p: Column, f: Column, least: Column, ranks: Column) -> Column:
    """All pairs of the least rank become one piece each, in one pass.  In a run of such
    pairs every other one does, from the left."""
    marks = F.array_join(F.transform(f, lambda r: F.when(r == least, "1").otherwise("0")), "")
    starts = F.transform(F.split(F.replace(marks, F.lit("11"), F.lit("10")), ""), lambda m: m == "1")
    after = _let(
        starts,
        lambda s: F.filter(
            F.transform(p, lambda x, i: F.when(F.get(s, i), F.concat(x, F.get(p, i + 1))).when(F.get(s, i - 1), F.lit(None).cast("string")).otherwise(x)),
            lambda x: x.isNotNull(),
        ),
    )
    return _let(after, lambda q: F.struct(q.alias("p"), _pair_ranks(q, ranks).alias("f")))


def fold_merges(word: Column, ranks: Column) -> Column:
    """The ids of one word, given as text: merges of the lowest rank first, over its
    UTF-8 bytes.  Each byte is written as the character of that number."""
    raw = F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")

    def step(acc: Column, _: Column) -> Column:
        p, f = acc["p"], acc["f"]

        def merge(least: Column) -> Column:
            settled = F.struct(p.alias("p"), F.array().cast("array<int>").alias("f"))
            more = F.when(F.size(p) > LONG_WORD, _merge_all(p, f, least, ranks)).otherwise(_merge_one(p, f, least, ranks))
            return F.when(least.isNull(), settled).otherwise(more)

        return F.when(F.size(f) == 0, acc).otherwise(_let(F.array_min(f), merge))

    def folded(w: Column) -> Column:
        start = _let(F.split(w, ""), lambda p: F.struct(p.alias("p"), _pair_ranks(p, ranks).alias("f")))
        return F.aggregate(F.sequence(F.lit(1), F.length(w)), start, step, lambda acc: F.transform(acc["p"], lambda p: _rank(p, ranks)))

    return _let(raw, lambda w: _let(_rank(w, ranks), lambda r: F.when(r.isNotNull(), F.array(r)).otherwise(folded(w))))


def encoded(words: Column, ranks: Column, pattern: str) -> Column:
    """The ids of each of an array of texts, each match of ``pattern`` by itself."""
    cut = F.lit(f"(?U)({pattern})")
    # The map is bound once, so that the plan holds one copy of it.
    return _let(ranks, lambda r: F.transform(words, lambda t: F.flatten(F.transform(F.regexp_extract_all(t, cut, F.lit(1)), lambda w: fold_merges(w, r)))))


_BLANK_BEFORE = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= )")


def words_of(text: str) -> list[str]:
    """``text`` cut before each blank that follows a character that is not white space.
    No match of the pattern crosses such a place, so the ids of the parts add up."""
    if _BLANK_BEFORE.search(text):
        return _CUT.split(text)
    first, *rest = text.split(" ")
    return [first, *(" " + w for w in rest)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen: Counter = Counter()
        for t in batch.column(0).to_pylist():
            if t:
                seen.update(words_of(t))
        words = [w for w in seen if 0 < len(w) <= KEPT_CHARS]
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([seen[w] for w in words], pa.int64())], names=["word", "n"])


def frequent_words(docs: DataFrame, most: int = KEPT_WORDS) -> DataFrame:
    """The words that occur most often, ``most`` at the most: all whose count reaches
    the least class of counts (eight to a doubling) down to which they fit."""
    counts = pin(docs.select("text").mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter("n > 1"))
    step = F.floor(F.log2("n") * 8).cast("int")
    classes = sorted(((r["c"], r["k"]) for r in counts.groupBy(step.alias("c")).agg(F.count(F.lit(1)).alias("k")).collect()), reverse=True)  # some hundreds of classes
    least, total = None, 0
    for c, k in classes:
        if total + k > most:
            break
        least, total = c, total + k
    return counts.filter(step >= least if least is not None else F.lit(False)).select("word")


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one word by the same rule as ``fold_merges``."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > LONG_BYTES:
        return _merge_long(word, ranks)
    find, none = ranks.get, len(ranks) + 1
    at = list(range(len(word) + 1))  # where pieces start
    pair = [find(word[i : i + 2], none) for i in range(len(word) - 1)]
    while pair:
        least = min(pair)
        if least == none:
            break
        k = pair.index(least)
        del at[k + 1], pair[k]
        if k < len(pair):
            pair[k] = find(word[at[k] : at[k + 2]], none)
        if k:
            pair[k - 1] = find(word[at[k - 1] : at[k + 1]], none)
    return [ranks[word[i:j]] for i, j in zip(at, at[1:])]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """All pairs of the least rank in one pass, so that long words take few passes."""
    pieces = [word[i : i + 1] for i in range(len(word))]
    while len(pieces) > 1:
        found = [ranks.get(a + b) for a, b in zip(pieces, pieces[1:])]
        least = min((r for r in found if r is not None), default=None)
        if least is None:
            break
        after, i = [], 0
        while i < len(pieces):
            if i < len(found) and found[i] == least:
                after.append(pieces[i] + pieces[i + 1])
                i += 2
            else:
                after.append(pieces[i])
                i += 1
        pieces = after
    return [ranks[p] for p in pieces]


class _Words:
    """Ids by word as bytes: the frequent words' from Spark's fold, other words' as they
    come, kept while there is room.  Made once in a worker."""

    made: dict[str, "_Words"] = {}

    def __init__(self, frequent, ranks: dict[bytes, int], pattern: str):
        import regex

        words, ids, ends = frequent
        cuts = [0, *ends.tolist()]
        self.known = {w: ids[a:b] for w, a, b in zip(words.to_pylist(), cuts[:-1], cuts[1:])}
        self.room = len(self.known) + TAIL_WORDS
        self.ranks, self.pattern = ranks, regex.compile(pattern)

    @classmethod
    def of(cls, name: str, frequent, ranks, pattern: str) -> "_Words":
        if name not in cls.made:
            cls.made.clear()
            cls.made[name] = cls(frequent.value, ranks.value, pattern)
        return cls.made[name]

    def rest(self, word: str) -> bytes:
        parts = self.pattern.findall(word)
        if len(parts) > 1:  # a word and what clings to it: often known apart
            out = b"".join([self.known.get(m) or self._merged(m) for m in parts])
        else:
            out = self._merged(word)
        if len(self.known) < self.room and len(word) <= KEPT_CHARS:
            self.known[word] = out
        return out

    def _merged(self, part: str) -> bytes:
        ids = merge(part.encode(), self.ranks)
        return _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        words = words_of(text)
        found = list(map(self.known.get, words))
        if None in found:
            found = [self.rest(w) if ids is None else ids for w, ids in zip(words, found)]
        return b"".join(found)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, digests: bool = False, most: int = KEPT_WORDS) -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian unsigned 32-bit numbers) of each whole text.

    Spark folds the merges over each of the ``most`` most frequent distinct words once;
    their table is sent to the tasks, where documents are cut into words and looked up.
    Words that are not in it are merged in the task by the same rule.  (To fold those
    too within each row gives the same ids at five times the cost; see the README.)

    With ``digests`` the ids are decoded again and the columns are ``n_tokens``,
    ``ids_sha256`` and ``decoded_sha256`` instead.  Null text counts as empty and has no
    ids.  Rows are kept as they come; columns other than doc_id and text are left out.
    """
    spark = docs.sparkSession
    ranks = read_ranks(ranks_path)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    frequent = pin(frequent_words(docs, most).repartition(max(12, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    folded = pin(frequent.select("word", F.get(encoded(F.array("word"), rank_map(spark, ranks), pattern), F.lit(0)).alias("ids")))
    kept = folded.toArrow().combine_chunks()  # bounded by ``most`` words of bounded length
    words, ids = (pa.concat_arrays(kept[c].chunks) if kept.num_rows else pa.array([], kept.schema.field(c).type) for c in ("word", "ids"))
    ends = np.cumsum(pa.compute.list_value_length(ids).to_numpy(zero_copy_only=False)).astype(np.int64) * 4
    sent = spark.sparkContext.broadcast((words, ids.flatten().to_numpy().astype("<u4").tobytes(), ends))
    sent_ranks, name = spark.sparkContext.broadcast(ranks), uuid.uuid4().hex
    fields = [("doc_id", pa.int64())] + ([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())] if digests else [("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _Words.of(name, sent, sent_ranks, pattern)
        piece = {rank: token for token, rank in table.ranks.items()}.__getitem__
        for batch in batches:
            for part in (batch.slice(at, DOCS) for at in range(0, batch.num_rows, DOCS)):
                rows = []
                for i, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = table.encode(text) if text else b""
                    if digests:
                        decoded = b"".join(map(piece, np.frombuffer(ids, "<u4").tolist()))
                        rows.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()))
                    else:
                        rows.append((i, ids))
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(zip(*rows), fields)], names=[n for n, _ in fields])

    return docs.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "doc_id long, ids binary")


def decode_documents(encoded_docs: DataFrame, ranks_path: str) -> DataFrame:
    """``doc_id`` and ``text_bytes``: the tokens' bytes, joined by Spark."""
    ranks = read_ranks(ranks_path)
    most = max(ranks.values())
    by_rank = {r: t for t, r in ranks.items()}
    tokens = F.from_json(F.lit(json.dumps([by_rank.get(r, b"").decode("latin-1") for r in range(most + 1)])), "array<string>")

    def to_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = pa.array([None if x.as_py() is None else np.frombuffer(x.as_py(), "<u4").astype(np.int32) for x in batch.column(1)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["doc_id", "ids"])

    rows = encoded_docs.select("doc_id", "ids").mapInArrow(to_ids, "doc_id long, ids array<int>")
    text = _let(tokens, lambda t: F.array_join(F.transform("ids", lambda i: F.get(t, i)), ""))
    return rows.select("doc_id", F.encode(text, "ISO-8859-1").alias("text_bytes"))
