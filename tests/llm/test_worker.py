"""Workers live through all stages: what one leaves must not weigh on the next."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from documents import frame  # noqa: F401

from cuadrante.llm import near_dedup, packing, quality
from cuadrante.llm.word_table import WordTable, between_spaces

WORDS = public_tokenizers.path("word_bpe_49k.json")
BATCH = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["a few words of a text", None]})


class Caught(Exception):
    pass


class Docs:
    """Stands for a frame and gives the function of its tasks."""

    def __init__(self, docs):
        self.docs, self.sparkSession = docs, docs.sparkSession

    def select(self, *cols):
        return Docs(self.docs.select(*cols))

    @property
    def schema(self):
        return self.docs.schema

    def mapInArrow(self, run, schema):
        raise Caught(run)


def tasks_of(make, docs):
    with pytest.raises(Caught) as caught:
        make(Docs(docs))
    return caught.value.args[0]


def test_word_tables_of_packing_are_given_back(frame):
    docs = frame([(1, "a few words")])
    score = tasks_of(lambda d: quality.score_quality(d, np.zeros(((1 << quality.BITS) + 1, 1))), docs)
    for run in (near_dedup._sign(5), near_dedup._gather_sets(5), score):
        WordTable.of(WORDS, between_spaces, True, places=1 << 10)
        assert sum(b.num_rows for b in run(iter([BATCH]))) == 2 and not WordTable.made


def test_tables_stay_between_tasks_of_packing(frame):
    run = tasks_of(lambda d: packing.token_pieces(d, WORDS, places=1 << 10), frame([(1, "a few words")]))
    list(run(iter([BATCH])))
    (table,) = WordTable.made.values()
    list(run(iter([BATCH])))
    assert list(WordTable.made.values()) == [table] and len(table.bytes) == 1 << 10


def test_pieces_do_not_depend_on_what_a_worker_holds(frame):
    docs = frame([(i, " ".join(f"word{(i * 31 + k * k) % 977} Straße" for k in range(i * 40))) for i in range(60)] + [(100, None), (101, "")])
    few = packing.token_pieces(docs, WORDS, places=1 << 8, block=100)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, packing.token_pieces(docs, WORDS).collect()))
