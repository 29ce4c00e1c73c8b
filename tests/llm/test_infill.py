"""Fill-in-middle against a plain version on code points."""

import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from documents import frame  # noqa: F401

from cuadrante.llm.infill import BLOCK, UnitEnds, fill_in_middle, restored

ODD = ["", None, "a", "ab", "naïve — ça", "日本語のテキスト です。", "🙂🙂🙃👨‍👩‍👧 x", "x <P> y", "<S>", "a<M>b", "<", "P>", "<P", "S>", "<<P", "\x00\x00", "é", "é" * 7, "\n", "<M" + "é"]


def plain(i, text, seed="1"):
    text = text or ""
    d = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h = [int(d[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def check(frame, rows):
    out = fill_in_middle(frame(rows)).withColumn("back", restored()).collect()
    got = sorted(((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["back"]) for r in out), key=str)
    assert got == sorted(((i, *plain(i, t), t or "") for i, t in rows), key=str)
    return {g[2] for g in got}


def test_odd_texts_under_many_draws(frame):
    assert check(frame, [(i, ODD[i % len(ODD)]) for i in range(600)]) == {"plain", "psm", "spm"}


def test_null_and_repeated_ids(frame):
    check(frame, [(None, "abc"), (None, None), (3, "same text"), (3, "same text"), (3, "another"), (-5, "negative")])


def test_texts_longer_than_a_block(frame):
    check(frame, [(1, "né " * BLOCK), (2, "x"), (4, "🙂" * (BLOCK // 4 + 3)), (5, "日本"), (6, None)])


def test_no_documents(frame):
    assert fill_in_middle(frame([])).count() == 0


def test_all_plain_and_all_spm(frame):
    rows = [(i, f"text {i}") for i in range(20)]
    assert {r["form"] for r in fill_in_middle(frame(rows), plain_percent=100).collect()} == {"plain"}
    assert {r["form"] for r in fill_in_middle(frame(rows), plain_percent=0, spm_percent=100).collect()} == {"spm"}


def test_outputs_of_text_near_marks_are_restored(spark):
    rows = [(i, t) for i in range(40) for t in ("<<S", "a<", "<P<S<M", "><M", "<S" * 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = fill_in_middle(docs).withColumn("back", restored()).groupBy("doc_id").agg(F.sort_array(F.collect_list("back")).alias("b"))
    assert all(r["b"] == sorted(t for i, t in rows if i == r["doc_id"]) for r in out.collect())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=12), max_size=8))
def test_ends_of_units(texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    ends = UnitEnds(data)
    whole = "".join(texts)
    at = np.array([len(whole[:k].encode()) for k in range(len(whole) + 1)])
    assert ends.after(np.arange(len(whole) + 1)).tolist() == at.tolist()
    assert ends.before(at).tolist() == list(range(len(whole) + 1))
