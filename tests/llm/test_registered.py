"""The registered queries and the pipeline on the small tables."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from compare import connection, differences

import __spark_entry__ as contract
import corpus_pipeline
from cuadrante.llm.byte_bpe import read_ranks
from cuadrante.llm.queries import ORACLES, QUERIES

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = connection(SF_SMALL)
    yield con
    con.close()


def test_they_are_registered():
    names = [n for n in contract.queries() if n.startswith("op") and "_" in n and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in contract.queries()
    assert set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_reference_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_SMALL), duck, ORACLES[name]) == []


def test_encoding(spark):
    bpe = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = QUERIES["op7_byte_bpe"](spark, SF_SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = np.array(bpe.encode_ordinary(texts[r["doc_id"]]), "<u4")
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest())


@pytest.mark.parametrize("name, folds, fold", [("op2_toxicity_knn", 5, 0), ("op6_quality_ftrl", 5, 0), ("op9_language_ecoc", 4, 2)])
def test_scores(spark, name, folds, fold):
    rows = QUERIES[name](spark, SF_SMALL).collect()
    assert len(rows) == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % folds == fold) and 0 <= r["score"] <= 1
    if name.startswith("op9"):
        lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang").collect()}
        held = [r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"]]
        assert sum(held) >= 0.95 * len(held)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "language ID", "exact dedup", "MinHash near-dedup", "best-fit packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = corpus_pipeline.pin(stage(spark, docs, SF_SMALL))
        assert docs.columns == before.columns and docs.join(before, docs.columns, "left_anti").isEmpty()
        if name == "exact dedup":
            assert docs.count() == docs.select("text").distinct().count() == before.select("text").distinct().count()
            best = before.groupBy("text").agg({"doc_id": "max"}).toDF("text", "doc_id")
            assert best.join(docs, "doc_id", "left_anti").isEmpty()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    assert packed.select("doc_id").distinct().count() == docs.count()
    full = packed.groupBy("sequence_id").agg({"length": "sum"}).toDF("s", "n")
    assert full.filter("n > 4096").isEmpty()


def test_stages_decide_row_by_row(spark):
    good = spark.read.parquet(f"{SF_SMALL}/documents.parquet").filter("n_chars > 600").orderBy("doc_id").limit(3).collect()
    texts = [r["text"] for r in good]
    near = texts[1] + " x"
    rows = [(None, None), (None, "12 ... 34"), (7, texts[0]), (7, texts[0]), (8, texts[1]), (8, texts[2]), (None, texts[0]), (3, "12 ... 34"), (3, texts[2]), (None, near)]
    docs = spark.createDataFrame([(i, t, None, "s", 1, f"own{k}") for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long, extra string")

    def after(stage, docs):
        out = corpus_pipeline.pin(stage(spark, docs, SF_SMALL))
        assert out.columns == docs.columns
        return out, sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)

    scores = {r["text"]: r["score"] for r in corpus_pipeline.quality_scores(spark, SF_SMALL, docs, carry=("text",)).collect()}
    assert after(corpus_pipeline.quality_stage, docs)[1] == sorted(((i, t) for i, t in rows if scores[t] >= corpus_pipeline.MIN_QUALITY), key=str)
    docs, got = after(corpus_pipeline.language_stage, docs)
    assert got == sorted(((i, t) for i, t in rows if t in (*texts, near)), key=str)
    docs, got = after(corpus_pipeline.exact_stage, docs)
    assert got == sorted([(7, texts[0]), (8, texts[1]), (8, texts[2]), (None, near)], key=str)
    docs, got = after(corpus_pipeline.near_stage, docs)
    assert got == sorted([(7, texts[0]), (8, texts[1]), (8, texts[2])], key=str)


def test_ambiguous_documents_stay(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "ja yes", 9), (2, "12", 9)], "doc_id long, text string, row int")
    found = lambda s, d, x, carry: x.selectExpr(*carry, "IF(row.doc_id = 1, 'de', 'und') AS lang_pred", "0.5D AS score", "true AS ambiguous")
    monkeypatch.setattr(corpus_pipeline, "languages_of", found)
    assert [r["doc_id"] for r in corpus_pipeline.language_stage(spark, docs, SF_SMALL).collect()] == [1]
