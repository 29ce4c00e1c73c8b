"""The registered queries of this package and their reference SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuadrante.llm import sql
from cuadrante.llm.byte_bpe import encode_documents
from cuadrante.llm.common import held_out
from cuadrante.llm.exact_dedup import exact_dedup
from cuadrante.llm.host_rules import host_rules
from cuadrante.llm.infill import fill_in_middle, restored
from cuadrante.llm.language import fit_languages, identify
from cuadrante.llm.line_dedup import line_dedup
from cuadrante.llm.near_dedup import near_dedup
from cuadrante.llm.packing import pack, token_pieces
from cuadrante.llm.phrases import collocations
from cuadrante.llm.quality import fit_quality, score_quality
from cuadrante.llm.token_planes import read_ids, write_ids
from cuadrante.llm.toxicity import fit_index, score_toxicity
from cuadrante.llm.warc import join_originals, read_archive, write_archive
from cuadrante.session import scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents."""
    return near_dedup(table(spark, sf_dir, "documents"))


def op2_toxicity_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id"), 5, 0)).select("doc_id", F.col("toxic").alias("label"))
    scored = score_toxicity(docs, fit_index(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def op3_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to archives that store equal payloads once, and read back."""
    path = scratch(spark, "archive")
    write_archive(table(spark, sf_dir, "pages"), path)
    return join_originals(read_archive(spark, path)).drop("url")


def op4_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule figures and verdicts of all documents."""
    out = host_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def packed(docs: DataFrame, **bounds: int) -> DataFrame:
    """Token pieces of ``docs`` in sequences of at most 4096 tokens."""
    pieces = token_pieces(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"), **bounds)
    return pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, tokenised and packed."""
    return packed(table(spark, sf_dir, "documents"))


def quality_scores(spark: SparkSession, sf_dir: str, docs: DataFrame, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Scores of ``docs`` by a model learned from the labelled documents in ``sf_dir``."""
    labels = table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id"), 5, 0)).select("doc_id", F.col("quality").alias("label"))
    return score_quality(docs, fit_quality(table(spark, sf_dir, "documents"), labels), carry=carry)


def op6_quality_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    scored = quality_scores(spark, sf_dir, table(spark, sf_dir, "documents"))
    return scored.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded."""
    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, digests=True)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that ten sites or more share."""
    out = line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


def languages_of(spark: SparkSession, sf_dir: str, docs: DataFrame, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Languages of ``docs`` by a model learned from the documents in ``sf_dir``."""
    return identify(docs, fit_languages(table(spark, sf_dir, "documents").filter(~held_out(F.col("doc_id"), 4, 2)).select("doc_id", "text", "lang")), carry=carry)


def op9_language_ecoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents."""
    found = languages_of(spark, sf_dir, table(spark, sf_dir, "documents"))
    return found.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score", "ambiguous")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts."""
    docs = table(spark, sf_dir, "documents").withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256))
    return exact_dedup(docs, carry=("text_sha256",)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op11_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written in byte planes and read back."""
    path = scratch(spark, "ids")
    write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_ids(spark, path)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with prefix, middle and suffix exchanged, and restored."""
    out = fill_in_middle(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of each language, over all documents."""
    return collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_near_dedup": op1_near_dedup,
    "op2_toxicity_knn": op2_toxicity_knn,
    "op3_warc_revisits": op3_warc_revisits,
    "op4_host_rules": op4_host_rules,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_quality_ftrl": op6_quality_ftrl,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_line_dedup": op8_line_dedup,
    "op9_language_ecoc": op9_language_ecoc,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_token_planes": op11_token_planes,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_phrase_collocations": op13_phrase_collocations,
}
ORACLES = {"op8_line_dedup": sql.LINE_DEDUP, "op1_near_dedup": sql.NEAR_DEDUP, "op3_warc_revisits": sql.WARC, "op4_host_rules": sql.HOST_RULES, "op10_exact_dedup": sql.EXACT_DEDUP, "op12_fill_in_middle": sql.INFILL, "op13_phrase_collocations": sql.PHRASES}
