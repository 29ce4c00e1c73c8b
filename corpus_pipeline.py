"""The corpus pipeline: stages over ``documents``, each written and read again.

Filters decide on each row by its own text, whether or not it has an id and whatever
other rows share the id, and leave the rows they keep as they are, with all columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuadrante.llm.common import bounded
from cuadrante.llm.exact_dedup import exact_dedup
from cuadrante.llm.near_dedup import near_dedup
from cuadrante.llm.queries import languages_of, packed, quality_scores
from cuadrante.llm.word_table import BLOCK, PLACES
from cuadrante.operators.ranking import sequential_id
from cuadrante.session import pin

MIN_QUALITY = 0.3
BATCH_ROWS = 1000  # whole texts that Spark and Python hold for each other at once
KEY = "_row_key"


def whole(docs: DataFrame) -> DataFrame:
    """``docs`` as (doc_id, text, row), where ``row`` is the whole row."""
    return docs.select("doc_id", "text", F.struct(*(F.col(c) for c in docs.columns)).alias("row"))


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of ``BATCH_ROWS`` rows at most, so that whole texts going to Python and
    back hold little memory in either.  Results do not depend on it."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def parted(docs: DataFrame) -> DataFrame:
    """``docs`` as (text, row), where ``row`` has the other columns."""
    return docs.select("text", F.struct(*(F.col(c) for c in docs.columns if c != "text")).alias("row"))


def joined(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows of ``parted(docs)`` with the columns of ``docs``."""
    return rows.select(*(F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores below ``MIN_QUALITY`` go.  A null text
    counts as empty; repeated rows share a fate; an empty table stays empty."""
    small_batches(spark)
    scored = quality_scores(spark, sf_dir, parted(docs), carry=("text", "row"))
    return joined(scored.filter(F.col("score") >= MIN_QUALITY), docs)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of no language go, null and empty texts among them.  An ambiguous one
    stays: a low score alone does not make a short or mixed document unclean."""
    small_batches(spark)
    found = languages_of(spark, sf_dir, parted(docs), carry=("text", "row"))
    return joined(found.filter("lang_pred <> 'und'"), docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of equal texts the document with the largest id stays, one row of it."""
    kept = pin(exact_dedup(whole(docs), carry=("row",)).filter("kept"))
    several = kept.filter("group_size > 1").groupBy("doc_id", F.sha2(F.coalesce("row.text", F.lit("")), 256)).agg(F.min("row").alias("row"))
    return kept.filter("group_size = 1").select("row.*").unionByName(several.select("row.*"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the row with the least id stays; rows without
    an id come after all others."""
    small_batches(spark)
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if ids.filter("n > 1 or doc_id is null").isEmpty():
        keyed = docs.withColumn(KEY, F.col("doc_id"))
    else:
        order = [F.col("doc_id").isNull(), F.col("doc_id"), F.sha2(F.coalesce("text", F.lit("")), 256)]
        keyed = pin(sequential_id(docs, order, start=0, name=KEY))
    gone = pin(near_dedup(keyed, id_col=KEY).filter("not kept").select(F.col(KEY).alias("_gone")))
    return keyed.join(bounded(gone), keyed[KEY] == gone["_gone"], "left_anti").select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of what is left and their places in sequences.  The executors' heaps
    are large by now, so a worker holds half the words and a quarter of the bytes at once."""
    small_batches(spark)
    return packed(docs, places=PLACES // 2, block=BLOCK // 4)


STAGES = [
    ("quality classifier", quality_stage),
    ("language ID", language_stage),
    ("exact dedup", exact_stage),
    ("MinHash near-dedup", near_stage),
    ("best-fit packing", packing_stage),
]
# Models and tokens are not for SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = pin(stage(spark, docs, sf_dir))
    return docs
