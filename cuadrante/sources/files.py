"""Reading and writing tables of files."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cuadrante.functions.keys import file_name


def read_table(spark: SparkSession, path, fmt: str = "parquet", version: int | None = None) -> DataFrame:
    """A table by path or glob (or a list of them), in any installed format.
    ``version`` reads an older state where the format keeps one."""
    reader = spark.read.format(fmt)
    if version is not None:
        reader = reader.option("versionAsOf", version)
    return reader.load([path] if isinstance(path, str) else list(path))


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header.  Give a schema: inferring one reads the data twice."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_whole_text(spark: SparkSession, pattern: str) -> DataFrame:
    """One row per text file: ``file_name`` and the whole ``text``."""
    raw = spark.read.text(pattern, wholetext=True)
    return raw.select(file_name("_metadata.file_path").alias("file_name"), F.col("value").alias("text"))


def existing_paths(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """Those of the paths that exist, on whatever file system they name."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        if p.getFileSystem(conf).exists(p):
            found.append(path)
    return found


def read_existing(spark: SparkSession, pattern: str, codes: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """One scan over the files of the given codes; missing ones are skipped.
    ``pattern`` has ``{}`` where the code goes."""
    found = existing_paths(spark, [pattern.format(c) for c in codes])
    if not found:
        raise FileNotFoundError(f"no file matches {pattern} for any code")
    return read_table(spark, found, fmt)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "error",
    fmt: str = "parquet",
    max_records: int | None = None,
    partitions: int | None = None,
    by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
) -> None:
    """Write a table, with its physical layout where one is wanted.

    ``by`` hashes rows to ``partitions`` files by key, or rebalances them by key where no
    number is given, so that a hot key gets several files; ``sort_by`` alone ranges
    and sorts them, so readers can skip row groups.  ``max_records`` bounds the
    rows of a file, however many a task holds.
    """
    if sort_by and not by:
        df = df.repartitionByRange(partitions, *sort_by) if partitions else df.repartitionByRange(*sort_by)
    elif by:
        df = df.repartition(partitions, *by) if partitions else df.hint("rebalance", *by)
    elif partitions:
        df = df.repartition(partitions)
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    writer = df.write.format(fmt).mode(mode)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.save(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite",
                      spread: int = 1, max_records: int | None = None) -> None:
    """Write one folder per value of ``by``; a re-run replaces only the folders
    it has rows for.

    Rows are rebalanced by value: small values share a task and a value with a large
    part of the rows is split by adaptive execution.  ``spread`` deals each value out
    over that many tasks beforehand, where adaptive execution is off.
    """
    by = [by] if isinstance(by, str) else list(by)
    if spread > 1:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(spread))
        df = df.repartition(*by, salt)
    else:
        df = df.hint("rebalance", *by)
    writer = df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*by)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """CSV files with a header."""
    df.write.mode(mode).option("header", True).csv(path)


def compact(spark: SparkSession, src: str, dst: str, target_files: int,
            sort_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Rewrite a table of many small files as ``target_files`` files at ``dst``."""
    write_table(read_table(spark, src, fmt), dst, fmt=fmt, partitions=target_files, sort_by=sort_by)
