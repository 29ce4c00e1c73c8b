"""Row-level changes and versions of tables whose format has neither.

Each operator but ``upsert_files`` returns the new content.  Write it to a new path (or a
new batch), never over the path being read.  ``upsert_files`` changes a table of files in
place and rewrites only the files that hold a row to change.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cuadrante.session import pin
from cuadrante.sources.files import write_table

_CHANGES = "_changes"  # Spark's readers pass over folders that begin with an underscore


def delete_where(df: DataFrame, cond) -> DataFrame:
    """Rows left after a conditional delete.  As in SQL, a row whose condition
    is null is kept."""
    cond = F.expr(cond) if isinstance(cond, str) else cond
    return df.filter(~F.coalesce(cond, F.lit(False)))


def upsert(target: DataFrame, source: DataFrame, keys, update_cols: Sequence[str]) -> DataFrame:
    """Update listed columns of matching rows, insert the other source rows whole.

    A source null overwrites.  Two source rows with one key raise.  Updates are
    a left join and inserts an anti join: both can broadcast a source measured
    as small, so a large target need not be shuffled for the updates, and a
    skewed target is split, which a full outer join allows neither of.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    extra = [c for c in source.columns if c not in keys]
    fresh = source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.first(F.struct(*extra)).alias("_new")
    )
    checked = fresh.withColumn(
        "_new",
        F.when(F.col("_n") > 1, F.raise_error(F.lit("upsert: source key is not unique"))).otherwise(F.col("_new")),
    ).drop("_n")
    updated = target.join(
        checked.withColumn("_hit", F.lit(True)), on=keys, how="left"
    ).select(
        *[
            F.when(F.col("_hit"), F.col("_new")[c]).otherwise(F.col(c)).alias(c) if c in update_cols else F.col(c)
            for c in target.columns
        ]
    )
    inserted = checked.join(target.select(*keys), on=keys, how="left_anti").select(*keys, "_new.*")
    return updated.unionByName(inserted.select(*target.columns))


def _folder(spark: SparkSession, path: str):
    """The file system of ``path``, and a function that makes its paths."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, at


def touched_files(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The files (``file``) of ``target`` that hold a key of ``source``; reads the keys alone.
    A null key matches nothing."""
    named = target.select(*keys, F.col("_metadata.file_path").alias("file"))
    return named.join(source.select(*keys), list(keys), "left_semi").select("file").distinct()


def finish_changes(spark: SparkSession, path: str) -> int:
    """End the changes of the table at ``path`` that were interrupted, and count those that
    were carried through.  A change whose files were all staged is carried through; one
    that stopped before that is forgotten."""
    fs, at = _folder(spark, path)
    if not fs.exists(at(path, _CHANGES)):
        return 0
    done = 0
    for change in fs.listStatus(at(path, _CHANGES)):
        journal = at(change.getPath(), "replaced.json")
        if fs.exists(journal):
            replaced = json.loads(spark.read.text(journal.toString(), wholetext=True).first()[0])
            staged = at(change.getPath(), "files")
            for file in fs.listStatus(staged) if fs.exists(staged) else []:
                if file.getPath().getName().endswith(".parquet") and not fs.rename(file.getPath(), at(path, file.getPath().getName())):
                    raise OSError(f"cannot move {file.getPath()}")
            for name in replaced:
                fs.delete(at(path, name), False)
            done += 1
        fs.delete(change.getPath(), True)
    return done


def upsert_files(spark: SparkSession, path: str, source: DataFrame, keys, update_cols: Sequence[str], max_records: int | None = None) -> list[str]:
    """``upsert`` into the parquet table at ``path``, one folder of files, in place.  Returns
    the names of the files it replaced.

    A semi join on the keys finds the files that hold a row to change; they alone are read
    whole and written anew, with the inserted rows, and all other files stay as they are.
    New files are staged below the table, a journal names the files they replace, and only
    then are they moved in and the old ones deleted.  A run that stops earlier leaves the
    table as it was; one that stops later is carried through by the next call or by
    ``finish_changes``.  Run one change at a time, and no reader while files are exchanged.

    An empty source changes nothing, an empty table takes all source rows, a null key is
    inserted, and two source rows with one key raise before the table is touched.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    finish_changes(spark, path)
    fs, at = _folder(spark, path)
    target = spark.read.parquet(path)
    fresh = pin(source.select(*target.columns))
    if fresh.isEmpty():
        return []
    uri = spark.sparkContext._jvm.java.net.URI
    files = [at(uri(row["file"])) for row in touched_files(target, fresh, keys).collect()]
    if any(f.getParent().getName() != at(path).getName() for f in files):
        raise ValueError("upsert_files: the table must be one folder of files")
    part = spark.read.schema(target.schema)
    part = part.parquet(*[f.toString() for f in files]) if files else target.limit(0)
    change = at(at(path, _CHANGES), uuid.uuid4().hex)
    write_table(upsert(part, fresh, keys, update_cols), at(change, "files").toString(), max_records=max_records)
    names = sorted(f.getName() for f in files)
    # The journal appears whole or not at all.
    out = fs.create(at(change, "_replaced.json"))
    out.write(bytearray(json.dumps(names).encode()))
    out.close()
    if not fs.rename(at(change, "_replaced.json"), at(change, "replaced.json")):
        raise OSError(f"cannot write the journal of {path}")
    finish_changes(spark, path)
    return names


def batch_history(df: DataFrame, batch: str, ts: str) -> DataFrame:
    """One row per loaded batch: first and last time, and rows."""
    return df.groupBy(batch).agg(
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("n_rows")
    )


def as_of(df: DataFrame, version_col: str, version) -> DataFrame:
    """Content of an append-only table at an older version."""
    return df.filter(F.col(version_col) <= F.lit(version))


def compare_versions(df: DataFrame, version_col: str, old, new, metrics: Sequence[str]) -> DataFrame:
    """Averages of the metrics at two versions, from one pass over the table."""
    v = F.col(version_col)
    aggs: list[Column] = []
    for label, version in (("old", old), ("new", new)):
        inside = v <= F.lit(version)
        aggs.append(F.count_if(inside).alias(f"n_{label}"))
        aggs += [F.avg(F.when(inside, F.col(m))).alias(f"avg_{m}_{label}") for m in metrics]
    return df.filter(v <= F.lit(new)).agg(*aggs)


def max_id(df: DataFrame, col: str) -> DataFrame:
    """Highest id, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(col), F.lit(0)).alias("max_id"))
