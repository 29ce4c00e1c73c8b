import pytest
from pyspark.sql import functions as F

from cuadrante.operators import maintenance
from cuadrante.sources import files


def names(path):
    return {p.name for p in path.iterdir() if p.suffix == ".parquet"}


def content(spark, path):
    return {r["k"]: r["v"] for r in spark.read.parquet(str(path)).collect()}


@pytest.fixture
def stock(spark, tmp_path):
    """A table of 1,000 rows in files by key range."""
    path = tmp_path / "a table"
    files.write_table(spark.range(1000).select(F.col("id").alias("k"), F.lit("old").alias("v")), str(path), partitions=8, sort_by=["k"])
    return path


def test_files_without_a_change_stay(spark, stock):
    before = names(stock)
    source = spark.createDataFrame([(3, "new"), (5, None), (2000, "more"), (None, "no key")], "k long, v string")
    replaced = set(maintenance.upsert_files(spark, str(stock), source, "k", ["v"]))
    assert len(replaced) == 1 and before - replaced <= names(stock) and not replaced & names(stock)
    want = {i: "old" for i in range(1000)} | {3: "new", 5: None, 2000: "more", None: "no key"}
    assert content(spark, stock) == want and spark.read.parquet(str(stock)).count() == 1002


def test_only_new_rows_replace_nothing(spark, stock):
    before = names(stock)
    source = spark.createDataFrame([("x", 5000, 1)], "v string, k long, other int")
    assert maintenance.upsert_files(spark, str(stock), source, ["k"], ["v"]) == [] and before < names(stock)
    assert maintenance.upsert_files(spark, str(stock), source.limit(0), ["k"], ["v"]) == []
    assert content(spark, stock)[5000] == "x" and spark.read.parquet(str(stock)).count() == 1001


def test_empty_table(spark, tmp_path):
    path = tmp_path / "t"
    spark.createDataFrame([], "k long, v string").write.parquet(str(path))
    maintenance.upsert_files(spark, str(path), spark.createDataFrame([(1, "a")], "k long, v string"), "k", ["v"])
    assert content(spark, path) == {1: "a"}


def test_change_that_stops_is_carried_through_or_forgotten(spark, stock, monkeypatch):
    source = spark.createDataFrame([(3, "new"), (999, "new"), (1500, "new")], "k long, v string")
    before, finish = names(stock), maintenance.finish_changes
    with monkeypatch.context() as m:  # stops when the journal is written: the table is not touched yet
        calls = []
        m.setattr(maintenance, "finish_changes", lambda s, p: calls.append(p) or (finish(s, p) if len(calls) == 1 else 1 / 0))
        with pytest.raises(ZeroDivisionError):
            maintenance.upsert_files(spark, str(stock), source, "k", ["v"])
    assert names(stock) == before and len(content(spark, stock)) == 1000
    # One staged file had been moved in when the next attempt stopped, too.
    change = next((stock / "_changes").iterdir())
    moved = next(p for p in (change / "files").iterdir() if p.suffix == ".parquet")
    moved.rename(stock / moved.name)
    assert maintenance.finish_changes(spark, str(stock)) == 1 and maintenance.finish_changes(spark, str(stock)) == 0
    assert content(spark, stock) == {i: "old" for i in range(1000)} | {3: "new", 999: "new", 1500: "new"}
    assert spark.read.parquet(str(stock)).count() == 1001 and len(before - names(stock)) == 2
    # A change without a journal stopped while it was staged.
    (stock / "_changes" / "half" / "files").mkdir(parents=True)
    assert maintenance.finish_changes(spark, str(stock)) == 0 and not list((stock / "_changes").iterdir())


def test_doubtful_source_leaves_the_table(spark, stock):
    before = names(stock)
    source = spark.createDataFrame([(3, "a"), (3, "b")], "k long, v string")
    with pytest.raises(Exception, match="not unique"):
        maintenance.upsert_files(spark, str(stock), source, "k", ["v"])
    assert names(stock) == before and set(content(spark, stock).values()) == {"old"}


def test_touched_files_reads_keys_alone(spark, stock):
    plan = maintenance.touched_files(spark.read.parquet(str(stock)), spark.range(1).select(F.col("id").alias("k")), ["k"])
    assert "ReadSchema: struct<k:bigint>" in plan._jdf.queryExecution().executedPlan().toString()
