import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cuadrante.session import pin, release_scratch, scratch, shared_root
from cuadrante.sources import catalog, files

SCHEMA = StructType([StructField("id", LongType())])


def test_scratch_is_below_the_named_folder(spark):
    assert scratch(spark, "x").startswith(shared_root(spark)) and scratch(spark, "x") != scratch(spark, "x")
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_pinned_rows_do_not_change(spark):
    df = pin(spark.range(50).withColumn("u", F.rand()))
    assert df.collect() == df.collect()
    assert pin(spark.range(0).withColumn("u", F.lit(1))).columns == ["id", "u"]


def test_bounded_files(spark, tmp_path):
    path = str(tmp_path / "bounded")
    files.write_table(spark.range(100).coalesce(1), path, max_records=30)
    assert len(list((tmp_path / "bounded").glob("*.parquet"))) == 4
    assert files.read_table(spark, path).count() == 100


def test_layout_by_key_and_by_range(spark, tmp_path):
    df = spark.range(1000).withColumn("k", F.col("id") % 10)
    files.write_table(df, str(tmp_path / "by"), partitions=5, by=["k"])
    back = files.read_table(spark, str(tmp_path / "by")).withColumn("f", F.input_file_name())
    assert back.groupBy("k").agg(F.count_distinct("f").alias("n")).filter("n > 1").count() == 0
    files.write_table(df, str(tmp_path / "sorted"), partitions=4, sort_by=["id"])
    spans = files.read_table(spark, str(tmp_path / "sorted")).groupBy(F.input_file_name()).agg(
        F.min("id").alias("lo"), F.max("id").alias("hi")).orderBy("lo").collect()
    assert all(a["hi"] < b["lo"] for a, b in zip(spans, spans[1:]))


def test_rerun_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "parts")
    files.write_partitioned(spark.range(10).withColumn("e", F.col("id") % 2), path, "e")
    files.write_partitioned(spark.createDataFrame([(99, 1)], "id long, e long"), path, "e", spread=3)
    assert sorted(r["id"] for r in files.read_table(spark, path).collect()) == [0, 2, 4, 6, 8, 99]


def test_missing_files_are_skipped(spark, tmp_path):
    for code in ("02", "31"):
        files.write_table(spark.range(3), str(tmp_path / f"{code}_POB.parquet"))
    codes = [f"{i:02d}" for i in range(1, 33)]
    assert files.read_existing(spark, str(tmp_path) + "/{}_POB.parquet", codes).count() == 6
    with pytest.raises(FileNotFoundError):
        files.read_existing(spark, str(tmp_path) + "/{}_none.parquet", codes)


def test_whole_text_files(spark, tmp_path):
    (tmp_path / "uno.txt").write_text("a\nb\n")
    (tmp_path / "dos.txt").write_text("c")
    got = {r["file_name"]: r["text"] for r in files.read_whole_text(spark, str(tmp_path / "*.txt")).collect()}
    assert got == {"uno.txt": "a\nb\n", "dos.txt": "c"}


def test_csv_with_inferred_types(spark, tmp_path):
    files.write_csv(spark.range(3).withColumn("x", F.lit(1.5)), str(tmp_path / "c"))
    assert dict(files.read_csv(spark, str(tmp_path / "c")).dtypes) == {"id": "int", "x": "double"}


def test_compaction_keeps_the_rows(spark, tmp_path):
    files.write_table(spark.range(200), str(tmp_path / "s"), partitions=20)
    files.compact(spark, str(tmp_path / "s"), str(tmp_path / "d"), 2)
    assert len(list((tmp_path / "d").glob("*.parquet"))) == 2
    a, b = (files.read_table(spark, str(tmp_path / x)) for x in "sd")
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_database_and_tables(spark, tmp_path):
    catalog.ensure_database(spark, "pool")
    catalog.ensure_database(spark, "pool", str(tmp_path / "pool"))
    assert not catalog.table_exists(spark, "pool", "t") and not catalog.table_exists(spark, "nowhere", "t")
    assert catalog.init_table(spark, "pool", "t", SCHEMA, str(tmp_path / "t"))
    assert not catalog.init_table(spark, "pool", "t", SCHEMA, str(tmp_path / "t"))
    assert spark.table("pool.t").count() == 0
    kinds = {(r["kind"], r["name"]) for r in catalog.catalog_report(spark, "pool").collect()}
    assert {("database", "pool"), ("table", "t"), ("column", "t.id")} <= kinds
    catalog.drop_table(spark, "pool.t")
    catalog.drop_table(spark, "pool.t")
    assert not catalog.table_exists(spark, "pool", "t") and (tmp_path / "t").exists()


def test_health_check(spark, tmp_path):
    files.write_table(spark.range(3), str(tmp_path / "ok"))
    got = {r["name"]: r for r in catalog.health_check(spark, {"ok": str(tmp_path / "ok"), "no": str(tmp_path / "no")}).collect()}
    assert got["ok"]["alive"] and got["ok"]["error"] is None
    assert not got["no"]["alive"] and got["no"]["error"]


def test_scratch_can_be_released(spark):
    import os

    df = pin(spark.range(3))
    folder = os.path.dirname(df.inputFiles()[0].removeprefix("file://"))
    assert os.path.exists(folder)
    release_scratch(spark)
    assert not os.path.exists(folder)
