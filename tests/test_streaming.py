import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from cuadrante.plans import jobs
from cuadrante.sources import files
from cuadrante.streaming import ingest

SCHEMA = StructType([StructField("id", StringType()), StructField("edad", IntegerType())])


def drop(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def ids(df):
    return sorted(str(r["id"]) for r in df.collect())


def test_bad_payloads(spark):
    good = json.dumps([{"id": "a", "edad": 1}, {"id": "b", "edad": "x"}])
    df = spark.createDataFrame([(good,), ("garbage",), ("[]",), ('{"id": "c"}',), (None,)], "value string")
    records, dead = ingest.split_corrupt(df, SCHEMA)
    assert {(r["id"], r["edad"]) for r in records.collect()} == {("a", 1), ("c", None)}
    assert sorted(r["payload"] for r in dead.collect()) == ["garbage", '{"id":"b","edad":"x"}']
    assert ids(ingest.parse_json_array(df, SCHEMA)) == ["a", "b", "c"]


def test_binary_payload(spark):
    df = spark.createDataFrame([(bytearray(b'{"id": "z", "edad": 9}'),)], "value binary")
    assert tuple(ingest.parse_json_object(df, SCHEMA).first()) == ("z", 9)


def test_restart_does_not_repeat_rows(spark, tmp_path):
    inbox, out, state = (tmp_path / x for x in ("in", "out", "state"))

    def run():
        source = ingest.file_stream_source(spark, str(inbox), "text", max_files=1)
        q = ingest.start_append(ingest.parse_json_array(source, SCHEMA), str(out), str(state))
        ingest.finish_all([q])
        return ids(files.read_table(spark, str(out)))

    drop(inbox, "1.txt", '[{"id": "a"}]', '[{"id": "b"}]')
    assert run() == ["a", "b"]
    assert run() == ["a", "b"]
    drop(inbox, "2.txt", '[{"id": "c"}]')
    assert run() == ["a", "b", "c"]


def test_records_and_dead_letters_at_once(spark, tmp_path):
    drop(tmp_path / "in", "1.txt", '[{"id": "a"}]', "broken")
    source = ingest.file_stream_source(spark, str(tmp_path / "in"), "text")
    queries = ingest.start_split(source, SCHEMA, str(tmp_path / "good"), str(tmp_path / "dead"), str(tmp_path / "st"))
    assert ingest.run_all(spark, queries, timeout=120)
    ingest.finish_all(queries)
    assert ids(files.read_table(spark, str(tmp_path / "good"))) == ["a"]
    assert [r[0] for r in files.read_table(spark, str(tmp_path / "dead")).collect()] == ["broken"]


def test_report_of_a_live_query(spark, tmp_path):
    drop(tmp_path / "in", "1.txt", '[{"id": "a"}]')
    source = ingest.file_stream_source(spark, str(tmp_path / "in"), "text")
    q = ingest.start_append(
        ingest.parse_json_array(source, SCHEMA), str(tmp_path / "o"), str(tmp_path / "s"), trigger="2 minutes", name="live"
    )
    try:
        assert "live" in {r["name"] for r in ingest.stream_report(spark).collect()}
        assert ingest.run_all(spark, [q], timeout=1) is False
    finally:
        q.stop()


def test_stamp_adds_audit_columns(spark):
    row = ingest.stamp(spark.range(1), 7).first()
    assert row["batch_id"] == "7" and row["sent_at"] is not None


def test_options():
    options = ingest.kafka_options("kafka:9092", "clientes", 50_000)
    assert options["maxOffsetsPerTrigger"] == "50000" and options["startingOffsets"] == "earliest"
    assert options["failOnDataLoss"] == "false" and options["subscribe"] == "clientes"
    assert ingest.trigger_options(None) == {"availableNow": True}
    assert ingest.trigger_options("2 minutes") == {"processingTime": "2 minutes"}


class Stop(RuntimeError):
    pass


def test_each_row_once_whatever_stops_the_query(spark, tmp_path):
    inbox, good, dead, done, state = (str(tmp_path / x) for x in ("in", "good", "dead", "done", "state"))
    drop(tmp_path / "in", "1.txt", '[{"id": "a"}]', "broken")
    seen = []

    def run(*stop):
        def after(batch_id, sink):
            seen.append((batch_id, sink))
            if (batch_id, sink) in stop:
                raise Stop(sink)

        source = ingest.file_stream_source(spark, inbox, "text", max_files=1)
        q = ingest.start_once(source, SCHEMA, good, dead, done, state, after=after)
        if stop:
            with pytest.raises(StreamingQueryException):
                ingest.finish_all([q])
        else:
            ingest.finish_all([q])

    run((0, "records"))
    assert ids(files.read_table(spark, good)) == ["a"] and seen == [(0, "records")]
    run((0, "dead"))  # records of the batch are left alone
    assert seen == [(0, "records"), (0, "dead")]
    run()  # nothing is left to write
    assert seen == [(0, "records"), (0, "dead")]
    drop(tmp_path / "in", "2.txt", '[{"id": "b"}, {"id": "c", "edad": "x"}]')
    run()
    assert ids(files.read_table(spark, good)) == ["a", "b"]
    letters = sorted((r["batch_id"], r["payload"]) for r in files.read_table(spark, dead).collect())
    assert letters == [(0, "broken"), (1, '{"id":"c","edad":"x"}')]
    finished = sorted(tuple(r) for r in ingest.finished_batches(spark, done).collect())
    assert finished == [(0, "dead", 1), (0, "records", 1), (1, "dead", 1), (1, "records", 1)]


def test_a_half_written_folder_is_replaced(spark, tmp_path):
    path, done = str(tmp_path / "out"), str(tmp_path / "done")
    spark.range(5).write.parquet(f"{path}/batch_id=3")  # written, not marked
    assert ingest.write_batch(3, {"s": (spark.range(2), path)}, done) == ["s"]
    assert ingest.write_batch(3, {"s": (spark.range(9), path)}, done) == []
    assert sorted(r["id"] for r in files.read_table(spark, path).collect()) == [0, 1]


def test_batches_of_the_object_stream_do_not_grow_with_the_records(spark, tmp_path, monkeypatch):
    n, queries, finish = 20_000, [], ingest.finish_all
    ids = spark.range(n).select(F.col("id").alias("event_id"), (F.col("id") % 7).alias("user_id"), F.lit("v").alias("event_type"), (F.col("id") / 3).alias("value"))
    ids.write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(ingest, "finish_all", lambda qs: queries.extend(qs) or finish(qs))
    got = jobs.stream_json_object(spark, str(tmp_path))
    assert got.exceptAll(ids).isEmpty() and got.count() == n
    assert 4 <= queries[0].lastProgress["batchId"] + 1 <= 20
    assert [jobs._per_file(x) for x in (0, 12_800, 12_801, 6_000_000, 10**9)] == [200, 200, 201, 93_750, 1_000_000]
