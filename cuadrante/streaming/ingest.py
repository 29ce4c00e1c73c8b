"""Stateless ingest of JSON records: sources, parsing, dead letters, sinks."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType, StructType

from cuadrante.sources.files import existing_paths


def kafka_options(servers: str, topic: str, max_offsets: int | None = None,
                  starting: str = "earliest", fail_on_loss: bool = False) -> dict[str, str]:
    """Options of a topic source: start, rate limit, tolerance of lost data."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_loss).lower(),
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def kafka_source(spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None,
                 starting: str = "earliest") -> DataFrame:
    """A topic as a stream.  The Kafka connector must be on the class path."""
    reader = spark.readStream.format("kafka")
    return reader.options(**kafka_options(servers, topic, max_offsets, starting)).load()


def file_stream_source(spark: SparkSession, path: str, fmt: str = "text",
                       max_files: int | None = None, schema: StructType | str | None = None) -> DataFrame:
    """Files dropped into a folder as a stream, one record per line for text."""
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def _payload(col: str) -> Column:
    return F.col(col).cast("string")


def parse_json_array(df: DataFrame, schema: StructType, col: str = "value") -> DataFrame:
    """Payload with an array of records -> one row per record.  A lone object
    counts as an array of one; a payload that is no JSON gives no rows (see
    ``split_corrupt``)."""
    records = F.from_json(_payload(col), ArrayType(schema))
    return df.select(F.explode(records).alias("data")).select("data.*")


def parse_json_object(df: DataFrame, schema: StructType, col: str = "value") -> DataFrame:
    """Payload with one record -> one row; a bad payload gives a row of nulls."""
    return df.select(F.from_json(_payload(col), schema).alias("data")).select("data.*")


def judged(df: DataFrame, schema: StructType, col: str = "value") -> DataFrame:
    """Each record as (payload, _record, _sound): its text, its fields and whether it is
    one.  A payload that is not JSON from end to end is one record that is not."""
    strings = "array<string>"
    raw = df.select(_payload(col).alias("payload")).filter("payload IS NOT NULL")
    # Within brackets the payload must be one value: text after it makes the whole invalid.
    outer = F.from_json(F.concat(F.lit("["), F.col("payload"), F.lit("]")), strings)
    whole = F.coalesce((F.size(outer) == 1) & F.ltrim("payload").rlike(r"^[\[{]"), F.lit(False))
    each = F.when(F.ltrim("payload").startswith("["), F.from_json("payload", strings)).otherwise(F.array("payload"))
    records = raw.select(F.explode(F.when(whole, each).otherwise(F.array("payload"))).alias("payload"), whole.alias("_whole"))
    parsed = records.select(
        F.coalesce("payload", F.lit("null")).alias("payload"),
        "_whole",
        F.from_json("payload", schema).alias("_record"),
        F.from_json("payload", "map<string,string>").alias("_texts"),
    )
    # A field that has a text but no value is of another type.
    lost = [F.col("_texts")[f.name].isNotNull() & F.col(f"_record.{f.name}").isNull() for f in schema.fields]
    sound = F.col("_whole") & F.col("_texts").isNotNull() & ~reduce(lambda x, y: x | y, lost)
    return parsed.select("payload", "_record", F.coalesce(sound, F.lit(False)).alias("_sound"))


def _parted(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    return records.filter("_sound").select("_record.*"), records.filter(~F.col("_sound")).select("payload")


def split_corrupt(df: DataFrame, schema: StructType, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """The good records, and what is not one: payloads that are not JSON from end to
    end, and single records with a field of another type than the schema's.

    Dead letters keep the raw text under ``payload``, of the payload or of the one
    record; the other records of its payload stay.  Null payloads are neither.
    """
    return _parted(judged(df, schema, col))


def stamp(df: DataFrame, batch_id) -> DataFrame:
    """Audit columns: the batch and the time of ingest."""
    batch = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    return df.withColumns({"batch_id": batch.cast("string"), "sent_at": F.current_timestamp()})


def trigger_options(trigger: str | None) -> dict[str, object]:
    """``None`` takes what is there and ends; text is a micro-batch interval."""
    return {"availableNow": True} if trigger is None else {"processingTime": trigger}


def start_append(df: DataFrame, path: str, checkpoint: str, trigger: str | None = None,
                 table: str | None = None, fmt: str = "parquet", name: str | None = None) -> StreamingQuery:
    """Append a stream to a path, as a catalog table if one is named.  The
    checkpoint lets a restart go on without repeating rows."""
    writer = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(trigger))
    )
    if name:
        writer = writer.queryName(name)
    if table:
        return writer.option("path", path).toTable(table)
    return writer.start(path)


def start_split(df: DataFrame, schema: StructType, path: str, dead_path: str, checkpoint: str,
                col: str = "value", trigger: str | None = None, fmt: str = "parquet") -> list[StreamingQuery]:
    """Records and dead letters of one source as two queries, each with its own
    checkpoint, so that either can be restarted alone."""
    good, bad = split_corrupt(df, schema, col)
    return [
        start_append(good, path, f"{checkpoint}/records", trigger, fmt=fmt),
        start_append(bad, dead_path, f"{checkpoint}/dead", trigger, fmt=fmt),
    ]


def _batch_path(path: str, batch_id: int, sink: str | None = None) -> str:
    return f"{path}/batch_id={batch_id}" + (f"/sink={sink}" if sink else "")


def write_batch(batch_id: int, outputs: Mapping[str, tuple[DataFrame, str]], done: str, fmt: str = "parquet",
                after: Callable[[int, str], None] | None = None) -> list[str]:
    """Write one batch to several sinks, each once; the sinks written this time.

    ``outputs`` gives each sink's rows and path.  A sink's rows go to a folder of the
    batch, which a replay replaces; then a row (batch_id, sink, n_rows) in the table
    ``done`` says that they are there, and a replay leaves that sink alone.  A job that
    stops at any point can therefore run the batch again.  ``after`` is called after
    each sink.
    """
    written = []
    for sink, (df, path) in outputs.items():
        spark, mark = df.sparkSession, _batch_path(done, batch_id, sink)
        if existing_paths(spark, [f"{mark}/_SUCCESS"]):
            continue
        target = _batch_path(path, batch_id)
        df.write.format(fmt).mode("overwrite").save(target)
        n = spark.read.format(fmt).schema(df.schema).load(target).select(F.count(F.lit(1)).alias("n_rows"))
        n.write.mode("overwrite").parquet(mark)
        written.append(sink)
        if after is not None:
            after(batch_id, sink)
    return written


def start_once(df: DataFrame, schema: StructType, path: str, dead_path: str, done: str, checkpoint: str, col: str = "value",
               trigger: str | None = None, fmt: str = "parquet", name: str | None = None, after: Callable[[int, str], None] | None = None) -> StreamingQuery:
    """Records and dead letters of one source as one query that reads it once, each row
    written exactly once whatever stops the query (see ``write_batch``).

    Both tables carry ``batch_id``.  A restart from ``checkpoint`` runs the last batch
    again unless it was finished, with the same input.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        records = judged(batch, schema, col).persist(StorageLevel.MEMORY_AND_DISK)  # if lost, it is read again
        try:
            good, bad = _parted(records)
            write_batch(batch_id, {"records": (good, path), "dead": (bad, dead_path)}, done, fmt, after)
        finally:
            records.unpersist()

    writer = df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**trigger_options(trigger))
    return (writer.queryName(name) if name else writer).start()


def finished_batches(spark: SparkSession, done: str) -> DataFrame:
    """What ``write_batch`` has finished: batch_id, sink, n_rows."""
    return spark.read.parquet(done).select(F.col("batch_id").cast("bigint").alias("batch_id"), "sink", "n_rows")


def run_all(spark: SparkSession, queries: list[StreamingQuery], timeout: float | None = None) -> bool:
    """Wait until any of the queries ends; false when time runs out first.  A
    failed query raises its error here."""
    # Queries that ended earlier in the session must not end the wait.  One that
    # ends while they are being forgotten is caught by the check that follows.
    spark.streams.resetTerminated()
    ended = [q for q in queries if not q.isActive]
    if not ended and any(q.isActive for q in queries):
        done = spark.streams.awaitAnyTermination(timeout) if timeout else spark.streams.awaitAnyTermination()
        if done is False:
            return False
        ended = [q for q in queries if not q.isActive]
    for q in ended:
        if q.exception() is not None:
            raise q.exception()
    return True


def finish_all(queries: list[StreamingQuery], timeout: float | None = None) -> None:
    """Wait until each of the bounded queries has taken all its input.  With a
    ``timeout`` all are stopped once one has taken longer."""
    for q in queries:
        if timeout is None:
            q.awaitTermination()
        elif not q.awaitTermination(timeout):
            for late in queries:
                late.stop()
            raise TimeoutError(f"stream {q.name or q.id} is still running after {timeout} s")


def stream_report(spark: SparkSession) -> DataFrame:
    """Live queries: name, whether active, status, rows of the last batch."""
    rows = []
    for q in spark.streams.active:
        progress: Mapping | None = q.lastProgress
        rows.append(
            (q.name, q.isActive, q.status["message"], int(progress["numInputRows"]) if progress else None)
        )
    return spark.createDataFrame(rows, "name string, active boolean, status string, last_rows bigint")
