"""File sources, and draining a stream into a table."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecquery.sources.tables import new_path

STATE_STORE_SETTING = "spark.sql.streaming.stateStore.providerClass"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def file_stream(
    spark: SparkSession, folder: str, glob: str, schema, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files of ``folder`` matching ``glob`` as a stream; the limit bounds a micro-batch."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


@contextmanager
def keeping_state(spark: SparkSession) -> Iterator[None]:
    """While it lasts, streams that start keep their state in the RocksDB store; then the session's own setting is back."""
    given = spark.conf.get(STATE_STORE_SETTING)
    spark.conf.set(STATE_STORE_SETTING, STATE_STORE)
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE_SETTING, given)


def replayed(rows: DataFrame, ts: str, parts: int, marker: dict, make: Callable[[DataFrame], DataFrame], label: str) -> DataFrame:
    """What ``make`` of a stream gives when ``rows`` arrive in ``parts`` portions in time order, drained into a table.

    A portion is written by as many tasks as hold its rows, and the stream takes all of it before the next one is written,
    going on from its checkpoint. The last portion is one row, ``marker`` (column values; others null), later than all
    others by ten years, so that the watermark passes every row and nothing is left open. The caller drops what it gives.
    """
    spark = rows.sparkSession
    path, made = new_path(spark, "replay"), new_path(spark, label)
    seconds = F.unix_seconds(ts)
    cuts = rows.select(seconds.cast("double").alias("s")).approxQuantile("s", [i / parts for i in range(1, parts)], 0.001)
    last = rows.agg(F.max(ts)).first()[0]
    slot = F.aggregate(F.lit(sorted(set(cuts)) or [0.0]), F.lit(0), lambda n, c: n + (c < seconds).cast("int"))
    end = [F.lit(marker[f.name]).cast(f.dataType).alias(f.name) if f.name in marker else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema]
    ended = spark.range(1 if last is not None else 0).select(*end).withColumn(
        ts, (F.lit(last).cast("timestamp") + F.expr("INTERVAL 10 YEARS")).cast(rows.schema[ts].dataType)
    )
    for portion in [*(rows.filter(slot == i) for i in range(parts)), ended]:
        portion.write.mode("append").parquet(path)
        table = _drained(make(file_stream(spark, path, "*.parquet", rows.schema)), made)
    return table


def _drained(stream: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Append all that is there and not yet taken to the table at ``path``, beside which the progress is kept."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    query = writer.option("checkpointLocation", f"{path}-progress").trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def drain(stream: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Append everything available now to a Parquet table and read that table."""
    return _drained(stream, new_path(stream.sparkSession, label), partition_by)


def drain_batches(stream: DataFrame, label: str, work: Callable[[DataFrame], DataFrame], schema) -> DataFrame:
    """Run ``work`` on each micro-batch; a batch that is retried overwrites its own folder."""
    return _drained_batches(stream, new_path(stream.sparkSession, label), lambda batch, _: work(batch), schema)


def drain_portions(
    portions: Iterable[DataFrame], label: str, work: Callable[[DataFrame, int], DataFrame], schema
) -> DataFrame:
    """The same for tables that arrive one after another: a portion is one micro-batch, and ``work`` also gets its number."""
    made = None
    for portion in portions:
        spark = portion.sparkSession
        if made is None:
            path, made = new_path(spark, "arriving"), new_path(spark, label)
        portion.write.mode("append").parquet(path)
        table = _drained_batches(file_stream(spark, path, "*.parquet", portion.schema), made, work, schema)
    return table


def _drained_batches(stream: DataFrame, path: str, work: Callable[[DataFrame, int], DataFrame], schema) -> DataFrame:
    spark = stream.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # read several times by the work
        try:
            work(batch, batch_id).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        finally:
            batch.unpersist()

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{path}-progress").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(schema).parquet(f"{path}/batch=*")
