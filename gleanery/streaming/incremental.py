"""Structured Streaming forms of the ingest operators."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gleanery import schema
from gleanery.operators import merge
from gleanery.sources.snapshots import Table, retried


def file_stream(spark: SparkSession, path: str, fields: T.StructType, pattern: str = "*.parquet",
                files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(fields).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def zoned(rows: DataFrame, column: str) -> DataFrame:
    """Watermarks need a zoned timestamp; stored times are UTC."""
    return rows.withColumn(column, F.col(column).cast("timestamp"))


def upsert_stream(rows: DataFrame, out: str, checkpoint: str, order: list[str]) -> StreamingQuery:
    """Collapse every micro-batch to one first/last state per key and write it
    under its batch number.

    A batch costs its own size, not the table's. Writing is idempotent: a batch
    replayed after a failure overwrites its own folder. `current_rows` folds the
    states, and `compact_states` replaces many batches by one.
    """
    last, first = merge.policy([c for c in rows.columns if c in schema.LAST_WINS + schema.FIRST_WINS])

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # two writes of one batch
        try:
            keyed, loose = merge.split_keyed(batch)
            merge.key_states(keyed, order, last, first).write.mode("overwrite").parquet(
                f"{out}/states/batch={batch_id}")
            loose.write.mode("overwrite").parquet(f"{out}/loose/batch={batch_id}")
        finally:
            batch.unpersist()

    return (rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def upsert_stored(rows: DataFrame, table: Table, checkpoint: str, order: list[str], *,
                  stream: str = "stream", compact_after: int | None = None,
                  partition: str | None = None) -> StreamingQuery:
    """Merge every micro-batch into a stored table, as `merge.merge_upsert` would one after the other.

    The table notes the last batch of each stream in the version that holds it, so a
    batch replayed after a failure counts once. Readers see the table before or after a
    batch. After `compact_after` batches the states are folded into the base.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        version = retried(lambda: table.upsert(batch, order, stream, batch_id))
        if compact_after and len(version.states) >= compact_after:
            retried(lambda: table.compact(partition))

    return (rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def current_rows(spark: SparkSession, out: str, columns: list[str]) -> DataFrame:
    """The merged table as of the last finished batch."""
    states = spark.read.parquet(f"{out}/states")
    merged = merge.expand_states(merge.fold_states(states.drop("batch")))
    loose = spark.read.parquet(f"{out}/loose")
    return merged.select(*columns).unionByName(loose.select(*columns))


def compact_states(spark: SparkSession, out: str, to: str) -> None:
    """Fold all batches into one under a new location, never in place. It has a
    number that no batch of a stream can take, so a stream may go on there."""
    states = spark.read.parquet(f"{out}/states").drop("batch")
    merge.fold_states(states).write.parquet(f"{to}/states/batch=-1")
    spark.read.parquet(f"{out}/loose").drop("batch").write.parquet(f"{to}/loose/batch=-1")


def daily_counts(rows: DataFrame, time: str = "ts", delay: str = "2 days") -> DataFrame:
    """Rows per day and source on event time."""
    return (rows.withWatermark(time, delay)
            .groupBy(F.window(time, "1 day").alias("w"), "source")
            .agg(F.count("*").alias("count"))
            .select(F.col("w.start").alias("time"), "source", "count"))


def first_seen(rows: DataFrame, key: list[str], time: str = "ts", delay: str = "60 days") -> DataFrame:
    """First row per key within the watermark; the state is dropped behind it."""
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(key)


def write_complete(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Every trigger replaces the whole result, under its batch number."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (rows.writeStream.outputMode("complete").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def write_append(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    return (rows.writeStream.outputMode("append").format("parquet").option("path", out)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def latest_complete(spark: SparkSession, out: str, query: StreamingQuery) -> DataFrame:
    return spark.read.parquet(f"{out}/batch={query.lastProgress['batchId']}")
