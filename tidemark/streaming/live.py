"""Structured Streaming forms of the incremental operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import setting
from tidemark.sinks.tables import load_number, upsert

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LATE_BY = "7 days"


def file_stream(spark: SparkSession, path: str, schema: T.StructType, kind: str = "parquet") -> DataFrame:
    """New files of a folder; the checkpoint remembers those already read."""
    return spark.readStream.format(kind).schema(schema).load(path)


def drop_repeats(stream: DataFrame, keys: Sequence[str], cursor: str, late_by: str = LATE_BY) -> DataFrame:
    """Pass each key once, as long as its repeats come at most ``late_by`` late.

    State older than that is dropped, so it stays bounded. A watermark needs a time
    with a zone; one without is read as UTC and turned back afterwards.
    """
    plain = isinstance(stream.schema[cursor].dataType, T.TimestampNTZType)
    timed = stream.withColumn(cursor, F.col(cursor).cast("timestamp")) if plain else stream
    kept = timed.withWatermark(cursor, late_by).dropDuplicatesWithinWatermark(list(keys))
    return kept.withColumn(cursor, F.col(cursor).cast("timestamp_ntz")) if plain else kept


def run_to_files(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append everything available to Parquet, then stop. State is kept in RocksDB."""
    spark = stream.sparkSession
    with setting(spark, STATE_STORE, ROCKSDB):
        query = (
            stream.writeStream.format("parquet").outputMode("append")
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()


def run_upserts(
    stream: DataFrame, table: str, keys: Sequence[str], cursor: str, checkpoint: str
) -> None:
    """Upsert each micro-batch. A batch replayed after a failure changes nothing."""
    def apply(batch: DataFrame, number: int) -> None:
        upsert(batch, table, keys, cursor, load_number())

    query = (
        stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    # Batches run in a session of their own; this one has to look at the files anew.
    spark = stream.sparkSession
    if spark.catalog.tableExists(table):
        spark.catalog.refreshTable(table)
