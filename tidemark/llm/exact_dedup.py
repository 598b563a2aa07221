"""Exact deduplication as a stateful stream.

A file stream reads the documents. Its state, in RocksDB below the shared checkpoint
folder, has one entry for each digest of a normalised text and never expires: the
smallest identifier, where that row lies (file and row), and how many rows came. Every
micro-batch writes the entries that it changed, so later files are held against all
earlier ones. Rows that hit an entry are then compared in full: a digest counts as one
text only if all its rows have the same bytes.
"""

from __future__ import annotations

from contextlib import ExitStack

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.session import exists, scratch_path, setting

_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Many small stores: no disk is set aside for logs before it is needed.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
_KEEPER = "no_id boolean, doc_id bigint, file string, row bigint"


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _identity() -> Column:
    """Order of rows: by doc_id, nulls last, then by place (the content locator)."""
    meta = F.col("_metadata")
    return F.struct(
        F.col("doc_id").isNull().alias("no_id"),
        F.col("doc_id").cast("long").alias("doc_id"),
        meta["file_path"].alias("file"),
        meta["row_index"].alias("row"),
    )


def keep_state(spark: SparkSession, path: str, state: str, updates: str, files_per_batch: int | None = None) -> None:
    """Take in the files below ``path`` that the stream with this ``state`` folder has not seen.

    ``updates`` receives (digest, keeper, group_size) of every entry that a micro-batch
    changed, in a folder for each batch; a batch that is run again replaces its folder.
    """
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # As a pattern: a stream reads a single file only that way.
    rows = reader.parquet(f"{path[:-1]}[{path[-1]}]").select(digest(normalised(F.col("text"))).alias("digest"), _identity().alias("identity"))
    entries = rows.groupBy("digest").agg(F.min("identity").alias("keeper"), F.count("*").alias("group_size"))

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{updates}/batch={number}")

    with ExitStack() as conf:
        for key, value in _STATE_CONF.items():
            conf.enter_context(setting(spark, key, value))
        query = (
            entries.writeStream.outputMode("update")
            .option("checkpointLocation", state)
            .foreachBatch(write)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()


def entries(spark: SparkSession, updates: str) -> DataFrame:
    """The state's entries: the last update of each digest."""
    schema = f"digest binary, keeper struct<{_KEEPER}>, group_size bigint, batch bigint"
    if not exists(spark, updates):
        return spark.createDataFrame([], schema).drop("batch")
    log = spark.read.schema(schema).parquet(updates)
    last = F.max(F.struct("batch", "keeper", "group_size")).alias("last")
    return log.groupBy("digest").agg(last).select("digest", "last.keeper", "last.group_size")


def exact_dedup(
    spark: SparkSession,
    path: str,
    state: str | None = None,
    updates: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), a row for each row of the Parquet files at ``path``.

    Texts are equal when they are identical after each run of ASCII white space is made one
    space; a null text counts as empty. The row with the smallest doc_id stays, null ids
    last; rows that repeat an id are told apart by their file and place in it, and one of
    them stays. Extra columns are ignored. An empty table gives no rows.

    ``state`` and ``updates`` name folders to go on from; new ones are made below the shared
    folder by default. Hot texts are combined before every shuffle.
    """
    state = state or scratch_path(spark, "dedup-state")
    updates = updates or scratch_path(spark, "dedup-updates")
    keep_state(spark, path, state, updates, files_per_batch)
    known = stored(entries(spark, updates), "dedup-entries")

    docs = spark.read.parquet(path)
    text = normalised(F.col("text"))
    placed = docs.select(digest(text).alias("digest"), _identity().alias("identity"))

    # The full bytes of every text that was hit. Copies in a task meet before the shuffle.
    hits = known.where("group_size > 1").select("digest")
    bytes_of = docs.select(digest(text).alias("digest"), text.alias("bytes"))
    compared = bytes_of.join(hits, "digest", "left_semi").groupBy("digest").agg(F.min("bytes").alias("a"), F.max("bytes").alias("b"))
    clashes = stored(compared.where("a != b").select("digest"), "dedup-clashes")

    result = placed.join(known, "digest")
    if not clashes.isEmpty():
        # One digest, different texts: these rows are grouped by their bytes.
        exact = docs.select(digest(text).alias("digest"), text.alias("bytes"), _identity().alias("identity")).join(clashes, "digest", "left_semi")
        groups = exact.groupBy("digest", "bytes").agg(F.min("identity").alias("keeper"), F.count("*").alias("group_size"))
        result = result.join(clashes, "digest", "left_anti").unionByName(exact.join(groups, ["digest", "bytes"]).drop("bytes"))
    return result.select(
        "identity.doc_id",
        F.col("keeper.doc_id").alias("keep_id"),
        "group_size",
        (F.col("identity") == F.col("keeper")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
