"""Writing layers: replace, append, upsert, routing, materialisation."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import contracts
from tidemark.functions.jsontext import payload_hash
from tidemark.functions.text import is_blank
from tidemark.operators.checks import DataCheckError, assert_unique, require_some
from tidemark.operators.dedup import last_per_payload, newest_per_key
from tidemark.session import remove
from tidemark.sinks import versions

# More touched partitions than this are looked up by join instead of by a list.
LISTED_PARTITIONS = 2_000
LOAD_SEQ = "_load_seq"
# Table property: the stretches that each month is cut into.
PARTS = "tidemark.parts"


def load_number() -> int:
    """A number for a load, above those of all earlier loads: its start in microseconds.

    Asking the table for its highest number would scan all of it.
    """
    return time.time_ns() // 1_000


def ensure_layers(spark: SparkSession, names: Sequence[str] = contracts.LAYERS) -> None:
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def replace_table(
    df: DataFrame, table: str, partition_by: Sequence[str] = (), guard: bool = False, unique: Sequence[str] = ()
) -> DataFrame:
    """Write ``df`` as the whole new content; with ``guard`` never replace by nothing.

    The rows are built aside and counted as they are written, and with ``unique`` the key is
    checked there; only then do they take the table's place. Until then, and for good if the
    writer dies or a check fails, the table is as it was. A table with other columns is
    dropped and made anew, once the rows that replace it are there.
    """
    replace_measured(df, table, partition_by, guard, unique)
    return df.sparkSession.table(table)


def replace_measured(
    df: DataFrame, table: str, partition_by: Sequence[str] = (), guard: bool = False, unique: Sequence[str] = (),
    required: Sequence[str] = (),
) -> dict[str, int]:
    """Replace a table and return what was counted on the way: ``rows``, and blanks as ``<column>_blank``.

    The source is read once: nothing is asked of it before the write or of the table after it.
    """
    spark = df.sparkSession
    blanks = [F.count_if(is_blank(F.col(f"`{c}`").cast("string"))).alias(f"{c}_blank") for c in required]
    path, seen = versions.build(df, table, partition_by, blanks)
    try:
        if guard:
            require_some(seen["rows"], table)
        if unique:
            assert_unique(spark.read.schema(df.schema).parquet(path), unique)
    except DataCheckError:
        remove(spark, path)
        raise
    columns = [c for c in df.columns if c not in partition_by] + list(partition_by)
    if spark.catalog.tableExists(table):
        there = [(f.name, f.dataType) for f in spark.table(table).schema]
        same = there == [(c, df.schema[c].dataType) for c in columns]
        if not same or versions.partition_columns(spark, table) != list(partition_by):
            spark.sql(f"DROP TABLE {table}")
    if not spark.catalog.tableExists(table):
        versions.create_empty(spark, df.select(*(F.col(f"`{c}`") for c in columns)), table, partition_by)
    versions.publish(spark, table, path, whole=True)
    return {c: seen.get(c, 0) for c in ("rows", *(f"{c}_blank" for c in required))}


def _rebalanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Few files per folder, and several for a folder that holds most of the rows."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def append_table(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> DataFrame:
    _rebalanced(df, partition_by).write.mode("append").partitionBy(*partition_by).saveAsTable(table)
    return df.sparkSession.table(table)


def upsert(
    increment: DataFrame, table: str, keys: Sequence[str], cursor: str, load_seq: int,
    month_column: str = "load_month", parts: int = 1, part_column: str = "load_part",
) -> DataFrame:
    """Append an increment and keep the newest row per key.

    The table is partitioned by the cursor's month. Because the cursor is part of the
    key, a key never changes its month, so only the months the increment touches are
    read and written, once, as a version that then takes their place (see ``versions``).
    Applying an increment again changes no data column. If a load dies before its
    version is named, the table is as it was; after that, the next load finishes it.

    With ``parts`` above 1 each month is cut into as many equal stretches of time, each a
    folder of its own, and only the stretches that the increment touches are rewritten: a
    few late rows cost a few folders of a large month. A table keeps the parts it was made with.

    The first load of a table reads the increment once, so it need not be stored before.
    """
    if cursor not in keys:
        raise ValueError("the cursor has to be part of the key")
    spark = increment.sparkSession
    month = F.coalesce(F.date_format(cursor, "yyyyMM"), F.lit("none"))
    fresh = increment.withColumns({LOAD_SEQ: F.lit(load_seq).cast("bigint"), month_column: month})
    exists = spark.catalog.tableExists(table)
    by = versions.partition_columns(spark, table) if exists else [month_column] + ([part_column] if parts > 1 else [])
    if len(by) > 1:
        parts = int(versions.table_property(spark, table, PARTS)) if exists else parts
        fresh = fresh.withColumn(by[1], _part_of_month(cursor, parts))
    if not exists:
        versions.create_empty(spark, fresh, table, by, {PARTS: str(parts)} if parts > 1 else {})
    versions.finish(spark, table)
    # Another session may have rewritten files since this one last looked.
    spark.catalog.refreshTable(table)
    old = spark.table(table)
    rows = fresh.select(*old.columns)
    if exists:
        folders = fresh.select(*by).distinct()
        touched = folders.limit(LISTED_PARTITIONS + 1).collect()
        if not touched:
            return old
        if len(touched) <= LISTED_PARTITIONS:
            affected = old.where(F.col(by[0]).isin(*{r[0] for r in touched}))
            if len(by) > 1:
                affected = affected.where(F.struct(*by).isin(*(F.struct(*map(F.lit, r)) for r in touched)))
        else:
            affected = old.join(folders, by, "left_semi")
        rows = affected.unionByName(rows)
    path, _ = versions.build(newest_per_key(rows, keys, cursor, LOAD_SEQ).select(*old.columns), table, by)
    versions.publish(spark, table, path)
    return spark.table(table)


def _part_of_month(cursor: str, parts: int) -> Column:
    """Which of ``parts`` equal stretches of its month a moment lies in; 0 without one."""
    start = F.date_trunc("month", cursor).cast("timestamp_ntz")
    whole = F.timestamp_diff("SECOND", start, F.add_months(start, 1).cast("timestamp_ntz"))
    since = F.timestamp_diff("SECOND", start, F.col(cursor).cast("timestamp_ntz"))
    return F.coalesce(F.floor(since * parts / whole), F.lit(0)).cast("int")


def route_records(
    records: DataFrame, database: str, roster: Sequence[contracts.RecordSet] = contracts.RECORD_SETS
) -> dict[str, DataFrame]:
    """Append records once, partitioned by dataset, under one named view per dataset.

    All datasets are written in a single pass; each view reads only its own partition.
    """
    spark = records.sparkSession
    whole = f"{database}.{contracts.OPEN_DATA_STREAM}"
    append_table(records, whole, ["_socrata_resource_id"])
    tables = {}
    for entry in roster:
        spark.sql(
            f"CREATE OR REPLACE VIEW {database}.{entry.table} AS SELECT * FROM {whole} "
            f"WHERE _socrata_resource_id = '{entry.resource_id}'"
        )
        tables[entry.table] = spark.table(f"{database}.{entry.table}")
    return tables


def materialize(df: DataFrame, name: str, kind: str = "view") -> DataFrame:
    """A model as a session view (default) or as a table."""
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    if kind == "table":
        return replace_table(df, name)
    raise ValueError(f"unknown kind {kind!r}")


def with_payload_hash(df: DataFrame, payload: str = "payload") -> DataFrame:
    return df.withColumn("payload_hash", payload_hash(F.col(payload)))


def dedup_payloads(df: DataFrame, sequence: str, payload: str = "payload") -> DataFrame:
    """Add the hash, keep the last row per payload. Doing it again changes nothing."""
    return last_per_payload(df, payload, sequence, hash_as="payload_hash")


def replace_unique(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Replace a table by rows whose key is unique; by others it is not replaced."""
    return replace_table(df, table, unique=keys)
