"""Versions of a table's data, built aside and put in place by pointing the catalog at them.

A version is a folder next to the table. While it is built, and if its writer dies, the table
is as it was. Putting it in place moves no data: the table, or each of its partitions that
the version has, gets the version's folder as its location. What a load is about to put in
place is named in the table's properties first, so the next load can finish it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.session import folders, remove

#: Table properties: a version that is not in place yet, and whether it is the whole content.
PENDING, WHOLE = "tidemark.pending", "tidemark.pending.whole"


def _place(spark: SparkSession, table: str) -> tuple[str, str]:
    database, _, name = table.rpartition(".")
    return database or spark.catalog.currentDatabase(), name


def new_version(spark: SparkSession, table: str) -> str:
    """A folder for a version of the table, unused so far."""
    database, name = _place(spark, table)
    root = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    return f"{root}/_versions/{name}-{uuid.uuid4().hex}"


def build(
    df: DataFrame, table: str, partition_by: Sequence[str] = (), measures: Sequence[Column] = (),
    last: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[str, dict[str, int]]:
    """Write a version; its folder and what was measured in the same pass: ``rows``, and aggregates of ``df``.

    ``last`` adds columns to the rows when they are dealt out, so that these need not be sent along.
    """
    path = new_version(df.sparkSession, table)
    seen = Observation()
    rows = df.observe(seen, F.count(F.lit(1)).alias("rows"), *measures)
    if partition_by:
        # Few files per folder, and several for a folder that holds most of the rows.
        rows = rows.hint("rebalance", *partition_by)
    if last:
        rows = last(rows)
    rows.write.partitionBy(*partition_by).parquet(path)
    return path, {"rows": 0, **seen.get}


def create_empty(
    spark: SparkSession, df: DataFrame, table: str, partition_by: Sequence[str] = (), properties: dict[str, str] | None = None
) -> None:
    """The table with the columns of ``df``, in their order, and no rows."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    by = ", ".join(f"`{c}`" for c in partition_by)
    told = ", ".join(f"'{k}' = '{v}'" for k, v in (properties or {}).items())
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet"
        + (f" PARTITIONED BY ({by})" if by else "") + (f" TBLPROPERTIES ({told})" if told else "")
    )


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def table_property(spark: SparkSession, table: str, key: str) -> str | None:
    found = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == key).head()
    return found["value"] if found else None


def _location(spark: SparkSession, table: str) -> str | None:
    told = spark.sql(f"DESCRIBE EXTENDED {table}").where("trim(col_name) = 'Location'").head()
    return told["data_type"] if told else None


def _spec(folder: str) -> str:
    """PARTITION clause of a folder ``a=1/b=x``."""
    pairs = (part.split("=", 1) for part in folder.split("/"))
    return "PARTITION (" + ", ".join(f"`{name}`='{value}'" for name, value in pairs) + ")"


def publish(spark: SparkSession, table: str, path: str, whole: bool = False) -> None:
    """Put a version in place. With ``whole`` the table has nothing else afterwards.

    From the moment the version is named in the table's properties it counts: if this job
    dies, ``finish`` goes on with it. Folders that it takes the place of are deleted.
    """
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{PENDING}' = '{path}', '{WHOLE}' = '{str(whole).lower()}')")
    finish(spark, table)


def finish(spark: SparkSession, table: str) -> bool:
    """Put in place what a load has named and not finished; whether there was anything."""
    path = table_property(spark, table, PENDING)
    if path is None:
        return False
    whole = table_property(spark, table, WHOLE) == "true"
    if columns := partition_columns(spark, table):
        new = folders(spark, path, len(columns))
        old = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
        both = sorted(old.intersection(new))
        gone = _folders_of(spark, table, both)
        for folder in both:
            spark.sql(f"ALTER TABLE {table} {_spec(folder)} SET LOCATION '{path}/{folder}'")
        fresh = [f"{_spec(folder)} LOCATION '{path}/{folder}'" for folder in new if folder not in old]
        if fresh:
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(fresh)}")
        left = [_spec(folder) for folder in sorted(old.difference(new))] if whole else []
        if left:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(left)}")
    else:
        gone = {_location(spark, table)}
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{PENDING}', '{WHOLE}')")
    for folder in gone:
        # A folder of this very version is in place already when a load is finished a second time.
        if folder and path.rsplit("/", 1)[-1] not in folder:
            remove(spark, folder)
    return True


def _folders_of(spark: SparkSession, table: str, parts: Sequence[str]) -> set[str]:
    """Where the files of some partitions lie: one listing of these, and of no others."""
    if not parts:
        return set()
    specs = [dict(pair.split("=", 1) for pair in part.split("/")) for part in parts]
    rows = spark.table(table)
    for column in specs[0]:
        rows = rows.where(F.col(f"`{column}`").cast("string").isin(*{s[column] for s in specs}))
    found = {file.rsplit("/", 1)[0] for file in rows.inputFiles()}
    return {folder for folder in found if any(folder.endswith("/" + part) for part in parts)}


def sweep(spark: SparkSession, table: str) -> int:
    """Delete versions that no part of the table refers to, left by writers that died; how many there were."""
    finish(spark, table)
    spark.catalog.refreshTable(table)
    used = {_location(spark, table), *(file.rsplit("/", 1)[0] for file in spark.table(table).inputFiles())}
    root, _, own = new_version(spark, table).rpartition("/")
    name = own.rpartition("-")[0]
    swept = 0
    for folder in folders(spark, root, 1):
        if folder.rpartition("-")[0] == name and not any(f"/{folder}" in (place or "") for place in used):
            remove(spark, f"{root}/{folder}")
            swept += 1
    return swept
