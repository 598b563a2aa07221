"""Watermark store: one value per source, never moving back.

Advances are appended and the newest value is taken on reading. No row is rewritten,
so a lost task or two jobs at once cannot lose or lower a watermark. ``compact`` folds a
log that has grown.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import iso_text
from tidemark.session import remove, stored
from tidemark.sources.files import footer_bounds

TABLE = "_watermarks"
_COLUMNS = "source_name STRING, last_value STRING, updated_at TIMESTAMP"


def create_store(spark: SparkSession, database: str = "raw") -> str:
    table = f"{database}.{TABLE}"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({_COLUMNS}) USING parquet")
    return table


def newest_values(df: DataFrame, cursor: str, source: str | None = None, by: str | None = None) -> DataFrame:
    """Highest cursor per source, as ISO text. ``by`` names a column holding the source."""
    name = F.col(by) if by else F.lit(source)
    return (
        df.groupBy(name.alias("source_name"))
        .agg(iso_text(F.max(cursor)).alias("last_value"))
        .where("last_value IS NOT NULL")
    )


def newest_in_files(spark: SparkSession, paths: Sequence[str], cursor: str, source: str) -> DataFrame:
    """(source_name, last_value, row_count) of Parquet files, from their footers where these say it.

    Only files whose footers do not tell the newest cursor are scanned, and of them one column.
    """
    told = stored(footer_bounds(spark, paths, cursor), "footers")
    silent = [r["path"] for r in told.where("NOT known").select("path").collect()]
    found = told.select("rows", "newest")
    if silent:
        scanned = spark.read.option("mergeSchema", "true").parquet(*silent)
        newest = F.max(F.col(cursor).cast("timestamp_ntz")) if cursor in scanned.columns else F.lit(None).cast("timestamp_ntz")
        found = told.where("known").select("rows", "newest").unionByName(
            scanned.agg(F.count("*").alias("rows"), newest.alias("newest"))
        )
    return found.agg(
        F.lit(source).alias("source_name"), iso_text(F.max("newest")).alias("last_value"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"),
    )


def compact(spark: SparkSession, table: str) -> int:
    """Fold the log into one file; how many files it took the place of.

    The files are listed once, their watermarks written as one more file, and then exactly
    those files are deleted. An advance that comes meanwhile is another file and stays.
    """
    spark.catalog.refreshTable(table)
    files = spark.table(table).inputFiles()
    if len(files) < 2:
        return 0
    log = spark.read.schema(spark.table(table).schema).parquet(*files)
    folded = stored(_newest(log), "watermarks")
    folded.coalesce(1).write.mode("append").insertInto(table)
    for file in files:
        remove(spark, file)
    spark.catalog.refreshTable(table)
    return len(files)


def advance(spark: SparkSession, table: str, values: DataFrame) -> None:
    """Record new values; lower ones have no effect."""
    values.select(
        F.col("source_name"), F.col("last_value"), F.current_timestamp().alias("updated_at")
    ).coalesce(1).write.mode("append").insertInto(table)


def watermarks(spark: SparkSession, table: str) -> DataFrame:
    """One row per source: its highest value and when that was first reached."""
    return _newest(spark.table(table))


def _newest(log: DataFrame) -> DataFrame:
    reached = log.groupBy("source_name", "last_value").agg(F.min("updated_at").alias("updated_at"))
    return reached.groupBy("source_name").agg(
        F.max("last_value").alias("last_value"), F.max_by("updated_at", "last_value").alias("updated_at")
    )


def last_value(spark: SparkSession, table: str, source: str) -> str | None:
    row = watermarks(spark, table).where(F.col("source_name") == source).head()
    return row["last_value"] if row else None
