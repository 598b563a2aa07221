"""Incremental reads: lookback, incremental upsert, resumable slices."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import contracts
from tidemark.functions.times import ntz
from tidemark.session import setting, stored
from tidemark.sinks.tables import load_number, upsert
from tidemark.streaming import watermarks
from tidemark.streaming.slices import date_slices, in_slice


def since(
    df: DataFrame, cursor: str, last_value: str | None, lookback_days: int = contracts.LOOKBACK_DAYS,
    months: tuple[str, str] | None = None,
) -> DataFrame:
    """Rows from ``last_value`` minus the lookback on; all rows on the first load.

    Rows without a cursor belong to every load, the first like all later ones.
    The bound is a literal, so it reaches the Parquet scan. ``months`` names the year
    and month columns of a source laid out by the cursor's month: earlier folders are
    then pruned.
    """
    if last_value is None:
        return df
    start = datetime.fromisoformat(last_value) - timedelta(days=lookback_days)
    rows = df.where((F.col(cursor) >= ntz(start)) | F.col(cursor).isNull())
    if months:
        year, month = F.col(months[0]), F.col(months[1])
        later = (year > start.year) | ((year == start.year) & (month >= start.month))
        rows = rows.where(later | year.isNull() | month.isNull())
    return rows


def load_increment(
    source: DataFrame, source_name: str, table: str, keys: Sequence[str], cursor: str,
    store: str, lookback_days: int = contracts.LOOKBACK_DAYS,
    months: tuple[str, str] | None = None, not_after: datetime | None = None,
) -> DataFrame:
    """Watermark -> lookback read -> upsert -> new watermark.

    The increment is read from its source once and landed in the shared folder. The
    watermark moves after the write; a failure in between only repeats work. Rows from
    after ``not_after`` (default: now) are loaded, but do not move the watermark, or one
    wrong date would end all later loads; ``beyond`` lists them.
    """
    spark = source.sparkSession
    mark = watermarks.last_value(spark, store, source_name)
    fresh = stored(since(source, cursor, mark, lookback_days, months), "increment")
    loaded = upsert(fresh, table, keys, cursor, load_number())
    latest = not_after or datetime.now(UTC).replace(tzinfo=None)
    dated = fresh.where(F.col(cursor) <= ntz(latest))
    watermarks.advance(spark, store, watermarks.newest_values(dated, cursor, source_name))
    return loaded


def beyond(df: DataFrame, cursor: str, not_after: datetime) -> DataFrame:
    """Rows whose cursor lies after ``not_after``."""
    return df.where(F.col(cursor) > ntz(not_after))


def replace_slice(rows: DataFrame, table: str, number: int, column: str = "slice_no") -> None:
    """Write one slice of a table partitioned by ``column``, in place of what it had."""
    spark = rows.sparkSession
    numbered = rows.withColumn(column, F.lit(number))
    if not spark.catalog.tableExists(table):
        numbered.write.partitionBy(column).saveAsTable(table)
        return
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        numbered.select(spark.table(table).columns).write.insertInto(table, overwrite=True)


def load_slices(
    source: DataFrame, source_name: str, cursor: str, store: str, start: str, end: str,
    write: Callable[[DataFrame, int], None], days: int = contracts.SLICE_DAYS,
) -> int:
    """Write the range slice by slice and resume after the last finished slice.

    ``write`` gets the rows and the slice number and has to replace that slice, as
    ``replace_slice`` does, so that a slice repeated after a failure is not doubled. A
    later ``end`` loads the cut last slice again. Returns the slices written.
    """
    spark = source.sparkSession
    done = watermarks.last_value(spark, store, source_name)
    slices = date_slices(spark, start, end, days).orderBy("slice_no").collect()
    written = 0
    for s in slices:
        finished = s["slice_end"].isoformat(timespec="seconds")
        if done is not None and finished <= done:
            continue
        rows = in_slice(source, cursor, F.lit(s["slice_start"]), F.lit(s["next_start"]))
        write(rows, s["slice_no"])
        mark = spark.createDataFrame([(source_name, finished)], "source_name string, last_value string")
        watermarks.advance(spark, store, mark)
        written += 1
    return written
