"""Date slices of a range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import contracts
from tidemark.functions.times import iso_text, ntz


def date_slices(
    spark: SparkSession, start: str, end: str | None = None, days: int = contracts.SLICE_DAYS
) -> DataFrame:
    """Consecutive ``days``-long slices from ``start`` to ``end`` (default: now)."""
    last = ntz(end) if end else F.current_timestamp().cast("timestamp_ntz")
    bounds = spark.range(1).select(ntz(start).alias("first"), last.alias("last"))
    return slices_between(bounds, days)


def slices_between(bounds: DataFrame, days: int = contracts.SLICE_DAYS) -> DataFrame:
    """Slices of the range in columns ``first`` and ``last``.

    ``slice_end`` is the last whole second inside, as the source is asked for it;
    ``next_start`` is the open end, so that no moment falls between two slices.
    """
    second = F.expr("INTERVAL 1 SECOND")
    step = F.make_dt_interval(F.lit(days))
    starts = F.when(
        F.col("first") <= F.col("last"), F.sequence("first", "last", step)
    ).otherwise(F.array().cast("array<timestamp_ntz>"))
    return bounds.select("last", F.posexplode(starts).alias("slice_no", "slice_start")).select(
        "slice_no",
        "slice_start",
        F.least(F.col("slice_start") + step - second, F.col("last")).alias("slice_end"),
        F.least(F.col("slice_start") + step, F.col("last") + second).alias("next_start"),
    )


def in_slice(df: DataFrame, cursor: str, start: Column, next_start: Column) -> DataFrame:
    return df.where((F.col(cursor) >= start) & (F.col(cursor) < next_start))


def slice_list(slices: DataFrame) -> list[tuple[int, str, str]]:
    """Slices as control values: number, first and last moment as ISO text."""
    rows = slices.select("slice_no", iso_text(F.col("slice_start")), iso_text(F.col("slice_end")))
    return sorted(tuple(r) for r in rows.collect())
