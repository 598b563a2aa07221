"""Facts, dimensions, daily summaries, flows, nested documents.

The published table names carry no formulas; the definitions here are ours.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tidemark.operators.joins import attach_zones
from tidemark.operators.numbering import number_rows
from tidemark.session import stored

#: What a zone flow is counted by.
FLOW_ENDS = ("pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone")


def money(col: Column) -> Column:
    """Exact amounts, so that a sum does not depend on the order of its rows."""
    return col.cast("decimal(18,2)")


def exact(col: Column) -> Column:
    """Readings to nine places, whose sum does not depend on the order of its rows either."""
    return col.cast("decimal(28,9)")


def daily_fact(
    df: DataFrame, cursor: str, by: Sequence[str] = (), measures: Mapping[str, Column] | None = None
) -> DataFrame:
    """Rows per day (and key); sum, average, minimum and maximum of each measure.

    Measures keep the type they are given in: ``money`` or ``exact`` make them exact, and
    sums of doubles depend on the order of their rows.
    """
    totals = []
    for name, col in (measures or {}).items():
        totals += [
            F.sum(col).alias(f"{name}_sum"),
            F.avg(col).alias(f"{name}_avg"),
            F.min(col).alias(f"{name}_min"),
            F.max(col).alias(f"{name}_max"),
        ]
    return df.groupBy(F.to_date(cursor).alias("day"), *by).agg(F.count("*").alias("row_count"), *totals)


def partial_fact(
    df: DataFrame, cursor: str, by: Sequence[str] = (), measures: Mapping[str, Column] | None = None
) -> DataFrame:
    """What ``merge_facts`` needs of some of the rows: counts, sums, minima and maxima per day (and key)."""
    totals = []
    for name, col in (measures or {}).items():
        totals += [
            F.sum(col).alias(f"{name}_sum"),
            F.count(col).alias(f"{name}_n"),
            F.min(col).alias(f"{name}_min"),
            F.max(col).alias(f"{name}_max"),
        ]
    return df.groupBy(F.to_date(cursor).alias("day"), *by).agg(F.count("*").alias("row_count"), *totals)


def merge_facts(partials: DataFrame, by: Sequence[str] = (), measures: Sequence[str] = ()) -> DataFrame:
    """The daily fact of all rows that the partial facts were made of, as ``daily_fact`` gives it."""
    totals = []
    for name in measures:
        total = F.sum(f"{name}_sum").cast(partials.schema[f"{name}_sum"].dataType)
        mean = F.try_divide(total, F.sum(f"{name}_n"))
        kind = partials.schema[f"{name}_min"].dataType
        if isinstance(kind, DecimalType):
            mean = mean.cast(DecimalType(min(kind.precision + 4, 38), min(kind.scale + 4, 38)))
        totals += [
            total.alias(f"{name}_sum"),
            mean.alias(f"{name}_avg"),
            F.min(f"{name}_min").alias(f"{name}_min"),
            F.max(f"{name}_max").alias(f"{name}_max"),
        ]
    return partials.groupBy("day", *by).agg(F.sum("row_count").alias("row_count"), *totals)


def date_dimension(bounds: DataFrame, first: str = "first", last: str = "last") -> DataFrame:
    """Every day of the range with its calendar parts (1 = Sunday)."""
    days = F.when(
        F.col(first) <= F.col(last), F.sequence(F.col(first), F.col(last), F.expr("INTERVAL 1 DAY"))
    ).otherwise(F.array().cast("array<date>"))
    return bounds.select(F.explode(days).alias("day")).select(
        "day",
        F.year("day").alias("year"),
        F.quarter("day").alias("quarter"),
        F.month("day").alias("month"),
        F.dayofmonth("day").alias("day_of_month"),
        F.dayofweek("day").alias("day_of_week"),
        F.dayofweek("day").isin(1, 7).alias("is_weekend"),
    )


def modal_daily(
    modes: Mapping[str, DataFrame], weather: DataFrame | None = None, holidays: DataFrame | None = None,
    events: DataFrame | None = None,
) -> DataFrame:
    """One row per day over all modes; a mode without rows on a day counts 0.

    ``modes`` maps a mode to daily facts with ``day`` and ``row_count``. They are
    stacked and grouped once instead of being joined one by one, and kept as a table of
    days, because the range of days and the counts would each scan all facts otherwise.
    ``weather`` is one row per ``day``; ``holidays`` has ``day`` and ``holiday``;
    ``events`` is a daily fact.
    """
    counted = dict(modes)
    if events is not None:
        counted["event"] = events
    stacked = reduce(
        DataFrame.unionByName,
        [f.select("day", F.lit(mode).alias("_mode"), "row_count") for mode, f in counted.items()],
    )
    counts = stacked.groupBy("day").agg(
        *[
            F.sum(F.when(F.col("_mode") == mode, F.col("row_count")).otherwise(0)).alias(f"{mode}_count")
            for mode in counted
        ]
    )
    daily = stored(counts, "modal-days")
    span = daily.agg(F.min("day").alias("first"), F.max("day").alias("last"))
    summary = date_dimension(span).join(daily, "day", "left").na.fill(0, [f"{m}_count" for m in counted])
    total = reduce(Column.__add__, [F.col(f"{m}_count") for m in modes])
    summary = summary.withColumn("all_modes_count", total)
    if weather is not None:
        summary = summary.join(weather, "day", "left")
    if holidays is not None:
        summary = summary.join(holidays.select("day", "holiday"), "day", "left")
        summary = summary.withColumn("is_holiday", F.col("holiday").isNotNull())
    return summary


def zone_flow(
    trips: DataFrame, zones: DataFrame, pickup: str = "pulocationid", dropoff: str = "dolocationid"
) -> DataFrame:
    """Trips by origin and destination zone, keeping the boroughs for the roll-up.

    Counted by zone ids first, so that names are joined to pairs of zones, not to trips.
    """
    by_id = trips.groupBy(pickup, dropoff).agg(F.count("*").alias("_n"))
    named = attach_zones(by_id, zones, pickup, dropoff)
    return named.groupBy(*FLOW_ENDS).agg(F.sum("_n").alias("trips"))


def borough_flow(flow: DataFrame) -> DataFrame:
    """Borough flow, rolled up from the far smaller zone flow."""
    return flow.groupBy("pickup_borough", "dropoff_borough").agg(F.sum("trips").alias("trips"))


def station_dimension(df: DataFrame, station: str, columns: Mapping[str, str], newest_by: str) -> DataFrame:
    """One row per station with the attributes of its newest row.

    A max over a struct is combined before the shuffle, so a busy station is cheap.
    """
    fields = [F.col(f"`{old}`").alias(new) for new, old in columns.items()]
    newest = F.max(F.struct(F.col(f"`{newest_by}`").alias("_at"), *fields)).alias("_s")
    return (
        df.where(F.col(f"`{station}`").isNotNull())
        .groupBy(F.col(f"`{station}`").alias("station_id")).agg(newest)
        .select("station_id", *[f"_s.`{new}`" for new in columns])
    )


def documents(
    df: DataFrame, keys: Sequence[str], children: Sequence[str], name: str, part_size: int
) -> DataFrame:
    """Group flat rows into documents per key, each with a sorted array of children.

    A document is cut into consecutive sorted parts of ``part_size`` children, numbered from
    0 in ``part``, so that no task has to hold a whole large one; all children are kept.
    """
    child = F.struct(*[F.col(f"`{c}`") for c in children])
    collected = F.sort_array(F.collect_list(child)).alias(name)
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    large = counts.where(F.col("_n") > part_size).select(
        *[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)]
    )
    if large.isEmpty():
        return df.groupBy(*keys).agg(collected).withColumn("part", F.lit(0))

    same = reduce(
        Column.__and__, [df[f"`{k}`"].eqNullSafe(large[f"_k{i}"]) for i, k in enumerate(keys)]
    )
    small = df.join(large, same, "left_anti").select(*keys, *children, F.lit(0).alias("part"))
    # Copies of one child may be many, so rows that tie are spread as well.
    hot = stored(df.join(large, same, "left_semi").select(*keys, *children), "hot-documents")
    numbered = number_rows(hot, children, "_n", within=keys, spread_ties=True)
    parts = numbered.withColumn("part", F.floor(F.col("_n") / part_size).cast("int")).drop("_n")
    return small.unionByName(parts).groupBy(*keys, "part").agg(collected)
