"""Marts from the raw and staging layers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import contracts
from tidemark.functions.keys import composite_key
from tidemark.functions.times import ntz
from tidemark.operators.checks import kept_and_dropped
from tidemark.operators.joins import attach_zones, nearest_zone
from tidemark.operators.marts import (
    FLOW_ENDS,
    borough_flow,
    daily_fact,
    documents,
    exact,
    merge_facts,
    modal_daily,
    partial_fact,
    station_dimension,
    zone_flow,
)
from tidemark.operators.shape import before, stage_json
from tidemark.session import stored
from tidemark.sinks.derived import ORIGIN, refresh
from tidemark.sinks.tables import LOAD_SEQ, replace_table
from tidemark.sinks.versions import partition_columns

# Up to so many zones are sent to every executor when trips get their names.
FEW_ZONES = 10_000


def fact_trips(
    trips: DataFrame, zones: DataFrame, cursor: str, reliable_before: str | None = contracts.RELIABLE_BEFORE
) -> DataFrame:
    """Trips with their zones; those from ``reliable_before`` on are left out unless it is None."""
    return attach_zones(trips if reliable_before is None else before(trips, cursor, ntz(reliable_before)), zones)


def station_zones(stations: DataFrame, zones: DataFrame) -> DataFrame:
    """Station dimension with the taxi zone each station lies nearest to."""
    return nearest_zone(stations, zones).withColumnRenamed("zone_id", "location_id")


def build_marts(
    trips: DataFrame, zones: DataFrame, cursor: str, other_modes: Mapping[str, tuple[DataFrame, str]],
    weather: DataFrame | None = None, holidays: DataFrame | None = None,
    events: tuple[DataFrame, str] | None = None, others: Mapping[str, DataFrame] | None = None,
    reliable_before: str | None = contracts.RELIABLE_BEFORE,
) -> dict[str, DataFrame]:
    """Write facts, daily summary and flows, and the ``others`` by name.

    Later marts read the written fact table instead of deriving the trips again.
    ``fact_trips_dropped`` counts the trips that ``reliable_before`` keeps out.
    """
    made = {"fact_trips": replace_table(fact_trips(trips, zones, cursor, reliable_before), "marts.fact_trips")}
    if reliable_before is not None:
        made["fact_trips_dropped"] = kept_and_dropped(trips, F.col(cursor) < ntz(reliable_before))
    flow = replace_table(zone_flow(made["fact_trips"], zones), "marts.agg_flow_zone")
    made["agg_flow_zone"] = flow
    made["agg_flow_borough"] = replace_table(borough_flow(flow), "marts.agg_flow_borough")
    modes = {"taxi": daily_fact(made["fact_trips"], cursor)}
    modes |= {name: daily_fact(df, column) for name, (df, column) in other_modes.items()}
    permits = daily_fact(*events) if events else None
    daily = modal_daily(modes, weather, holidays, permits)
    made["agg_modal_daily"] = replace_table(daily, "marts.agg_modal_daily")
    made["dim_date"] = replace_table(
        made["agg_modal_daily"].select(
            "day", "year", "quarter", "month", "day_of_month", "day_of_week", "is_weekend"
        ),
        "marts.dim_date",
    )
    for name, df in {**(others or {}), "dim_weather": weather, "dim_holidays": holidays}.items():
        if df is not None:
            made[name] = replace_table(df, f"marts.{name}")
    return made


def update_marts(
    spark: SparkSession, trips: str, zones: DataFrame, cursor: str, database: str = "marts",
    reliable_before: str | None = contracts.RELIABLE_BEFORE, measures: Mapping[str, Column] | None = None,
) -> dict[str, DataFrame]:
    """Bring the trip marts up to date after loads into the table ``trips``, which ``upsert`` keeps.

    Only the months (or stretches of months) that loads have touched since the last update
    are read: their trips get zones anew (``fact_trips``), and one partial summary for each
    day and pair of zones (``trip_totals``). Flows and the daily fact are merged from
    the summaries, which are far smaller than the trips. The result is that of a whole
    rebuild, whatever a load has added or corrected; other zones, or another
    ``reliable_before``, make all months anew. ``measures`` should be exact (``money``,
    ``exact``); sums of doubles depend on the order of their rows.
    """
    measures = measures or {}
    fact, totals = f"{database}.fact_trips", f"{database}.trip_totals"
    seen = zones.agg(F.count("*"), F.sum(F.xxhash64(*zones.columns).cast("decimal(20,0)"))).head()
    few = seen[0] <= FEW_ZONES
    named = F.broadcast(zones) if few else zones
    refresh(
        spark, trips, fact, lambda rows: fact_trips(rows.drop(LOAD_SEQ), named, cursor, reliable_before),
        f"{seen[0]} {seen[1]} {reliable_before}", by_row=few,
    )

    def summary(rows: DataFrame) -> DataFrame:
        return partial_fact(rows, cursor, [*by, *FLOW_ENDS], measures)

    by = partition_columns(spark, fact)
    refresh(spark, fact, totals, summary, " ".join(f"{name}={col}" for name, col in measures.items()))
    made = {"fact_trips": spark.table(fact).drop(ORIGIN), "trip_totals": spark.table(totals).drop(ORIGIN)}
    flow = made["trip_totals"].groupBy(*FLOW_ENDS).agg(F.sum("row_count").alias("trips"))
    made["agg_flow_zone"] = replace_table(flow, f"{database}.agg_flow_zone")
    made["agg_flow_borough"] = replace_table(borough_flow(made["agg_flow_zone"]), f"{database}.agg_flow_borough")
    daily = merge_facts(made["trip_totals"], (), list(measures))
    made["fact_trips_daily"] = replace_table(daily, f"{database}.fact_trips_daily")
    return made


def inspection_documents(records: DataFrame, part_size: int = contracts.INSPECTION_PART) -> DataFrame:
    """Inspection rows nested per restaurant and date, ``part_size`` to a document."""
    nested = documents(records, contracts.INSPECTION_KEY, contracts.INSPECTION_CHILD, "violations", part_size)
    return nested.select(composite_key(*contracts.INSPECTION_KEY).alias("document_key"), "part", "violations")


def fact_bike_trips(raw: DataFrame) -> DataFrame:
    """Typed bike trips. The new layout has no duration; it follows from the times."""
    start, stop = (F.col(c).try_cast("timestamp_ntz") for c in ("starttime", "stoptime"))
    seconds = F.timestamp_diff("SECOND", start, stop)
    return raw.select(
        F.col("bikeid").alias("bike_id"),
        start.alias("started_at"),
        stop.alias("ended_at"),
        F.coalesce(F.col("tripduration").try_cast("bigint"), seconds).alias("duration_seconds"),
        F.col("start station id").alias("start_station_id"),
        F.col("end station id").alias("end_station_id"),
        F.col("usertype").alias("user_type"),
    )


def bike_stations(raw: DataFrame, zones: DataFrame) -> DataFrame:
    """Stations seen at either end of a trip, with their newest place and taxi zone.

    The trips are read once; stations are few and kept as a table before they are mapped.
    """
    def seen(end: str, at: str) -> Column:
        return F.struct(
            F.col(f"{end} station id").alias("id"),
            F.col(f"{end} station name").alias("station_name"),
            F.col(f"{end} station latitude").try_cast("double").alias("lat"),
            F.col(f"{end} station longitude").try_cast("double").alias("lon"),
            F.col(at).alias("seen_at"),
        )

    both = raw.select(F.inline(F.array(seen("start", "starttime"), seen("end", "stoptime"))))
    columns = {"station_name": "station_name", "lat": "lat", "lon": "lon"}
    stations = stored(station_dimension(both, "id", columns, "seen_at"), "stations")
    return station_zones(stations, zones)


def fact_complaints(records: DataFrame, zones: DataFrame) -> DataFrame:
    """Service requests per day, type and nearest zone.

    Counted by place first and kept, so that requests are parsed once, and places are
    mapped instead of requests.
    """
    fields = {
        "created_date": "timestamp_ntz", "complaint_type": "string",
        "latitude": "double", "longitude": "double",
    }
    typed = stage_json(records.select("payload"), "payload", fields).drop("payload")
    typed = typed.withColumnsRenamed({"latitude": "lat", "longitude": "lon"})
    places = stored(daily_fact(typed, "created_date", ["complaint_type", "lat", "lon"]), "requests")
    by_zone = station_zones(places, zones).groupBy("day", "complaint_type", "location_id")
    return by_zone.agg(F.sum("row_count").alias("row_count"))


def fact_event_permits(records: DataFrame) -> DataFrame:
    """One row per permit with its hours."""
    fields = {
        "event_id": "string", "event_name": "string", "event_type": "string",
        "start_date_time": "timestamp_ntz", "end_date_time": "timestamp_ntz",
    }
    typed = stage_json(records.select("payload"), "payload", fields).drop("payload")
    minutes = F.timestamp_diff("MINUTE", F.col("start_date_time"), F.col("end_date_time"))
    return typed.withColumn("duration_hours", minutes / 60)


def fact_air_quality(readings: DataFrame, cursor: str, parameter: str, value: str) -> DataFrame:
    """Daily readings per measured parameter."""
    return daily_fact(readings, cursor, [parameter], {"value": exact(F.col(value))})


def fact_subway_entries(readings: DataFrame, cursor: str, station: str, entries: str) -> DataFrame:
    """Entries per station and day."""
    return readings.groupBy(F.to_date(cursor).alias("day"), station).agg(F.sum(entries).alias("entries"))


def dim_weather(readings: DataFrame, cursor: str, measures: Mapping[str, str]) -> DataFrame:
    """One row per day with the day's mean, lowest and highest reading of each measure."""
    daily = daily_fact(readings, cursor, (), {name: exact(F.col(c)) for name, c in measures.items()})
    return daily.drop("row_count", *[f"{name}_sum" for name in measures])


def dim_subway_stations(readings: DataFrame, station: str, columns: Mapping[str, str], newest_by: str) -> DataFrame:
    """One row per subway station with the attributes of its newest reading."""
    return station_dimension(readings, station, columns, newest_by)


def dim_holidays(records: DataFrame, day: str, name: str) -> DataFrame:
    """One row per holiday; several names of one day are listed together."""
    names = F.array_join(F.sort_array(F.collect_set(name)), "; ")
    return records.where(F.col(name).isNotNull()).groupBy(F.to_date(day).alias("day")).agg(names.alias("holiday"))
