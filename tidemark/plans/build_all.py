"""Everything in dependency order: raw layers first, then the marts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import contracts
from tidemark.plans.bikes import ingest_bikes
from tidemark.plans.marts import (
    bike_stations,
    build_marts,
    dim_subway_stations,
    dim_weather,
    fact_air_quality,
    fact_bike_trips,
    fact_complaints,
    fact_event_permits,
    fact_subway_entries,
    inspection_documents,
)
from tidemark.plans.open_data import current_records, load_records
from tidemark.plans.trips import load_trips
from tidemark.plans.zones import build_zones
from tidemark.operators.shape import union_all
from tidemark.session import exists, prepare
from tidemark.sources.paged_json import Fetch


PICKED_UP = "picked_up_at"


@dataclass(frozen=True)
class Readings:
    """Measurements: their time, what they are of (a parameter or a station), and columns by name.

    For air quality ``columns`` has ``value``; for the subway ``entries`` and the attributes
    of a station; for weather a measure for each name.
    """

    rows: DataFrame
    cursor: str
    of: str | None
    columns: dict[str, str]


@dataclass(frozen=True)
class Inputs:
    """Where the sources lie. ``records`` maps a roster name to (fetch, start, end).

    ``streams`` names the trip streams to load; one without a folder is left out.
    ``centroids`` are zones with ``location_id``, ``lat`` and ``lon``; ``weather`` and
    ``holidays`` are one row per ``day``.
    """

    zones_csv: str
    trips_root: str
    streams: tuple[str, ...] = tuple(contracts.TRIP_STREAMS)
    bikes_root: str | None = None
    bike_months: tuple[str, str] | None = None
    records: dict[str, tuple[Fetch, str, str | None]] = field(default_factory=dict)
    centroids: DataFrame | None = None
    weather: DataFrame | None = None
    holidays: DataFrame | None = None
    air_quality: Readings | None = None
    subway: Readings | None = None
    weather_readings: Readings | None = None


def all_trips(spark: SparkSession, root: str, streams: tuple[str, ...]) -> DataFrame:
    """The trips of all streams as one relation, with the stream and one pickup time."""
    found = [s for s in map(contracts.TRIP_STREAMS.get, streams) if exists(spark, f"{root}/{s.folder}")]
    if not found:
        raise ValueError(f"{root} has none of the folders of {', '.join(streams)}")
    loaded = [
        load_trips(spark, root, s).withColumns({"stream": F.lit(s.name), PICKED_UP: F.col(s.cursor)}) for s in found
    ]
    return union_all(loaded)


def build_all(spark: SparkSession, inputs: Inputs) -> dict[str, DataFrame]:
    prepare(spark)
    zones = build_zones(spark, inputs.zones_csv)
    trips = all_trips(spark, inputs.trips_root, inputs.streams)
    made = {"dim_nyc_taxi_zones": zones}

    modes: dict[str, tuple[DataFrame, str]] = {}
    others: dict[str, DataFrame] = {}
    permits: tuple[DataFrame, str] | None = None
    if inputs.bikes_root:
        start, end = inputs.bike_months or (None, None)
        bikes = ingest_bikes(spark, inputs.bikes_root, start, end)
        made[contracts.BIKE_TABLE] = bikes.table
        others["fact_citibike_trips"] = fact_bike_trips(bikes.table)
        modes["bike"] = (others["fact_citibike_trips"], "started_at")
        if inputs.centroids is not None:
            others["dim_citibike_stations"] = bike_stations(bikes.table, inputs.centroids)
    for entry in contracts.RECORD_SETS:
        if entry.name in inputs.records:
            fetch, start, end = inputs.records[entry.name]
            made[entry.table] = load_records(spark, entry, fetch, start, end)
            current = current_records(made[entry.table], entry)
            if entry.cursor == "created_date" and inputs.centroids is not None:
                others["fact_311_complaints"] = fact_complaints(current, inputs.centroids)
            elif entry.cursor == "start_date_time":
                others["fact_event_permits"] = fact_event_permits(current)
                permits = (others["fact_event_permits"], "start_date_time")
            elif entry.cursor == "inspection_date":
                made["inspection_documents"] = inspection_documents(current)
    weather = inputs.weather
    if air := inputs.air_quality:
        others["fact_air_quality"] = fact_air_quality(air.rows, air.cursor, air.of, air.columns["value"])
    if subway := inputs.subway:
        places = {name: c for name, c in subway.columns.items() if name != "entries"}
        others["fact_subway_entries"] = fact_subway_entries(subway.rows, subway.cursor, subway.of, subway.columns["entries"])
        others["dim_subway_stations"] = dim_subway_stations(subway.rows, subway.of, places, subway.cursor)
    if readings := inputs.weather_readings:
        weather = dim_weather(readings.rows, readings.cursor, readings.columns)
    marts = build_marts(
        trips, zones, PICKED_UP, modes, weather, inputs.holidays, permits, others
    )
    return made | marts
