"""Bike job: months -> archives -> header contract -> raw table -> checks."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import contracts
from tidemark.operators.checks import blank_counts, require_rows, sample_rows
from tidemark.session import stored
from tidemark.sinks.tables import ensure_layers, replace_table
from tidemark.sources.archives import accepted, bike_archive_rows, rejects
from tidemark.sources.listing import list_files, listed_months, month_list, pick_archives
from tidemark.streaming.increments import load_increment
from tidemark.streaming.watermarks import create_store


def bike_source(rows: DataFrame) -> DataFrame:
    """Unpacked trips under the new layout's names, with typed times."""
    named = rows.select(*[F.col(f"`{old}`").alias(new) for old, new in contracts.BIKE_NEW_TO_OLD.items()])
    return named.withColumns({c: F.col(c).try_cast("timestamp_ntz") for c in ("started_at", "ended_at")})


def archives_of(
    spark: SparkSession, root: str, start: str | None = None, end: str | None = None, months: int | None = None
) -> DataFrame:
    """The archives of a range, or of the first ``months`` months; of all months when neither is given."""
    listing = list_files(spark, root, "*.zip")
    if start is None and end is None and months is None:
        return pick_archives(listing, listed_months(listing))
    wanted = month_list(spark, start, end) if months is None else month_list(spark, start, end, months)
    return pick_archives(listing, wanted)


def load_bikes(
    spark: SparkSession, root: str, start: str | None = None, end: str | None = None, months: int | None = None
) -> DataFrame:
    """Incremental load: archives of the given months (all unless given), lookback, upsert by the trip's key."""
    ensure_layers(spark)
    archives = archives_of(spark, root, start, end, months)
    return upsert_bikes(accepted(bike_archive_rows(archives)), f"raw.{contracts.BIKE_TABLE}_current", create_store(spark))


def upsert_bikes(rows: DataFrame, table: str, store: str) -> DataFrame:
    return load_increment(bike_source(rows), "citibike", table, contracts.BIKE_KEY, contracts.BIKE_CURSOR, store)


class BikeLoad(NamedTuple):
    table: DataFrame
    rejected: DataFrame
    checks: DataFrame
    sample: DataFrame


def ingest_bikes(
    spark: SparkSession, root: str, start: str | None = None, end: str | None = None, months: int | None = None
) -> BikeLoad:
    """Replace the bike table by the archives of the given months, of all unless a range or a count is given.

    The unpacked rows are written once and reused, because unpacking is the dear part.
    Without any row the old table stays.
    """
    ensure_layers(spark)
    archives = archives_of(spark, root, start, end, months)
    unpacked = stored(bike_archive_rows(archives), "bikes", ("_layout",))
    rows = require_rows(accepted(unpacked).select(*[f"`{c}`" for c in contracts.BIKE_OLD_COLUMNS]))
    table = replace_table(rows, f"raw.{contracts.BIKE_TABLE}")
    shown = ["starttime", "start station name", "end station name"]
    return BikeLoad(
        table,
        rejects(unpacked),
        blank_counts(table, contracts.BIKE_REQUIRED),
        sample_rows(table, shown, [f"`{c}`" for c in shown]),
    )
