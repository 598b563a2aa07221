"""Zone job: CSV -> raw table -> staging view -> dimension table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark import contracts
from tidemark.functions.names import rename_all, snake_name
from tidemark.operators.shape import project, required
from tidemark.sinks.tables import ensure_layers, materialize, replace_table
from tidemark.sources.files import csv_text

STAGED = {
    "location_id": "location_id",
    "borough": "borough",
    "zone_name": "zone",
    "service_zone": "service_zone",
}


def stage_zones(raw: DataFrame) -> DataFrame:
    return project(raw, STAGED)


def zone_dimension(staged: DataFrame) -> DataFrame:
    """Zones with an id. Empty text is an id here, as it is in the source."""
    return required(staged.select(*STAGED), "location_id")


def build_zones(spark: SparkSession, csv_path: str) -> DataFrame:
    ensure_layers(spark)
    landed = rename_all(csv_text(spark, csv_path), snake_name)
    raw = replace_table(landed, f"raw.{contracts.ZONE_TABLE}", guard=True)
    staged = materialize(stage_zones(raw), "stg_nyc_taxi_zones", "view")
    return materialize(zone_dimension(staged), "marts.dim_nyc_taxi_zones", "table")
