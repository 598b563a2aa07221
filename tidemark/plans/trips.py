"""Trip jobs: full ingest of listed files, and the incremental load."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tidemark import contracts
from tidemark.functions.names import lower_name, rename_all
from tidemark.functions.text import blank_to_null
from tidemark.operators.checks import load_report
from tidemark.sinks.tables import ensure_layers, replace_table
from tidemark.sources.files import (
    head_per_file,
    partitioned_scan,
    struct_from_json_schema,
    union_files,
)
from tidemark.sources.listing import capped_listing, list_prefixes, paths_of
from tidemark.streaming import watermarks
from tidemark.streaming.increments import load_increment


def ingest_trips(
    spark: SparkSession, root: str, prefixes: Mapping[str, list[str]], limit: int | None = None,
    head_rows: int = 0, head_order: tuple[str, ...] = (), layer: str = "raw",
) -> DataFrame:
    """Replace each stream's raw table by its files, or the first ``limit`` of them; rows per stream.

    A stream without files is reported with 0 and its table stays as it was.
    """
    ensure_layers(spark, [layer])
    loaded: dict[str, DataFrame | None] = {}
    for name, wanted in prefixes.items():
        paths = paths_of(capped_listing(list_prefixes(spark, root, wanted), wanted, limit))
        if not paths:
            loaded[name] = None
            continue
        rows = union_files(spark, paths, base_path=root)
        if head_rows:
            rows = head_per_file(rows, head_order, head_rows)
        landed = blank_to_null(rename_all(rows, lower_name))
        loaded[name] = replace_table(landed, f"{layer}.{contracts.TRIP_STREAMS[name].table}")
    return load_report(loaded)


def trip_source(spark: SparkSession, root: str, stream: contracts.TripStream) -> DataFrame:
    """All files of a stream under its specified schema, lower-case names."""
    schema = struct_from_json_schema(stream.json_schema).add("puYear", "integer").add("puMonth", "integer")
    return rename_all(partitioned_scan(spark, root, stream.glob, schema), lower_name)


def load_trips(spark: SparkSession, root: str, stream: contracts.TripStream) -> DataFrame:
    """Incremental load of one stream: watermark, 7-day lookback, upsert by natural key.

    The source folders are pickup months, so folders before the lookback are not opened.
    """
    ensure_layers(spark)
    store = watermarks.create_store(spark)
    return load_increment(
        trip_source(spark, root, stream), stream.name, f"raw.{stream.table}",
        stream.key, stream.cursor, store, months=("puyear", "pumonth"),
    )
