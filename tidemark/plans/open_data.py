"""Open-data job: slices -> pages -> constants -> routed tables -> one row per payload."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import contracts
from tidemark.functions.times import parse_iso
from tidemark.operators.dedup import newest_per_key
from tidemark.operators.shape import parse_records, stage_json, with_constants
from tidemark.session import exists, remove, shared_root, stored
from tidemark.sinks.tables import dedup_payloads, ensure_layers, load_number, replace_unique, route_records
from tidemark.sources.files import relation
from tidemark.sources.paged_json import SCHEMA as PAGES
from tidemark.sources.paged_json import Fetch, read_pages
from tidemark.streaming import watermarks
from tidemark.streaming.extract import pull_slices, replace_slices
from tidemark.streaming.slices import date_slices, slice_list


def extract_records(
    spark: SparkSession, entry: contracts.RecordSet, fetch: Fetch, start: str,
    end: str | None = None, page_size: int = contracts.PAGE_SIZE, days: int = contracts.SLICE_DAYS,
) -> DataFrame:
    """Read one dataset's range and mark every record with where it came from."""
    pages = read_pages(spark, fetch, slice_list(date_slices(spark, start, end, days)), page_size)
    return _marked(pages, entry)


def _marked(pages: DataFrame, entry: contracts.RecordSet) -> DataFrame:
    marked = with_constants(
        pages, {"_socrata_resource_id": entry.resource_id, "_socrata_domain": entry.domain}
    )
    return parse_records(marked, "payload")


def load_records(
    spark: SparkSession, entry: contracts.RecordSet, fetch: Fetch, start: str,
    end: str | None = None, page_size: int = contracts.PAGE_SIZE, days: int = contracts.SLICE_DAYS,
    state: str | None = None, layer: str = "raw",
) -> DataFrame:
    """Append the records since the watermark (less the lookback), then move it.

    The slices are pulled as a stream whose progress lies in ``state``, by default a folder
    for the dataset and the range's start below the shared folder. A load that died is taken up
    there by the next one: finished slices and landed pages are not fetched again, and
    records that are in the table already are not appended again.
    """
    ensure_layers(spark, [layer])
    store = watermarks.create_store(spark, layer)
    mark = watermarks.last_value(spark, store, entry.name)
    if mark is not None:
        again = datetime.fromisoformat(mark) - timedelta(days=contracts.LOOKBACK_DAYS)
        start = max(start, again.isoformat(timespec="seconds"))
    state = state or f"{shared_root(spark)}/extract-{layer}-{entry.table}-{quote(start, safe='')}"
    number = _number_of(spark, state)
    if not _appended(spark, f"{layer}.{entry.table}", number):
        slices = slice_list(date_slices(spark, start, end, days))
        pull_slices(spark, fetch, slices, state, lambda batch: replace_slices(batch, f"{state}/records"), page_size)
        found = f"{state}/records"
        pages = spark.read.schema(PAGES).parquet(found) if exists(spark, found) else spark.createDataFrame([], PAGES)
        records = _marked(pages, entry).drop("_rest").withColumn("_load_seq", F.lit(number).cast("bigint"))
        route_records(records, layer)
    loaded = spark.table(f"{layer}.{entry.table}")
    fresh = loaded.where(F.col("_load_seq") == number)
    moments = fresh.select(parse_iso(F.left(entry.cursor, F.lit(19))).alias("at"))
    # A date from after the load would end all later ones.
    moments = moments.where(F.col("at") <= F.current_timestamp().cast("timestamp_ntz"))
    watermarks.advance(spark, store, watermarks.newest_values(moments, "at", entry.name))
    remove(spark, state)
    return loaded


def _number_of(spark: SparkSession, state: str) -> int:
    """The load's number, which it keeps when it is taken up again."""
    spark.createDataFrame([(load_number(),)], "number bigint").coalesce(1).write.mode("ignore").parquet(f"{state}/number")
    return spark.read.schema("number bigint").parquet(f"{state}/number").head()["number"]


def _appended(spark: SparkSession, table: str, number: int) -> bool:
    return spark.catalog.tableExists(table) and not spark.table(table).where(F.col("_load_seq") == number).isEmpty()


def current_records(loaded: DataFrame, entry: contracts.RecordSet) -> DataFrame:
    """One row per record: by the dataset's key, or by the whole payload without one."""
    if entry.key:
        return newest_per_key(loaded, entry.key, entry.cursor, "_load_seq")
    return dedup_payloads(loaded, "_load_seq")


def migrate_payloads(
    spark: SparkSession, sequence: str, layer: str = "raw", tables: Sequence[str] = contracts.PAYLOAD_TABLES
) -> dict[str, DataFrame]:
    """Give each payload table its hash and one row per payload, and check that the hash is unique.

    Tables that do not exist are left out; doing it again changes nothing.
    """
    done = {}
    for name in tables:
        if spark.catalog.tableExists(f"{layer}.{name}"):
            rows = relation(spark, name, layer)
            kept = stored(dedup_payloads(rows.drop("payload_hash"), sequence), "payloads")
            done[name] = replace_unique(kept, f"{layer}.{name}", ["payload_hash"])
    return done


def typed_records(records: DataFrame, types: dict[str, str]) -> DataFrame:
    """Staging view: the needed fields, cleaned and typed."""
    return stage_json(records.select("payload"), "payload", types).drop("payload")
