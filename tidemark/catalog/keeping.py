"""Registered queries for dedup, upsert, routing, watermarks, slices and streams."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import contracts
from tidemark.catalog.base import (
    LINE_KEY,
    MICRO,
    SECOND,
    Query,
    micro_text,
    newest_lines_sql,
    second_text,
    table,
)
from tidemark.functions.keys import surrogate_key
from tidemark.functions.times import slice_number
from tidemark.operators.checks import key_violations
from tidemark.operators.dedup import last_per_payload, newest_per_key
from tidemark.operators.shape import before, with_constants
from tidemark.plans.bikes import upsert_bikes
from tidemark.plans.open_data import migrate_payloads
from tidemark.session import scratch_database, scratch_path, stored
from tidemark.sinks.tables import (
    append_table,
    dedup_payloads,
    replace_unique,
    route_records,
    upsert,
)
from tidemark.streaming import watermarks
from tidemark.streaming.increments import load_increment, load_slices, replace_slice, since
from tidemark.streaming.live import drop_repeats, file_stream, run_to_files, run_upserts
from tidemark.streaming.slices import date_slices as slices_of
from tidemark.streaming.slices import in_slice, slices_between

FULL_KEY = (*LINE_KEY, "l_shipdate")


def _shipped(df: DataFrame) -> DataFrame:
    return df.withColumn("l_shipdate", second_text("l_shipdate"))


def _lines_sql(inner: str) -> str:
    return f"SELECT * REPLACE (strftime(l_shipdate, {SECOND}) AS l_shipdate) FROM ({inner})"


def append_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shipped(newest_per_key(table(spark, sf_dir, "lineitem"), LINE_KEY, "l_shipdate"))


def append_then_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain append twice; the copies go when the table is read."""
    name = f"{scratch_database(spark, 'append')}.orders"
    orders = table(spark, sf_dir, "orders")
    append_table(orders, name)
    both = append_table(orders, name)
    return newest_per_key(both, ["o_orderkey"], "o_orderdate").withColumn(
        "o_orderdate", second_text("o_orderdate")
    )


def payload_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_payloads(table(spark, sf_dir, "events"), "event_id", "props")
    return kept.select("event_id", "event_type", "value", "props", "payload_hash")


def payload_dedup_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payloads spelled in six ways, one of which is NULL and one not JSON."""
    k = F.get_json_object("props", "$.k")
    way = F.col("event_id") % 6
    spelled = (
        F.when(way == 0, F.concat(F.lit('{"k": '), k, F.lit(', "s": "1.0, x"}')))
        .when(way == 1, F.concat(F.lit('{"s":"1.0, x","k":'), k, F.lit(".0}")))
        .when(way == 2, F.concat(F.lit('{"k":0,"s":"1.0, x","k":'), k, F.lit("}")))
        .when(way == 3, F.concat(F.lit('{ "s" : "1.0, x" , "k" : '), k, F.lit("e0 }")))
        .when(way == 4, F.concat(F.lit("not json "), k))
    )
    events = table(spark, sf_dir, "events").select("event_id", spelled.alias("payload"))
    return last_per_payload(events, "payload", "event_id").select("event_id")


def unique_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_violations(table(spark, sf_dir, "lineitem"), LINE_KEY)


def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(surrogate_key(*columns).alias("line_key"), "l_orderkey", "l_linenumber")


def constant_columns_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types as datasets; each record is written once and seen through its view."""
    database = scratch_database(spark, "routing")
    events = table(spark, sf_dir, "events")
    types = sorted(r[0] for r in events.select("event_type").distinct().collect())
    roster = [contracts.RecordSet(t, t, "ts", f"socrata_{t}_", ("event_id",)) for t in types]
    named = events.withColumn("_socrata_resource_id", F.col("event_type"))
    records = with_constants(named, {"_socrata_domain": contracts.OPEN_DATA_DOMAIN})
    views = route_records(records, database, roster)
    frames = [
        view.groupBy("_socrata_domain").agg(
            F.count("*").alias("row_count"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id")
        ).select(F.lit(name).alias("table_name"), F.col("_socrata_domain").alias("domain"), "row_count", "first_id", "last_id")
        for name, view in views.items()
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.union(frame)
    return result


def increment_null_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of lines of which every seventh order has no ship date; none of them is lost."""
    database = scratch_database(spark, "undated")
    store = watermarks.create_store(spark, database)
    undated = F.when(F.col("l_orderkey") % 7 != 0, F.col("l_shipdate"))
    lines = table(spark, sf_dir, "lineitem").withColumn("l_shipdate", undated)
    keys = (*LINE_KEY, "l_partkey", "l_suppkey", "l_shipdate")
    for _ in range(2):
        loaded = load_increment(lines, "lines", f"{database}.lines", keys, "l_shipdate", store)
    return loaded.groupBy("l_orderkey").agg(
        F.count("*").alias("row_count"), F.count_if(F.col("l_shipdate").isNull()).alias("undated")
    )


def watermark_future_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fiftieth event lies in the year 2084 on the first load; the second load still finds the rest."""
    database = scratch_database(spark, "future")
    store = watermarks.create_store(spark, database)
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    half = events.agg(F.max("ts")).head()[0] - timedelta(days=10)
    far = F.lit("2084-01-01 00:00:00").cast("timestamp_ntz")
    early = events.where(F.col("ts") <= half).withColumn("ts", F.when(F.col("event_id") % 50 == 0, far).otherwise(F.col("ts")))
    name = f"{database}.events"
    load_increment(early, "events", name, ("event_id", "ts"), "ts", store)
    loaded = load_increment(events.where(F.col("ts") > half), "events", name, ("event_id", "ts"), "ts", store)
    return loaded.select("event_id", micro_text("ts").alias("ts"))


def bike_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as trips of the old layout, loaded twice; the key makes each trip one row."""
    database = scratch_database(spark, "bikes")
    store = watermarks.create_store(spark, database)
    new = {
        "started_at": F.col("ts").cast("string"), "ended_at": F.col("ts").cast("string"),
        "start_station_id": F.col("user_id").cast("string"), "end_station_id": F.col("event_type"),
        "ride_id": F.col("event_id").cast("string"),
    }
    old = {o: new.get(n, F.lit(None).cast("string")) for o, n in contracts.BIKE_NEW_TO_OLD.items()}
    rows = table(spark, sf_dir, "events").select(*[c.alias(o) for o, c in old.items()])
    for _ in range(2):
        loaded = upsert_bikes(rows.unionByName(rows), f"{database}.trips", store)
    return loaded.select("ride_id", micro_text("started_at").alias("started_at"), "start_station_id", "end_station_id")


def payload_migration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties in the seven payload tables by event number, migrated twice."""
    database = scratch_database(spark, "payloads")
    events = table(spark, sf_dir, "events").select("event_id", F.col("props").alias("payload"))
    for at, name in enumerate(contracts.PAYLOAD_TABLES):
        append_table(events.where(F.pmod("event_id", F.lit(len(contracts.PAYLOAD_TABLES))) == at), f"{database}.{name}")
    for _ in range(2):
        done = migrate_payloads(spark, "event_id", database)
    frames = [df.select(F.lit(name).alias("table_name"), "event_id", "payload") for name, df in done.items()]
    return reduce(DataFrame.unionByName, frames)


def watermark_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Advance by the newest event per type, then try to move back by the oldest."""
    database = scratch_database(spark, "marks")
    store = watermarks.create_store(spark, database)
    events = table(spark, sf_dir, "events")
    watermarks.advance(spark, store, watermarks.newest_values(events, "ts", by="event_type"))
    oldest = events.groupBy("event_type").agg(F.min("ts").alias("ts"))
    watermarks.advance(spark, store, watermarks.newest_values(oldest, "ts", by="event_type"))
    return watermarks.watermarks(spark, store).select("source_name", "last_value")


def lookback_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven days before the stored watermark."""
    database = scratch_database(spark, "lookback")
    store = watermarks.create_store(spark, database)
    events = table(spark, sf_dir, "events")
    watermarks.advance(spark, store, watermarks.newest_values(events, "ts", "events"))
    fresh = since(events, "ts", watermarks.last_value(spark, store, "events"))
    return fresh.select("event_id", micro_text("ts").alias("ts"), "event_type", "value")


def date_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """90-day slices over all orders with the orders in each."""
    orders = table(spark, sf_dir, "orders")
    first = orders.agg(F.min("o_orderdate")).head()[0]
    start = F.lit(first).cast("timestamp_ntz")
    by_slice = orders.groupBy(slice_number("o_orderdate", start, 90).alias("slice_no")).agg(
        F.count("*").alias("row_count"), F.max("o_orderdate").alias("newest")
    )
    counts = stored(by_slice, "slices")
    bounds = counts.agg(start.alias("first"), F.max("newest").alias("last"))
    return slices_between(bounds, 90).join(counts, "slice_no", "left").select(
        "slice_no", second_text("slice_start").alias("slice_start"),
        second_text("slice_end").alias("slice_end"),
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
    )


def resumed_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written by 600-day slices; the first slice comes again after a crash, a second run finds nothing left."""
    database = scratch_database(spark, "slices")
    store = watermarks.create_store(spark, database)
    orders = table(spark, sf_dir, "orders")
    first, last = orders.agg(F.min("o_orderdate"), F.max("o_orderdate")).head()
    name = f"{database}.orders"

    def write(rows: DataFrame, number: int) -> None:
        replace_slice(rows, name, number)

    bounds = (first.isoformat(timespec="seconds"), last.isoformat(timespec="seconds"))
    # As if a load had died after its write and before its mark.
    (early,) = slices_of(spark, *bounds, 600).where("slice_no = 0").collect()
    write(in_slice(orders, "o_orderdate", F.lit(early["slice_start"]), F.lit(early["next_start"])), 0)
    load_slices(orders, "orders", "o_orderdate", store, *bounds, write, days=600)
    again = load_slices(orders, "orders", "o_orderdate", store, *bounds, write, days=600)
    return spark.table(name).groupBy("slice_no").agg(
        F.count("*").alias("row_count"), F.lit(again).alias("repeated")
    )


def incremental_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load all lines, then the lookback increment twice more."""
    database = scratch_database(spark, "trips")
    store = watermarks.create_store(spark, database)
    lines = table(spark, sf_dir, "lineitem")
    name = f"{database}.trips"
    for _ in range(3):
        loaded = load_increment(lines, "lines", name, FULL_KEY, "l_shipdate", store)
    return _shipped(loaded.select(*lines.columns))


def late_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second load corrects the price of every line; the first load never comes back."""
    name = f"{scratch_database(spark, 'late')}.trips"
    lines = table(spark, sf_dir, "lineitem")
    upsert(lines, name, FULL_KEY, "l_shipdate", 1)
    corrected = lines.withColumn("l_extendedprice", F.col("l_extendedprice") + 1)
    loaded = upsert(corrected, name, FULL_KEY, "l_shipdate", 2)
    return _shipped(loaded.select(*lines.columns))


LATE_PARTS = 4


def late_rows_few_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the last three days corrected late, in a table of months cut into stretches.

    For each stretch its rows, their price, and whether its files are others than before.
    """
    name = f"{scratch_database(spark, 'late')}.trips"
    lines = table(spark, sf_dir, "lineitem")
    upsert(lines, name, FULL_KEY, "l_shipdate", 1, parts=LATE_PARTS)
    place = F.col("_metadata.file_path")
    before = stored(spark.table(name).select(place.alias("path")).distinct(), "files")
    (newest,) = lines.agg(F.max("l_shipdate")).head()
    late = lines.where(F.col("l_shipdate") >= F.lit(newest - timedelta(days=3)))
    late = late.withColumn("l_extendedprice", F.col("l_extendedprice") + 1)
    upsert(late, name, FULL_KEY, "l_shipdate", 2)
    after = spark.table(name).select("load_month", "load_part", "l_extendedprice", place.alias("path"))
    known = after.join(before.withColumn("kept", F.lit(True)), "path", "left")
    return known.groupBy("load_month", "load_part").agg(
        F.count("*").alias("row_count"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("price"),
        F.bool_or(F.col("kept").isNull()).alias("rewritten"),
    )


def unique_after_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace a table by its deduplicated rows and assert the key on what was written."""
    name = f"{scratch_database(spark, 'unique')}.lines"
    kept = newest_per_key(table(spark, sf_dir, "lineitem"), LINE_KEY, "l_shipdate")
    return _shipped(replace_unique(kept, name, LINE_KEY))


def _weekly_feed(spark: SparkSession, sf_dir: str):
    """Weekly deliveries, each repeating the seven days before it."""
    events = table(spark, sf_dir, "events")
    first, last = events.agg(F.min("ts"), F.max("ts")).head()
    start = first
    while start <= last:
        end = start + timedelta(days=7)
        yield events.where(
            (F.col("ts") >= F.lit(start - timedelta(days=7))) & (F.col("ts") < F.lit(end))
        )
        start = end


def stream_dedup_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One streaming run per delivery; each event passes once."""
    root = scratch_path(spark, "stream")
    schema = table(spark, sf_dir, "events").schema
    for delivery in _weekly_feed(spark, sf_dir):
        delivery.write.mode("append").parquet(f"{root}/in")
        stream = drop_repeats(file_stream(spark, f"{root}/in", schema), ["event_id"], "ts")
        run_to_files(stream, f"{root}/out", f"{root}/state")
    out = spark.read.schema(schema).parquet(f"{root}/out")
    return out.select("event_id", micro_text("ts").alias("ts"), "event_type", "value", "props")


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same deliveries, upserted per micro-batch."""
    root = scratch_path(spark, "stream")
    schema = table(spark, sf_dir, "events").schema
    name = f"{scratch_database(spark, 'streamed')}.events"
    for delivery in _weekly_feed(spark, sf_dir):
        delivery.write.mode("append").parquet(f"{root}/in")
        run_upserts(file_stream(spark, f"{root}/in", schema), name, ("event_id", "ts"), "ts", f"{root}/state")
    return spark.table(name).select("event_id", micro_text("ts").alias("ts"), "event_type", "value", "props")


def quality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    limit = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    kept = before(table(spark, sf_dir, "orders"), "o_orderdate", limit)
    return kept.select("o_orderkey", second_text("o_orderdate").alias("ordered"), "o_totalprice")


def _marked(columns: str) -> str:
    """Each column behind the length of its text."""
    return ", ".join(f"len(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR)" for c in columns.split(", "))


_LINE_COLUMNS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus"
_EVENT_COLUMNS = f"event_id, strftime(ts, {MICRO}) AS ts, event_type, value, props"

QUERIES = {
    "append_dedup": Query(append_dedup, _lines_sql(newest_lines_sql(LINE_KEY))),
    "append_then_dedup": Query(append_then_dedup, f"""
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
               strftime(o_orderdate, {SECOND}) AS o_orderdate, o_orderpriority FROM orders
    """),
    "payload_dedup": Query(payload_dedup, """
        SELECT event_id, event_type, value, props, md5(replace(props, ' ', '')) AS payload_hash
        FROM (SELECT *, row_number() OVER (PARTITION BY props ORDER BY event_id DESC) AS rn FROM events)
        WHERE rn = 1
    """),
    "payload_dedup_canonical": Query(payload_dedup_canonical, """
        WITH e AS (SELECT event_id, event_id % 6 AS way, json_extract_string(props, '$.k') AS k FROM events)
        SELECT event_id FROM (SELECT event_id, row_number() OVER (
                   PARTITION BY way = 4, k ORDER BY event_id DESC) AS rn FROM e WHERE way <> 5) WHERE rn = 1
        UNION ALL SELECT event_id FROM e WHERE way = 5
    """),
    "unique_violations": Query(unique_violations, """
        SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
        GROUP BY 1, 2 HAVING count(*) > 1
    """),
    "surrogate_key": Query(surrogate_keys, f"""
        SELECT md5(concat_ws('|', {_marked(_LINE_COLUMNS)})) AS line_key, l_orderkey, l_linenumber FROM lineitem
    """),
    "constant_columns_routing": Query(constant_columns_routing, f"""
        SELECT 'socrata_' || event_type || '_socrata_records' AS table_name,
               '{contracts.OPEN_DATA_DOMAIN}' AS domain, count(*) AS row_count,
               min(event_id) AS first_id, max(event_id) AS last_id
        FROM events GROUP BY event_type
    """),
    "increment_null_cursor": Query(increment_null_cursor, """
        WITH l AS (SELECT l_orderkey, CASE WHEN l_orderkey % 7 <> 0 THEN l_shipdate END AS shipped,
                          l_linenumber, l_partkey, l_suppkey FROM lineitem),
        d AS (SELECT DISTINCT * FROM l)
        SELECT l_orderkey, count(*) AS row_count, count(*) FILTER (shipped IS NULL) AS undated FROM d GROUP BY 1
    """),
    "watermark_future_rows": Query(watermark_future_rows, f"""
        WITH h AS (SELECT max(ts) - INTERVAL 10 DAY AS half FROM events)
        SELECT event_id, strftime(CASE WHEN ts <= half AND event_id % 50 = 0 THEN TIMESTAMP '2084-01-01' ELSE ts END,
                                  {MICRO}) AS ts FROM events, h
    """),
    "bike_upsert": Query(bike_upsert, f"""
        SELECT CAST(event_id AS VARCHAR) AS ride_id, strftime(ts, {MICRO}) AS started_at,
               CAST(user_id AS VARCHAR) AS start_station_id, event_type AS end_station_id FROM events
    """),
    "payload_migration": Query(payload_migration, "SELECT table_name, event_id, payload FROM ("
        "SELECT ['" + "', '".join(contracts.PAYLOAD_TABLES) + "'][event_id % 7 + 1] AS table_name, event_id, props AS payload, "
        "row_number() OVER (PARTITION BY event_id % 7, props ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1"
    ),
    "watermark_upsert": Query(watermark_upsert, """
        SELECT event_type AS source_name, strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS last_value
        FROM events GROUP BY 1
    """),
    "lookback_increment": Query(lookback_increment, f"""
        SELECT event_id, strftime(ts, {MICRO}) AS ts, event_type, value FROM events
        WHERE ts >= (SELECT date_trunc('second', max(ts)) - INTERVAL 7 DAY FROM events)
    """),
    "date_slices": Query(date_slices, f"""
        WITH b AS (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders),
        s AS (SELECT unnest(generate_series(lo, hi, INTERVAL 90 DAY)) AS st, lo, hi FROM b),
        n AS (SELECT CAST(date_diff('day', lo, st) // 90 AS INTEGER) AS slice_no, st,
                     least(st + INTERVAL 90 DAY - INTERVAL 1 SECOND, hi) AS en FROM s)
        SELECT slice_no, strftime(st, {SECOND}) AS slice_start, strftime(en, {SECOND}) AS slice_end,
               (SELECT count(*) FROM orders WHERE o_orderdate >= st AND o_orderdate <= en) AS row_count
        FROM n
    """),
    "resumed_slices": Query(resumed_slices, """
        SELECT CAST(date_diff('day', (SELECT min(o_orderdate) FROM orders), o_orderdate) // 600 AS INTEGER) AS slice_no,
               count(*) AS row_count, 0 AS repeated FROM orders GROUP BY 1
    """),
    "incremental_idempotent": Query(incremental_idempotent, _lines_sql(newest_lines_sql(FULL_KEY))),
    "late_correction": Query(
        late_correction,
        f"SELECT * REPLACE (l_extendedprice + 1 AS l_extendedprice) FROM ({_lines_sql(newest_lines_sql(FULL_KEY))})",
    ),
    "late_rows_few_files": Query(late_rows_few_files, f"""
        WITH l AS (SELECT l_shipdate, l_extendedprice FROM ({newest_lines_sql(FULL_KEY)})),
        m AS (SELECT max(l_shipdate) - INTERVAL 3 DAY AS late FROM l),
        s AS (SELECT l.*, l_shipdate >= late AS is_late, strftime(l_shipdate, '%Y%m') AS load_month,
                     CAST(date_diff('second', date_trunc('month', l_shipdate), l_shipdate) * {LATE_PARTS}
                          // date_diff('second', date_trunc('month', l_shipdate), date_trunc('month', l_shipdate) + INTERVAL 1 MONTH)
                          AS INTEGER) AS load_part FROM l, m)
        SELECT load_month, load_part, count(*) AS row_count,
               CAST(sum(CAST(l_extendedprice + CASE WHEN is_late THEN 1 ELSE 0 END AS DECIMAL(18,2))) AS DOUBLE) AS price,
               bool_or(is_late) AS rewritten FROM s GROUP BY 1, 2
    """),
    "unique_after_dedup": Query(unique_after_dedup, _lines_sql(newest_lines_sql(LINE_KEY))),
    "stream_dedup_late": Query(stream_dedup_late, f"SELECT {_EVENT_COLUMNS} FROM events"),
    "stream_upsert": Query(stream_upsert, f"SELECT {_EVENT_COLUMNS} FROM events"),
    "quality_filter": Query(quality_filter, f"""
        SELECT o_orderkey, strftime(o_orderdate, {SECOND}) AS ordered, o_totalprice
        FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
    """),
}
