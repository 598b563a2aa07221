"""Registered queries for joins and marts."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.base import (
    DAY,
    LINE_KEY,
    SECOND,
    TRIPS_SQL,
    ZONES_SQL,
    Query,
    day_text,
    double,
    newest_lines_sql,
    second_text,
    table,
    trips,
    zones,
)
from tidemark.operators.dedup import newest_per_key
from tidemark.operators.joins import EARTH_KM, attach_zones, nearest_zone
from tidemark.operators.marts import (
    borough_flow,
    daily_fact,
    date_dimension,
    documents,
    modal_daily,
    money,
    station_dimension,
    zone_flow,
)
from tidemark.operators.shape import bikes_to_old_layout
from tidemark.plans.marts import (
    bike_stations,
    dim_holidays,
    dim_subway_stations,
    dim_weather,
    fact_air_quality,
    fact_bike_trips,
    fact_complaints,
    fact_event_permits,
    fact_subway_entries,
    update_marts,
)
from tidemark.session import scratch_database, stored
from tidemark.sinks.tables import LOAD_SEQ, upsert

PART_SIZE = 500


def trip_zone_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = attach_zones(trips(spark, sf_dir), zones(spark, sf_dir))
    return joined.select(
        "l_orderkey", "l_linenumber", "l_partkey", second_text("l_shipdate").alias("picked_up"),
        "pickup_zone", "pickup_borough", "dropoff_zone", "dropoff_borough",
    )


def _spot(df: DataFrame, key: str, lat: Column, lon: Column, name: str) -> DataFrame:
    return df.select(F.col(key).alias(name), lat.alias("lat"), lon.alias("lon"))


def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as stations, suppliers as zone centroids, places made from their keys."""
    c, s = F.col("c_custkey"), F.col("s_suppkey")
    stations = _spot(
        table(spark, sf_dir, "customer"), "c_custkey",
        40.5 + (c * 7919 % 4001) / 10000.0, F.when(c % 50 != 0, -74.25 + (c * 104729 % 5003) / 10000.0), "station_id",
    )
    centroids = _spot(
        table(spark, sf_dir, "supplier"), "s_suppkey",
        40.5 + (s * 6007 % 3989) / 10000.0, -74.25 + (s * 3571 % 4999) / 10000.0, "location_id",
    )
    return nearest_zone(stations, centroids).select(
        "station_id", F.coalesce("zone_id", F.lit(-1)).alias("zone_id"),
        F.round(F.coalesce("distance_km", F.lit(-1.0)), 3).alias("distance_km"),
    )


_NEAREST_SQL = f"""
    WITH st AS (SELECT c_custkey AS station_id, 40.5 + (c_custkey * 7919 % 4001) / 10000.0::DOUBLE AS lat,
                       CASE WHEN c_custkey % 50 <> 0 THEN -74.25 + (c_custkey * 104729 % 5003) / 10000.0::DOUBLE END AS lon
                FROM customer),
    z AS (SELECT s_suppkey AS zone_id, 40.5 + (s_suppkey * 6007 % 3989) / 10000.0::DOUBLE AS zlat,
                 -74.25 + (s_suppkey * 3571 % 4999) / 10000.0::DOUBLE AS zlon FROM supplier),
    d AS (SELECT station_id, zone_id, round({2 * EARTH_KM} * asin(sqrt(least(1.0::DOUBLE,
              pow(sin(radians(zlat - lat) / 2), 2)
              + cos(radians(lat)) * cos(radians(zlat)) * pow(sin(radians(zlon - lon) / 2), 2)))), 9) AS km
          FROM st, z WHERE lon IS NOT NULL),
    r AS (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY km, zone_id) AS rn FROM d)
    SELECT st.station_id, coalesce(zone_id, -1) AS zone_id, round(coalesce(km, -1.0::DOUBLE), 3) AS distance_km
    FROM st LEFT JOIN r ON st.station_id = r.station_id AND rn = 1
"""


def flow_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_flow(trips(spark, sf_dir), zones(spark, sf_dir))


def flow_borough(spark: SparkSession, sf_dir: str) -> DataFrame:
    return borough_flow(flow_zone(spark, sf_dir))


def _centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        n.alias("location_id"), (40.5 + (n * 37 % 29) / 50.0).alias("lat"), (-74.25 + (n * 53 % 31) / 50.0).alias("lon")
    )


_CENTROIDS_SQL = """
    SELECT n_nationkey AS zone, 40.5 + (n_nationkey * 37 % 29) / 50.0::DOUBLE AS zlat,
           -74.25 + (n_nationkey * 53 % 31) / 50.0::DOUBLE AS zlon FROM nation
"""


def _bikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as bike trips under the old column names, all text."""
    user = F.col("user_id")
    new = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("ride_id"),
        second_text("ts").alias("started_at"),
        second_text(F.col("ts") + F.expr("INTERVAL 10 MINUTES")).alias("ended_at"),
        user.cast("string").alias("start_station_id"),
        F.concat(F.lit("Station "), user).alias("start_station_name"),
        (40.5 + user / 400.0).cast("string").alias("start_lat"),
        (-74.25 + user / 300.0).cast("string").alias("start_lng"),
        F.col("event_type").alias("member_casual"),
    )
    return bikes_to_old_layout(new)


def bike_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = fact_bike_trips(_bikes(spark, sf_dir))
    return fact.withColumns({c: second_text(c) for c in ("started_at", "ended_at")}).na.fill("none", ["end_station_id"])


def station_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bike stations with the zone they lie in."""
    return bike_stations(_bikes(spark, sf_dir), _centroids(spark, sf_dir)).select(
        "station_id", "station_name", F.col("location_id").cast("int").alias("location_id")
    )


def complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as requests in JSON, by day, type and nearest zone."""
    user = F.col("user_id")
    payload = F.to_json(
        F.struct(
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("created_date"),
            F.col("event_type").alias("complaint_type"),
            (40.5 + user / 400.0).cast("string").alias("latitude"),
            (-74.25 + user / 300.0).cast("string").alias("longitude"),
        )
    )
    records = table(spark, sf_dir, "events").select(payload.alias("payload"))
    fact = fact_complaints(records, _centroids(spark, sf_dir))
    return fact.withColumns({"day": day_text("day"), "location_id": F.col("location_id").cast("int")})


_USER_ZONE_SQL = f"""
    SELECT user_id, zone FROM (
        SELECT user_id, zone, row_number() OVER (PARTITION BY user_id ORDER BY
            round({2 * EARTH_KM} * asin(sqrt(least(1.0::DOUBLE,
                pow(sin(radians(zlat - (40.5 + user_id / 400.0::DOUBLE)) / 2), 2)
                + cos(radians(40.5 + user_id / 400.0::DOUBLE)) * cos(radians(zlat))
                  * pow(sin(radians(zlon - (-74.25 + user_id / 300.0::DOUBLE)) / 2), 2)))), 9), zone) AS rn
        FROM (SELECT DISTINCT user_id FROM events), ({_CENTROIDS_SQL})) WHERE rn = 1
"""


def permits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as permits in JSON, each lasting as many hours as its status is worth."""
    hours = F.when(F.col("o_orderstatus") == "F", 2.5).otherwise(8)
    end = F.timestamp_add("MINUTE", (hours * 60).cast("int"), F.col("o_orderdate"))
    payload = F.to_json(
        F.struct(
            F.col("o_orderkey").cast("string").alias("event_id"), F.lit("").alias("event_name"),
            F.col("o_orderpriority").alias("event_type"),
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("start_date_time"),
            F.date_format(end, "yyyy-MM-dd'T'HH:mm:ss").alias("end_date_time"),
        )
    )
    fact = fact_event_permits(table(spark, sf_dir, "orders").select(payload.alias("payload")))
    return fact.withColumns(
        {c: second_text(c) for c in ("start_date_time", "end_date_time")}
    ).na.fill("none", ["event_name"])


def air_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thousandths of a discount as readings of a parameter named by the return flag: finer than a cent."""
    lines = table(spark, sf_dir, "lineitem").withColumn("reading", F.col("l_discount") / 1000)
    return _fine(fact_air_quality(lines, "l_shipdate", "l_returnflag", "reading"), "value")


def subway(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers as entries per supplier and day."""
    return fact_subway_entries(table(spark, sf_dir, "lineitem"), "l_shipdate", "l_suppkey", "l_linenumber").withColumn(
        "day", day_text("day")
    )


def subway_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as stations, with the part and the line number of their newest lines."""
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "at", F.struct("l_shipdate", "l_orderkey", "l_linenumber")
    )
    return dim_subway_stations(lines, "l_suppkey", {"part": "l_partkey", "line": "l_linenumber"}, "at")


def weather_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("value", F.col("value") / 1000)
    days = dim_weather(events, "ts", {"value": "value"})
    return _fine(days, "value")


def holiday_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days with urgent or high orders, both names listed when both occur."""
    named = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.col("o_orderpriority"))
    orders = table(spark, sf_dir, "orders").withColumn("name", named)
    return dim_holidays(orders, "o_orderdate", "name").withColumn("day", day_text("day"))


_ENDS_SQL = f"""
    FROM ({TRIPS_SQL.format(lines="{lines}")}) t
    JOIN ({ZONES_SQL}) p ON t.pu = p.n_nationkey JOIN ({ZONES_SQL}) q ON t.do_ = q.n_nationkey
"""


def fact_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = daily_fact(table(spark, sf_dir, "events"), "ts", ["event_type"], {"value": money(F.col("value"))})
    return _plain(fact, "value")


def fact_trips_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per ship date and part of the price."""
    lines = table(spark, sf_dir, "lineitem")
    return _plain(daily_fact(lines, "l_shipdate", (), {"price": money(F.col("l_extendedprice"))}), "price")


def _plain(fact: DataFrame, measure: str) -> DataFrame:
    kinds = {f"{measure}_{k}": double(f"{measure}_{k}") for k in ("sum", "avg", "min", "max")}
    return fact.withColumns({"day": day_text("day"), **kinds})


def _fine(fact: DataFrame, measure: str) -> DataFrame:
    named = [c for c in fact.columns if c.startswith(f"{measure}_")]
    return fact.withColumns({"day": day_text("day"), **{c: F.round(double(c), 9) for c in named}})


def _fine_sql(source: str, cursor: str, by: str, value: str, name: str) -> str:
    """As ``_daily_sql``, without a cast of the values."""
    kinds = ", ".join(f"round({k}({value}), 9) AS {name}_{k}" for k in ("sum", "avg", "min", "max"))
    return f"SELECT strftime({cursor}, {DAY}) AS day, {by} count(*) AS row_count, {kinds} FROM {source} GROUP BY ALL"


def _daily_sql(source: str, cursor: str, by: str, value: str, name: str) -> str:
    v = f"CAST({value} AS DECIMAL(18,2))"
    # The average in millionths, rounded half up, from whole cents.
    average = f"(2 * CAST(sum({v}) * 100 AS HUGEINT) * 10000 + count(*)) // (2 * count(*))"
    return f"""
        SELECT strftime({cursor}, {DAY}) AS day, {by} count(*) AS row_count,
               CAST(sum({v}) AS DOUBLE) AS {name}_sum,
               CAST({average} AS DOUBLE) / 1000000.0::DOUBLE AS {name}_avg,
               CAST(min({v}) AS DOUBLE) AS {name}_min, CAST(max({v}) AS DOUBLE) AS {name}_max
        FROM {source} GROUP BY ALL
    """


def modal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, lines and page views by day; mean event value as weather, errors as events."""
    events = table(spark, sf_dir, "events")
    modes = {
        "orders": daily_fact(table(spark, sf_dir, "orders"), "o_orderdate"),
        "lines": daily_fact(table(spark, sf_dir, "lineitem"), "l_shipdate"),
        "views": daily_fact(events.where(F.col("event_type") == "view"), "ts"),
    }
    weather = events.groupBy(F.to_date("ts").alias("day")).agg(
        double(F.sum(F.col("value").cast("decimal(18,2)"))).alias("reading")
    )
    # The days on which an urgent order was placed stand in for holidays.
    urgent = F.col("o_orderpriority") == "1-URGENT"
    holidays = (
        table(spark, sf_dir, "orders").where(urgent).groupBy(F.to_date("o_orderdate").alias("day"))
        .agg(F.max("o_orderpriority").alias("holiday"))
    )
    permits = daily_fact(events.where(F.col("event_type") == "error"), "ts")
    daily = modal_daily(modes, weather, holidays, permits)
    return daily.select(
        day_text("day").alias("day"), "year", "quarter", "month", "day_of_month", "day_of_week", "is_weekend",
        "orders_count", "lines_count", "views_count", "event_count", "all_modes_count",
        F.coalesce("reading", F.lit(-1.0)).alias("reading"), "is_holiday",
    )


_MODAL_SQL = f"""
    WITH o AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n,
                      count(*) FILTER (o_orderpriority = '1-URGENT') AS u FROM orders GROUP BY 1),
    l AS (SELECT CAST(l_shipdate AS DATE) AS d, count(*) AS n FROM lineitem GROUP BY 1),
    e AS (SELECT CAST(ts AS DATE) AS d, count(*) FILTER (event_type = 'view') AS v,
                 count(*) FILTER (event_type = 'error') AS er,
                 CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS reading FROM events GROUP BY 1),
    every AS (SELECT d FROM o UNION ALL SELECT d FROM l UNION ALL SELECT d FROM e WHERE v > 0 OR er > 0),
    span AS (SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d FROM every)
    SELECT strftime(span.d, {DAY}) AS day, CAST(year(span.d) AS INTEGER) AS year,
           CAST(quarter(span.d) AS INTEGER) AS quarter, CAST(month(span.d) AS INTEGER) AS month,
           CAST(day(span.d) AS INTEGER) AS day_of_month, CAST(dayofweek(span.d) + 1 AS INTEGER) AS day_of_week,
           dayofweek(span.d) IN (0, 6) AS is_weekend,
           coalesce(o.n, 0) AS orders_count, coalesce(l.n, 0) AS lines_count, coalesce(v, 0) AS views_count,
           coalesce(er, 0) AS event_count, coalesce(o.n, 0) + coalesce(l.n, 0) + coalesce(v, 0) AS all_modes_count,
           coalesce(reading, -1.0::DOUBLE) AS reading, coalesce(u, 0) > 0 AS is_holiday
    FROM span LEFT JOIN o ON span.d = o.d LEFT JOIN l ON span.d = l.d LEFT JOIN e ON span.d = e.d
"""


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = table(spark, sf_dir, "orders").agg(
        F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last")
    )
    return date_dimension(span).withColumn("day", day_text("day"))


def dim_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as stations, with the type and payload of their newest event."""
    events = table(spark, sf_dir, "events").withColumn("newest_at", F.struct("ts", "event_id"))
    return station_dimension(
        events, "user_id", {"kind": "event_type", "payload": "props", "last_event": "event_id"}, "newest_at"
    )


def group_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders nested by customer and day; the array is shown as text."""
    nested = documents(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderdate"], ["o_orderkey", "o_orderstatus"], "orders", PART_SIZE)
    shown = F.array_join(F.transform("orders", lambda x: F.concat_ws(":", x["o_orderkey"].cast("string"), x["o_orderstatus"])), ",")
    return nested.select(
        F.concat_ws("|", F.col("o_custkey").cast("string"), second_text("o_orderdate")).alias("document_key"),
        "part", F.size("orders").alias("n"), shown.alias("orders"),
    )


def group_documents_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events nested by type; every type is too large for one document and is cut."""
    nested = documents(table(spark, sf_dir, "events"), ["event_type"], ["event_id", "user_id"], "events", PART_SIZE)
    shown = F.array_join(F.transform("events", lambda x: F.concat_ws(":", x["event_id"].cast("string"), x["user_id"].cast("string"))), ",")
    return nested.select("event_type", "part", F.size("events").alias("n"), shown.alias("events"))


def medallion_flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest row per trip -> zones at both ends -> borough flow."""
    kept = newest_per_key(table(spark, sf_dir, "lineitem"), LINE_KEY, "l_shipdate")
    return borough_flow(zone_flow(trips(spark, sf_dir, kept), zones(spark, sf_dir)))


FULL_KEY = (*LINE_KEY, "l_shipdate")


def marts_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip marts after a late correction turns the trips of the last three days around and raises their price.

    Rows of the zone flow and of the daily fact, and for each month whether the update made it anew.
    """
    database = scratch_database(spark, "marts")
    name = f"{database}.trips"
    # Dealt out by order once, for the newest lines, the join with orders and the first load.
    lines = newest_per_key(table(spark, sf_dir, "lineitem").repartition("l_orderkey"), FULL_KEY, "l_shipdate")

    def update() -> dict[str, DataFrame]:
        price = {"price": money(F.col("l_extendedprice"))}
        return update_marts(spark, name, zones(spark, sf_dir), "l_shipdate", database, None, price)

    all_trips = upsert(trips(spark, sf_dir, lines), name, FULL_KEY, "l_shipdate", 1).drop(LOAD_SEQ, "load_month")
    place = F.col("_metadata.file_path")
    before = stored(update()["trip_totals"].select(place.alias("path")).distinct(), "files")
    (newest,) = all_trips.agg(F.max("l_shipdate")).head()
    late = all_trips.where(F.col("l_shipdate") >= F.lit(newest - timedelta(days=3))).withColumns({
        "l_extendedprice": F.col("l_extendedprice") + 1,
        "pulocationid": F.col("dolocationid"), "dolocationid": F.col("pulocationid"),
    })
    upsert(late, name, FULL_KEY, "l_shipdate", 2)
    marts = update()
    none = F.lit(0.0)
    flow = marts["agg_flow_zone"].select(
        F.lit("flow").alias("mart"), F.concat_ws(" > ", "pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone").alias("name"),
        "trips", none.alias("price"), none.alias("mean"), F.lit(False).alias("remade"),
    )
    daily = marts["fact_trips_daily"].select(
        F.lit("daily"), day_text("day"), "row_count", double("price_sum"), double("price_avg"), F.lit(False)
    )
    paths = marts["trip_totals"].select("load_month", "row_count", place.alias("path"))
    known = paths.join(before.withColumn("kept", F.lit(True)), "path", "left")
    months = known.groupBy("load_month").agg(F.sum("row_count").alias("n"), F.bool_or(F.col("kept").isNull()).alias("remade"))
    return flow.union(daily).union(months.select(F.lit("month"), "load_month", "n", none, none, "remade"))


_MARTS_SQL = f"""
    WITH t AS ({TRIPS_SQL.format(lines="(" + newest_lines_sql(FULL_KEY) + ")")}),
    m AS (SELECT max(l_shipdate) - INTERVAL 3 DAY AS late FROM t),
    c AS (SELECT l_shipdate, l_shipdate >= late AS is_late, CASE WHEN l_shipdate >= late THEN do_ ELSE pu END AS pu,
                 CASE WHEN l_shipdate >= late THEN pu ELSE do_ END AS do_,
                 CAST(l_extendedprice + CASE WHEN l_shipdate >= late THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS price FROM t, m)
    SELECT 'flow' AS mart, concat_ws(' > ', p.r_name, p.n_name, q.r_name, q.n_name) AS name, count(*) AS trips,
           0.0::DOUBLE AS price, 0.0::DOUBLE AS mean, false AS remade
    FROM c LEFT JOIN ({ZONES_SQL}) p ON c.pu = p.n_nationkey LEFT JOIN ({ZONES_SQL}) q ON c.do_ = q.n_nationkey GROUP BY 2
    UNION ALL SELECT 'daily', strftime(l_shipdate, {DAY}), count(*), CAST(sum(price) AS DOUBLE),
           CAST((2 * CAST(sum(price) * 100 AS HUGEINT) * 10000 + count(*)) // (2 * count(*)) AS DOUBLE) / 1000000.0::DOUBLE, false
           FROM c GROUP BY 2
    UNION ALL SELECT 'month', strftime(l_shipdate, '%Y%m'), count(*), 0.0, 0.0, bool_or(is_late) FROM c GROUP BY 2
"""


QUERIES = {
    "trip_zone_join": Query(trip_zone_join, f"""
        SELECT l_orderkey, l_linenumber, l_partkey, strftime(l_shipdate, {SECOND}) AS picked_up,
               p.n_name AS pickup_zone, p.r_name AS pickup_borough, q.n_name AS dropoff_zone, q.r_name AS dropoff_borough
        {_ENDS_SQL.format(lines="lineitem")}
    """),
    "nearest_zone": Query(nearest, _NEAREST_SQL),
    "flow_zone": Query(flow_zone, f"""
        SELECT p.r_name AS pickup_borough, p.n_name AS pickup_zone, q.r_name AS dropoff_borough,
               q.n_name AS dropoff_zone, count(*) AS trips {_ENDS_SQL.format(lines="lineitem")} GROUP BY ALL
    """),
    "flow_borough": Query(flow_borough, f"""
        SELECT p.r_name AS pickup_borough, q.r_name AS dropoff_borough, count(*) AS trips
        {_ENDS_SQL.format(lines="lineitem")} GROUP BY ALL
    """),
    "fact_daily": Query(fact_daily, _daily_sql("events", "ts", "event_type,", "value", "value")),
    "fact_trips_daily": Query(fact_trips_daily, _daily_sql("lineitem", "l_shipdate", "", "l_extendedprice", "price")),
    "modal_daily": Query(modal, _MODAL_SQL),
    "dim_date": Query(dim_date, f"""
        WITH s AS (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d FROM orders)
        SELECT strftime(d, {DAY}) AS day, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
               CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day_of_month,
               CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend FROM s
    """),
    "dim_stations": Query(dim_stations, """
        SELECT user_id AS station_id, event_type AS kind, props AS payload, event_id AS last_event
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
        WHERE rn = 1
    """),
    "fact_bike_trips": Query(bike_trips, f"""
        SELECT CAST(event_id AS VARCHAR) AS bike_id, strftime(ts, {SECOND}) AS started_at,
               strftime(ts + INTERVAL 10 MINUTE, {SECOND}) AS ended_at, 600 AS duration_seconds,
               CAST(user_id AS VARCHAR) AS start_station_id, 'none' AS end_station_id, event_type AS user_type
        FROM events
    """),
    "dim_bike_stations": Query(station_map, f"""
        SELECT CAST(user_id AS VARCHAR) AS station_id, 'Station ' || user_id AS station_name, zone AS location_id
        FROM ({_USER_ZONE_SQL})
    """),
    "fact_complaints": Query(complaints, f"""
        SELECT strftime(ts, {DAY}) AS day, event_type AS complaint_type, zone AS location_id, count(*) AS row_count
        FROM events JOIN ({_USER_ZONE_SQL}) USING (user_id) GROUP BY ALL
    """),
    "fact_event_permits": Query(permits, f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS event_id, 'none' AS event_name, o_orderpriority AS event_type,
               strftime(o_orderdate, {SECOND}) AS start_date_time,
               strftime(o_orderdate + CASE WHEN o_orderstatus = 'F' THEN INTERVAL 150 MINUTE ELSE INTERVAL 480 MINUTE END,
                        {SECOND}) AS end_date_time,
               CASE WHEN o_orderstatus = 'F' THEN 2.5::DOUBLE ELSE 8.0::DOUBLE END AS duration_hours
        FROM orders
    """),
    "fact_air_quality": Query(
        air_quality, _fine_sql("lineitem", "l_shipdate", "l_returnflag,", "l_discount / 1000", "value")
    ),
    "fact_subway_entries": Query(subway, f"""
        SELECT strftime(l_shipdate, {DAY}) AS day, l_suppkey, CAST(sum(l_linenumber) AS BIGINT) AS entries
        FROM lineitem GROUP BY ALL
    """),
    "dim_subway_stations": Query(subway_stations, """
        SELECT l_suppkey AS station_id, l_partkey AS part, l_linenumber AS line FROM (
            SELECT *, row_number() OVER (PARTITION BY l_suppkey
                   ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC) AS rn FROM lineitem)
        WHERE rn = 1
    """),
    "dim_weather": Query(weather_days, f"""
        SELECT day, value_avg, value_min, value_max FROM ({_fine_sql("events", "ts", "", "value / 1000", "value")})
    """),
    "dim_holidays": Query(holiday_days, f"""
        SELECT strftime(o_orderdate, {DAY}) AS day,
               string_agg(DISTINCT o_orderpriority, '; ' ORDER BY o_orderpriority) AS holiday
        FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 1
    """),
    "group_documents": Query(group_documents, f"""
        SELECT concat_ws('|', o_custkey, strftime(o_orderdate, {SECOND})) AS document_key, 0 AS part,
               CAST(count(*) AS INTEGER) AS n,
               string_agg(o_orderkey || ':' || o_orderstatus, ',' ORDER BY o_orderkey, o_orderstatus) AS orders
        FROM orders GROUP BY o_custkey, o_orderdate
    """),
    "group_documents_parts": Query(group_documents_parts, f"""
        WITH n AS (SELECT event_type, event_id, user_id, row_number() OVER (
                       PARTITION BY event_type ORDER BY event_id, user_id) - 1 AS rn FROM events)
        SELECT event_type, CAST(rn // {PART_SIZE} AS INTEGER) AS part, CAST(count(*) AS INTEGER) AS n,
               string_agg(event_id || ':' || user_id, ',' ORDER BY event_id, user_id) AS events
        FROM n GROUP BY ALL
    """),
    "marts_incremental": Query(marts_incremental, _MARTS_SQL),
    "medallion_flagship": Query(medallion_flagship, f"""
        SELECT p.r_name AS pickup_borough, q.r_name AS dropoff_borough, count(*) AS trips
        {_ENDS_SQL.format(lines="(" + newest_lines_sql(LINE_KEY) + ")")} GROUP BY ALL
    """),
}
