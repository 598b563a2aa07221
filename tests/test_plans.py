import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from test_sources import OLD, make_zip, source_of

from tidemark import contracts
from tidemark.operators.checks import DataCheckError
from tidemark.plans.bikes import ingest_bikes
from tidemark.plans.build_all import Inputs, Readings, build_all
from tidemark.plans.marts import inspection_documents, station_zones
from tidemark.plans.open_data import current_records, load_records, typed_records
from tidemark.plans.trips import ingest_trips, load_trips
from tidemark.plans.zones import build_zones
from tidemark.sinks.tables import ensure_layers

YELLOW = contracts.TRIP_STREAMS["yellow"]


@pytest.fixture(autouse=True)
def fresh_layers(spark):
    for name in contracts.LAYERS:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    ensure_layers(spark)


def zones_csv(tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text("LocationID,Borough,Zone,service_zone\n1,EWR,Newark,EWR\n2,Queens,Jamaica,N/A\n,Unknown,N/A,N/A\n")
    return str(path)


def write_trips(spark, root, rows, stream=YELLOW):
    df = spark.createDataFrame(
        [(v, t, pu, do, f, t.year, t.month) for v, t, pu, do, f in rows],
        f"VendorID long, {stream.cursor} timestamp_ntz, PULocationID long, DOLocationID long, fare_amount double, "
        "puYear int, puMonth int",
    )
    df.coalesce(1).write.mode("append").partitionBy("puYear", "puMonth").parquet(f"{root}/{stream.folder}")


def test_zones(spark, tmp_path, rows):
    out = build_zones(spark, zones_csv(tmp_path))
    assert out.columns == ["location_id", "borough", "zone_name", "service_zone"]
    assert rows(out) == [("1", "EWR", "Newark", "EWR"), ("2", "Queens", "Jamaica", "N/A")]
    assert spark.table("raw.nyc_taxi_zones").count() == 3
    assert build_zones(spark, zones_csv(tmp_path)).count() == 2


def test_full_trip_ingest(spark, tmp_path, rows):
    root = f"file://{tmp_path}"
    write_trips(spark, root, [(1, datetime(2019, 1, 1), 1, 2, 5.0)] * 3)
    write_trips(spark, root, [(1, datetime(2019, 2, 1), 1, 2, 5.0)] * 4)
    write_trips(spark, root, [(1, datetime(2019, 3, 1), 1, 2, 5.0)] * 9)
    prefixes = {n: s.month_prefixes(2019, range(1, 3)) for n, s in contracts.TRIP_STREAMS.items()}
    assert rows(ingest_trips(spark, root, prefixes)) == [("fhv", 0), ("fhvhv", 0), ("green", 0), ("yellow", 7)]
    assert "pulocationid" in spark.table("raw.taxi_trips").columns
    assert rows(ingest_trips(spark, root, {"yellow": prefixes["yellow"]}, limit=1)) == [("yellow", 3)]
    head = ingest_trips(spark, root, {"yellow": prefixes["yellow"]}, head_rows=2, head_order=("VendorID",))
    assert rows(head) == [("yellow", 4)]


def test_incremental_trips(spark, tmp_path):
    root = f"file://{tmp_path}"
    write_trips(spark, root, [(1, datetime(2019, 1, 1), 1, 2, 5.0), (1, datetime(2019, 1, 1), 1, 2, 6.0)])
    assert load_trips(spark, root, YELLOW).count() == 1, "same natural key"
    write_trips(spark, root, [(1, datetime(2019, 1, 1), 1, 2, 7.5), (2, datetime(2019, 1, 3), 1, 2, 1.0)])
    for _ in range(2):
        got = {r["vendorid"]: r["fare_amount"] for r in load_trips(spark, root, YELLOW).collect()}
        assert got == {1: 7.5, 2: 1.0}


def test_bikes(spark, tmp_path, rows):
    line = ",".join(f"v{i}" for i in range(15))
    make_zip(tmp_path / "JC-201901-citibike-tripdata.csv.zip", [("a.csv", f"{OLD}\n{line}\n{line}\n")])
    make_zip(tmp_path / "JC-201902-citibike-tripdata.zip", [("a.csv", "started_at,ride_id\n,r1\n")])
    make_zip(tmp_path / "JC-201903-citibike-tripdata.zip", [("a.csv", "x\n1\n")])
    load = ingest_bikes(spark, str(tmp_path), "2019-01", "2019-04")
    assert load.table.columns == list(contracts.BIKE_OLD_COLUMNS) and load.table.count() == 3
    assert tuple(load.checks.head()) == (3, 1)
    assert [r["reason"] for r in load.rejected.collect()] == ["header"]
    assert load.sample.count() == 3
    with pytest.raises(DataCheckError):
        ingest_bikes(spark, str(tmp_path), "2019-03", "2019-03")
    assert spark.table("raw.citibike_trips").count() == 3, "an empty load leaves the table"


def test_bikes_of_all_months(spark, tmp_path):
    for name in ("201901-citibike-tripdata.csv.zip", "201904-citibike-tripdata.zip", "202107-citibike-tripdata.zip"):
        make_zip(tmp_path / f"JC-{name}", [("a.csv", f"started_at,ride_id\n2019-01-02 08:00:00,{name}\n")])
    assert ingest_bikes(spark, str(tmp_path)).table.count() == 3
    assert ingest_bikes(spark, str(tmp_path), months=2).table.count() == 1
    assert ingest_bikes(spark, str(tmp_path), "2019-04", "2021-07").table.count() == 2


def test_open_data(spark):
    entry = contracts.RECORD_SETS[0]

    def feed(*items):
        def fetch(start, end, limit, offset):
            inside = sorted((i for i in items if start <= i["created_date"] <= end), key=lambda i: i["created_date"])
            return inside[offset:offset + limit]

        return fetch

    a = {"unique_key": "a", "created_date": "2023-01-02T00:00:00", "borough": " QUEENS ", "score": "x"}
    b = {"unique_key": "b", "created_date": "2023-05-01T00:00:00", "score": "3", "surprise": [1]}
    late = {"unique_key": "c", "created_date": "2023-04-27T00:00:00"}
    early = {"unique_key": "d", "created_date": "2023-02-01T00:00:00"}
    range_ = ("2023-01-01T00:00:00", "2023-06-30T23:59:59")
    assert load_records(spark, entry, feed(a, b), *range_, page_size=1).count() == 2
    corrected = {**b, "score": "4"}
    loaded = load_records(spark, entry, feed(a, corrected, late, early), *range_, page_size=1)
    assert sorted(r["unique_key"] for r in loaded.collect()) == ["a", "b", "b", "c"], "appended; d is too late"
    now = current_records(loaded, entry)
    assert {r["unique_key"]: r["score"] for r in now.collect()} == {"a": "x", "b": "4", "c": None}
    assert {r["_socrata_resource_id"] for r in now.collect()} == {entry.resource_id}
    typed = typed_records(now, {"unique_key": "string", "borough": "string", "score": "int"})
    assert sorted(map(tuple, typed.collect())) == [("a", "QUEENS", None), ("b", None, 4), ("c", None, None)]
    by_payload = current_records(loaded, contracts.RECORD_SETS[3])
    assert by_payload.count() == 4 and json.loads(by_payload.where("unique_key = 'a'").head()["payload"]) == a


def test_inspection_documents(spark):
    df = spark.createDataFrame(
        [("1", "2020", "b", "x", None), ("1", "2020", "a", None, "Y"), ("2", "2020", None, None, None)],
        ["camis", "inspection_date", *contracts.INSPECTION_CHILD],
    )
    got = {r["document_key"]: [tuple(v) for v in r["violations"]] for r in inspection_documents(df).collect()}
    assert got == {"1|2020": [("a", None, "Y"), ("b", "x", None)], "2|2020": [(None, None, None)]}


def test_station_zones(spark):
    zones = spark.createDataFrame([(1, 40.0, -74.0), (2, 41.0, -74.0)], "location_id int, lat double, lon double")
    stations = spark.createDataFrame([("s", 40.9, -74.0)], "station string, lat double, lon double")
    assert station_zones(stations, zones).head()["location_id"] == 2


def test_everything_in_order(spark, tmp_path, rows):
    root = f"file://{tmp_path}/trips"
    write_trips(
        spark, root,
        [
            (1, datetime(2019, 1, 1, 10), 1, 2, 5.0), (1, datetime(2019, 1, 1, 11), 1, 2, 5.0),
            (2, datetime(2019, 1, 3, 9), 2, 1, 5.0), (3, datetime(2019, 7, 1), 2, 1, 5.0),
        ],
    )
    bikes = tmp_path / "bikes"
    bikes.mkdir()
    make_zip(bikes / "JC-201901-citibike-tripdata.zip", [("a.csv", "started_at,ride_id\n2019-01-02 08:00:00,r\n")])
    entry = contracts.RECORD_SETS[0]
    fetch = source_of([("2023-01-02T00:00:00", "a")])
    readings = spark.sql(
        "SELECT * FROM VALUES (timestamp_ntz'2019-01-01 08:00:00', 'a', 0.004D, 3, 'L1'), "
        "(timestamp_ntz'2019-01-01 09:00:00', 'a', 0.002D, 4, 'L2') AS r(at, what, x, n, line)"
    )
    made = build_all(
        spark,
        Inputs(
            zones_csv(tmp_path), root, bikes_root=str(bikes), bike_months=("2019-01", "2019-01"),
            records={entry.name: (fetch, "2023-01-01T00:00:00", "2023-01-31T00:00:00")},
            centroids=spark.createDataFrame([(1, 40.0, -74.0)], "location_id int, lat double, lon double"),
            holidays=spark.sql("SELECT date'2019-01-01' AS day, 'New Year' AS holiday"),
            air_quality=Readings(readings, "at", "what", {"value": "x"}),
            subway=Readings(readings, "at", "what", {"entries": "n", "line": "line"}),
            weather_readings=Readings(readings, "at", None, {"temperature": "x"}),
        ),
    )
    assert made["fact_citibike_trips"].count() == 1 and made["dim_citibike_stations"].count() == 0
    assert made["fact_311_complaints"].agg(F.sum("row_count")).head()[0] == 1
    assert made["agg_modal_daily"].where("is_holiday").count() == 1
    assert made["dim_holidays"].count() == 1
    assert made["fact_trips"].count() == 3, "the row from July 2019 is unreliable"
    assert rows(made["agg_flow_borough"]) == [("EWR", "Queens", 2), ("Queens", "EWR", 1)]
    daily = made["agg_modal_daily"].orderBy("day").select(F.date_format("day", "dd"), "taxi_count", "bike_count").collect()
    assert [tuple(r) for r in daily] == [("01", 2, 0), ("02", 0, 1), ("03", 1, 0)]
    assert made["dim_date"].count() == 3
    assert [float(r["value_sum"]) for r in made["fact_air_quality"].collect()] == [0.006]
    assert [r["entries"] for r in made["fact_subway_entries"].collect()] == [7]
    assert rows(made["dim_subway_stations"]) == [("a", "L2")]
    assert [float(r["temperature_max"]) for r in made["dim_weather"].collect()] == [0.004]
    assert tuple(made["fact_trips_dropped"].head()) == (3, 1)
    assert made[entry.table].count() == 1
