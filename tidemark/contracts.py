"""Source layouts, keys, cursors and the dataset roster.

Everything here is data that has to match the published source layouts.
"""

from __future__ import annotations

from dataclasses import dataclass

# -- layers ------------------------------------------------------------------
LAYERS = ("raw", "staging", "marts")

# -- trip streams (fixed values: column name -> JSON Schema type) --------------
_DATE_TIME = {"type": "string", "format": "date-time"}
_INTEGER = {"type": "integer"}
_NUMBER = {"type": "number"}
_STRING = {"type": "string"}


def _street_hail(prefix: str) -> dict[str, dict[str, str]]:
    return {
        "VendorID": _INTEGER,
        f"{prefix}_pickup_datetime": _DATE_TIME,
        f"{prefix}_dropoff_datetime": _DATE_TIME,
        "passenger_count": _INTEGER,
        "trip_distance": _NUMBER,
        "RatecodeID": _INTEGER,
        "store_and_fwd_flag": _STRING,
        "PULocationID": _INTEGER,
        "DOLocationID": _INTEGER,
        "payment_type": _INTEGER,
        "fare_amount": _NUMBER,
        "extra": _NUMBER,
        "mta_tax": _NUMBER,
        "tip_amount": _NUMBER,
        "tolls_amount": _NUMBER,
        "total_amount": _NUMBER,
    }


_FOR_HIRE = {
    "dispatching_base_num": _STRING,
    "pickup_datetime": _DATE_TIME,
    "dropOff_datetime": _DATE_TIME,
    "PULocationID": _INTEGER,
    "DOLocationID": _INTEGER,
    "SR_Flag": _INTEGER,
    "Affiliated_base_number": _STRING,
}

_HIGH_VOLUME = {
    "hvfhs_license_num": _STRING,
    "dispatching_base_num": _STRING,
    "pickup_datetime": _DATE_TIME,
    "dropoff_datetime": _DATE_TIME,
    "PULocationID": _INTEGER,
    "DOLocationID": _INTEGER,
    "trip_miles": _NUMBER,
    "trip_time": _INTEGER,
    "base_passenger_fare": _NUMBER,
    "tolls": _NUMBER,
    "sales_tax": _NUMBER,
    "congestion_surcharge": _NUMBER,
    "tips": _NUMBER,
    "driver_pay": _NUMBER,
    "shared_request_flag": _STRING,
    "shared_match_flag": _STRING,
}


@dataclass(frozen=True)
class TripStream:
    """One family of trip files: where it lies, how it is keyed, where it lands."""

    name: str
    folder: str
    table: str
    cursor: str
    key: tuple[str, ...]
    properties: dict[str, dict[str, str]]

    @property
    def glob(self) -> str:
        return f"{self.folder}/puYear=*/puMonth=*/*.parquet"

    @property
    def json_schema(self) -> dict:
        return {"type": "object", "properties": self.properties}

    def month_prefixes(self, year: int, months: range) -> list[str]:
        return [f"{self.folder}/puYear={year}/puMonth={m}/" for m in months]


TRIP_STREAMS = {
    "yellow": TripStream(
        "yellow", "yellow", "taxi_trips", "tpep_pickup_datetime",
        ("vendorid", "tpep_pickup_datetime", "pulocationid"), _street_hail("tpep"),
    ),
    "green": TripStream(
        "green", "green", "taxi_trips_green", "lpep_pickup_datetime",
        ("vendorid", "lpep_pickup_datetime", "pulocationid"), _street_hail("lpep"),
    ),
    "fhv": TripStream(
        "fhv", "fhv", "taxi_trips_fhv", "pickup_datetime",
        ("dispatching_base_num", "pickup_datetime", "pulocationid"), _FOR_HIRE,
    ),
    "fhvhv": TripStream(
        "fhvhv", "fhvhv", "taxi_trips_fhvhv", "pickup_datetime",
        ("hvfhs_license_num", "pickup_datetime", "pulocationid"), _HIGH_VOLUME,
    ),
}

# -- bike trips (fixed values) -------------------------------------------------
BIKE_TABLE = "citibike_trips"
BIKE_OLD_COLUMNS = (
    "tripduration",
    "starttime",
    "stoptime",
    "start station id",
    "start station name",
    "start station latitude",
    "start station longitude",
    "end station id",
    "end station name",
    "end station latitude",
    "end station longitude",
    "bikeid",
    "usertype",
    "birth year",
    "gender",
)
# Old column -> new column; columns that the new layout lacks are left out.
BIKE_NEW_TO_OLD = {
    "starttime": "started_at",
    "stoptime": "ended_at",
    "start station id": "start_station_id",
    "start station name": "start_station_name",
    "start station latitude": "start_lat",
    "start station longitude": "start_lng",
    "end station id": "end_station_id",
    "end station name": "end_station_name",
    "end station latitude": "end_lat",
    "end station longitude": "end_lng",
    "bikeid": "ride_id",
    "usertype": "member_casual",
}
BIKE_NEW_MARKER = "started_at"
BIKE_CURSOR = "started_at"
BIKE_KEY = ("started_at", "ended_at", "start_station_id", "end_station_id", "ride_id")
BIKE_ARCHIVE_STEM = "JC-{month}-citibike-tripdata"
BIKE_ARCHIVE_ENDINGS = (".csv.zip", ".zip")
BIKE_FIRST_MONTH = "201901"
BIKE_REQUIRED = ("starttime",)

# -- high-volume files by month (fixed values) ---------------------------------
HIGH_VOLUME_FIRST_MONTH = "2019-02"
HIGH_VOLUME_FILE = "fhvhv_tripdata_{year_month}.parquet"

# -- open-data records (fixed values) ------------------------------------------
OPEN_DATA_DOMAIN = "data.cityofnewyork.us"
OPEN_DATA_STREAM = "socrata_records"
OPEN_DATA_FIELDS = (
    "unique_key", "created_date", "closed_date", "complaint_type", "descriptor",
    "borough", "agency", "status", "latitude", "longitude", "incident_zip",
    "cmplnt_num", "cmplnt_fr_dt", "cmplnt_fr_tm", "boro_nm", "ofns_desc",
    "start_date_time", "end_date_time", "event_id", "event_name", "event_type",
    "camis", "dba", "inspection_date", "inspection_type", "violation_code",
    "violation_description", "critical_flag", "grade", "score", "grade_date",
    "record_date", "cuisine_description", "building", "street", "zipcode",
    "phone", "action", "_socrata_resource_id", "_socrata_domain",
)
PAGE_SIZE = 50_000
SLICE_DAYS = 90
LOOKBACK_DAYS = 7


@dataclass(frozen=True)
class RecordSet:
    """One open-data dataset; ``key`` is our choice, empty means the whole record."""

    name: str
    resource_id: str
    cursor: str
    table_prefix: str
    key: tuple[str, ...]
    domain: str = OPEN_DATA_DOMAIN

    @property
    def table(self) -> str:
        return f"{self.table_prefix}{OPEN_DATA_STREAM}"


RECORD_SETS = (
    RecordSet("socrata-311-complaints", "erm2-nwe9", "created_date", "socrata_311_", ("unique_key",)),
    RecordSet("socrata-nypd-complaints", "qgea-i56i", "cmplnt_fr_dt", "socrata_nypd_", ("cmplnt_num",)),
    RecordSet("socrata-event-permits", "tvpp-9vvx", "start_date_time", "socrata_events_", ("event_id",)),
    RecordSet(
        "socrata-restaurant-inspections", "43nn-pn8j", "inspection_date", "socrata_restaurants_", ()
    ),
)

# -- payload tables, zones, quality (fixed values) -------------------------------
PAYLOAD_TABLES = (
    "air_quality", "weather", "nypd_complaints", "complaints_311",
    "event_permits", "restaurant_inspections", "holidays",
)
ZONE_TABLE = "nyc_taxi_zones"
RELIABLE_BEFORE = "2019-07-01"
INSPECTION_KEY = ("camis", "inspection_date")
INSPECTION_CHILD = ("violation_code", "violation_description", "critical_flag")
# Our own choice: an inspection has a handful of violations.
INSPECTION_PART = 10_000
