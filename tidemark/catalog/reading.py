"""Registered queries for sources and scans."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import contracts
from tidemark.catalog.base import (
    MICRO,
    SECOND,
    ZONES_SQL,
    Query,
    double,
    micro_text,
    second_text,
    table,
    zones,
)
from tidemark.functions.names import lower_name, rename_all, snake_name
from tidemark.functions.times import iso_text, slice_number
from tidemark.operators.checks import load_report, require_rows
from tidemark.operators.numbering import one_page, pages
from tidemark.operators.shape import bike_layout, bikes_to_old_layout, parse_records, union_all
from tidemark.plans.open_data import current_records, load_records
from tidemark.plans.trips import ingest_trips
from tidemark.plans.zones import stage_zones, zone_dimension
from tidemark.session import remove, scratch_database, scratch_path, stored
from tidemark.sinks.tables import materialize, replace_table
from tidemark.sources.archives import accepted, members, zipped_csv
from tidemark.sources.files import (
    csv_inferred,
    csv_text,
    csv_typed,
    footers,
    head_per_file,
    partitioned_scan,
    physical_head,
    relation,
    struct_from_json_schema,
    tolerant_scan,
    union_files,
)
from tidemark.sources.listing import capped_listing, list_files, month_list, paths_of
from tidemark.sources.paged_json import SCHEMA as PAGES
from tidemark.sources.paged_json import read_pages, stored_pages
from tidemark.sources.paths import file_system
from tidemark.streaming.extract import pull_slices, replace_slices
from tidemark.streaming.slices import slice_list, slices_between


def _landed_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones written as a CSV with camel-case names and read back as text."""
    path = scratch_path(spark, "zones")
    source = zones(spark, sf_dir).select(
        F.col("location_id").alias("LocationID"), F.col("borough").alias("Borough"),
        F.col("zone_name").alias("Zone"), F.lit("N/A").alias("service_zone"),
    )
    source.write.option("header", "true").csv(path)
    return rename_all(csv_text(spark, path), snake_name)


def stg_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_zones(_landed_zones(spark, sf_dir))


def dim_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = scratch_database(spark, "zones")
    raw = replace_table(_landed_zones(spark, sf_dir), f"{database}.raw_zones", guard=True)
    staged = materialize(stage_zones(raw), f"stg_{database}", "view")
    return materialize(zone_dimension(staged), f"{database}.dim_zones", "table")


def partitioned_glob_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "orders")
    months = table(spark, sf_dir, "orders").withColumns(
        {"puYear": F.year("o_orderdate"), "puMonth": F.month("o_orderdate")}
    )
    months.hint("rebalance", "puYear", "puMonth").write.partitionBy("puYear", "puMonth").parquet(
        f"{root}/yellow"
    )
    read = partitioned_scan(spark, root, "yellow/puYear=*/puMonth=*/*.parquet")
    return read.groupBy(F.col("puYear").cast("int").alias("pu_year")).agg(
        F.count("*").alias("row_count"),
        double(F.sum(F.col("o_totalprice").cast("decimal(18,2)"))).alias("total"),
    )


_ORDER_SCHEMA = {
    "type": "object",
    "properties": {
        "o_orderkey": {"type": "integer"},
        "o_custkey": {"type": "integer"},
        "o_orderstatus": {"type": ["null", "string"]},
        "o_totalprice": {"type": "number"},
        "o_orderdate": {"type": "string", "format": "date-time"},
        "o_orderpriority": {"type": "string"},
    },
}


def explicit_schema_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders-csv")
    table(spark, sf_dir, "orders").write.option("header", "true").csv(path)
    read = csv_typed(spark, path, struct_from_json_schema(_ORDER_SCHEMA))
    return read.withColumn("o_orderdate", second_text("o_orderdate"))


def inferred_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as CSV with inferred types; the NA word is NULL."""
    path = scratch_path(spark, "suppliers-csv")
    supplier = table(spark, sf_dir, "supplier")
    name = F.when(F.col("s_suppkey") % 4 == 0, "N/A").otherwise(F.col("s_name"))
    supplier.select("s_suppkey", name.alias("s_name"), "s_nationkey").write.option("header", "true").csv(path)
    read = csv_inferred(spark, path)
    return read.select(
        F.col("s_suppkey").cast("bigint").alias("s_suppkey"), F.coalesce("s_name", F.lit("missing")).alias("s_name"),
        F.col("s_nationkey").cast("int").alias("s_nationkey"), F.lit(dict(read.dtypes)["s_suppkey"]).alias("inferred"),
    )


def seed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as a seed: typed CSV, written as a table of a layer and read by its name."""
    path = scratch_path(spark, "nation-csv")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    nation.write.option("header", "true").csv(path)
    layer = scratch_database(spark, "seeds")
    replace_table(csv_typed(spark, path, nation.schema), f"{layer}.nation", guard=True)
    return relation(spark, "nation", layer)


def capped_file_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in two layouts, one without priority, read back as one relation; no cap is set."""
    root = scratch_path(spark, "layouts")
    orders = table(spark, sf_dir, "orders")
    old = F.col("o_orderstatus") == "F"
    orders.where(old).drop("o_orderpriority").write.parquet(f"{root}/old")
    orders.where(~old).write.parquet(f"{root}/new")
    listing = list_files(spark, root)
    chosen = capped_listing(listing, ["old/", "new/"])
    read = union_files(spark, paths_of(chosen))
    return read.select(
        "o_orderkey", "o_orderstatus", "o_totalprice",
        F.coalesce("o_orderpriority", F.lit("none")).alias("priority"),
    )


def _line_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lines")
    table(spark, sf_dir, "lineitem").write.partitionBy("l_linenumber").parquet(path)
    return spark.read.parquet(path)


_HEAD_ORDER = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
)


def _head(n: int):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        head = head_per_file(_line_files(spark, sf_dir), _HEAD_ORDER, n, folder=True)
        return head.select(
            F.col("l_linenumber").cast("int").alias("l_linenumber"), "l_orderkey", "l_partkey",
            "l_suppkey", "l_quantity", second_text("l_shipdate").alias("shipped"),
        )

    return run


def per_file_head_physical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written in order, one folder of part files to a line number: the first rows of each folder as they lie there.

    The lines are dealt out by ranges, so that no task holds all lines of a number.
    """
    path = scratch_path(spark, "sorted-lines")
    order = ("l_linenumber", *_HEAD_ORDER)
    dealt = table(spark, sf_dir, "lineitem").repartitionByRange(*order).sortWithinPartitions(*order)
    dealt.write.partitionBy("l_linenumber").parquet(path)
    return physical_head(spark.read.parquet(path), 25, folder=True).select(
        F.col("l_linenumber").cast("int").alias("l_linenumber"), "l_orderkey", "l_partkey",
        "l_suppkey", "l_quantity", second_text("l_shipdate").alias("shipped"),
    )


def archive_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the central directories of archives of two members say, without unpacking one."""
    folder = scratch_path(spark, "members")
    rows = table(spark, sf_dir, "customer").select(
        *[F.col(c).cast("string").alias(c) for c in _CUSTOMER[:-1]], F.lit("").alias("note"),
        F.floor(F.col("c_custkey") / ROWS_PER_ARCHIVE).alias("archive_no"),
    )
    _archives(rows, _CUSTOMER, _CUSTOMER_NEW, folder, members=2).write.parquet(scratch_path(spark, "packed"))
    found = members(list_files(spark, folder, "*.zip"))
    number = F.regexp_extract("archive", r"([0-9]+)[.]csv[.]zip$", 1).cast("bigint")
    return found.select(number.alias("archive_no"), "member", (F.col("size") > 0).alias("filled"), F.col("problem").isNull().alias("fine"))


def open_data_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as paged records of one dataset, loaded as a job would: slices, pages, constants, routing, watermark."""
    root, slices = _paged_events(spark, sf_dir)
    entry = contracts.RECORD_SETS[0]
    kept = stored_pages(root)

    def fetch(start: str, end: str, limit: int, offset: int) -> list:
        # Under the dataset's own names, with a cursor to the second.
        return [
            {"unique_key": str(r["event_id"]), entry.cursor: r["ts"][:19].replace(" ", "T"), "complaint_type": r["event_type"]}
            for r in kept(start, end, limit, offset)
        ]

    layer = scratch_database(spark, "open_data")
    loaded = load_records(spark, entry, fetch, slices[0][1], slices[-1][2], PAGE_ROWS, 7, layer=layer)
    return current_records(loaded, entry).select(
        "unique_key", F.col(entry.cursor).alias("created"), "complaint_type", F.col("_socrata_resource_id").alias("resource_id")
    )


def trip_ingest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders laid out as yellow trips by month: listed, united, renamed, landed, counted per stream."""
    root = scratch_path(spark, "trips")
    stream = contracts.TRIP_STREAMS["yellow"]
    orders = table(spark, sf_dir, "orders")
    trips = orders.select(
        F.col("o_custkey").alias("VendorID"), F.col("o_orderdate").alias(stream.cursor), F.col("o_orderkey").alias("PULocationID"),
        F.col("o_totalprice").alias("fare_amount"), F.year("o_orderdate").alias("puYear"), F.month("o_orderdate").alias("puMonth"),
    )
    trips.write.partitionBy("puYear", "puMonth").parquet(f"{root}/{stream.folder}")
    years = [r[0] for r in orders.select(F.year("o_orderdate")).distinct().collect()]
    prefixes = {
        name: [p for year in sorted(years) for p in s.month_prefixes(year, range(1, 13))] for name, s in contracts.TRIP_STREAMS.items()
    }
    return ingest_trips(spark, root, prefixes, layer=scratch_database(spark, "ingest"))


def _head_sql(n: int) -> str:
    return f"""
        SELECT l_linenumber, l_orderkey, l_partkey, l_suppkey, l_quantity,
               strftime(l_shipdate, {SECOND}) AS shipped
        FROM (SELECT *, row_number() OVER (PARTITION BY l_linenumber
                     ORDER BY {', '.join(_HEAD_ORDER)}) AS rn FROM lineitem)
        WHERE rn <= {n}
    """


def skip_corrupt_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "partly-broken")
    events = table(spark, sf_dir, "events")
    events.write.parquet(f"{root}/good")
    events.select(F.col("props")).write.text(f"{root}/bad")
    read = tolerant_scan(spark, [f"{root}/good", f"{root}/bad"], events.schema)
    return read.select("event_id", micro_text("ts").alias("ts"), "event_type", "value", "props")


_CUSTOMER = ("c_custkey", "c_name", "c_nationkey", "c_mktsegment", "note")
_CUSTOMER_NEW = {"c_custkey": "id", "c_name": "full_name", "c_nationkey": "nation", "c_mktsegment": "segment"}
ROWS_PER_ARCHIVE = 2_000


def _archives(rows: DataFrame, columns: tuple[str, ...], renamed: dict[str, str], folder: str, members: int = 1) -> DataFrame:
    """Zip rows per ``archive_no``; odd archives use the renamed layout."""
    def pack(group):
        import csv
        import io
        import zipfile

        import pandas as pd

        number = int(group["archive_no"].iloc[0])
        kept = [c for c in columns if number % 2 == 0 or c in renamed]
        part = group[columns[0]].astype("int64") % members
        texts = {}
        for at in range(members):
            text = io.StringIO()
            writer = csv.writer(text, lineterminator="\n")
            writer.writerow([renamed[c] if number % 2 else c for c in kept])
            writer.writerows(group.loc[part == at, kept].itertuples(index=False))
            texts["data.csv" if members == 1 else f"part{at}.csv"] = text.getvalue()
        system, base = file_system(folder)
        system.create_dir(base, recursive=True)
        with system.open_output_stream(f"{base}/{number:08d}.csv.zip") as sink:
            packed = io.BytesIO()
            with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as made:
                made.writestr("__MACOSX/data.csv", "ignored")
                for name, text in texts.items():
                    made.writestr(name, text)
            sink.write(packed.getvalue())
        return pd.DataFrame({"archive_no": [number], "row_count": [len(group)]})

    return rows.groupBy("archive_no").applyInPandas(pack, "archive_no long, row_count long")


def zip_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers zipped in archives of a fixed number of keys, then read back."""
    folder = scratch_path(spark, "archives")
    rows = table(spark, sf_dir, "customer").select(
        *[F.col(c).cast("string").alias(c) for c in _CUSTOMER[:-1]], F.lit("").alias("note"),
        F.floor(F.col("c_custkey") / ROWS_PER_ARCHIVE).alias("archive_no"),
    )
    _archives(rows, _CUSTOMER, _CUSTOMER_NEW, folder).write.parquet(scratch_path(spark, "packed"))
    read = zipped_csv(list_files(spark, folder, "*.zip"), "path", _CUSTOMER, _CUSTOMER_NEW, "full_name")
    return accepted(read).select(
        F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name",
        F.col("c_nationkey").cast("int").alias("c_nationkey"), "c_mktsegment",
        F.coalesce("note", F.lit("missing")).alias("note"), F.col("_layout").alias("layout"),
    )


def zip_all_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers zipped in two members to an archive, one in each layout; all members are read."""
    folder = scratch_path(spark, "members")
    rows = table(spark, sf_dir, "customer").select(
        *[F.col(c).cast("string").alias(c) for c in _CUSTOMER[:-1]], F.lit("").alias("note"),
        F.floor(F.col("c_custkey") / ROWS_PER_ARCHIVE).alias("archive_no"),
    )
    packed = _archives(rows, _CUSTOMER, _CUSTOMER_NEW, folder, members=2)
    packed.write.parquet(scratch_path(spark, "packed"))
    read = zipped_csv(list_files(spark, folder, "*.zip"), "path", _CUSTOMER, _CUSTOMER_NEW, "full_name")
    return accepted(read).select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name", "_member").withColumnRenamed("_member", "member")


def unreadable_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good files, and one broken file for each event type: how many can be read, and how many cannot."""
    root = scratch_path(spark, "broken")
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    events.write.partitionBy("event_type").parquet(f"{root}/good")
    events.select("event_type").distinct().select(F.concat(F.lit("not parquet: "), "event_type").alias("value")).write.text(f"{root}/bad")
    looked = footers(spark, [f"{root}/good", f"{root}/bad"])
    kind = F.when(F.col("problem").isNull(), "good").otherwise("bad")
    place = F.regexp_extract("path", r"/(good/event_type=[^/]+|bad)/", 1)
    return looked.select(place.alias("place"), kind.alias("state")).distinct()


def header_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Under a contract without the mapping, every archive in the other layout is refused."""
    folder = scratch_path(spark, "archives")
    rows = table(spark, sf_dir, "customer").select(
        *[F.col(c).cast("string").alias(c) for c in _CUSTOMER[:-1]], F.lit("").alias("note"),
        F.floor(F.col("c_custkey") / ROWS_PER_ARCHIVE).alias("archive_no"),
    )
    _archives(rows, _CUSTOMER, _CUSTOMER_NEW, folder).write.parquet(scratch_path(spark, "packed"))
    read = zipped_csv(list_files(spark, folder, "*.zip"), "path", _CUSTOMER)
    taken = F.col("_layout").isin("old", "new")
    counts = [
        F.struct(F.lit(what).alias("what"), F.count_if(rows).alias("row_count"))
        for what, rows in (("accepted rows", taken), ("rejected archives", ~taken))
    ]
    return read.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))


def layout_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events dressed as new-layout bike trips."""
    new = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("ride_id"),
        second_text("ts").alias("started_at"),
        second_text(F.col("ts") + F.expr("INTERVAL 10 MINUTES")).alias("ended_at"),
        F.col("user_id").cast("string").alias("start_station_id"),
        F.concat(F.lit("Station "), "user_id").alias("start_station_name"),
        F.lit("").alias("end_station_id"),
        F.col("event_type").alias("member_casual"),
    )
    if bike_layout(new.columns) != "new":
        raise ValueError("not the new layout")
    return rename_all(bikes_to_old_layout(new), lower_name)


def _layout_sql() -> str:
    given = {
        "bikeid": "CAST(event_id AS VARCHAR)",
        "starttime": f"strftime(ts, {SECOND})",
        "stoptime": f"strftime(ts + INTERVAL 10 MINUTE, {SECOND})",
        "start station id": "CAST(user_id AS VARCHAR)",
        "start station name": "'Station ' || user_id",
        "usertype": "event_type",
    }
    cols = [
        f"{given.get(c, 'CAST(NULL AS VARCHAR)')} AS {lower_name(c)}" for c in contracts.BIKE_OLD_COLUMNS
    ]
    return f"SELECT {', '.join(cols)} FROM events"


def month_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly files that cover all orders, with the orders each should hold."""
    by_month = table(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyyMM").alias("month_key")).agg(
        F.count("*").alias("row_count"),
        F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last"),
    )
    counts = stored(by_month, "months")
    bounds = counts.agg(F.min("first"), F.max("last")).head()
    months = month_list(spark, *(f"{day:%Y-%m}" for day in bounds)).join(counts.drop("first", "last"), "month_key", "left")
    stem, _, tail = contracts.BIKE_ARCHIVE_STEM.partition("{month}")
    return months.select(
        "month_key",
        F.concat(F.lit(stem), "month_key", F.lit(tail + contracts.BIKE_ARCHIVE_ENDINGS[0])).alias("file_name"),
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
    )


# Rows to a page, whatever the table's size.
PAGE_ROWS = 1_000


def _paged_events(spark: SparkSession, sf_dir: str) -> tuple[str, list]:
    """Events stored as pages per weekly slice: where, and the slices."""
    events = table(spark, sf_dir, "events")
    span = events.agg(
        F.min(F.date_trunc("day", "ts")).cast("timestamp_ntz").alias("first"),
        F.max(F.date_trunc("second", "ts")).cast("timestamp_ntz").alias("last"),
    )
    span_row = span.head()
    slices = slices_between(
        spark.createDataFrame([(span_row["first"], span_row["last"])], "first timestamp_ntz, last timestamp_ntz"),
        days=7,
    )
    root = scratch_path(spark, "pages")
    first = F.lit(span_row["first"])
    days = slice_number("ts", first, 7) * 7
    number = iso_text(first + F.make_dt_interval(days))
    paged = pages(
        events.withColumn("slice_start", number), ["ts", "event_id"], PAGE_ROWS, within=["slice_start"]
    )
    (
        paged.withColumn("ts", micro_text("ts")).drop("row_no")
        .repartition("slice_start", "page_no").write.partitionBy("slice_start", "page_no").json(root)
    )
    return root, slice_list(slices)


def _events_of(pages_read: DataFrame) -> DataFrame:
    fields = ("event_id", "ts", "user_id", "event_type", "value", "props")
    return parse_records(pages_read, "payload", fields).select(
        F.col("event_id").cast("bigint").alias("event_id"), "ts", "event_type",
        F.col("value").cast("double").alias("value"), "props", "slice_no", "page_no",
    )


def json_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events stored as pages per weekly slice, then extracted slice by slice."""
    root, slices = _paged_events(spark, sf_dir)
    return _events_of(read_pages(spark, stored_pages(root), slices, PAGE_ROWS))


def json_pages_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pages pulled as a stream: the first two slices, then all open ones, then nothing.

    The source's pages of the first two slices are gone before the second run, so a
    finished slice that was asked for again would be lost.
    """
    root, slices = _paged_events(spark, sf_dir)
    state = scratch_path(spark, "extract")

    def pull(some: list) -> None:
        pull_slices(spark, stored_pages(root), some, state, lambda rows: replace_slices(rows, f"{state}/records"), PAGE_ROWS)

    pull(slices[:2])
    for _, start, _ in slices[:2]:
        remove(spark, f"{root}/slice_start={quote(start, safe='')}")
    pull(slices)
    pull(slices)
    return _events_of(spark.read.schema(PAGES).parquet(f"{state}/records"))


def _json_pages_sql() -> str:
    return f"""
        WITH b AS (SELECT date_trunc('day', min(ts)) AS first FROM events),
        s AS (SELECT e.*, CAST(floor(date_diff('microsecond', first, ts) / 604800000000.0) AS INTEGER) AS slice_no
              FROM events e, b)
        SELECT event_id, strftime(ts, {MICRO}) AS ts, event_type, value, props, slice_no,
               CAST(floor((row_number() OVER (PARTITION BY slice_no ORDER BY ts, event_id) - 1)
                    / {PAGE_ROWS}) AS INTEGER) AS page_no
        FROM s
    """


def open_json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "props")
    return parse_records(events, "props", ["k", "unique_key"]).select(
        "event_id", "k", F.coalesce("unique_key", F.lit("absent")).alias("unique_key"),
        F.to_json("_rest").alias("rest"),
    )


def page_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fourth page of orders by date."""
    page = one_page(table(spark, sf_dir, "orders"), ["o_orderdate", "o_orderkey"], 3, 500)
    return page.select("o_orderkey", "o_custkey", second_text("o_orderdate").alias("ordered"))


def numbered_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with its page, in cursor order over the whole table."""
    numbered = pages(table(spark, sf_dir, "events").select("event_id", "ts"), ["ts", "event_id"], 500)
    return numbered.select("event_id", "row_no", "page_no")


def union_field_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers under one wide set of fields."""
    customer = table(spark, sf_dir, "customer").select(
        F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )
    supplier = table(spark, sf_dir, "supplier").select(
        F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        second_text(F.lit("2000-01-01").cast("timestamp_ntz")).alias("since"),
    )
    return union_all([customer, supplier])


def file_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per stream: each order status as one stream, and one without files."""
    root = scratch_path(spark, "streams")
    table(spark, sf_dir, "orders").write.partitionBy("o_orderstatus").parquet(root)
    read = require_rows(partitioned_scan(spark, root, "o_orderstatus=*/*.parquet"))
    found = [r[0] for r in read.select("o_orderstatus").distinct().collect()]
    streams = {s: read.where(F.col("o_orderstatus") == s) for s in sorted(found)}
    return load_report({**streams, "none": None})


_EVEN = f"floor(c_custkey / {ROWS_PER_ARCHIVE}) % 2 = 0"

QUERIES = {
    "stg_zones": Query(stg_zones, f"""
        SELECT CAST(n_nationkey AS VARCHAR) AS location_id, r_name AS borough, n_name AS zone_name,
               'N/A' AS service_zone FROM ({ZONES_SQL})
    """),
    "dim_zones": Query(dim_zones, f"""
        SELECT CAST(n_nationkey AS VARCHAR) AS location_id, r_name AS borough, n_name AS zone_name,
               'N/A' AS service_zone FROM ({ZONES_SQL}) WHERE n_nationkey IS NOT NULL
    """),
    "partitioned_glob_scan": Query(partitioned_glob_scan, """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS pu_year, count(*) AS row_count,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
        FROM orders GROUP BY 1
    """),
    "explicit_schema_scan": Query(explicit_schema_scan, f"""
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
               strftime(o_orderdate, {SECOND}) AS o_orderdate, o_orderpriority FROM orders
    """),
    "inferred_csv": Query(inferred_csv, """
        SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 'missing' ELSE s_name END AS s_name, s_nationkey,
               'int' AS inferred FROM supplier
    """),
    "seed_table": Query(seed_table, "SELECT n_nationkey, n_name, n_regionkey FROM nation"),
    "capped_file_union": Query(capped_file_union, """
        SELECT o_orderkey, o_orderstatus, o_totalprice,
               CASE WHEN o_orderstatus = 'F' THEN 'none' ELSE o_orderpriority END AS priority
        FROM orders
    """),
    "per_file_head": Query(_head(100), _head_sql(100)),
    "per_file_head_deep": Query(_head(3_000), _head_sql(3_000)),
    "skip_corrupt_files": Query(skip_corrupt_files, f"""
        SELECT event_id, strftime(ts, {MICRO}) AS ts, event_type, value, props FROM events
    """),
    "zip_csv_scan": Query(zip_csv_scan, f"""
        SELECT c_custkey, c_name, c_nationkey, c_mktsegment, 'missing' AS note,
               CASE WHEN {_EVEN} THEN 'old' ELSE 'new' END AS layout FROM customer
    """),
    "zip_all_members": Query(zip_all_members, """
        SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 = 0 THEN 'part0.csv' ELSE 'part1.csv' END AS member FROM customer
    """),
    "unreadable_files": Query(unreadable_files, """
        SELECT DISTINCT 'good/event_type=' || event_type AS place, 'good' AS state FROM events
        UNION ALL SELECT 'bad', 'bad' WHERE EXISTS (SELECT 1 FROM events)
    """),
    "header_rejects": Query(header_rejects, f"""
        SELECT 'accepted rows' AS what, count(*) FILTER ({_EVEN}) AS row_count FROM customer
        UNION ALL
        SELECT 'rejected archives', count(DISTINCT CASE WHEN NOT ({_EVEN})
               THEN floor(c_custkey / {ROWS_PER_ARCHIVE}) END) FROM customer
    """),
    "layout_mapping": Query(layout_mapping, _layout_sql()),
    "month_files": Query(month_files, """
        WITH b AS (SELECT date_trunc('month', min(o_orderdate)) AS lo, date_trunc('month', max(o_orderdate)) AS hi FROM orders),
        m AS (SELECT strftime(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)), '%Y%m') AS month_key FROM b)
        SELECT month_key, 'JC-' || month_key || '-citibike-tripdata.csv.zip' AS file_name,
               (SELECT count(*) FROM orders WHERE strftime(o_orderdate, '%Y%m') = month_key) AS row_count
        FROM m
    """),
    "json_pages": Query(json_pages, _json_pages_sql()),
    "json_pages_resumed": Query(json_pages_resumed, _json_pages_sql()),
    "per_file_head_physical": Query(per_file_head_physical, _head_sql(25)),
    "archive_members": Query(archive_members, f"""
        SELECT DISTINCT CAST(c_custkey // {ROWS_PER_ARCHIVE} AS BIGINT) AS archive_no,
               'part' || unnest([0, 1]) || '.csv' AS member, true AS filled, true AS fine FROM customer
    """),
    "open_data_load": Query(open_data_load, f"""
        SELECT CAST(event_id AS VARCHAR) AS unique_key, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS created,
               event_type AS complaint_type, '{contracts.RECORD_SETS[0].resource_id}' AS resource_id FROM events
    """),
    "trip_ingest_report": Query(trip_ingest_report, """
        SELECT unnest(['fhv', 'fhvhv', 'green', 'yellow']) AS stream,
               unnest([0, 0, 0, (SELECT count(*) FROM orders)]) AS rows
    """),
    "open_json_records": Query(open_json_records, """
        SELECT event_id, json_extract_string(props, '$.k') AS k, 'absent' AS unique_key,
               replace(props, ' ', '') AS rest FROM events
    """),
    "page_of_orders": Query(page_of_orders, f"""
        SELECT o_orderkey, o_custkey, strftime(o_orderdate, {SECOND}) AS ordered
        FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 500 OFFSET 1500
    """),
    "numbered_pages": Query(numbered_pages, """
        SELECT event_id, row_no, CAST(row_no // 500 AS INTEGER) AS page_no FROM (
            SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS row_no FROM events)
    """),
    "union_field_sets": Query(union_field_sets, """
        SELECT 'customer' AS kind, c_custkey AS id, c_name AS name, c_mktsegment AS segment,
               CAST(NULL AS VARCHAR) AS since FROM customer
        UNION ALL
        SELECT 'supplier', s_suppkey, s_name, NULL, '2000-01-01 00:00:00' FROM supplier
    """),
    "file_report": Query(file_report, """
        SELECT stream, (SELECT count(*) FROM orders WHERE o_orderstatus = stream) AS rows
        FROM (SELECT DISTINCT o_orderstatus AS stream FROM orders UNION ALL SELECT 'none')
    """),
}
