"""Registered queries for checks, inventories and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.base import SECOND, TABLES, Query, double, second_text, table
from tidemark.functions.keys import composite_key
from tidemark.functions.text import last_segment, megabytes, preview, split_names
from tidemark.functions.times import is_iso, iso_text, month_key, or_now, parse_iso, parse_month
from tidemark.operators.checks import (
    blank_counts,
    column_listing,
    compare_counts,
    inventory,
    kept_and_dropped,
    reconcile,
    row_count,
    sample_rows,
    table_counts,
    verify_count,
)
from tidemark.operators.shape import between, names_like, rejected_fields, stage_json, stage_json_checked, union_all
from tidemark.session import scratch_database, stored
from tidemark.sinks.tables import replace_measured, replace_table
from tidemark.streaming.watermarks import newest_in_files

_CUSTOMER = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
_LINE_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
    "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}


def quality_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    limit = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    return kept_and_dropped(table(spark, sf_dir, "orders"), F.col("o_orderdate") < limit)


def required_column_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank values per customer column, the segment being emptied for one in three."""
    emptied = F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_mktsegment"))
    return blank_counts(table(spark, sf_dir, "customer").withColumn("c_mktsegment", emptied), _CUSTOMER)


def table_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_counts({name: table(spark, sf_dir, name) for name in TABLES})


def layer_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of a schema with counts, after writing three and verifying one."""
    database = scratch_database(spark, "layer")
    for name in ("orders", "customer", "nation"):
        replace_table(table(spark, sf_dir, name), f"{database}.{name}")
    expected = row_count(table(spark, sf_dir, "orders")).head()["row_count"]
    verify_count(spark.table(f"{database}.orders"), expected)
    return inventory(spark, database)


def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns in order with type and blank values."""
    lines = table(spark, sf_dir, "lineitem")
    blanks = blank_counts(lines, lines.columns)
    long = blanks.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"{c}_blank").alias("blank")) for c in lines.columns])
        ).alias("c")
    ).select("c.*")
    return column_listing(lines).join(long, "column_name").select("ordinal", "column_name", "data_type", "blank")


def sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return sample_rows(pages.withColumn("html", preview(pages, "html")), ["page_id", "url", "html"], ["page_id"])


def page_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page: first 500 characters, last part of its address, size."""
    pages = table(spark, sf_dir, "pages")
    return pages.select(
        "page_id", preview(pages, "html").alias("shown"), last_segment(F.col("url")).alias("last_part"),
        F.round(megabytes(F.octet_length("html").cast("double")), 9).alias("size_mb"),
    )


def count_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_counts(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"))


def reconcile_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against the order keys of their lines."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_key"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_key"))
    return reconcile(orders, lines, ["order_key"])


def reconcile_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' order totals against a rebuilt table in which some totals moved."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice")
    moved = orders.withColumn(
        "o_totalprice", F.when(F.col("o_custkey") % 7 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    )
    return reconcile(orders, moved, ["o_custkey"], "o_totalprice").select(
        "o_custkey", "left_rows", "right_rows", double("left_amount").alias("left_amount"),
        double("right_amount").alias("right_amount"), "status",
    )


def time_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = iso_text(F.col("o_orderdate"))
    broken = F.when(F.col("o_orderkey") % 2 == 0, text).otherwise(F.date_format("o_orderdate", "yyyy-MM"))
    parsed = parse_iso(broken)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        month_key(F.col("o_orderdate")).alias("month_key"),
        F.date_format(parse_month(F.date_format("o_orderdate", "yyyy-MM")), "yyyy-MM-dd").alias("month_start"),
        is_iso(broken).alias("is_iso"),
        F.coalesce(second_text(parsed), F.lit("none")).alias("parsed"),
        second_text(F.col("o_orderdate") - F.expr("INTERVAL 7 DAYS")).alias("week_before"),
        second_text(F.col("o_orderdate") + F.expr("INTERVAL 90 DAYS") - F.expr("INTERVAL 1 SECOND")).alias("slice_end"),
        (or_now(parsed) >= F.col("o_orderdate")).alias("not_before"),
    )


def key_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        composite_key("o_custkey", "o_orderstatus", "o_orderpriority").alias("key"), "o_orderkey"
    )


def names_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comma lists split, trimmed and without blanks, counted by entry."""
    joined = F.concat_ws(", ", F.col("p_name"), F.lit(""), F.col("p_brand"), F.lit("  "), F.col("p_type"))
    names = table(spark, sf_dir, "part").select(F.explode(split_names(joined)).alias("name"))
    return names.groupBy("name").agg(F.count("*").alias("row_count"))


def name_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    return names_like(parts, "p_name", ["%ring%", "blue%"], ["red ring", "blue bolt"])


def cursor_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = (F.lit(t).cast("timestamp_ntz") for t in ("1996-01-01 00:00:00", "1996-03-31 23:59:59"))
    rows = between(table(spark, sf_dir, "orders"), "o_orderdate", start, end)
    return rows.orderBy("o_orderdate", "o_orderkey").select("o_orderkey", second_text("o_orderdate").alias("ordered"))


def _raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw JSON built from customers; odd balances are not numbers."""
    balance = F.when(F.col("c_custkey") % 5 == 0, "n/a").otherwise(F.concat(F.lit(" "), "c_custkey", F.lit(" ")))
    return table(spark, sf_dir, "customer").select(
        F.to_json(
            F.struct(
                F.col("c_custkey").cast("string").alias("id"), F.concat(F.lit("  "), "c_mktsegment").alias("segment"),
                balance.alias("balance"), F.lit("").alias("note"),
            )
        ).alias("payload")
    )


_RAW_TYPES = {"id": "bigint", "segment": "string", "balance": "bigint", "note": "string"}


def typed_staging_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of the raw customers did not fit its type, with the share of rows counted in the pass that wrote them."""
    seen = Observation()
    staged = stored(stage_json_checked(_raw_customers(spark, sf_dir), "payload", _RAW_TYPES, seen), "staged")
    counted = seen.get
    return rejected_fields(staged, ["id"]).withColumns(
        {"rejected": F.lit(counted["rejected"]), "rows": F.lit(counted["rows"])}
    )


def observed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers landed with their rows and blanks counted by the write itself, beside what the table has."""
    name = f"{scratch_database(spark, 'observed')}.customer"
    emptied = F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_mktsegment"))
    rows = table(spark, sf_dir, "customer").withColumn("c_mktsegment", emptied)
    seen = replace_measured(rows, name, guard=True, required=["c_name", "c_mktsegment"])
    there = spark.table(name).agg(F.count("*").alias("row_count"))
    return there.withColumns({c: F.lit(n) for c, n in seen.items()})


def watermark_from_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest cursor and rows of three tables, from their files' footers."""
    cursors = {"events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate"}
    found = [newest_in_files(spark, [f"{sf_dir}/{name}.parquet"], cursor, name) for name, cursor in cursors.items()]
    return union_all(found)


def reconcile_fine_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances against a rebuilt table in which some moved by a thousandth."""
    balance = (F.col("c_custkey") % 100 * 0.001).alias("balance")
    customers = table(spark, sf_dir, "customer").select("c_custkey", balance)
    moved = customers.withColumn("balance", F.when(F.col("c_custkey") % 11 == 0, F.col("balance") + 0.001).otherwise(F.col("balance")))
    return reconcile(customers, moved, ["c_custkey"], "balance").select("c_custkey", "status")


def typed_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw customers, cleaned and typed."""
    typed = stage_json(_raw_customers(spark, sf_dir), "payload", _RAW_TYPES)
    return typed.select(
        "id", "segment", F.coalesce("balance", F.lit(-1)).alias("balance"),
        F.coalesce("note", F.lit("missing")).alias("note"),
    )


_BLANK = ", ".join(
    f"count(*) FILTER ({'c_custkey % 3 = 0' if c == 'c_mktsegment' else f'{c} IS NULL'}) AS {c}_blank"
    for c in _CUSTOMER
)
_PROFILE = " UNION ALL ".join(
    f"SELECT {i} AS ordinal, '{c}' AS column_name, '{t}' AS data_type, count(*) FILTER ({c} IS NULL) AS blank FROM lineitem"
    for i, (c, t) in enumerate(_LINE_TYPES.items(), 1)
)

QUERIES = {
    "quality_cutoff": Query(quality_cutoff, """
        SELECT count(*) FILTER (o_orderdate < TIMESTAMP '1998-01-01') AS kept,
               count(*) FILTER (o_orderdate >= TIMESTAMP '1998-01-01') AS dropped FROM orders
    """),
    "required_column_check": Query(
        required_column_check, f"SELECT count(*) AS row_count, {_BLANK} FROM customer"
    ),
    "table_inventory": Query(table_inventory, " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES
    )),
    "layer_inventory": Query(layer_inventory, " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in ("customer", "nation", "orders")
    )),
    "column_listing": Query(column_profile, _PROFILE),
    "sample_rows": Query(sample, """
        SELECT page_id, url, left(html, 500) AS html FROM pages ORDER BY page_id LIMIT 3
    """),
    "page_preview": Query(page_preview, """
        SELECT page_id, CASE WHEN html IS NULL OR html = '' THEN 'NULL' ELSE left(html, 500) END AS shown,
               regexp_extract(url, '[^/]*$') AS last_part,
               round(strlen(html) / 1048576.0, 9)::DOUBLE AS size_mb FROM pages
    """),
    "count_comparison": Query(count_comparison, """
        SELECT l AS left_rows, r AS right_rows, l - r AS difference
        FROM (SELECT (SELECT count(*) FROM lineitem) AS l, (SELECT count(*) FROM orders) AS r)
    """),
    "reconcile_tables": Query(reconcile_tables, """
        WITH l AS (SELECT o_orderkey AS k, count(*) AS n FROM orders GROUP BY 1),
             r AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1)
        SELECT coalesce(l.k, r.k) AS order_key, coalesce(l.n, 0) AS left_rows, coalesce(r.n, 0) AS right_rows,
               CASE WHEN r.n IS NULL THEN 'left only' WHEN l.n IS NULL THEN 'right only'
                    WHEN l.n <> r.n THEN 'count differs' ELSE 'same' END AS status
        FROM l FULL JOIN r ON l.k = r.k
    """),
    "reconcile_amounts": Query(reconcile_amounts, """
        WITH s AS (SELECT o_custkey, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS a,
                          sum(CAST(CASE WHEN o_custkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS DECIMAL(18,2))) AS b
                   FROM orders GROUP BY 1)
        SELECT o_custkey, n AS left_rows, n AS right_rows, CAST(a AS DOUBLE) AS left_amount,
               CAST(b AS DOUBLE) AS right_amount, CASE WHEN a <> b THEN 'amount differs' ELSE 'same' END AS status
        FROM s
    """),
    "time_functions": Query(time_functions, f"""
        SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS month_key,
               strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month_start,
               o_orderkey % 2 = 0 AS is_iso,
               CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, {SECOND}) ELSE 'none' END AS parsed,
               strftime(o_orderdate - INTERVAL 7 DAY, {SECOND}) AS week_before,
               strftime(o_orderdate + INTERVAL 90 DAY - INTERVAL 1 SECOND, {SECOND}) AS slice_end,
               true AS not_before
        FROM orders
    """),
    "key_functions": Query(key_functions, """
        SELECT concat_ws('|', o_custkey, o_orderstatus, o_orderpriority) AS key, o_orderkey FROM orders
    """),
    "names_list": Query(names_list, """
        SELECT name, count(*) AS row_count FROM (
            SELECT unnest([p_name, p_brand, p_type]) AS name FROM part) GROUP BY 1
    """),
    "name_patterns": Query(name_patterns, """
        SELECT p_partkey, p_name, p_brand FROM part
        WHERE (p_name LIKE '%ring%' OR p_name LIKE 'blue%') AND p_name NOT IN ('red ring', 'blue bolt')
    """),
    "cursor_range": Query(cursor_range, f"""
        SELECT o_orderkey, strftime(o_orderdate, {SECOND}) AS ordered FROM orders
        WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '1996-03-31 23:59:59'
    """),
    "typed_staging_rejects": Query(typed_staging_rejects, """
        SELECT c_custkey AS id, 'balance' AS field, 'n/a' AS raw, count(*) OVER () AS rejected,
               (SELECT count(*) FROM customer) AS rows FROM customer WHERE c_custkey % 5 = 0
    """),
    "observed_load": Query(observed_load, """
        SELECT count(*) AS row_count, count(*) AS rows, count(*) FILTER (c_name IS NULL OR c_name = '') AS c_name_blank,
               count(*) FILTER (c_custkey % 3 = 0 OR c_mktsegment IS NULL OR c_mktsegment = '') AS c_mktsegment_blank
        FROM customer
    """),
    "watermark_from_footers": Query(watermark_from_footers, """
        SELECT 'events' AS source_name, strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS last_value, count(*) AS row_count FROM events
        UNION ALL SELECT 'orders', strftime(max(o_orderdate), '%Y-%m-%dT%H:%M:%S'), count(*) FROM orders
        UNION ALL SELECT 'lineitem', strftime(max(l_shipdate), '%Y-%m-%dT%H:%M:%S'), count(*) FROM lineitem
    """),
    "reconcile_fine_amounts": Query(reconcile_fine_amounts, """
        SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN 'amount differs' ELSE 'same' END AS status FROM customer
    """),
    "typed_staging": Query(typed_staging, """
        SELECT c_custkey AS id, c_mktsegment AS segment,
               CASE WHEN c_custkey % 5 = 0 THEN -1 ELSE c_custkey END AS balance, 'missing' AS note
        FROM customer
    """),
}
