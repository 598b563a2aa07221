"""What a registered query is: a Spark function, and SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Run = Callable[[SparkSession, str], DataFrame]

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
LINE_KEY = ("l_orderkey", "l_linenumber")
LINE_REST = (
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
)


class Query(NamedTuple):
    run: Run
    sql: str | None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def second_text(col: str | Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


def micro_text(col: str | Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def day_text(col: str | Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd")


# The same in DuckDB.
SECOND = "'%Y-%m-%d %H:%M:%S'"
MICRO = "'%Y-%m-%d %H:%M:%S.%f'"
DAY = "'%Y-%m-%d'"


def double(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("double")


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as zones, regions as boroughs."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("string").alias("location_id"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone_name"),
    )


def trips(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Order lines as trips from the supplier's to the customer's nation.

    Customers are joined to the orders, which are far fewer than the lines.
    """
    lines = table(spark, sf_dir, "lineitem") if lines is None else lines
    orders = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice",
            F.col("s_nationkey").cast("bigint").alias("pulocationid"),
            F.col("c_nationkey").cast("bigint").alias("dolocationid"),
        )
    )


TRIPS_SQL = """
    SELECT l.*, s.s_nationkey AS pu, c.c_nationkey AS do_
    FROM {lines} l JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN supplier s ON l.l_suppkey = s.s_suppkey
    JOIN customer c ON o.o_custkey = c.c_custkey
"""
ZONES_SQL = "SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey"


def newest_lines_sql(keys: tuple[str, ...]) -> str:
    """Lines kept by key, newest ship date first, then the highest other columns."""
    rest = [c for c in (*LINE_KEY, *LINE_REST) if c not in keys]
    # Schema order: the key columns that are not part of the key come first.
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ["l_shipdate", *rest])
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} "
        f"ORDER BY {order}) AS rn FROM lineitem) WHERE rn = 1"
    )
