"""Counts, uniqueness, inventories and reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

from tidemark.functions.text import is_blank


class DataCheckError(ValueError):
    """A table does not meet its contract."""


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


def blank_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and NULL-or-empty values of every given column, in one pass."""
    text = {c: F.col(f"`{c}`").cast("string") for c in columns}
    return df.agg(
        F.count("*").alias("row_count"),
        *[F.count_if(is_blank(text[c])).alias(f"{c}_blank") for c in columns],
    )


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; a key with a NULL part may repeat."""
    present = reduce(Column.__and__, [F.col(f"`{k}`").isNotNull() for k in keys])
    return (
        df.where(present).groupBy(*keys).agg(F.count("*").alias("row_count")).where("row_count > 1")
    )


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    bad = key_violations(df, keys).limit(3).collect()
    if bad:
        raise DataCheckError(f"{list(keys)} repeat, for example {[tuple(r) for r in bad]}")


def require_rows(df: DataFrame) -> DataFrame:
    """Stop before a table is replaced by nothing."""
    if df.isEmpty():
        raise DataCheckError("no rows were loaded")
    return df


def require_some(rows: int, what: str) -> int:
    """The same once the rows are counted."""
    if not rows:
        raise DataCheckError(f"no rows were loaded for {what}")
    return rows


def verify_count(written: DataFrame, expected: int) -> int:
    found = written.count()
    if found != expected:
        raise DataCheckError(f"{found} rows were written, {expected} were expected")
    return found


def kept_and_dropped(df: DataFrame, keep: Column) -> DataFrame:
    """How many rows a quality filter keeps and drops (unknown counts as dropped)."""
    keeps = F.coalesce(keep, F.lit(False))
    return df.agg(F.count_if(keeps).alias("kept"), F.count_if(~keeps).alias("dropped"))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count, as one job."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def inventory(spark: SparkSession, database: str) -> DataFrame:
    """Every table of a database with its row count, by name."""
    names = sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)
    if not names:
        return spark.createDataFrame([], "table_name string, row_count long")
    return table_counts({n: spark.table(f"{database}.`{n}`") for n in names}).orderBy("table_name")


def column_listing(df: DataFrame) -> DataFrame:
    """Position, name and type of every column."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema, 1)]
    return df.sparkSession.createDataFrame(
        rows, "ordinal int, column_name string, data_type string"
    ).orderBy("ordinal")


def sample_rows(df: DataFrame, columns: Sequence[str], order: Sequence[str], n: int = 3) -> DataFrame:
    return df.orderBy(*order).limit(n).select(*[f"`{c}`" for c in columns])


def load_report(tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """Rows loaded per stream; a stream without data reads 0."""
    spark = SparkSession.active()
    empty = spark.createDataFrame([], "x int")
    named = {name: empty if df is None else df for name, df in tables.items()}
    return table_counts(named).select(F.col("table_name").alias("stream"), F.col("row_count").alias("rows"))


def compare_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Row counts of two tables side by side, in one job."""
    sides = left.select(F.lit(1).alias("_l"), F.lit(0).alias("_r")).union(
        right.select(F.lit(0), F.lit(1))
    )
    totals = sides.agg(
        F.coalesce(F.sum("_l"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("_r"), F.lit(0)).alias("right_rows"),
    )
    return totals.withColumn("difference", F.col("left_rows") - F.col("right_rows"))


def reconcile(
    left: DataFrame, right: DataFrame, keys: Sequence[str], amount: str | None = None
) -> DataFrame:
    """Row counts (and a summed amount) per key on both sides.

    Whole numbers and decimals are summed as they are, other numbers as decimals of nine
    places, so that the sum does not depend on the order of the rows.

    Both sides are tagged and grouped once instead of being joined: rows are combined
    before the only shuffle, so a hot key costs no more than any other, and NULL keys
    meet each other.
    """
    def amount_type(df: DataFrame) -> str:
        kind = df.select(F.col(amount)).schema[0].dataType if amount else None
        return kind.simpleString() if isinstance(kind, (DecimalType, IntegralType)) else "decimal(38,9)"

    # Both sides in one type, the finer one where they differ.
    kinds = {amount_type(left), amount_type(right)}
    kind = kinds.pop() if len(kinds) == 1 else "decimal(38,9)"

    def side(df: DataFrame, is_left: bool) -> DataFrame:
        value = F.col(amount) if amount else F.lit(None)
        cols = [F.col(f"`{k}`") for k in keys]
        value = value.cast(kind)
        nothing = F.lit(None).cast(kind)
        return df.select(
            *cols,
            F.lit(1 if is_left else 0).alias("_l"),
            F.lit(0 if is_left else 1).alias("_r"),
            (value if is_left else nothing).alias("_la"),
            (nothing if is_left else value).alias("_ra"),
        )

    grouped = side(left, True).union(side(right, False)).groupBy(*keys).agg(
        F.sum("_l").alias("left_rows"),
        F.sum("_r").alias("right_rows"),
        F.sum("_la").alias("left_amount"),
        F.sum("_ra").alias("right_amount"),
    )
    status = (
        F.when(F.col("right_rows") == 0, "left only")
        .when(F.col("left_rows") == 0, "right only")
        .when(~F.col("left_amount").eqNullSafe(F.col("right_amount")), "amount differs")
        .when(F.col("left_rows") != F.col("right_rows"), "count differs")
        .otherwise("same")
    )
    result = grouped.withColumn("status", status)
    return result if amount else result.drop("left_amount", "right_amount")
