"""Which files to read: listings, with a cap where one is asked for, and names by month."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import contracts
from tidemark.functions.text import last_segment, megabytes
from tidemark.functions.times import months_between, parse_month
from tidemark.session import exists


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """``path``, ``name`` below the root, last segment and size; contents are not read."""
    return _list(spark, root, [root], glob)


def list_prefixes(spark: SparkSession, root: str, prefixes: Sequence[str]) -> DataFrame:
    """The same for names below the given prefixes only.

    Prefixes that are folders are listed alone instead of the whole root.
    """
    if all(p.endswith("/") for p in prefixes):
        folders = [f"{root.rstrip('/')}/{p}" for p in prefixes]
        found = [f for f in dict.fromkeys(folders) if exists(spark, f)]
        if not found:
            return _list(spark, root, [root], None).limit(0)
        return _list(spark, root, found, None)
    return _list(spark, root, [root], None)


def _list(spark: SparkSession, root: str, folders: list[str], glob: str | None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    base = _bare(root).rstrip("/") + "/"
    bare = F.regexp_replace("path", r"^[A-Za-z0-9]+:/+", "/")
    return reader.load(folders).select(
        "path",
        F.substring(bare, F.lit(len(base) + 1), F.length(bare)).alias("name"),
        last_segment(F.col("path")).alias("file_name"),
        F.col("length").alias("size"),
        megabytes(F.col("length")).alias("size_mb"),
    )


def _bare(path: str) -> str:
    return re.sub(r"^[A-Za-z0-9]+:/+", "/", path)


def capped_listing(
    listing: DataFrame, prefixes: Sequence[str], limit: int | None = None,
    suffix: str = ".parquet", looked_at: int | None = None,
) -> DataFrame:
    """The names with ``suffix``, prefix by prefix in the given order.

    ``limit`` keeps the first names only; ``looked_at`` considers, for each prefix, only its
    first names of any kind. Neither holds unless it is given.
    """
    if limit is not None and limit < 1:
        raise ValueError("limit must be at least 1")
    wanted = listing.select(
        "*", F.posexplode(F.array(*[F.lit(p) for p in prefixes])).alias("prefix_no", "prefix")
    ).where(F.col("name").startswith(F.col("prefix")))
    if looked_at is not None:
        place = F.row_number().over(Window.partitionBy("prefix_no").orderBy("name"))
        wanted = wanted.withColumn("_n", place).where(F.col("_n") <= looked_at).drop("_n")
    chosen = wanted.where(F.col("name").endswith(suffix)).orderBy("prefix_no", "name").drop("prefix")
    return chosen if limit is None else chosen.limit(limit)


def paths_of(listing: DataFrame) -> list[str]:
    """The paths of a capped listing, as arguments for one read."""
    return [r["path"] for r in listing.select("path").collect()]


def month_list(
    spark: SparkSession, start: str | None = None, end: str | None = None, months: int = 2
) -> DataFrame:
    """``month_key`` (yyyyMM) from ``start`` to ``end`` (YYYY-MM), both included.

    Without a range: ``months`` months from the first default month on.
    """
    if (start is None) != (end is None):
        raise ValueError("give both start and end, or neither")
    if start is None:
        first = F.to_date(F.lit(contracts.BIKE_FIRST_MONTH), "yyyyMM")
        return spark.range(max(months, 0)).select(
            F.date_format(F.add_months(first, F.col("id").cast("int")), "yyyyMM").alias("month_key")
        )
    bounds = spark.range(1).select(
        parse_month(F.lit(start)).alias("first"), parse_month(F.lit(end)).alias("last")
    )
    return month_keys(bounds, "first", "last")


def listed_months(listing: DataFrame) -> DataFrame:
    """``month_key`` (yyyyMM) of every archive in a listing, whatever its ending."""
    stem, _, tail = contracts.BIKE_ARCHIVE_STEM.partition("{month}")
    endings = "|".join(re.escape(e) for e in contracts.BIKE_ARCHIVE_ENDINGS)
    pattern = f"^{re.escape(stem)}([0-9]{{6}}){re.escape(tail)}(?:{endings})$"
    key = F.regexp_extract("file_name", pattern, 1)
    return listing.select(key.alias("month_key")).where("month_key <> ''").distinct()


def month_keys(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """All months between two date columns, one row each."""
    days = months_between(F.trunc(first, "month"), F.trunc(last, "month"))
    return bounds.select(F.explode(days).alias("month")).select(
        F.date_format("month", "yyyyMM").alias("month_key")
    )


def high_volume_files(spark: SparkSession, count: int) -> DataFrame:
    """File names of the first ``count`` months, rolling over into the next year."""
    first, _, rest = contracts.HIGH_VOLUME_FILE.partition("{year_month}")
    month = F.add_months(parse_month(F.lit(contracts.HIGH_VOLUME_FIRST_MONTH)), F.col("id").cast("int"))
    return spark.range(max(count, 0)).select(
        F.concat(F.lit(first), F.date_format(month, "yyyy-MM"), F.lit(rest)).alias("file_name")
    )


def pick_archives(listing: DataFrame, months: DataFrame) -> DataFrame:
    """One archive per month: of the possible endings the first that exists."""
    stem, _, tail = contracts.BIKE_ARCHIVE_STEM.partition("{month}")
    endings = F.array(*[F.lit(e) for e in contracts.BIKE_ARCHIVE_ENDINGS])
    wanted = months.select("month_key", F.posexplode(endings).alias("choice", "ending")).select(
        "month_key", "choice",
        F.concat(F.lit(stem), "month_key", F.lit(tail), "ending").alias("file_name"),
    )
    found = wanted.join(listing, "file_name")
    place = F.row_number().over(Window.partitionBy("month_key").orderBy("choice", "path"))
    return found.withColumn("_n", place).where("_n = 1").drop("_n", "choice")
