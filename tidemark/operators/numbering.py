"""Exact row positions, pages and heads without one task seeing all rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import scratch_path

# monotonically_increasing_id: partition number above this bit, row below it.
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1
# Up to this many (partition, group) stretches are handled as a list.
LISTED_RUNS = 10_000
# Spark keeps at most this many rows per group before the shuffle of a row_number
# filter (spark.sql.optimizer.windowGroupLimitThreshold).
WINDOW_LIMIT = 1_000
# Up to here a page is cheaper as a top-k than as a full sort.
SHALLOW_ROWS = 100_000


def number_rows(
    df: DataFrame, order: Sequence[str], name: str = "row_no", within: Sequence[str] = (),
    spread_ties: bool = False,
) -> DataFrame:
    """Add each row's 0-based position in ``order``, counted anew in each ``within`` group.

    The rows are range-partitioned, sorted and written once to the shared folder. A
    group, even one with a third of all rows, is spread over many partitions; only
    the row count per partition travels through the driver. ``order`` should end in a
    unique key, since rows that tie on all of it stay in one partition. With
    ``spread_ties`` they are spread too, in the order they were read; this is for ``df``
    straight from files, where a repeated task reads its rows in the same order.
    """
    spark = df.sparkSession
    keys = [F.col(f"`{k}`").asc_nulls_first() for k in [*within, *order]]
    source = df
    if spread_ties:
        source = df.withColumn("_read", F.monotonically_increasing_id())
        keys.append(F.col("_read").asc())
    path = scratch_path(spark, "numbered")
    (
        source.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_read")
        .withColumn("_place", F.monotonically_increasing_id())
        .write.parquet(path)
    )
    schema = T.StructType([*df.schema.fields, T.StructField("_place", T.LongType())])
    rows = spark.read.schema(schema).parquet(path).withColumn(
        "_part", F.shiftright("_place", _ROW_BITS).cast("int")
    )

    groups = [F.col(f"`{k}`").alias(f"_g{i}") for i, k in enumerate(within)]
    runs = rows.groupBy("_part", *groups).agg(
        F.count("*").alias("_count"), F.min("_place").bitwiseAND(F.lit(_ROW_MASK)).alias("_first")
    )
    starts, few = _run_starts(runs, [f"_g{i}" for i in range(len(within))])
    same = [rows["_part"] == starts["_at"]]
    same += [rows[f"`{k}`"].eqNullSafe(starts[f"_g{i}"]) for i, k in enumerate(within)]
    placed = rows.join(F.broadcast(starts) if few else starts, reduce(Column.__and__, same))
    row_in_part = F.col("_place").bitwiseAND(F.lit(_ROW_MASK))
    return placed.select(
        *[rows[f"`{c}`"] for c in df.columns], (row_in_part + F.col("_start")).alias(name)
    )


def _run_starts(runs: DataFrame, groups: list[str]) -> tuple[DataFrame, bool]:
    """What to add to a row's place in its partition, per partition and group.

    A run is the stretch of one group inside one sorted partition. Few runs are summed
    up here, and can be broadcast. Many are summed up by Spark: only the row counts of
    whole partitions come to the driver, one number each.
    """
    spark = runs.sparkSession
    shape = T.StructType(
        [T.StructField("_at", T.IntegerType()), T.StructField("_start", T.LongType())]
        + [runs.schema[g] for g in groups]
    )
    listed = runs.limit(LISTED_RUNS + 1).collect()
    if len(listed) <= LISTED_RUNS:
        sizes: dict[int, int] = {}
        for run in listed:
            sizes[run["_part"]] = sizes.get(run["_part"], 0) + run["_count"]
        before = _sums_before(sizes)
        base: dict[tuple, int] = {}
        for run in listed:
            key = tuple(run[g] for g in groups)
            position = before[run["_part"]] + run["_first"]
            base[key] = min(position, base.get(key, position))
        starts = [
            (run["_part"], before[run["_part"]] - (base[key] if groups else 0), *key)
            for run in listed
            for key in [tuple(run[g] for g in groups)]
        ]
        return spark.createDataFrame(starts, shape), True

    sizes = dict(runs.groupBy("_part").agg(F.sum("_count")).collect())
    offsets = spark.createDataFrame(
        list(_sums_before(sizes).items()), "_part int, _before long"
    )
    # One row per partition; Spark knows its size and broadcasts it if that is small.
    at = runs.join(offsets, "_part").withColumn("_position", F.col("_before") + F.col("_first"))
    if not groups:
        return at.select(F.col("_part").alias("_at"), F.col("_before").alias("_start")), False
    bases = at.groupBy(*[F.col(g).alias(f"{g}_base") for g in groups]).agg(F.min("_position").alias("_base"))
    same = reduce(Column.__and__, [at[g].eqNullSafe(bases[f"{g}_base"]) for g in groups])
    return at.join(bases, same).select(
        F.col("_part").alias("_at"), (F.col("_before") - F.col("_base")).alias("_start"), *groups
    ), False


def _sums_before(sizes: dict[int, int]) -> dict[int, int]:
    before, total = {}, 0
    for part in sorted(sizes):
        before[part] = total
        total += sizes[part]
    return before


def pages(
    df: DataFrame, order: Sequence[str], page_size: int, within: Sequence[str] = ()
) -> DataFrame:
    """Add ``page_no`` and ``row_no`` to every row."""
    numbered = number_rows(df, order, "row_no", within)
    return numbered.withColumn("page_no", F.floor(F.col("row_no") / page_size).cast("int"))


def one_page(df: DataFrame, order: Sequence[str], page_no: int, page_size: int) -> DataFrame:
    """Page ``page_no`` (from 0) in ``order``."""
    first = page_no * page_size
    if first + page_size <= SHALLOW_ROWS:
        return df.orderBy(*order).offset(first).limit(page_size)
    numbered = number_rows(df, order, "_row_no")
    inside = (F.col("_row_no") >= first) & (F.col("_row_no") < first + page_size)
    return numbered.where(inside).orderBy("_row_no").drop("_row_no")


def head_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[str], n: int
) -> DataFrame:
    """The first ``n`` rows of each group in ``order``; ``n`` = 0 keeps all rows."""
    if n < 0:
        raise ValueError("n must not be negative")
    if n == 0:
        return df
    if n <= WINDOW_LIMIT:
        place = F.row_number().over(
            Window.partitionBy(*group).orderBy(*[F.col(f"`{c}`").asc_nulls_first() for c in order])
        )
        return df.withColumn("_n", place).where(F.col("_n") <= n).drop("_n")
    numbered = number_rows(df, order, "_n", within=group)
    return numbered.where(F.col("_n") < n).drop("_n")
