"""Tables derived from a partitioned table, partition by partition.

A partition of a derived table depends on the partition of its source with the same values,
and on no other: rows with names joined on, or partial aggregates that are merged later. An
upsert gives each partition that it touches a new folder, so a derived partition is up to
date while the folder it was made from is still the source's. Loads need not hand on what
they touched, nothing is taken back or added twice, and partitions that a job has not made
before it died are found out of date by the next one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import folders
from tidemark.sinks import versions

#: Column of a derived table: a digest of the folder that its partition was made from, and of the stamp.
ORIGIN = "_origin"
# More partitions than this are looked up by join instead of by a list.
LISTED_PARTITIONS = 2_000

Values = tuple[str, ...]


def _values(folder: str) -> Values:
    """Partition values of a path that ends in ``a=1/b=x``, as text."""
    return tuple(unquote(part.split("=", 1)[1]) for part in folder.split("/"))


def partition_folders(spark: SparkSession, table: str) -> dict[Values, str]:
    """The folder of each partition of a table, by its values: a listing, no scan."""
    depth = len(versions.partition_columns(spark, table))
    places = {file.rsplit("/", 1)[0] for file in spark.table(table).inputFiles()}
    return {_values(unquote("/".join(place.rsplit("/", depth)[1:]))): place for place in places}


def _origins(rows: DataFrame, by: list[str], wanted: Mapping[Values, str]) -> DataFrame:
    """The partitions' values and origins, a row each."""
    data = [(*values, origin) for values, origin in wanted.items()]
    texts = rows.sparkSession.createDataFrame(data, ", ".join(f"`{c}` string" for c in [*by, ORIGIN]))
    return texts.select(*(F.col(f"`{c}`").cast(rows.schema[c].dataType).alias(c) for c in by), ORIGIN)


def _only(rows: DataFrame, by: list[str], parts: Iterable[Values], origins: DataFrame) -> DataFrame:
    """The rows of some partitions; the condition prunes folders."""
    parts = list(parts)
    if len(parts) > LISTED_PARTITIONS:
        return rows.join(origins, by, "left_semi")
    first = rows.where(F.col(f"`{by[0]}`").cast("string").isin(*{p[0] for p in parts}))
    if len(by) == 1:
        return first
    texts = F.struct(*(F.col(f"`{c}`").cast("string") for c in by))
    return first.where(texts.isin(*(F.struct(*map(F.lit, p)) for p in parts)))


def refresh(
    spark: SparkSession, source: str, target: str, derive: Callable[[DataFrame], DataFrame], stamp: str = "",
    by_row: bool = False,
) -> list[Values]:
    """Bring ``target`` up to date with the partitioned table ``source``; the partitions made anew.

    ``derive`` maps rows of whole partitions to rows that keep the partition columns, and
    must not mix partitions. ``stamp`` names everything else that the result depends on: when it changes,
    or the columns do, all partitions are made anew. Partitions that ``source`` has no more,
    and those that ``derive`` leaves without rows, are dropped. Each partition is written
    once, aside, and put in place as an upsert does it. An empty source gives an empty table.
    Partition values must not be null.

    With ``by_row`` the rows are dealt out to their folders before ``derive`` and not after
    it, so that the columns it adds are not sent along. It must then shuffle nothing: it
    looks at one row at a time, or joins what is broadcast.
    """
    by = versions.partition_columns(spark, source)
    if not by:
        raise ValueError(f"{source} has no partitions")
    versions.finish(spark, source)
    # Another session may have put other folders in place since this one last looked.
    spark.catalog.refreshTable(source)
    rows = spark.table(source)
    # A digest, since every row holds it.
    wanted = {
        values: hashlib.md5(f"{place}|{stamp}".encode()).hexdigest() for values, place in partition_folders(spark, source).items()
    }
    shape = derive(rows)
    kept = [c for c in shape.columns if c not in by]
    if missing := set(by).difference(shape.columns):
        raise ValueError(f"the derived rows lack {sorted(missing)}")
    if ORIGIN in kept:
        # The source is a derived table itself.
        kept.remove(ORIGIN)
    empty = shape.select(*(F.col(f"`{c}`") for c in kept), F.lit("").alias(ORIGIN), *(F.col(f"`{c}`") for c in by))
    known: dict[Values, str] = {}
    if spark.catalog.tableExists(target):
        versions.finish(spark, target)
        spark.catalog.refreshTable(target)
        columns = [(f.name, f.dataType) for f in spark.table(target).schema]
        if columns != [(f.name, f.dataType) for f in empty.schema] or versions.partition_columns(spark, target) != by:
            spark.sql(f"DROP TABLE {target}")
        else:
            told = spark.table(target).select(*(F.col(f"`{c}`").cast("string") for c in by), ORIGIN).distinct()
            known = {tuple(r[:-1]): r[-1] for r in told.collect()}
    if not spark.catalog.tableExists(target):
        versions.create_empty(spark, empty, target, by)

    stale = {values: origin for values, origin in wanted.items() if known.get(values) != origin}
    gone = known.keys() - wanted.keys()
    path = None
    if stale:
        origins = _origins(rows, by, stale)
        only = _only(rows, by, stale, origins)

        def whole(dealt: DataFrame) -> DataFrame:
            # The origins are a list of the driver's; a row each travels, not one for each row of the table.
            made = (derive(dealt) if by_row else dealt).drop(ORIGIN).join(F.broadcast(origins), by)
            return made.select(*(F.col(f"`{c}`") for c in empty.columns))

        path, _ = versions.build(only if by_row else derive(only).drop(ORIGIN), target, by, last=whole)
        made = {_values(folder) for folder in folders(spark, path, len(by))}
        gone |= (stale.keys() & known.keys()) - made
    for values in sorted(gone):
        pairs = ", ".join(f"`{c}`='{v}'" for c, v in zip(by, values, strict=True))
        spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({pairs})")
    if path:
        versions.publish(spark, target, path)
    return sorted(stale)
