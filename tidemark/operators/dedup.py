"""Keep one row per key or per payload."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.jsontext import canonical_json

_UNORDERED = (T.MapType, T.VariantType)


def newest_per_key(
    df: DataFrame, keys: Sequence[str], cursor: str, sequence: str | None = None
) -> DataFrame:
    """Keep the newest row per key; NULL key parts count as equal.

    Newest means the highest ``cursor``, then the highest load ``sequence``, then the
    highest remaining columns, so the survivor never depends on row placement. Spark
    drops the losers before the shuffle, so a hot key sends one row per task.
    """
    first = [cursor] + ([sequence] if sequence else [])
    others = [
        f.name
        for f in df.schema
        if f.name not in {*keys, *first} and not isinstance(f.dataType, _UNORDERED)
    ]
    order = [F.col(f"`{c}`").desc_nulls_last() for c in [*first, *others]]
    rank = F.row_number().over(Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def last_per_payload(
    df: DataFrame, payload: str, sequence: str, hash_as: str | None = None
) -> DataFrame:
    """Keep the last loaded row of each payload; rows without a payload all stay.

    Payloads are compared by their canonical text, through two hashes of it (192 bits
    together), so that long texts are neither sorted nor sent twice. ``hash_as`` keeps
    the md5 as a column. NULL payloads never equal each other and bypass the shuffle.
    """
    value = F.col(payload)
    md5_name = hash_as or "_md5"
    source = df.drop(md5_name)
    canon = canonical_json(value)
    present = source.where(value.isNotNull()).withColumns(
        {md5_name: F.md5(canon), "_check": F.xxhash64(canon)}
    )
    kept = newest_per_key(present, [md5_name, "_check"], sequence).drop("_check")
    absent = source.where(value.isNull()).withColumn(md5_name, F.lit(None).cast("string"))
    both = kept.unionByName(absent)
    return both if hash_as else both.drop(md5_name)
