"""Projection, filtering and typing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import contracts


def project(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Select columns under new names: ``{new: old}``."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in mapping.items()])


def required(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where the given columns are not NULL. Empty text passes."""
    return df.where(reduce(Column.__and__, [F.col(f"`{c}`").isNotNull() for c in columns]))


def cast_all(df: DataFrame, types: Mapping[str, str | T.DataType]) -> DataFrame:
    """Give columns a type; a value that does not fit becomes NULL."""
    return df.withColumns({c: F.col(f"`{c}`").try_cast(t) for c, t in types.items()})


def with_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def bikes_to_old_layout(df: DataFrame) -> DataFrame:
    """New-layout bike trips under the old column names; what is missing is NULL."""
    have = set(df.columns)

    def column(old: str) -> Column:
        new = contracts.BIKE_NEW_TO_OLD.get(old)
        if new in have:
            return F.nullif(F.col(new).cast("string"), F.lit("")).alias(old)
        return F.lit(None).cast("string").alias(old)

    return df.select(*[column(c) for c in contracts.BIKE_OLD_COLUMNS])


def bike_layout(columns: Sequence[str]) -> str:
    """``old``, ``new`` or ``rejected``; the old layout must match in order too."""
    if tuple(columns) == contracts.BIKE_OLD_COLUMNS:
        return "old"
    return "new" if contracts.BIKE_NEW_MARKER in columns else "rejected"


def between(df: DataFrame, cursor: str, start: Column, end: Column) -> DataFrame:
    """Rows with ``start <= cursor <= end``."""
    return df.where((F.col(cursor) >= start) & (F.col(cursor) <= end))


def before(df: DataFrame, cursor: str, limit: Column) -> DataFrame:
    """Rows before the reliability limit; rows without a time are dropped."""
    return df.where(F.col(cursor) < limit)


def parse_records(
    df: DataFrame, payload: str, fields: Sequence[str] = contracts.OPEN_DATA_FIELDS
) -> DataFrame:
    """Open-schema records: known fields as text, the whole record as ``_rest``."""
    shape = T.StructType([T.StructField(name, T.StringType()) for name in fields])
    others = [c for c in df.columns if c not in fields]
    parsed = df.withColumn("_fields", F.from_json(payload, shape))
    return parsed.select(
        *[f"`{c}`" for c in others],
        *[F.col(f"_fields.`{name}`").alias(name) for name in fields if name not in df.columns],
        *[F.col(name) for name in fields if name in df.columns],
        F.try_parse_json(payload).alias("_rest"),
    )


def stage_json(df: DataFrame, payload: str, types: Mapping[str, str]) -> DataFrame:
    """Clean typed columns from raw JSON: extract, trim, empty to NULL, cast.

    The text is parsed once for all fields.
    """
    shape = T.StructType([T.StructField(name, T.StringType()) for name in types])
    cleaned = {
        name: F.nullif(F.trim(F.col(f"_fields.`{name}`")), F.lit("")).try_cast(kind)
        for name, kind in types.items()
    }
    return df.withColumn("_fields", F.from_json(payload, shape)).withColumns(cleaned).drop("_fields")


def stage_json_checked(
    df: DataFrame, payload: str, types: Mapping[str, str], seen: Observation | None = None
) -> DataFrame:
    """``stage_json`` that drops nothing silently: ``_rejects`` lists what did not fit its type.

    Each entry has the ``field`` and the ``raw`` text, cleaned of outer blanks only; a payload
    that is no JSON object is one entry with the field ``*``. The list is empty, not NULL, for a row
    without any. ``seen`` counts, in the pass that uses the rows, all of them (``rows``) and
    those with a reject (``rejected``).
    """
    shape = T.StructType([T.StructField(name, T.StringType()) for name in types])
    wide = df.withColumn("_fields", F.from_json(payload, shape)).withColumn("_whole", F.try_parse_json(payload))
    texts = {name: F.nullif(F.trim(F.col(f"_fields.`{name}`")), F.lit("")) for name in types}
    entry = "struct<field:string,raw:string>"

    def reject(when: Column, field: str, raw: Column) -> Column:
        return F.when(when, F.struct(F.lit(field).alias("field"), raw.alias("raw")).cast(entry))

    unfit = [reject(text.isNotNull() & text.try_cast(types[name]).isNull(), name, F.col(f"_fields.`{name}`")) for name, text in texts.items()]
    is_object = F.coalesce(F.schema_of_variant("_whole").startswith("OBJECT"), F.lit(False))
    unfit.append(reject(F.col(payload).isNotNull() & ~is_object, "*", F.col(payload)))
    checked = wide.withColumn("_rejects", F.filter(F.array(*unfit), lambda r: r.isNotNull()))
    typed = checked.withColumns({name: text.try_cast(types[name]) for name, text in texts.items()}).drop("_fields", "_whole")
    if seen is None:
        return typed
    return typed.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.size("_rejects") > 0).alias("rejected"))


def rejected_fields(staged: DataFrame, keep: Sequence[str]) -> DataFrame:
    """One row for each reject of ``stage_json_checked``: the columns to know it by, field and raw text."""
    return staged.where(F.size("_rejects") > 0).select(*keep, F.inline("_rejects"))


def names_like(names: DataFrame, column: str, patterns: Sequence[str], but: Sequence[str] = ()) -> DataFrame:
    """Names matching any LIKE pattern, apart from the listed ones."""
    hit = reduce(Column.__or__, [F.col(column).like(p) for p in patterns])
    return names.where(hit & ~F.col(column).isin(*but)) if but else names.where(hit)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column that one frame lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
