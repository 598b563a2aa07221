"""Text helpers; all of them are column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_blank(col: Column) -> Column:
    """NULL or empty text (white space is not empty)."""
    return col.isNull() | (col == "")


def blank_to_null(df: DataFrame, *columns: str, trim: bool = False) -> DataFrame:
    """Turn empty text into NULL in the given, or all, text columns."""
    names = columns or tuple(f.name for f in df.schema if isinstance(f.dataType, T.StringType))
    if not names:
        return df
    value = (lambda c: F.trim(_named(c))) if trim else _named
    return df.withColumns({c: F.nullif(value(c), F.lit("")) for c in names})


def split_names(col: Column) -> Column:
    """``'a, b,,c '`` -> ``['a', 'b', 'c']``."""
    return F.filter(F.transform(F.split(col, ","), lambda v: F.trim(v)), lambda v: v != "")


def preview(df: DataFrame, column: str, length: int = 500) -> Column:
    """The first characters of a value; missing, empty, zero and false read ``NULL``."""
    kind = df.schema[column].dataType
    col = _named(column)
    if isinstance(kind, T.StringType):
        absent = is_blank(col)
    elif isinstance(kind, T.NumericType):
        absent = col.isNull() | (col == 0)
    elif isinstance(kind, T.BooleanType):
        absent = col.isNull() | ~col
    else:
        absent = col.isNull()
    return F.when(absent, "NULL").otherwise(F.left(col.cast("string"), F.lit(length)))


def last_segment(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def megabytes(size: Column) -> Column:
    return size / F.lit(1024 * 1024)


def _named(column: str) -> Column:
    return F.col(f"`{column}`")
