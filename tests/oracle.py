"""Run a registered query in Spark and its SQL in DuckDB and compare all rows."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

from tidemark.catalog import QUERIES
from tidemark.catalog.base import TABLES


def _value(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 9)
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    named = [tuple(_value(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(named, key=repr)


def spark_rows(spark: SparkSession, name: str, sf_dir: str):
    df = QUERIES[name].run(spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for costly in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython"):
        if costly in plan:
            raise AssertionError(f"{name} plans {costly}")
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(name: str, sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    out = con.execute(QUERIES[name].sql)
    return _rows([d[0] for d in out.description], out.fetchall())


def difference(spark: SparkSession, name: str, sf_dir: str) -> str | None:
    (sc, sr), (dc, dr) = spark_rows(spark, name, sf_dir), duck_rows(name, sf_dir)
    if sc != dc:
        return f"columns {sc} != {dc}"
    if len(sr) != len(dr):
        return f"{len(sr)} rows != {len(dr)}"
    for a, b in zip(sr, dr, strict=True):
        if a != b:
            return f"{a} != {b}"
    return None
