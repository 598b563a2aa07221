"""Parquet and CSV scans."""

from __future__ import annotations

import json
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.checks import require_rows
from tidemark.operators.numbering import head_per_group
from tidemark.operators.shape import union_all
from tidemark.sources.paths import open_file

_SCALARS = {
    "integer": T.LongType(),
    "number": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
}


def partitioned_scan(
    spark: SparkSession, root: str, glob: str, schema: T.StructType | None = None
) -> DataFrame:
    """Read a glob below a Hive-partitioned root and keep the partition columns."""
    reader = spark.read.option("basePath", root)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(f"{root}/{glob}")


def struct_from_json_schema(schema: str | dict) -> T.StructType:
    """JSON Schema properties -> Spark columns; every column may be NULL."""
    parsed = json.loads(schema) if isinstance(schema, str) else schema
    return T.StructType(
        [T.StructField(name, _json_type(spec), True) for name, spec in parsed["properties"].items()]
    )


def _json_type(spec: dict) -> T.DataType:
    kind = spec["type"]
    if isinstance(kind, list):
        kind = next(k for k in kind if k != "null")
    if kind == "string" and spec.get("format") == "date-time":
        return T.TimestampNTZType()
    if kind == "array":
        return T.ArrayType(_json_type(spec["items"]))
    if kind == "object":
        return struct_from_json_schema(spec)
    return _SCALARS[kind]


def union_files(spark: SparkSession, paths: Sequence[str], base_path: str | None = None) -> DataFrame:
    """One relation over several Parquet files; a column a file lacks is NULL there.

    One read with merged footers, unless the files disagree on a type: then one read
    per distinct schema, and the union widens (integer with double gives double).
    """
    def reader():
        made = spark.read.option("mergeSchema", "true")
        return made.option("basePath", base_path) if base_path else made

    try:
        return reader().parquet(*paths)
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
    groups: dict[str, list[str]] = {}
    for row in footers(spark, paths).collect():
        if row["problem"]:
            raise ValueError(f"{row['path']}: {row['problem']}")
        groups.setdefault(row["columns"], []).append(row["path"])
    return union_all([reader().parquet(*groups[columns]) for columns in sorted(groups)])


def footers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, columns, problem) of Parquet files, read from their footers in tasks.

    ``columns`` spells names and types; ``problem`` says why a file cannot be read.
    """

    def look(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq

        for batch in batches:
            columns, problems = [], []
            for path in batch.column(0).to_pylist():
                try:
                    with open_file(path) as file:
                        schema = pq.read_schema(file)
                    columns.append("; ".join(f"{f.name}: {f.type}" for f in schema))
                    problems.append(None)
                except (pa.ArrowInvalid, OSError) as error:
                    columns.append(None)
                    problems.append(str(error).splitlines()[0][:200])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(columns, pa.string()), pa.array(problems, pa.string())],
                names=["path", "columns", "problem"],
            )

    # Only listed here, folders too; the content column is not asked for.
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths)).select("path")
    return listed.mapInArrow(look, "path string, columns string, problem string")


def unreadable(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, reason) of the files that ``tolerant_scan`` has to leave out."""
    return footers(spark, paths).where("problem IS NOT NULL").select("path", F.col("problem").alias("reason"))


def head_per_file(df: DataFrame, order: Sequence[str], n: int, folder: bool = False) -> DataFrame:
    """The first ``n`` rows of every file in ``order``; 0 keeps all. ``df`` is a file scan.

    With ``folder`` the part files of one folder count as one file.
    """
    if n == 0:
        return df
    file = F.col("_metadata.file_path")
    tagged = df.withColumn("_file", F.regexp_replace(file, "/[^/]*$", "") if folder else file)
    return head_per_group(tagged, ["_file"], order, n).drop("_file")


def physical_head(df: DataFrame, n: int, folder: bool = False) -> DataFrame:
    """The first ``n`` rows of every Parquet file as they lie in it; 0 keeps all. ``df`` is a file scan.

    The scan numbers the rows of a file itself, so nothing is sorted, moved or copied. With
    ``folder`` the part files of one folder count as one file, in the order of their names; then
    the heads of the part files, and no other rows, are compared by where they lie.
    """
    if n < 0:
        raise ValueError("n must not be negative")
    if n == 0:
        return df
    file, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    heads = df.where(row < n)
    if not folder:
        return heads
    tagged = heads.withColumns({"_file": file, "_row": row, "_folder": F.regexp_replace(file, "/[^/]*$", "")})
    return head_per_group(tagged, ["_folder"], ["_file", "_row"], n).drop("_file", "_row", "_folder")


def footer_bounds(spark: SparkSession, paths: Sequence[str], column: str) -> DataFrame:
    """(path, rows, newest, known) of Parquet files, from their footers alone.

    ``newest`` is the largest value of a date or time column as a timestamp without a zone. It
    is ``known`` if every row group either says its largest value or has nothing but NULLs.
    """

    def look(batches):
        import datetime

        import pyarrow as pa
        import pyarrow.parquet as pq

        for batch in batches:
            rows, newest, known = [], [], []
            for path in batch.column(0).to_pylist():
                with open_file(path) as file:
                    footer = pq.ParquetFile(file).metadata
                names = [footer.schema.column(i).path for i in range(footer.num_columns)]
                best, sure = None, column in names
                for group in range(footer.num_row_groups) if sure else ():
                    part = footer.row_group(group)
                    told = part.column(names.index(column)).statistics
                    if told is not None and told.has_min_max:
                        value = told.max
                        if isinstance(value, datetime.datetime):
                            value = value.replace(tzinfo=None)
                        elif isinstance(value, datetime.date):
                            value = datetime.datetime(value.year, value.month, value.day)
                        else:
                            sure = False
                            break
                        best = value if best is None else max(best, value)
                    elif told is None or not told.has_null_count or told.null_count < part.num_rows:
                        sure = False
                        break
                rows.append(footer.num_rows)
                newest.append(best if sure else None)
                known.append(sure)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.int64()), pa.array(newest, pa.timestamp("us")), pa.array(known)],
                names=["path", "rows", "newest", "known"],
            )

    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths)).select("path")
    tables = listed.where(F.col("path").endswith(".parquet"))
    return tables.mapInArrow(look, "path string, rows long, newest timestamp_ntz, known boolean")


def tolerant_scan(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType, must_have_rows: bool = True
) -> DataFrame:
    """Read Parquet files and skip those that cannot be read; ``unreadable`` lists them.

    The schema has to be given, since it cannot be inferred from a broken file.
    """
    df = (
        spark.read.schema(schema)
        .option("ignoreCorruptFiles", "true")
        .option("ignoreMissingFiles", "true")
        .parquet(*paths)
    )
    return require_rows(df) if must_have_rows else df


def csv_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; every value stays text (``N/A`` too), empty is NULL."""
    return spark.read.option("header", "true").csv(path)


def csv_inferred(spark: SparkSession, path: str, na: str = "N/A") -> DataFrame:
    """CSV with a header; types are inferred and the NA word is NULL."""
    return (
        spark.read.option("header", "true").option("inferSchema", "true").option("nullValue", na).csv(path)
    )


def csv_typed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and a fixed schema, for seeds and specified streams."""
    return spark.read.option("header", "true").option("enforceSchema", "false").schema(schema).csv(path)


def literal_relation(spark: SparkSession, **values: object) -> DataFrame:
    """One row of constants: ``literal_relation(spark, id=1, message="hello")``."""
    return spark.range(1).select(*[F.lit(v).alias(name) for name, v in values.items()])


def relation(spark: SparkSession, name: str, schema: str = "raw") -> DataFrame:
    """A table of a layer by name."""
    return spark.table(f"{schema}.`{name}`")
