"""Session settings and the shared folder for data that must outlive one plan."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Settings the operators rely on for right results (not for speed).
_SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON key keeps its last value instead of making the text invalid.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

_made: list[str] = []


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the session settings that change results."""
    for key, value in _SEMANTIC_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Set one session option for the duration of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. A local master, where driver and
    executors are one process, may do without: then a folder below the warehouse serves.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None)
    if named:
        return qualified(spark, named.rstrip("/"))
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors share")
    return qualified(spark, spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch")


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system spelled out, as tasks outside Spark's readers need it."""
    name = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = name.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(name).toString()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this process put below the shared folder.

    Only once nothing reads it any more: many operators return a plan over it.
    """
    while _made:
        remove(spark, _made.pop())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder and all in it, if it is there."""
    name = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    name.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(name, True)


def exists(spark: SparkSession, path: str) -> bool:
    name = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return name.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(name)


def folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Names of the folders ``depth`` levels below a path, without hidden ones; none if it is not there."""
    if not exists(spark, path):
        return []
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(f.getPath().getName() for f in system.listStatus(top) if f.isDirectory())
    names = [n for n in names if not n.startswith((".", "_"))]
    if depth == 1:
        return names
    return [f"{n}/{below}" for n in names for below in folders(spark, f"{path}/{n}", depth - 1)]


def stored(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts its lineage.

    The files survive the loss of an executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_database(spark: SparkSession, label: str) -> str:
    """Create an empty database whose tables live below the shared folder."""
    name = f"{label}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, label)}'")
    return name
