from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.session import scratch_database
from tidemark.streaming import increments, live, slices, watermarks
from tidemark.functions.times import ntz, slice_number


# -- slices ---------------------------------------------------------------------
def shown(df):
    cols = ["slice_start", "slice_end", "next_start"]
    return [tuple(str(v) for v in r) for r in df.orderBy("slice_no").select(*cols).collect()]


def test_ninety_day_slices(spark):
    got = shown(slices.date_slices(spark, "2023-01-01T00:00:00", "2023-06-30T23:59:59"))
    assert got == [
        ("2023-01-01 00:00:00", "2023-03-31 23:59:59", "2023-04-01 00:00:00"),
        ("2023-04-01 00:00:00", "2023-06-29 23:59:59", "2023-06-30 00:00:00"),
        ("2023-06-30 00:00:00", "2023-06-30 23:59:59", "2023-07-01 00:00:00"),
    ]


def test_slice_edges(spark):
    one = slices.date_slices(spark, "2023-01-01T00:00:00", "2023-01-01T00:00:00")
    assert shown(one) == [("2023-01-01 00:00:00",) * 2 + ("2023-01-01 00:00:01",)]
    assert slices.date_slices(spark, "2023-01-02T00:00:00", "2023-01-01T00:00:00").count() == 0
    assert slices.date_slices(spark, "2023-01-01T00:00:00").count() > 10, "open end is now"


def test_slices_have_no_gap_and_no_overlap(spark):
    start, end = "2023-01-01T00:00:00", "2023-01-20T12:00:00"
    made = slices.date_slices(spark, start, end, days=3).collect()
    moments = spark.range(0, 2 * 24 * 21).select(
        (ntz(start) + F.make_dt_interval(mins=(F.col("id") * 30).cast("int"), secs=F.lit(0.5))).alias("t")
    )
    parts = [slices.in_slice(moments, "t", F.lit(s["slice_start"]), F.lit(s["next_start"])) for s in made]
    total = moments.where(F.col("t") < F.lit(made[-1]["next_start"])).count()
    assert sum(p.count() for p in parts) == total
    for s, part in zip(made, parts, strict=True):
        numbers = part.select(slice_number("t", ntz(start), 3)).distinct().collect()
        assert [n[0] for n in numbers] == [s["slice_no"]]


# -- watermarks -----------------------------------------------------------------
@pytest.fixture
def store(spark):
    return watermarks.create_store(spark, scratch_database(spark, "marks"))


def put(spark, store, *values):
    watermarks.advance(spark, store, spark.createDataFrame(list(values), "source_name string, last_value string"))


def test_watermark_never_moves_back(spark, store):
    assert watermarks.last_value(spark, store, "a") is None
    put(spark, store, ("a", "2023-01-02T00:00:00"), ("b", "2023-01-01T00:00:00"))
    put(spark, store, ("a", "2023-01-01T00:00:00"))
    assert watermarks.last_value(spark, store, "a") == "2023-01-02T00:00:00"
    put(spark, store, ("a", "2023-01-03T00:00:00"))
    got = watermarks.watermarks(spark, store).orderBy("source_name").collect()
    assert [(r["source_name"], r["last_value"]) for r in got] == [
        ("a", "2023-01-03T00:00:00"), ("b", "2023-01-01T00:00:00"),
    ]
    assert all(r["updated_at"] is not None for r in got)


def test_no_rows_no_watermark(spark, store):
    empty = spark.createDataFrame([], "t timestamp_ntz")
    watermarks.advance(spark, store, watermarks.newest_values(empty, "t", "a"))
    assert watermarks.watermarks(spark, store).count() == 0


# -- increments -----------------------------------------------------------------
def events(spark, *days, value="v"):
    return spark.createDataFrame(
        [(i, datetime(2023, 1, 1) + timedelta(days=d), value) for i, d in days], "id int, t timestamp_ntz, v string"
    )


def test_lookback_bound_is_included(spark):
    df = spark.createDataFrame(
        [(1, datetime(2023, 1, 8)), (2, datetime(2023, 1, 7, 23, 59, 59)), (3, datetime(2023, 1, 15))], "id int, t timestamp_ntz"
    )
    got = increments.since(df, "t", "2023-01-15T00:00:00")
    assert sorted(r["id"] for r in got.collect()) == [1, 3]
    assert increments.since(df, "t", None).count() == 3


def test_lookback_reaches_the_scan(spark, tmp_path):
    events(spark, (1, 0)).write.parquet(f"{tmp_path}/e")
    plan = increments.since(spark.read.parquet(f"{tmp_path}/e"), "t", "2023-01-15T00:00:00")
    assert "GreaterThanOrEqual(t,2023-01-08T00:00)" in plan._jdf.queryExecution().executedPlan().toString()


def test_late_rows_within_seven_days_are_caught(spark, store):
    table = store.replace("_watermarks", "events")
    load = lambda df: increments.load_increment(df, "e", table, ("id", "t"), "t", store)
    load(events(spark, (1, 0), (2, 20)))
    late = events(spark, (1, 0), (2, 20), (3, 14), (4, 12), (5, 21))
    assert sorted(r["id"] for r in load(late).collect()) == [1, 2, 3, 5], "12 is more than 7 days before 20"
    assert sorted(r["id"] for r in load(late).collect()) == [1, 2, 3, 5]
    assert watermarks.last_value(spark, store, "e") == "2023-01-22T00:00:00"


def test_slices_resume_after_a_failure(spark, store):
    source = events(spark, *[(i, i) for i in range(10)])
    seen: list[int] = []

    def write(rows, number, fail_at=2):
        if number == fail_at:
            raise RuntimeError("lost")
        seen.append((number, rows.count()))

    args = (source, "s", "t", store, "2023-01-01T00:00:00", "2023-01-10T00:00:00")
    with pytest.raises(RuntimeError):
        increments.load_slices(*args, write, days=3)
    assert seen == [(0, 3), (1, 3)]
    assert increments.load_slices(*args, lambda r, n: write(r, n, None), days=3) == 2
    assert seen == [(0, 3), (1, 3), (2, 3), (3, 1)]
    assert increments.load_slices(*args, write, days=3) == 0


# -- streams --------------------------------------------------------------------
def test_stream_and_batch_dedup_agree(spark, tmp_path, rows):
    schema = events(spark, (1, 0)).schema
    feeds = [
        events(spark, (1, 0), (2, 6), (2, 6)),
        events(spark, (1, 0), (2, 6), (3, 9)),
        events(spark, (3, 9), (4, 30)),
        events(spark, (5, 24), (6, 10)),
    ]
    for feed in feeds:
        feed.write.mode("append").parquet(f"{tmp_path}/in")
        stream = live.drop_repeats(live.file_stream(spark, f"{tmp_path}/in", schema), ["id"], "t")
        live.run_to_files(stream, f"{tmp_path}/out", f"{tmp_path}/state")
    got = sorted(r["id"] for r in spark.read.schema(schema).parquet(f"{tmp_path}/out").collect())
    assert got == [1, 2, 3, 4, 5], "6 came more than seven days late"


def test_stream_upserts_survive_replay(spark, tmp_path):
    schema = events(spark, (1, 0)).schema
    table = f"{scratch_database(spark, 'live')}.events"
    for feed in (events(spark, (1, 0), (2, 1)), events(spark, (2, 1), (3, 40), value="w")):
        feed.write.mode("append").parquet(f"{tmp_path}/in")
        live.run_upserts(live.file_stream(spark, f"{tmp_path}/in", schema), table, ("id", "t"), "t", f"{tmp_path}/c")
    expected = [(1, "v"), (2, "w"), (3, "w")]
    assert sorted((r["id"], r["v"]) for r in spark.table(table).collect()) == expected
    live.run_upserts(live.file_stream(spark, f"{tmp_path}/in", schema), table, ("id", "t"), "t", f"{tmp_path}/other")
    assert sorted((r["id"]) for r in spark.table(table).collect()) == [1, 2, 3]


def test_lookback_prunes_month_folders(spark, tmp_path):
    df = spark.createDataFrame(
        [(datetime(2018, 12, 1), 2018, 12), (datetime(2019, 1, 30), 2019, 1), (datetime(2019, 2, 5), 2019, 2)],
        "t timestamp_ntz, y int, m int",
    )
    df.write.partitionBy("y", "m").parquet(f"{tmp_path}/e")
    got = increments.since(spark.read.parquet(f"{tmp_path}/e"), "t", "2019-02-05T00:00:00", months=("y", "m"))
    assert got.count() == 2
    scanned = {f.split("/y=")[1].split("/part")[0] for f in got.inputFiles()}
    plan = got._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "y#" in filters and "m#" in filters and scanned


# -- watermarks from footers, compaction -------------------------------------------
def test_newest_in_files_scans_only_where_footers_are_silent(spark, tmp_path):
    rows = spark.sql("SELECT * FROM VALUES (timestamp_ntz'2024-01-05 10:00:00', 1), (NULL, 2) AS v(t, n)")
    rows.coalesce(1).write.parquet(f"{tmp_path}/told")
    with_text = rows.select(F.lit("2024-05-01T00:00:00").alias("t"), "n")
    with_text.coalesce(1).write.parquet(f"{tmp_path}/text")
    spark.range(3).withColumnRenamed("id", "n").write.parquet(f"{tmp_path}/without")
    newest = lambda *names: tuple(watermarks.newest_in_files(spark, [f"{tmp_path}/{n}" for n in names], "t", "s").head())
    assert newest("told") == ("s", "2024-01-05T10:00:00", 2)
    assert newest("text") == ("s", "2024-05-01T00:00:00", 2)
    assert newest("told", "without")[1:] == ("2024-01-05T10:00:00", 5)


def test_a_long_log_is_folded_without_losing_an_advance(spark, store, monkeypatch):
    marks = spark.range(1000).select(
        (F.col("id") % 7).cast("string").alias("source_name"),
        F.date_format(F.timestamp_seconds(F.col("id") * 3600), "yyyy-MM-dd'T'HH:mm:ss").alias("last_value"),
        F.timestamp_seconds(F.col("id")).alias("updated_at"),
    )
    marks.repartition(100).write.mode("append").insertInto(store)
    put(spark, store, ("3", "1999-01-01T00:00:00"))
    before = sorted(map(tuple, watermarks.watermarks(spark, store).collect()))
    real = watermarks.stored

    def meanwhile(df, label):
        folded = real(df, label)
        put(spark, store, ("late", "2030-01-01T00:00:00"), ("3", "2031-01-01T00:00:00"))
        return folded

    monkeypatch.setattr(watermarks, "stored", meanwhile)
    assert watermarks.compact(spark, store) >= 100
    after = {r[0]: r[1] for r in watermarks.watermarks(spark, store).collect()}
    assert after == {**{r[0]: r[1] for r in before}, "late": "2030-01-01T00:00:00", "3": "2031-01-01T00:00:00"}
    monkeypatch.setattr(watermarks, "stored", real)
    assert watermarks.compact(spark, store) == 2 and len(spark.table(store).inputFiles()) == 1
    again = sorted(map(tuple, watermarks.watermarks(spark, store).collect()))
    assert [r for r in again if r[0] not in ("3", "late")] == [r for r in before if r[0] != "3"], "when it was reached stays too"
    assert watermarks.compact(spark, store) == 0
