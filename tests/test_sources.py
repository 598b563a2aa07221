import json
import zipfile

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark import contracts
from tidemark.catalog import reading
from tidemark.operators.checks import DataCheckError
from tidemark.session import setting
from tidemark.sources import archives, files, listing, paged_json
from tidemark.sources.paths import portable
from tidemark.streaming.slices import date_slices, slice_list


# -- Parquet and CSV ------------------------------------------------------------
def test_partition_columns_survive_a_glob(spark, tmp_path, rows):
    root = f"file://{tmp_path}"
    df = spark.createDataFrame([(1, 2019, 1), (2, 2019, 2)], "v int, puYear int, puMonth int")
    df.write.partitionBy("puYear", "puMonth").parquet(f"{root}/yellow")
    got = files.partitioned_scan(spark, root, "yellow/puYear=*/puMonth=*/*.parquet")
    assert rows(got.select("v", "puYear", "puMonth")) == [(1, 2019, 1), (2, 2019, 2)]
    plan = got.where("puMonth = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(puMonth" in plan


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    spark.range(10).withColumn("t", F.lit("x")).write.parquet(f"{tmp_path}/p")
    plan = spark.read.parquet(f"{tmp_path}/p").where("id >= 5").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThanOrEqual(id,5)]" in plan
    assert "ReadSchema: struct<id:bigint>" in plan


def test_json_schema_types():
    schema = files.struct_from_json_schema(
        json.dumps(
            {
                "type": "object",
                "properties": {
                    "a": {"type": "integer"}, "b": {"type": "number"}, "c": {"type": ["null", "string"]},
                    "d": {"type": "string", "format": "date-time"}, "e": {"type": "boolean"},
                    "f": {"type": "array", "items": {"type": "object", "properties": {"g": {"type": "string"}}}},
                },
            }
        )
    )
    assert schema.simpleString() == (
        "struct<a:bigint,b:double,c:string,d:timestamp_ntz,e:boolean,f:array<struct<g:string>>>"
    )
    for stream in contracts.TRIP_STREAMS.values():
        columns = {c.lower() for c in files.struct_from_json_schema(stream.json_schema).names}
        assert set(stream.key) <= columns and stream.cursor in stream.key


def test_files_with_other_columns_and_types(spark, tmp_path, rows):
    a, b, c = (f"{tmp_path}/{n}" for n in "abc")
    spark.createDataFrame([(1, "x")], "v int, s string").write.parquet(a)
    spark.createDataFrame([(2,)], "v int").write.parquet(b)
    spark.createDataFrame([(2.5,)], "v double").write.parquet(c)
    assert rows(files.union_files(spark, [a, b])) == [(1, "x"), (2, None)]
    assert rows(files.union_files(spark, [a, b, c])) == [(1.0, "x"), (2.0, None), (2.5, None)]


@pytest.mark.parametrize("folder", [False, True])
def test_head_per_file(spark, tmp_path, rows, folder):
    for name, start in (("a", 0), ("b", 100)):
        spark.range(start, start + 10).coalesce(1).write.parquet(f"{tmp_path}/{name}")
    df = spark.read.parquet(f"{tmp_path}/a", f"{tmp_path}/b")
    assert rows(files.head_per_file(df, ["id"], 2, folder)) == [(0,), (1,), (100,), (101,)]
    assert files.head_per_file(df, ["id"], 0).count() == 20


def test_broken_files_are_skipped(spark, tmp_path):
    good, bad = tmp_path / "good", tmp_path / "bad.parquet"
    spark.range(5).write.parquet(str(good))
    bad.write_bytes(b"not parquet at all")
    schema = spark.range(1).schema
    assert files.tolerant_scan(spark, [str(good), str(bad)], schema).count() == 5
    with pytest.raises(DataCheckError):
        files.tolerant_scan(spark, [str(bad)], schema)
    assert files.tolerant_scan(spark, [str(bad)], schema, must_have_rows=False).count() == 0


def test_csv_as_text_and_inferred(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text('LocationID,Borough\n1,"A, B"\n2,N/A\n3,\n')
    text = files.csv_text(spark, str(path)).collect()
    assert [tuple(r) for r in text] == [("1", "A, B"), ("2", "N/A"), ("3", None)]
    inferred = files.csv_inferred(spark, str(path))
    assert dict(inferred.dtypes)["LocationID"] == "int"
    assert [r["Borough"] for r in inferred.collect()] == ["A, B", None, None]


def test_literal_relation(spark, rows):
    made = files.literal_relation(spark, id=1, message="hello")
    assert made.columns == ["id", "message"] and rows(made) == [(1, "hello")]


# -- listings -------------------------------------------------------------------
def _touch(root, *names):
    for name in names:
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x" * 1024)


def test_capped_listing(spark, tmp_path):
    _touch(tmp_path, "y/m=1/b.parquet", "y/m=1/a.parquet", "y/m=1/c.txt", "y/m=2/a.parquet", "z/a.parquet")
    found = listing.list_files(spark, f"file://{tmp_path}")
    names = lambda **k: [r["name"] for r in listing.capped_listing(found, ["y/m=2/", "y/m=1/"], **k).collect()]
    assert names(limit=2) == ["y/m=2/a.parquet", "y/m=1/a.parquet"]
    assert names(limit=9) == ["y/m=2/a.parquet", "y/m=1/a.parquet", "y/m=1/b.parquet"]
    assert names(limit=9, looked_at=1) == ["y/m=2/a.parquet", "y/m=1/a.parquet"]
    assert found.head()["size_mb"] == 1 / 1024
    with pytest.raises(ValueError):
        listing.capped_listing(found, ["y/"], limit=0)


def test_names_looked_at_per_prefix(spark, tmp_path):
    _touch(tmp_path, *[f"p/{i:03d}.txt" for i in range(101)], "p/200.parquet", "p/201.parquet")
    found = listing.list_files(spark, f"file://{tmp_path}")
    names = lambda **k: [r["name"] for r in listing.capped_listing(found, ["p/"], **k).collect()]
    assert names(limit=5, looked_at=102) == ["p/200.parquet"]
    assert names() == ["p/200.parquet", "p/201.parquet"], "no cap unless one is asked for"
    assert listing.list_prefixes(spark, f"file://{tmp_path}", ["none/"]).count() == 0


@pytest.mark.parametrize(
    ("start", "end", "expected"),
    [
        ("2019-11", "2020-02", ["201911", "201912", "202001", "202002"]),
        ("2020-02", "2020-02", ["202002"]),
        ("2020-03", "2020-02", []),
        (None, None, ["201901", "201902"]),
    ],
)
def test_month_list(spark, start, end, expected):
    assert sorted(r[0] for r in listing.month_list(spark, start, end).collect()) == expected


def test_month_list_needs_both_ends(spark):
    with pytest.raises(ValueError):
        listing.month_list(spark, start="2020-01")
    assert listing.month_list(spark, months=1).count() == 1
    assert [r[0] for r in listing.month_list(spark, months=14).collect()][-2:] == ["202001", "202002"]


def test_high_volume_files_roll_over(spark):
    names = sorted(r[0] for r in listing.high_volume_files(spark, 12).collect())
    assert names[0] == "fhvhv_tripdata_2019-02.parquet" and names[-1] == "fhvhv_tripdata_2020-01.parquet"
    assert listing.high_volume_files(spark, 0).count() == 0


def test_first_existing_ending_wins(spark, tmp_path):
    stem = "JC-{}-citibike-tripdata"
    _touch(tmp_path, stem.format("201901") + ".csv.zip", stem.format("201901") + ".zip", stem.format("201902") + ".zip")
    got = listing.pick_archives(listing.list_files(spark, str(tmp_path)), listing.month_list(spark, "2019-01", "2019-03"))
    assert sorted(r["file_name"] for r in got.collect()) == [
        "JC-201901-citibike-tripdata.csv.zip", "JC-201902-citibike-tripdata.zip",
    ]


# -- archives -------------------------------------------------------------------
def make_zip(path, members):
    with zipfile.ZipFile(path, "w") as pack:
        for name, text in members:
            pack.writestr(name, text)


OLD = ",".join(contracts.BIKE_OLD_COLUMNS)


@pytest.fixture
def bike_zips(tmp_path):
    line = ",".join(f"v{i}" for i in range(15))
    make_zip(tmp_path / "old.zip", [("__MACOSX/x.csv", "bad"), ("a.csv", f"{OLD}\n{line}\n\n"), ("b.csv", f"{OLD}\nno\n")])
    make_zip(tmp_path / "new.zip", [("a.csv", 'started_at,ride_id,end_lat,unknown\n"2021, x",r1,,u\n2021,r2\n2022,r3,4,5,6,7\n')])
    make_zip(tmp_path / "moved.zip", [("a.csv", ",".join(contracts.BIKE_OLD_COLUMNS[::-1]) + "\n" + line)])
    make_zip(tmp_path / "other.zip", [("a.csv", "x,y\n1,2\n")])
    make_zip(tmp_path / "nothing.zip", [("readme.txt", "hi")])
    make_zip(tmp_path / "headless.zip", [("a.csv", "")])
    make_zip(tmp_path / "blank.zip", [("a.csv", f"\n{OLD}\n{line}\n")])
    (tmp_path / "fake.zip").write_bytes(b"no zip")
    return tmp_path


def test_archives(spark, bike_zips, monkeypatch):
    monkeypatch.setattr(archives, "ROWS_PER_BATCH", 2)
    read = archives.bike_archive_rows(listing.list_files(spark, str(bike_zips), "*.zip")).cache()
    got = archives.accepted(read).collect()
    old = [r for r in got if r["_layout"] == "old"]
    old.sort(key=lambda r: r["tripduration"], reverse=True)
    assert [r["tripduration"] for r in old] == ["v0", "no"] and old[0]["gender"] == "v14", "of both members"
    new = sorted((r["bikeid"], r["starttime"], r["end station latitude"], r["gender"]) for r in got if r["_layout"] == "new")
    assert new == [("r1", "2021, x", None, None), ("r2", "2021", None, None), ("r3", "2022", "4", None)]
    reasons = {r["_archive"].rsplit("/", 1)[1]: r["reason"] for r in archives.rejects(read).collect()}
    assert reasons == {
        "moved.zip": "header", "other.zip": "header", "headless.zip": "header", "blank.zip": "header",
        "nothing.zip": "no csv", "fake.zip": "not a zip",
    }
    read.unpersist()


def test_one_task_per_member(spark, bike_zips):
    read = archives.bike_archive_rows(listing.list_files(spark, str(bike_zips), "*.zip"))
    used = read.select(F.spark_partition_id().alias("p"), "_archive").distinct().groupBy("p").count()
    # Eight archives, one of them with two members.
    assert used.count() == 9 and used.agg(F.max("count")).head()[0] == 1


# -- pages ----------------------------------------------------------------------
def source_of(records):
    """A fetch over records of (moment, id), as the remote side would answer."""
    def fetch(start, end, limit, offset):
        inside = sorted(r for r in records if start <= r[0] <= end)
        return [{"at": t, "id": i} for t, i in inside[offset:offset + limit]]

    return fetch


@pytest.mark.parametrize(("size", "readers"), [(1, 1), (1, 4), (2, 3), (3, 1), (7, 2), (100, 4)])
def test_all_pages_of_all_slices(spark, size, readers):
    records = [(f"2023-01-{d:02d}T00:00:00", f"{d}-{k}") for d in range(1, 11) for k in range(d % 4)]
    slices = slice_list(date_slices(spark, "2023-01-01T00:00:00", "2023-01-10T00:00:00", days=3))
    got = paged_json.read_pages(spark, source_of(records), slices, size, readers).collect()
    assert sorted(json.loads(r["payload"])["id"] for r in got) == sorted(i for _, i in records)
    assert {r["slice_no"] for r in got} == {0, 1, 2, 3}
    per_page = {}
    for r in got:
        per_page[r["slice_no"], r["page_no"]] = per_page.get((r["slice_no"], r["page_no"]), 0) + 1
    assert max(per_page.values()) <= size


def test_pages_keep_cursor_order_and_stop_on_a_short_page(spark):
    records = [(f"2023-01-01T00:00:{i:02d}", str(i)) for i in range(4)]
    df = paged_json.read_pages(spark, source_of(records), [(0, "2023-01-01T00:00:00", "2023-01-01T23:59:59")], 2, readers=1)
    assert [(r["page_no"], json.loads(r["payload"])["id"]) for r in df.collect()] == [(0, "0"), (0, "1"), (1, "2"), (1, "3")]
    assert df.rdd.getNumPartitions() == 1
    assert paged_json.read_pages(spark, source_of([]), [], 2).count() == 0


def test_only_existing_prefix_folders_are_listed(spark, tmp_path):
    _touch(tmp_path, "y/m=1/a.parquet", "y/m=2/a.parquet", "z/a.parquet")
    names = lambda *p: sorted(r["name"] for r in listing.list_prefixes(spark, f"file://{tmp_path}", p).collect())
    assert names("y/m=1/", "y/m=9/") == ["y/m=1/a.parquet"]
    assert names("y/m") == ["y/m=1/a.parquet", "y/m=2/a.parquet", "z/a.parquet"]


def test_all_members_are_read_and_damage_is_told(spark, tmp_path):
    import zipfile

    header = ",".join(f'"{c}"' for c in contracts.BIKE_OLD_COLUMNS)
    row = ",".join(f"v{i}" for i in range(len(contracts.BIKE_OLD_COLUMNS)))
    with zipfile.ZipFile(tmp_path / "two.zip", "w") as made:
        made.writestr("a.csv", f"{header}\n{row}\n")
        made.writestr("b.csv", f"{header}\n{row}\n{row}\n")
        made.writestr("c.csv", f"{header}\n{row},damaged here\n")
    raw = (tmp_path / "two.zip").read_bytes()
    (tmp_path / "two.zip").write_bytes(raw.replace(b"damaged here", b"damaged HERE"))
    read = archives.bike_archive_rows(listing.list_files(spark, str(tmp_path), "*.zip"))
    assert sorted(r["_member"] for r in archives.accepted(read).collect()) == ["a.csv", "b.csv", "b.csv"]
    assert [(r["_member"], r["reason"]) for r in archives.rejects(read).collect()] == [("c.csv", "damaged")]


@pytest.mark.parametrize(
    ("uri", "name"),
    [
        ("s3a://b/x.zip", "s3://b/x.zip"),
        ("s3n://b/x.zip", "s3://b/x.zip"),
        ("wasbs://c@a.blob.core.windows.net/x", "abfss://c@a.dfs.core.windows.net/x"),
        ("abfss://c@a.dfs.core.windows.net/x", "abfss://c@a.dfs.core.windows.net/x"),
        ("dbfs:/x/y", "/dbfs/x/y"),
        ("hdfs://n:8020/x", "hdfs://n:8020/x"),
        ("file:/x/y", "/x/y"),
        ("file:///x/y", "/x/y"),
        ("/x/y:z", "/x/y:z"),
    ],
)
def test_paths_for_arrow(uri, name):
    assert portable(uri) == name


def test_unreadable_files_are_listed(spark, tmp_path):
    spark.range(3).coalesce(1).write.parquet(f"{tmp_path}/good")
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_bytes(b"no parquet")
    found = files.unreadable(spark, [f"{tmp_path}/good", f"{tmp_path}/bad"]).collect()
    assert [r["path"].rsplit("/", 2)[1:] for r in found] == [["bad", "x.parquet"]] and found[0]["reason"]


def test_members_are_planned_from_the_directory_and_read_apart(spark, tmp_path, monkeypatch):
    import zipfile

    for number in range(2):
        with zipfile.ZipFile(tmp_path / f"{number}.zip", "w", zipfile.ZIP_DEFLATED) as made:
            for at in range(3):
                made.writestr(f"p{at}.csv", "a,b\n" + "".join(f"{number},{at}-{i}\n" for i in range(50)))
            made.writestr("readme.txt", "no table")
    (tmp_path / "none.zip").write_bytes(b"nothing")
    with zipfile.ZipFile(tmp_path / "empty.zip", "w") as made:
        made.writestr("__MACOSX/x.csv", "a")
    listed = listing.list_files(spark, str(tmp_path), "*.zip")
    planned = archives.members(listed).collect()
    assert sorted((r.problem or "", r.member or "") for r in planned) == sorted(
        [("", f"p{at}.csv") for at in range(3)] * 2 + [("not a zip", ""), ("no csv", "")]
    )
    assert {r["size"] for r in planned if r.member} == {len("a,b\n" + "".join(f"0,0-{i}\n" for i in range(50)))}
    for held in (1 << 20, 0):
        monkeypatch.setattr(archives, "HELD_BYTES", held)
        read = archives.zipped_csv(listed, "path", ("a", "b"))
        tagged = read.where("_member IS NOT NULL").withColumn("task", F.spark_partition_id())
        placed = tagged.groupBy("_archive", "_member").agg(
            F.count_distinct("task").alias("tasks"), F.min("task").alias("task"), F.count("*").alias("n")
        ).collect()
        assert len(placed) == 6 and {r.tasks for r in placed} == {1} and {r.n for r in placed} == {50}
        assert len({r.task for r in placed}) == 6, "a task for each member"


def test_damage_at_the_end_of_a_member_takes_all_of_it(spark, tmp_path, monkeypatch):
    import zipfile

    path = tmp_path / "x.zip"
    with zipfile.ZipFile(path, "w") as made:
        made.writestr("a.csv", "a,b\n" + "1,2\n" * 20_000)
        made.writestr("b.csv", "a,b\n3,4\n")
    raw = bytearray(path.read_bytes())
    at = raw.index(b"1,2\n" * 100) + 79_000
    raw[at : at + 1] = b"9"
    path.write_bytes(raw)
    for held in (1 << 20, 0):
        monkeypatch.setattr(archives, "HELD_BYTES", held)
        read = archives.zipped_csv(listing.list_files(spark, str(tmp_path), "*.zip"), "path", ("a", "b"))
        assert sorted((r._member, r._layout, r.a) for r in read.collect()) == [("a.csv", "damaged", None), ("b.csv", "old", "3")]


def test_physical_heads_move_nothing(spark, tmp_path):
    path = str(tmp_path / "heads")
    for first in (5, 1):
        spark.range(first * 1000, first * 1000 + 300).coalesce(1).orderBy(F.desc("id")).write.mode("append").option(
            "parquet.block.size", 1024
        ).parquet(path)
    df = files.physical_head(spark.read.parquet(path), 2)
    assert sorted(r[0] for r in df.collect()) == [1298, 1299, 5298, 5299]
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert files.physical_head(spark.read.parquet(path), 0).count() == 600
    with pytest.raises(ValueError):
        files.physical_head(df, -1)


def test_physical_heads_of_folders_follow_their_part_files(spark, tmp_path):
    path = str(tmp_path / "parts")
    spark.range(40).select((F.col("id") % 2).alias("g"), "id").repartitionByRange(8, F.desc("id")).sortWithinPartitions(
        "g", F.desc("id")
    ).write.partitionBy("g").parquet(path)
    read = spark.read.parquet(path)
    for n in (1, 7, 2_000):
        got = sorted((r.g, r.id) for r in files.physical_head(read, n, folder=True).collect())
        assert got == sorted((g, i) for g in (0, 1) for i in range(38 + g, -1, -2)[:n])
    assert files.physical_head(read, 0, folder=True).columns == files.physical_head(read, 3, folder=True).columns == ["id", "g"]


def test_lines_of_one_number_are_written_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(reading, "scratch_path", lambda *_: str(tmp_path / "written"))
    lines = spark.range(400).select(
        F.col("id").alias("l_orderkey"), F.when(F.col("id") % 10 == 0, None).otherwise(F.lit(1)).alias("l_linenumber"),
        *[F.lit(k).alias(c) for k, c in enumerate(("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"))],
        F.lit("R").alias("l_returnflag"), F.lit("F").alias("l_linestatus"),
        F.lit("1995-01-01").cast("timestamp_ntz").alias("l_shipdate"),
    )
    lines.union(lines.where("l_orderkey < 3")).write.parquet(f"{tmp_path}/lineitem.parquet")
    with setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        got = reading.per_file_head_physical(spark, str(tmp_path)).collect()
    keys = {n: sorted(r.l_orderkey for r in got if r.l_linenumber == n) for n in (1, None)}
    ones = sorted([1, 2, *(i for i in range(400) if i % 10)])
    assert keys == {1: ones[:25], None: [0, *range(0, 240, 10)]}
    sizes = [pq.read_metadata(f).num_rows for f in (tmp_path / "written" / "l_linenumber=1").glob("*.parquet")]
    assert sum(sizes) == 362 and max(sizes) < 200


def test_footers_tell_the_newest_cursor(spark, tmp_path):
    def write(name, rows, kind="timestamp_ntz"):
        df = spark.createDataFrame([(r,) for r in rows], "t string").select(F.col("t").cast(kind).alias("t"))
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}")
        return f"{tmp_path}/{name}"

    paths = [
        write("a", ["2024-01-01 00:00:00", "2024-03-01 12:30:00.5", None]), write("b", [None, None]), write("c", []),
        write("d", ["2024-02-01"], "date"),
    ]
    got = {r["path"].split("/")[-2]: (r["rows"], str(r["newest"])[:19], r["known"]) for r in files.footer_bounds(spark, paths, "t").collect()}
    # A writer without rows may leave no file at all.
    got.pop("c", None)
    assert got == {"a": (3, "2024-03-01 12:30:00", True), "b": (2, "None", True), "d": (1, "2024-02-01 00:00:00", True)}
    other = write("e", ["x"], "string")
    assert [r["known"] for r in files.footer_bounds(spark, [other], "t").collect()] == [False]
    assert [r["known"] for r in files.footer_bounds(spark, [other], "missing").collect()] == [False]
