import uuid

import pytest
from pyspark.sql import functions as F

from tidemark import contracts
from tidemark.operators.checks import DataCheckError, inventory
from tidemark.operators.shape import with_constants
from tidemark.session import scratch_database
from tidemark.sinks import tables, versions

KEY = ("k", "t")


def trips(spark, data):
    df = spark.createDataFrame(data, "k int, t string, v string")
    return df.withColumn("t", F.col("t").cast("timestamp_ntz"))


@pytest.fixture
def table(spark):
    return f"{scratch_database(spark, 'sink')}.t{uuid.uuid4().hex[:6]}"


def content(df):
    return sorted((r["k"], str(r["t"])[:10], r["v"]) for r in df.collect())


def test_replace_and_append(spark, table, rows):
    tables.replace_table(spark.range(3), table)
    assert tables.replace_table(spark.range(2), table).count() == 2
    assert tables.append_table(spark.range(2), table).count() == 4


def test_guard_leaves_the_target_alone(spark, table):
    tables.replace_table(spark.range(3), table)
    with pytest.raises(DataCheckError):
        tables.replace_table(spark.range(0), table, guard=True)
    assert spark.table(table).count() == 3


def test_upsert_rewrites_only_touched_months(spark, table):
    first = trips(spark, [(1, "2020-01-05", "a"), (1, "2020-01-05", "a"), (2, "2020-02-01", "b"), (3, "2020-03-01", "c")])
    tables.upsert(first, table, KEY, "t", 1)
    files = lambda: {f for f in spark.table(table).inputFiles() if "202002" not in f}
    untouched = files()
    again = trips(spark, [(2, "2020-02-01", "B"), (4, "2020-02-09", "d")])
    got = tables.upsert(again, table, KEY, "t", 2)
    expected = [(1, "2020-01-05", "a"), (2, "2020-02-01", "B"), (3, "2020-03-01", "c"), (4, "2020-02-09", "d")]
    assert content(got) == expected
    assert files() == untouched
    assert content(tables.upsert(again, table, KEY, "t", 3)) == expected, "a second time changes nothing"


def test_older_load_never_wins(spark, table):
    tables.upsert(trips(spark, [(1, "2020-01-05", "a")]), table, KEY, "t", 5)
    got = tables.upsert(trips(spark, [(1, "2020-01-05", "z")]), table, KEY, "t", 4)
    assert content(got) == [(1, "2020-01-05", "a")]


def test_upsert_with_null_key_parts(spark, table):
    data = trips(spark, [(None, "2020-01-01", "a"), (None, "2020-01-01", "b"), (1, None, "x"), (1, None, "y")])
    tables.upsert(data, table, KEY, "t", 1)
    got = tables.upsert(data, table, KEY, "t", 2)
    assert sorted(r["v"] for r in got.collect()) == ["b", "y"]


def test_many_touched_months_are_looked_up_by_join(spark, table, monkeypatch):
    monkeypatch.setattr(tables, "LISTED_PARTITIONS", 1)
    base = trips(spark, [(m, f"2020-{m:02d}-01", "a") for m in range(1, 7)])
    tables.upsert(base, table, KEY, "t", 1)
    got = tables.upsert(trips(spark, [(m, f"2020-{m:02d}-01", "b") for m in range(1, 4)]), table, KEY, "t", 2)
    assert [v for _, _, v in content(got)] == ["b"] * 3 + ["a"] * 3


def test_upsert_needs_the_cursor_in_the_key(spark, table):
    with pytest.raises(ValueError):
        tables.upsert(trips(spark, [(1, "2020-01-01", "a")]), table, ("k",), "t", 1)


def test_empty_increment(spark, table):
    tables.upsert(trips(spark, [(1, "2020-01-05", "a")]), table, KEY, "t", 1)
    assert content(tables.upsert(trips(spark, []), table, KEY, "t", 2)) == [(1, "2020-01-05", "a")]


def test_routing(spark):
    database = scratch_database(spark, "route")
    def records(entry, n):
        return with_constants(spark.range(n), {"_socrata_resource_id": entry.resource_id, "_socrata_domain": entry.domain})

    first, second, *_ = contracts.RECORD_SETS
    made = tables.route_records(records(first, 3).union(records(second, 2)), database)
    assert {n: df.count() for n, df in made.items()} == {
        "socrata_311_socrata_records": 3, "socrata_nypd_socrata_records": 2,
        "socrata_events_socrata_records": 0, "socrata_restaurants_socrata_records": 0,
    }
    plan = made[first.table]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_socrata_resource_id" in plan
    tables.route_records(records(second, 4), database)
    assert spark.table(f"{database}.{second.table}").count() == 6
    assert spark.table(f"{database}.{first.table}").count() == 3


def test_materialize(spark, table, rows):
    assert tables.materialize(spark.range(2), "a_view").count() == 2
    assert tables.materialize(spark.range(2), table, "table").count() == 2
    assert rows(inventory(spark, table.split(".")[0])) == [(table.split(".")[1], 2)]
    with pytest.raises(ValueError):
        tables.materialize(spark.range(2), "x", "index")


def test_payload_migration_is_repeatable(spark, table, rows):
    df = spark.createDataFrame([(1, '{"a":1}'), (2, '{ "a": 1 }'), (3, None), (4, None)], "seq int, payload string")
    once = tables.dedup_payloads(df, "seq")
    assert sorted(r["seq"] for r in once.collect()) == [2, 3, 4]
    twice = tables.dedup_payloads(once, "seq")
    assert rows(once) == rows(twice)
    assert tables.replace_unique(once, table, ["payload_hash"]).count() == 3


def test_hash_column_equals_dedup_hash(spark, rows):
    df = spark.createDataFrame([(1, '{"a": 1}'), (2, None)], "seq int, payload string")
    assert rows(tables.with_payload_hash(df)) == rows(tables.dedup_payloads(df, "seq"))


def test_layers_are_created_once(spark):
    tables.ensure_layers(spark)
    tables.ensure_layers(spark)
    assert {d.name for d in spark.catalog.listDatabases()} >= set(contracts.LAYERS)


def test_a_writer_that_dies_leaves_the_old_rows(spark, table):
    tables.replace_table(spark.range(3), table)
    fails = F.udf(lambda x: 1 // (x - 5), "long")
    for by in ((), ("p",)):
        with pytest.raises(Exception, match="ZeroDivisionError|division"):
            tables.replace_table(spark.range(9).select(fails("id").alias("id"), F.lit(1).alias("p")), table, by)
        assert spark.table(table).count() == 3 and spark.table(table).columns == ["id"]
    assert versions.sweep(spark, table) >= 1
    assert tables.replace_table(spark.range(4), table).count() == 4
    assert versions.sweep(spark, table) == 0 and spark.table(table).count() == 4


def test_replace_by_other_columns_and_partitions(spark, table):
    tables.replace_table(spark.range(3), table)
    df = spark.range(6).select((F.col("id") % 3).alias("p"), "id")
    assert tables.replace_table(df, table, ["p"]).count() == 6
    got = tables.replace_table(df.where("p = 2"), table, ["p"])
    assert got.columns == ["id", "p"] and sorted(map(tuple, got.collect())) == [(2, 2), (5, 2)]
    assert tables.replace_table(spark.table(table).where("id = 5"), table, ["p"]).count() == 1, "from the table itself"
    assert tables.append_table(df.where("p = 0").select("id", "p"), table, ["p"]).count() == 3
    assert tables.replace_table(spark.range(2), table).columns == ["id"]
    spark.sql(f"DROP TABLE {table}")
    assert tables.replace_table(spark.range(1), table).count() == 1


def test_rows_that_repeat_a_key_replace_nothing(spark, table):
    tables.replace_unique(spark.range(3), table, ["id"])
    with pytest.raises(DataCheckError):
        tables.replace_unique(spark.range(2).union(spark.range(2)), table, ["id"])
    assert spark.table(table).count() == 3


def test_measured_in_the_pass_that_writes(spark, table):
    seen = spark.sparkContext.accumulator(0)

    def count(x):
        seen.add(1)
        return x

    df = spark.createDataFrame([("a", 1), ("", 2), (None, 3)], "name string, n int").withColumn("n", F.udf(count, "int")("n"))
    assert tables.replace_measured(df, table, guard=True, required=["name", "n"]) == {"rows": 3, "name_blank": 2, "n_blank": 0}
    assert seen.value == 3, "each row came through once"
    with pytest.raises(DataCheckError):
        tables.replace_measured(df.where("n > 5"), table, guard=True)
    assert tables.replace_measured(spark.createDataFrame([], df.schema), table, required=["n"]) == {"rows": 0, "n_blank": 0}


def three_loads(spark):
    rows = [(1, "2020-01-01", "a"), (2, "2020-01-02", "b"), (3, "2020-02-02", "c")]
    return [trips(spark, [r]) for r in rows]


def test_a_load_that_died_before_it_counted(spark, table, monkeypatch):
    first, second, third = three_loads(spark)
    tables.upsert(first, table, KEY, "t", 1)
    with monkeypatch.context() as patched:
        patched.setattr(versions, "publish", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            tables.upsert(second, table, KEY, "t", 2)
    assert content(spark.table(table)) == [(1, "2020-01-01", "a")]
    assert content(tables.upsert(third, table, KEY, "t", 3)) == [(1, "2020-01-01", "a"), (3, "2020-02-02", "c")]
    assert versions.sweep(spark, table) == 1


def test_a_load_that_died_in_the_switch_is_finished_by_the_next(spark, table, monkeypatch):
    first, second, third = three_loads(spark)
    tables.upsert(first.union(third), table, KEY, "t", 1)
    before = set(spark.table(table).inputFiles())
    real = spark.sql
    switched = []

    def dies(text, *args, **kwargs):
        if "SET LOCATION" in text:
            if switched:
                raise RuntimeError("the driver is gone")
            switched.append(text)
        return real(text, *args, **kwargs)

    both = second.union(trips(spark, [(4, "2020-02-05", "d")]))
    with monkeypatch.context() as patched:
        patched.setattr(type(spark), "sql", lambda self, text, *a, **k: dies(text, *a, **k))
        with pytest.raises(RuntimeError):
            tables.upsert(both, table, KEY, "t", 2)
    got = tables.upsert(trips(spark, [(5, "2020-03-05", "e")]), table, KEY, "t", 3)
    assert [v for _, _, v in content(got)] == ["a", "b", "c", "d", "e"]
    assert not before & set(spark.table(table).inputFiles())
    assert versions.sweep(spark, table) <= 1, "what the load that died had replaced already"


def test_each_merged_row_is_written_once(spark, table, monkeypatch):
    written = []
    real = versions.build
    monkeypatch.setattr(versions, "build", lambda *a, **k: written.append(real(*a, **k)) or written[-1])
    first, second, _ = three_loads(spark)
    tables.upsert(first, table, KEY, "t", 1)
    tables.upsert(second, table, KEY, "t", 2)
    assert [seen["rows"] for _, seen in written] == [1, 2]
    assert all(written[1][0] in f.replace("file:///", "file:/") for f in spark.table(table).inputFiles())


def test_late_rows_rewrite_only_their_stretch(spark, table):
    days = [(k, f"2020-01-{k:02d}", "a") for k in range(1, 31)] + [(40, "2020-02-10", "a"), (41, None, "x")]
    tables.upsert(trips(spark, days), table, KEY, "t", 1, parts=10)
    place = lambda: {r["f"].rsplit("/", 1)[0]: r["n"] for r in spark.table(table).groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n")).collect()}
    before = place()
    assert len(before) == 12
    # The parts that a table was made with hold, whatever is asked for later.
    got = tables.upsert(trips(spark, [(7, "2020-01-07", "b"), (8, "2020-01-08", "c"), (50, "2020-01-08", "d")]), table, KEY, "t", 2, parts=3)
    changed = {folder: n for folder, n in place().items() if folder not in before}
    assert sum(changed.values()) <= 9 and len(place()) == 12 and len(changed) <= 2
    assert {v for k, _, v in content(got) if k in (7, 8, 50)} == {"b", "c", "d"} and got.count() == 33


def test_stretches_of_a_month(spark):
    df = spark.sql("SELECT explode(array(timestamp_ntz'2024-02-01 00:00:00', timestamp_ntz'2024-02-29 23:59:59', timestamp_ntz'2024-02-15 12:00:00', NULL)) AS t")
    assert [r[0] for r in df.select(tables._part_of_month("t", 4)).collect()] == [0, 3, 2, 0]


def test_first_load_reads_its_increment_once(spark, table):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = trips(spark, [(1, "2020-01-05", "a"), (1, "2020-01-05", "b"), (2, "2020-02-05", "a"), (3, None, None)])
    made = tables.upsert(df.mapInArrow(counted, df.schema), table, KEY, "t", 1)
    assert read.value == 4
    assert content(made) == [(1, "2020-01-05", "b"), (2, "2020-02-05", "a"), (3, "None", None)]


def test_first_load_without_rows(spark, table):
    assert content(tables.upsert(trips(spark, []), table, KEY, "t", 1)) == []
    assert content(tables.upsert(trips(spark, [(1, "2020-01-05", "a")]), table, KEY, "t", 2)) == [(1, "2020-01-05", "a")]
