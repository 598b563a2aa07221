"""Derived tables follow their source partition by partition, and the marts made of them."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.operators.marts import FLOW_ENDS, daily_fact, merge_facts, money, partial_fact
from tidemark.plans import marts
from tidemark.plans.marts import fact_trips, update_marts
from tidemark.session import scratch_database
from tidemark.sinks import derived, tables, versions

KEY = ("k", "t")


def trips(spark, data):
    df = spark.createDataFrame(data, "k int, t string, pulocationid long, dolocationid long, fare double")
    return df.withColumn("t", F.col("t").cast("timestamp_ntz"))


@pytest.fixture
def names(spark):
    database, own = scratch_database(spark, "derived"), uuid.uuid4().hex[:6]
    return f"{database}.t{own}", f"{database}.d{own}"


def counts(rows):
    return rows.groupBy("load_month", "pulocationid").agg(F.count("*").alias("n"))


def content(spark, table):
    return sorted((r.load_month, r.pulocationid, r.n) for r in spark.table(table).collect())


FIRST = [(1, "2020-01-05", 7, 8, 1.0), (2, "2020-02-01", 7, 9, 2.0), (3, "2020-02-03", 8, 9, 3.0)]


def test_only_touched_partitions_are_made_anew(spark, names):
    source, target = names
    tables.upsert(trips(spark, FIRST), source, KEY, "t", 1)
    assert derived.refresh(spark, source, target, counts) == [("202001",), ("202002",)]
    assert derived.refresh(spark, source, target, counts) == []
    tables.upsert(trips(spark, [(3, "2020-02-03", 7, 9, 3.0), (4, "2020-03-01", 9, 9, 4.0)]), source, KEY, "t", 2)
    assert derived.refresh(spark, source, target, counts) == [("202002",), ("202003",)]
    assert content(spark, target) == [("202001", 7, 1), ("202002", 7, 2), ("202003", 9, 1)]
    assert derived.refresh(spark, source, target, counts, "other inputs") == [("202001",), ("202002",), ("202003",)]


def test_partitions_left_without_rows_go(spark, names):
    source, target = names
    tables.upsert(trips(spark, FIRST), source, KEY, "t", 1)
    derived.refresh(spark, source, target, counts)
    derived.refresh(spark, source, target, lambda rows: counts(rows.where("load_month > '202001'")), "later")
    assert content(spark, target) == [("202002", 7, 1), ("202002", 8, 1)]
    spark.sql(f"ALTER TABLE {source} DROP PARTITION (load_month='202002')")
    derived.refresh(spark, source, target, counts, "later")
    assert content(spark, target) == [("202001", 7, 1)]


def test_a_writer_that_dies_is_made_up_for(spark, names, monkeypatch):
    source, target = names
    tables.upsert(trips(spark, FIRST), source, KEY, "t", 1)
    derived.refresh(spark, source, target, counts)
    tables.upsert(trips(spark, [(3, "2020-02-03", 7, 9, 3.0)]), source, KEY, "t", 2)

    def dies(*_args, **_kwargs):
        raise RuntimeError("dead")

    with monkeypatch.context() as patched:
        patched.setattr(versions, "publish", dies)
        with pytest.raises(RuntimeError):
            derived.refresh(spark, source, target, counts)
    assert content(spark, target) == [("202001", 7, 1), ("202002", 7, 1), ("202002", 8, 1)]
    with monkeypatch.context() as patched:
        patched.setattr(versions, "finish", lambda *_: False)
        derived.refresh(spark, source, target, counts)
    assert derived.refresh(spark, source, target, counts) == [], "named before it died, so the next one puts it in place"
    assert content(spark, target) == [("202001", 7, 1), ("202002", 7, 2)]


def test_other_columns_and_empty_sources(spark, names):
    source, target = names
    tables.upsert(trips(spark, FIRST), source, KEY, "t", 1)
    derived.refresh(spark, source, target, counts)
    wider = lambda rows: counts(rows).withColumn("one", F.lit(1))
    assert len(derived.refresh(spark, source, target, wider)) == 2
    assert "one" in spark.table(target).columns
    spark.sql(f"ALTER TABLE {source} DROP PARTITION (load_month='202001'), PARTITION (load_month='202002')")
    assert derived.refresh(spark, source, target, wider) == []
    assert spark.table(target).count() == 0
    with pytest.raises(ValueError, match="no partitions"):
        tables.replace_table(spark.range(2), f"{target}_flat")
        derived.refresh(spark, f"{target}_flat", target, counts)


def test_partial_facts_merge_to_the_fact(spark, rows):
    rng = random.Random(5)
    data = [
        (i, f"2020-0{rng.randint(1, 2)}-0{rng.randint(1, 4)}", rng.randint(1, 3), 1, rng.choice([None, rng.random() * 10]))
        for i in range(200)
    ]
    df = trips(spark, [*data, (900, None, 1, 1, 5.0), (901, "2020-03-01", 1, 1, None)])
    fare = {"fare": money(F.col("fare"))}
    whole = daily_fact(df, "t", ["pulocationid"], fare)
    merged = merge_facts(partial_fact(df, "t", ["pulocationid", "dolocationid"], fare), ["pulocationid"], ["fare"])
    assert merged.schema["fare_avg"].dataType == whole.schema["fare_avg"].dataType
    assert rows(merged.select(whole.columns)) == rows(whole)


@pytest.mark.parametrize("parts", [1, 3])
def test_updated_marts_equal_a_rebuild(spark, names, rows, parts):
    source, _ = names
    database = scratch_database(spark, "marts")
    rng = random.Random(parts)
    zones = spark.createDataFrame([("7", "Q", "a"), ("8", "Q", "b"), ("9", "M", "c")], "location_id string, borough string, zone_name string")
    make = lambda k: (k, f"2020-0{rng.randint(1, 4)}-{rng.randint(1, 28):02d}", rng.choice([7, 8, 9, 10, None]), rng.randint(7, 9), rng.random())
    data = [make(k) for k in range(60)] + [(60, None, 7, 8, 1.0)]
    fare = {"fare": money(F.col("fare"))}
    for load in range(3):
        late = [(k, t, 9, 9, f) for k, t, _, _, f in rng.sample(data, 5)] + [make(100 * load + 100 + k) for k in range(3)]
        tables.upsert(trips(spark, data if load == 0 else late), source, KEY, "t", load + 1, parts=parts)
        made = update_marts(spark, source, zones, "t", database, None, fare)
        fact = fact_trips(spark.table(source).drop(tables.LOAD_SEQ), zones, "t", None)
        assert rows(made["fact_trips"].select(fact.columns)) == rows(fact)
        flow = fact.groupBy(*FLOW_ENDS).agg(F.count("*").alias("trips"))
        assert rows(made["agg_flow_zone"].select(flow.columns)) == rows(flow)
        whole = daily_fact(fact, "t", (), fare)
        assert rows(made["fact_trips_daily"].select(whole.columns)) == rows(whole)
    renamed = zones.withColumn("zone_name", F.concat(F.lit("new "), "zone_name"))
    made = update_marts(spark, source, renamed, "t", database, None, fare)
    assert made["fact_trips"].where("pickup_zone NOT LIKE 'new %'").count() == 0
    assert made["agg_flow_zone"].agg(F.sum("trips")).head()[0] == spark.table(source).count()


def test_what_is_added_by_row_is_not_dealt_out(spark, names, rows, monkeypatch):
    source, target = names
    tables.upsert(trips(spark, FIRST), source, KEY, "t", 1)
    dealt, build = [], versions.build

    def seen(df, *args, **kwargs):
        dealt.append(df.columns)
        return build(df, *args, **kwargs)

    monkeypatch.setattr(versions, "build", seen)
    zones = F.broadcast(spark.createDataFrame([(7, "x" * 200), (8, "y" * 200)], "pulocationid long, name string"))
    name = lambda df: df.where("k <> 2").drop(tables.LOAD_SEQ).join(zones, "pulocationid", "left")
    for load in (1, 2):
        assert derived.refresh(spark, source, target, name, "a", by_row=True) == [("202001",), ("202002",)][load - 1:]
        made = spark.table(target).drop(derived.ORIGIN)
        assert rows(made) == rows(name(spark.table(source)).select(made.columns))
        tables.upsert(trips(spark, [(3, "2020-02-03", 7, 9, 3.0), (5, "2020-02-09", 99, 9, None)]), source, KEY, "t", 2)
        assert all("name" not in columns and derived.ORIGIN not in columns for columns in dealt)


@pytest.mark.parametrize("few", [0, 3])
def test_names_of_few_zones_are_joined_after_the_shuffle(spark, names, rows, monkeypatch, few):
    source, _ = names
    monkeypatch.setattr(marts, "FEW_ZONES", few)
    monkeypatch.setattr(marts, "refresh", lambda *args, **kw: by_row.append(kw.get("by_row", False)) or derived.refresh(*args, **kw))
    by_row = []
    zones = spark.createDataFrame([("7", "Q", "a"), ("8", "Q", "b"), ("9", "M", None)], "location_id string, borough string, zone_name string")
    tables.upsert(trips(spark, [*FIRST, (4, None, None, 10, 1.0)]), source, KEY, "t", 1)
    made = update_marts(spark, source, zones, "t", scratch_database(spark, "marts"), None, {"fare": money(F.col("fare"))})
    fact = fact_trips(spark.table(source).drop(tables.LOAD_SEQ), zones, "t", None)
    assert rows(made["fact_trips"].select(fact.columns)) == rows(fact)
    assert by_row == [few == 3, False]
