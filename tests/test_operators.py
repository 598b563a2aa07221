import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark import contracts
from tidemark.operators import checks, dedup, joins, marts, numbering, shape
from tidemark.session import setting


# -- numbering ------------------------------------------------------------------
def test_rows_are_numbered_without_gap(spark):
    df = spark.range(0, 5000).withColumn("v", (F.col("id") * 7919) % 5000).repartition(7)
    got = sorted((r["v"], r["row_no"]) for r in numbering.number_rows(df, ["v"]).collect())
    assert got == [(i, i) for i in range(5000)]


@pytest.mark.parametrize("listed", [10_000, 0])
def test_numbering_within_a_group_that_holds_most_rows(spark, monkeypatch, listed):
    monkeypatch.setattr(numbering, "LISTED_RUNS", listed)
    hot = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, F.lit(None)).otherwise(
        (F.col("id") % 11).cast("string")
    )
    df = spark.range(3000).withColumn("g", hot).repartition(5)
    got = numbering.number_rows(df, ["id"], "n", within=["g"]).collect()
    seen: dict = {}
    for r in sorted(got, key=lambda r: r["id"]):
        assert r["n"] == seen.get(r["g"], 0)
        seen[r["g"]] = r["n"] + 1
    assert len(got) == 3000


def test_pages_and_deep_page(spark, monkeypatch):
    df = spark.range(95).select(F.col("id"))
    assert [r["page_no"] for r in numbering.pages(df, ["id"], 30).orderBy("id").collect()] == [
        i // 30 for i in range(95)
    ]
    assert [r[0] for r in numbering.one_page(df, ["id"], 3, 30).collect()] == list(range(90, 95))
    monkeypatch.setattr(numbering, "SHALLOW_ROWS", 10)
    assert [r[0] for r in numbering.one_page(df, ["id"], 1, 30).collect()] == list(range(30, 60))
    assert numbering.one_page(df, ["id"], 4, 30).count() == 0


@pytest.mark.parametrize("limit", [1_000, 1])
def test_head_per_group(spark, monkeypatch, rows, limit):
    monkeypatch.setattr(numbering, "WINDOW_LIMIT", limit)
    df = spark.createDataFrame([("a", 3), ("a", 1), ("a", 2), ("b", 9)], "g string, v int")
    assert rows(numbering.head_per_group(df, ["g"], ["v"], 2)) == [("a", 1), ("a", 2), ("b", 9)]
    assert numbering.head_per_group(df, ["g"], ["v"], 0).count() == 4
    with pytest.raises(ValueError):
        numbering.head_per_group(df, ["g"], ["v"], -1)


# -- dedup ----------------------------------------------------------------------
def test_newest_per_key(spark, rows):
    df = spark.createDataFrame(
        [
            (1, 10, 1, "old load"), (1, 10, 2, "new load"),
            (2, 20, 1, "newer cursor"), (2, 10, 9, "older row that came later"),
            (None, 5, 1, "null key"), (None, 6, 1, "null key, newer"),
            (3, None, 5, "no cursor"), (3, 1, 1, "has cursor"),
            (4, 1, 1, "a"), (4, 1, 1, "b"),
        ],
        "k int, cursor int, seq int, v string",
    )
    once = dedup.newest_per_key(df, ["k"], "cursor", "seq")
    assert sorted(r["v"] for r in once.collect()) == [
        "b", "has cursor", "new load", "newer cursor", "null key, newer",
    ]
    assert rows(dedup.newest_per_key(once, ["k"], "cursor", "seq")) == rows(once)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3) | st.none(), st.integers(0, 4), st.integers(0, 2), st.integers(0, 3)), min_size=1, max_size=30))
def test_newest_per_key_against_brute_force(spark, data):
    df = spark.createDataFrame(data, "k int, c int, s int, v int")
    best: dict = {}
    for k, *rest in data:
        best[k] = max(best.get(k, rest), rest)
    got = {r["k"]: [r["c"], r["s"], r["v"]] for r in dedup.newest_per_key(df, ["k"], "c", "s").collect()}
    assert got == best


def test_last_per_payload(spark, rows):
    df = spark.createDataFrame(
        [
            (1, '{"a":1,"b":2}'), (2, '{ "b": 2.0, "a": 1 }'), (3, None), (4, None), (5, "junk"), (6, "junk"),
            (7, '{"a":1,"a":5}'), (8, '{"a":5}'), (3, None),
        ],
        "seq int, payload string",
    )
    kept = dedup.last_per_payload(df, "payload", "seq")
    assert sorted(r["seq"] for r in kept.collect()) == [2, 3, 3, 4, 6, 8]
    assert rows(dedup.last_per_payload(kept, "payload", "seq")) == rows(kept)


def test_losers_are_dropped_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("c"))
    plan = dedup.newest_per_key(df, ["k"], "c")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


# -- shape ----------------------------------------------------------------------
def test_bike_layouts():
    old = list(contracts.BIKE_OLD_COLUMNS)
    assert shape.bike_layout(old) == "old"
    assert shape.bike_layout(old[::-1]) == "rejected"
    assert shape.bike_layout(["ride_id", "started_at"]) == "new"
    assert shape.bike_layout(["a"]) == "rejected"


def test_new_layout_is_mapped(spark):
    df = spark.createDataFrame([("r1", "2021-01-01 00:00:00", "", "member")], "ride_id string, started_at string, end_lat string, member_casual string")
    row = shape.bikes_to_old_layout(df).head().asDict()
    assert list(row) == list(contracts.BIKE_OLD_COLUMNS)
    assert {k: v for k, v in row.items() if v is not None} == {
        "starttime": "2021-01-01 00:00:00", "bikeid": "r1", "usertype": "member",
    }


def test_open_schema_records(spark):
    df = spark.createDataFrame([('{"unique_key": "7", "score": 3, "extra": {"a": 1}}',), ("broken",), (None,)], "payload string")
    out = shape.parse_records(df, "payload", ["unique_key", "score", "grade"])
    got = out.select("unique_key", "score", "grade", F.to_json("_rest")).collect()
    assert tuple(got[0]) == ("7", "3", None, '{"extra":{"a":1},"score":3,"unique_key":"7"}')
    assert [tuple(r) for r in got[1:]] == [(None,) * 4] * 2


def test_constants_win_over_record_fields(spark):
    df = spark.createDataFrame([('{"unique_key":"1"}',)], "payload string")
    marked = shape.with_constants(df, {"_socrata_resource_id": "abcd-1234", "_socrata_domain": "example.org"})
    row = shape.parse_records(marked, "payload").head()
    assert (row["_socrata_resource_id"], row["_socrata_domain"]) == ("abcd-1234", "example.org")


def test_cast_and_required(spark):
    df = spark.createDataFrame([("1", ""), ("x", None)], "a string, b string")
    assert [r[0] for r in shape.cast_all(df, {"a": "bigint"}).collect()] == [1, None]
    assert shape.required(df, "b").count() == 1, "empty text is not NULL"


def test_union_by_name_in_any_order(spark, rows):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3.5,)], "x double")
    one, two = shape.union_all([a, b]), shape.union_all([b, a]).select("x", "y")
    assert rows(one) == rows(two) == [(1.0, 2), (3.5, None)]


# -- checks ---------------------------------------------------------------------
def test_blank_counts(spark):
    df = spark.createDataFrame([("",), (None,), (" ",), ("N/A",)], ["a b"])
    assert tuple(checks.blank_counts(df, ["a b"]).head()) == (4, 2)


def test_uniqueness_lets_nulls_repeat(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (None,)], "k int")
    checks.assert_unique(df, ["k"])
    with pytest.raises(checks.DataCheckError, match="repeat"):
        checks.assert_unique(df.union(df), ["k"])


def test_guards(spark):
    empty = spark.createDataFrame([], "a int")
    with pytest.raises(checks.DataCheckError):
        checks.require_rows(empty)
    with pytest.raises(checks.DataCheckError):
        checks.verify_count(empty, 1)
    assert checks.verify_count(empty, 0) == 0


def test_reports(spark, rows):
    df = spark.range(3).toDF("a")
    assert rows(checks.load_report({"x": df, "y": None})) == [("x", 3), ("y", 0)]
    assert tuple(checks.compare_counts(df, df.limit(0)).head()) == (3, 0, 3)
    assert rows(checks.column_listing(df)) == [(1, "a", "bigint")]
    assert rows(checks.kept_and_dropped(df.union(spark.createDataFrame([(None,)], "a long")), F.col("a") < 1)) == [(1, 3)]


def test_reconcile(spark, rows):
    left = spark.createDataFrame([(1, 1.0), (2, 2.0), (2, 2.0), (None, 5.0), (4, 1.0)], "k int, v double")
    right = spark.createDataFrame([(2, 4.0), (3, 1.0), (None, 5.0), (4, 2.0)], "k int, v double")
    got = {r["k"]: r["status"] for r in checks.reconcile(left, right, ["k"], "v").collect()}
    assert got == {1: "left only", 2: "count differs", 3: "right only", None: "same", 4: "amount differs"}


# -- joins ----------------------------------------------------------------------
def brute_nearest(stations, zones):
    def km(a, b):
        la, lo, lb, mo = map(math.radians, (*a, *b))
        h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((mo - lo) / 2) ** 2
        return round(2 * joins.EARTH_KM * math.asin(math.sqrt(min(1.0, h))), 9)

    return {s: min((km(p, q), z) for z, q in zones.items())[1] for s, p in stations.items()}


@pytest.mark.parametrize("spread", ["world", "city", "clustered", "line"])
def test_nearest_zone_against_brute_force(spark, spread):
    rnd = random.Random(spread)

    def spot():
        if spread == "world":
            return rnd.uniform(-90, 90), rnd.uniform(-180, 180)
        if spread == "city" or (spread == "clustered" and rnd.random() < 0.3):
            return rnd.uniform(40.5, 40.9), rnd.uniform(-74.2, -73.7)
        if spread == "line":
            return rnd.uniform(-1, 1), rnd.choice([179.999, -179.999, 180.0])
        return 40.7 + rnd.uniform(0, 1e-5), -74.0 + rnd.uniform(0, 1e-5)

    zones = {i: spot() for i in range(400)}
    stations = {i: spot() for i in range(200)}
    zdf = spark.createDataFrame([(i, *p) for i, p in zones.items()], "location_id int, lat double, lon double")
    sdf = spark.createDataFrame([(i, *p) for i, p in stations.items()], "s int, lat double, lon double")
    got = {r["s"]: r["zone_id"] for r in joins.nearest_zone(sdf, zdf).collect()}
    assert got == brute_nearest(stations, zones)


def test_a_position_meets_cells_and_not_each_of_their_zones(spark):
    zones = {20 * c + i: (40.0 + c + i * 1e-7, -74.0) for c in range(3) for i in range(20)}
    stations = {s: (40.0 + s / 50, -73.9) for s in range(100)}
    zdf = spark.createDataFrame([(i, *p) for i, p in zones.items()], "location_id int, lat double, lon double")
    sdf = spark.createDataFrame([(i, *p) for i, p in stations.items()], "s int, lat double, lon double")

    def joined(node):
        under = node.children()
        rows = [r for i in range(under.size()) for r in joined(under.apply(i))]
        return rows + [node.metrics().apply("numOutputRows").value()] if node.nodeName().endswith("Join") else rows

    with setting(spark, "spark.sql.adaptive.enabled", "false"):
        df = joins.nearest_zone(sdf, zdf)
        # Collected through this very plan, whose counts are read.
        got = {r["s"]: r["zone_id"] for r in df.collect()}
        counts = joined(df._jdf.queryExecution().executedPlan())
    assert got == brute_nearest(stations, zones)
    assert len(counts) >= 3 and max(counts) <= 100 * joins.ROOT_CELLS


def test_nearest_zone_ties_and_missing_places(spark, rows):
    zones = spark.createDataFrame(
        [(9, 0.0, 1.0), (3, 0.0, -1.0), (5, 0.0, -1.0), (1, None, 0.0)], "location_id int, lat double, lon double"
    )
    stations = spark.createDataFrame(
        [("mid", 0.0, 0.0), ("mid again", 0.0, 0.0), ("none", None, 1.0), ("nan", float("nan"), 1.0), ("off", 1e9, 0.0), ("inf", 0.0, float("inf")), ("east", 0.0, 2.0)],
        "s string, lat double, lon double",
    )
    got = {r["s"]: r["zone_id"] for r in joins.nearest_zone(stations, zones).collect()}
    assert got == {"mid": 3, "mid again": 3, "none": None, "nan": None, "off": None, "inf": None, "east": 9}
    nothing = joins.nearest_zone(stations, zones.limit(0))
    assert {r["zone_id"] for r in nothing.collect()} == {None}


def test_trips_without_a_known_zone_stay(spark, rows):
    trips = spark.createDataFrame([(1, 1, 2), (2, 1, 99), (3, None, 2)], "t int, pulocationid long, dolocationid long")
    zones = spark.createDataFrame([("1", "A", "Z1"), ("2", "B", "Z2"), ("x", "C", "Z3")], "location_id string, borough string, zone_name string")
    out = joins.attach_zones(trips, zones).select("t", "pickup_zone", "dropoff_borough")
    assert rows(out) == [(1, "Z1", "B"), (2, "Z1", None), (3, None, "B")]
    flow = marts.zone_flow(trips, zones)
    assert sum(r["trips"] for r in flow.collect()) == 3
    assert sum(r["trips"] for r in marts.borough_flow(flow).collect()) == 3


def test_no_cross_join_anywhere(spark):
    zones = spark.createDataFrame([(1, 0.0, 1.0)], "location_id int, lat double, lon double")
    plan = joins.nearest_zone(zones.withColumnRenamed("location_id", "s"), zones)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


# -- marts ----------------------------------------------------------------------
def test_modal_daily_fills_missing_days(spark):
    day = lambda d, n: (f"2024-01-0{d}", n)
    frame = lambda data: spark.createDataFrame(data, "day string, row_count long").withColumn("day", F.to_date("day"))
    holidays = spark.createDataFrame([("2024-01-02", "H")], "day string, holiday string").withColumn("day", F.to_date("day"))
    got = marts.modal_daily(
        {"taxi": frame([day(1, 5), day(4, 1)]), "bike": frame([day(3, 2)])}, holidays=holidays
    ).orderBy("day").select("taxi_count", "bike_count", "all_modes_count", "is_holiday", "is_weekend").collect()
    assert [tuple(r) for r in got] == [
        (5, 0, 5, False, False), (0, 0, 0, True, False), (0, 2, 2, False, False), (1, 0, 1, False, False),
    ]


def test_date_dimension_of_an_empty_range(spark):
    none = spark.sql("SELECT date'2024-01-02' AS first, date'2024-01-01' AS last")
    assert marts.date_dimension(none).count() == 0


def test_daily_fact_amounts_are_exact(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00", 0.1), ("2024-01-01 11:00:00", 0.2)], "t string, v double")
    row = marts.daily_fact(df.withColumn("t", F.col("t").cast("timestamp_ntz")), "t", (), {"v": marts.money(F.col("v"))}).head()
    assert str(row["v_sum"]) == "0.30" and row["row_count"] == 2


def test_readings_finer_than_a_cent_stay(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'2024-01-01 10:00:00' AS t, v FROM VALUES (0.004D), (0.002D) AS d(v)"
    )
    row = marts.daily_fact(df, "t", (), {"v": marts.exact(F.col("v"))}).head()
    assert [float(row[f"v_{k}"]) for k in ("sum", "avg", "min", "max")] == [0.006, 0.003, 0.002, 0.004]


@pytest.mark.parametrize("most", [100, 7])
def test_documents_keep_every_child(spark, most):
    data = [("hot" if i % 3 == 0 else f"k{i % 5}", i, None if i % 4 == 0 else f"v{i}") for i in range(120)]
    data += [("hot", 1, "same")] * 20 + [(None, 5, "null key")]
    df = spark.createDataFrame(data, "k string, a int, b string").repartition(3)
    docs = marts.documents(df, ["k"], ["a", "b"], "kids", most).collect()
    kids = sorted(((d["k"], c["a"], c["b"]) for d in docs for c in d["kids"]), key=repr)
    assert kids == sorted(data, key=repr)
    assert max(len(d["kids"]) for d in docs) <= most
    hot = sorted((d for d in docs if d["k"] == "hot"), key=lambda d: d["part"])
    assert [d["part"] for d in hot] == list(range(math.ceil(60 / most)))
    flat = [c["a"] for d in hot for c in d["kids"]]
    assert flat == sorted(flat)


def test_station_dimension_takes_newest(spark, rows):
    df = spark.createDataFrame([("s1", "2020", "old"), ("s1", "2021", "new"), (None, "2022", "x")], "id string, t string, n string")
    assert rows(marts.station_dimension(df, "id", {"name": "n"}, "t")) == [("s1", "new")]


def test_staging_lists_what_does_not_fit(spark):
    from pyspark.sql import Observation

    from tidemark.operators.shape import rejected_fields, stage_json_checked

    rows = [
        (1, '{"n": " 12 ", "d": "2024-01-02", "t": " x "}'), (2, '{"n": "12a", "d": "soon", "t": ""}'), (3, '{"n": null}'),
        (4, "not json"), (5, "[1, 2]"), (6, None), (7, '{"n": "", "d": "2024-13-01"}'),
    ]
    df = spark.createDataFrame(rows, "id int, payload string")
    seen = Observation()
    staged = stage_json_checked(df, "payload", {"n": "int", "d": "date", "t": "string"}, seen)
    got = {r["id"]: (r["n"], str(r["d"]), r["t"], [tuple(x) for x in r["_rejects"]]) for r in staged.collect()}
    assert got == {
        1: (12, "2024-01-02", "x", []), 2: (None, "None", None, [("n", "12a"), ("d", "soon")]), 3: (None, "None", None, []),
        4: (None, "None", None, [("*", "not json")]), 5: (None, "None", None, [("*", "[1, 2]")]), 6: (None, "None", None, []),
        7: (None, "None", None, [("d", "2024-13-01")]),
    }
    assert seen.get == {"rows": 7, "rejected": 4}
    assert {tuple(r) for r in rejected_fields(staged, ["id"]).where("id = 7").collect()} == {(7, "d", "2024-13-01")}


def test_amounts_finer_than_a_cent_differ(spark):
    from tidemark.operators.checks import reconcile

    def side(value, kind):
        return spark.createDataFrame([(1, value)], "k int, v string").withColumn("v", F.col("v").cast(kind))

    status = lambda a, b, ka="double", kb="double": reconcile(side(a, ka), side(b, kb), ["k"], "v").head()["status"]
    assert status("0.004", "0.001") == "amount differs"
    assert status("0.004", "0.004") == status("7", "7", "bigint", "bigint") == "same"
    assert status("0.00000000001", "0.00000000002", "decimal(20,11)", "decimal(20,11)") == "amount differs"
    assert status("1.5", "1.5", "decimal(10,2)", "double") == "same"
