import pytest
from pyspark.sql import functions as F

from tidemark.functions import names, text, times
from tidemark.functions.jsontext import canonical_json, payload_hash
from tidemark.functions.keys import composite_key, surrogate_key


def test_lower_name():
    assert [names.lower_name(n) for n in ("PULocationID", "start station id", "a-b")] == [
        "pulocationid", "start_station_id", "a_b",
    ]


def test_snake_name():
    assert [names.snake_name(n) for n in ("LocationID", "PULocationID", "service_zone", "Zone", "a b-c")] == [
        "location_id", "pu_location_id", "service_zone", "zone", "a_b_c",
    ]


def test_renaming_refuses_a_collision(spark):
    with pytest.raises(ValueError, match="collide"):
        names.rename_all(spark.createDataFrame([(1, 2)], ["a b", "A-b"]), names.lower_name)


def test_blank_and_null(spark):
    df = spark.createDataFrame([("",), (" ",), (None,), ("N/A",)], "v string")
    assert [r[0] for r in df.select(text.is_blank(F.col("v"))).collect()] == [True, False, True, False]
    assert [r[0] for r in text.blank_to_null(df).collect()] == [None, " ", None, "N/A"]
    assert [r[0] for r in text.blank_to_null(df, "v", trim=True).collect()] == [None, None, None, "N/A"]


def test_split_names(spark):
    df = spark.createDataFrame([(" a, b,,  ,c ",)], "v string")
    assert df.select(text.split_names(F.col("v"))).head()[0] == ["a", "b", "c"]


def test_preview_labels_absent_values(spark):
    df = spark.createDataFrame(
        [("x" * 600, 0, False), ("", 7, True), (None, None, None)], "s string, n int, b boolean"
    )
    got = df.select(*[text.preview(df, c) for c in df.columns]).collect()
    assert [tuple(r) for r in got] == [("x" * 500, "NULL", "NULL"), ("NULL", "7", "true"), ("NULL",) * 3]


def test_path_and_size(spark):
    df = spark.createDataFrame([("s3a://b/x/y.parquet", 3 * 1024 * 1024)], "p string, n long")
    assert tuple(df.select(text.last_segment(F.col("p")), text.megabytes(F.col("n"))).head()) == ("y.parquet", 3.0)


@pytest.mark.parametrize(
    ("a", "b", "equal"),
    [
        ('{"a": 1, "b": 2}', '{"b":2,"a":1}', True),
        ('{"a": 2}', '{"a": 2.0}', True),
        ('{"a": 1e2}', '{"a": 100}', True),
        ('{"a": 1.50}', '{"a": 1.5}', True),
        ('{"a": 1, "a": 3}', '{"a": 3}', True),
        ('{"a": [1, 2]}', '{"a": [2, 1]}', False),
        ('{"a": "1.0"}', '{"a": 1.0}', False),
        ('{"a": "1e2 1.0,"}', '{"a": "1e2 1,"}', False),
        ('{"a": null}', "{}", False),
        ('{"a": 1e8}', '{"a": 100000000}', True),
        ('{"a": [1.5e9, "1.5e9"]}', '{"a": [1500000000, "1.5e9"]}', True),
        ('{"a": 12.5e-1}', '{"a": 1.25}', True),
        ('{"a": -2e10}', '{"a": 2e10}', False),
        ("no json", "no json", True),
        ("no json", "no  json", False),
        ('{"a": {"y": 1, "x": [1.0]}}', '{"a":{"x":[1],"y":1}}', True),
    ],
)
def test_json_equality(spark, a, b, equal):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    left, right = df.select(canonical_json(F.col("a")), canonical_json(F.col("b"))).head()
    assert (left == right) is equal
    hashes = df.select(payload_hash(F.col("a")), payload_hash(F.col("b"))).head()
    assert (hashes[0] == hashes[1]) is equal


def test_keys(spark):
    df = spark.createDataFrame([("x", None, 1), (None, "x", 1)], "a string, b string, c int")
    assert [r[0] for r in df.select(composite_key("a", "b", "c")).collect()] == ["x|1", "x|1"]
    keys = [r[0] for r in df.select(surrogate_key("a", "b", "c")).collect()]
    assert len(set(keys)) == 2
    near = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("", None), (None, ""), ("-", "")], "a string, b string")
    assert near.select(surrogate_key("a", "b")).distinct().count() == 5


def test_iso_text(spark):
    df = spark.createDataFrame([("2023-01-01T10:00:00",), ("2023-01-01",), (None,)], "t string")
    got = df.select(times.is_iso(F.col("t")), times.iso_text(times.parse_iso(F.col("t")))).collect()
    assert [tuple(r) for r in got] == [(True, "2023-01-01T10:00:00"), (False, None), (None, None)]


def test_default_end_is_now(spark):
    df = spark.createDataFrame([(None,), ("2020-01-01 00:00:00",)], "t string")
    got = df.select(times.iso_text(times.or_now(F.col("t").cast("timestamp_ntz")))).collect()
    assert got[0][0] > "2024" and got[1][0] == "2020-01-01T00:00:00"
