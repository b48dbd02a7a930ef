from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from motorpulse.functions import decode, encode, field_faults
from motorpulse.schemas import RAW_EVENT

NOTHING = (None,) * 6


def _decoded(spark, value, **how):
    df = spark.createDataFrame([(value,)], "value string")
    return [tuple(r) for r in decode(df, RAW_EVENT, **how).collect()]


@pytest.mark.parametrize(
    "value, expected",
    [
        (
            '{"event_id":"a","event_time":"t","car_id":1,"speed":2,"rpm":3,"gear":4}',
            ("a", "t", 1, 2, 3, 4),
        ),
        ('{"car_id":2,"speed":"50"}', (None, None, 2, None, None, None)),
        ('{"car_id":3,"speed":12.5,"rpm":7}', (None, None, 3, None, 7, None)),
        ('{"car_id":4,"speed":99999999999,"rpm":7}', (None, None, 4, None, 7, None)),
        ('{"car_id":5,"Speed":7}', (None, None, 5, None, None, None)),
        ('{"car_id":8,"speed":1,"speed":2}', (None, None, 8, 2, None, None)),
        ('{"car_id":9,"extra":{"x":1}}', (None, None, 9, None, None, None)),
        ("not json", NOTHING),
        ("[]", NOTHING),
        ('[{"car_id":6},{"car_id":7}]', NOTHING),
        ("null", NOTHING),
        ("{}", NOTHING),
        ('{"car_id":10,"gear":', NOTHING),
        ("", NOTHING),
        (None, NOTHING),
    ],
)
def test_decode(spark, value, expected):
    assert _decoded(spark, value) == [expected]


def test_decode_reads_bytes_and_keeps_the_envelope(spark):
    value = bytearray('{"event_id":"ä"}'.encode())
    df = spark.createDataFrame([("t", value)], "topic string, value binary")
    row = decode(df, RAW_EVENT, envelope=["topic"]).first()
    assert (row["topic"], row["event_id"]) == ("t", "ä")


@pytest.mark.parametrize("value", ["not json", "{}", "[]", "", None])
def test_malformed_is_dropped_or_set_apart(spark, value):
    assert _decoded(spark, value, on_malformed="drop") == []
    assert _decoded(spark, value, on_malformed="quarantine") == [(value or "", *NOTHING)]


def test_quarantine_leaves_good_rows_alone(spark):
    assert _decoded(spark, '{"gear":1}', on_malformed="quarantine") == [
        (None, None, None, None, None, None, 1)
    ]


def test_unknown_mode_is_refused(spark):
    with pytest.raises(ValueError):
        _decoded(spark, "{}", on_malformed="ignore")


def test_encode_leaves_nulls_out(spark):
    df = spark.createDataFrame([("a", None), (None, None)], "x string, y int")
    assert [r[0] for r in encode(df).collect()] == ['{"x":"a"}', "{}"]


def test_decode_of_encode_is_the_same(spark):
    rows = [("a", "2024-01-01", 1, 2, 3, 4), ('q"\\ü\n', None, None, -1, 0, 7)]
    df = spark.createDataFrame(rows, RAW_EVENT)
    assert [tuple(r) for r in decode(encode(df), RAW_EVENT).collect()] == rows


_ints = st.none() | st.integers(-(2**31), 2**31 - 1)
_texts = st.none() | st.text(st.characters(exclude_categories=["Cs"]), max_size=12)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(_texts, _texts, _ints, _ints, _ints, _ints), min_size=1, max_size=200))
def test_any_row_survives_encode_and_decode(spark, rows):
    df = spark.createDataFrame(rows, RAW_EVENT).coalesce(1)
    assert [tuple(r) for r in decode(encode(df), RAW_EVENT).collect()] == rows


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_messages_are_parsed_once_under_a_filter(spark, folder):
    spark.createDataFrame([("{}",)], "value string").write.parquet(f"{folder}/m")
    rows = decode(spark.read.parquet(f"{folder}/m"), RAW_EVENT).where("speed > 1 or rpm > 2")
    assert _plan(rows).count("from_json") == 1


def test_field_faults(spark):
    texts = {
        "a": '{"event_id": "a", "speed": "50", "gear": 12.5, "rpm": 3000000000, "car_id": true}',
        "b": '{"event_id": 7, "event_time": {"x": 1}, "speed": [1], "gear": {"y": 2}, "rpm": 1e2}',
        "c": '{"event_id": "c", "speed": null, "gear": 3, "car_id": -2147483649, "extra": "x"}',
        "d": '{"speed": 12.0, "rpm": 123456789012345678901234567890, "gear": -0}',
        "e": '{"speed": "5',
        "f": "",
        "g": None,
        "h": "[1]",
        "i": '{"speed": 1, "speed": "x"}',
        "j": '{"event_id": "j", "event_time": "t", "car_id": 1, "speed": 2, "rpm": 3, "gear": 4}',
    }
    df = spark.createDataFrame(list(texts.items()), "name string, value string")
    found = field_faults(df, RAW_EVENT, envelope=["name"])
    assert found.columns == ["name", "field", "kind", "found"]
    assert sorted(map(tuple, found.collect())) == [
        ("a", "car_id", "boolean", "true"), ("a", "gear", "fraction", "12.5"),
        ("a", "rpm", "integer", "3000000000"), ("a", "speed", "text", "50"),
        ("b", "gear", "object", '{"y":2}'), ("b", "rpm", "fraction", "100.0"), ("b", "speed", "list", "[1]"),
        ("c", "car_id", "integer", "-2147483649"),
        ("d", "rpm", "integer", "123456789012345678901234567890"), ("d", "speed", found_kind(spark), "12"),
    ]
    as_bytes = df.withColumn("value", F.col("value").cast("binary"))
    assert field_faults(as_bytes, RAW_EVENT).count() == 10


def found_kind(spark):
    """Spark keeps 12.0 as the decimal it is written as, or as a shorter one."""
    kind = spark.sql("""SELECT schema_of_variant(parse_json('12.0'))""").first()[0]
    return "integer" if kind.endswith(",0)") else "fraction"


def test_faults_of_good_messages_are_none(spark):
    df = spark.createDataFrame([('{"speed": 1}',), ("{}",)], "value string")
    assert field_faults(df, RAW_EVENT).collect() == []
