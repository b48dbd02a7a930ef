from __future__ import annotations

from datetime import UTC, datetime

import pytest

from motorpulse.functions import color_of, event_timestamp, expected_gear
from motorpulse.operators import alerts


@pytest.mark.parametrize(
    "speed, gear",
    [
        (0, 0), (14, 0), (15, 1), (44, 1), (45, 2), (74, 2), (75, 3), (105, 4),
        (135, 5), (165, 6), (195, 7), (200, 7), (-15, -1), (None, None),
    ],
)
def test_expected_gear(spark, speed, gear):
    df = spark.createDataFrame([(speed,)], "speed int")
    assert df.select(expected_gear()).first()[0] == gear


@pytest.mark.parametrize(
    "speed, expected, gear, rpm, kept",
    [
        (121, 4, 4, 100, True),
        (120, 4, 4, 6000, False),
        (120, 4, 4, 6001, True),
        (None, None, 3, 7000, True),
        (None, None, 3, 10, False),
        (100, 3, None, 10, False),
        (130, 4, None, None, True),
        (100, 3, 4, None, True),
        (None, 3, 4, None, True),
        (None, None, None, None, False),
    ],
)
def test_alert(spark, speed, expected, gear, rpm, kept):
    row = [(speed, expected, gear, rpm)]
    df = spark.createDataFrame(row, "speed int, expected_gear int, gear int, rpm int")
    assert bool(alerts(df).collect()) == kept


def test_alert_limits_are_parameters(spark):
    df = spark.createDataFrame(
        [(90, 3, 3, 100), (10, 3, 3, 900)], "speed int, expected_gear int, gear int, rpm int"
    )
    assert alerts(df, max_speed=80, max_rpm=800).count() == 2
    assert alerts(df).count() == 0


MIDNIGHT = datetime(2024, 1, 1, tzinfo=UTC)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-01-01T00:00:00.123456+00:00", MIDNIGHT.replace(microsecond=123456)),
        ("2024-01-01T02:00:00+02:00", MIDNIGHT),
        ("2024-01-01T00:00:00Z", MIDNIGHT),
        ("2024-01-01 00:00:00", MIDNIGHT),
        ("2024-01-01", MIDNIGHT),
        ("1704067200", None),
        ("", None),
        ("garbage", None),
        (None, None),
    ],
)
def test_event_time(spark, text, expected):
    arrived = datetime(2025, 5, 5, 5, 5, 5, tzinfo=UTC)
    df = spark.createDataFrame([(text, arrived)], "event_time string, arrived timestamp")
    found = df.select(
        event_timestamp().cast("double").alias("own"),
        event_timestamp(fallback="arrived").cast("double").alias("any"),
    ).first()
    assert found["own"] == (expected.timestamp() if expected else None)
    assert found["any"] == (expected or arrived).timestamp()


@pytest.mark.parametrize(
    "named, plain, expected",
    [
        ("WHITE", None, "white"),
        (None, "Black", "black"),
        ("Red", "Black", "red"),
        (None, None, None),
    ],
)
def test_color(spark, named, plain, expected):
    df = spark.createDataFrame([(named, plain)], "color_name string, color string")
    assert df.select(color_of("color_name", "color")).first()[0] == expected
