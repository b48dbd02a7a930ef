"""Message and table schemas, and the constants of the fleet domain."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "int": T.IntegerType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "binary": T.BinaryType(),
}


def _schema(columns: str, nullable: bool = True) -> T.StructType:
    """A schema from ``name type, ...``; unlike Spark's own DDL parser it needs no session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(n, _TYPES[t], nullable) for n, t in pairs])


# Messages ------------------------------------------------------------------

RAW_EVENT = _schema("event_id string, event_time string, car_id int, speed int, rpm int, gear int")

ENRICHED_EVENT = _schema(
    "event_id string, event_time string, car_id int, speed int, rpm int, gear int, "
    "driver_id int, brand_name string, model_name string, color_name string, expected_gear int"
)

COUNTER_INPUT = _schema(
    "event_time string, speed int, gear int, rpm int, color string, color_name string"
)

# What a broker row carries that the jobs use.
ENVELOPE = _schema("topic string, timestamp timestamp, value binary")

# What one message holds when a directory of files stands in for a topic.
FILE_MESSAGE = _schema("value string, timestamp timestamp")

# Dimension tables ----------------------------------------------------------

CARS = _schema("car_id int, driver_id int, model_id int, color_id int", nullable=False)
CAR_MODELS = _schema("model_id int, car_brand string, car_model string", nullable=False)
CAR_COLORS = _schema("color_id int, color_name string", nullable=False)

# One row per car with every attribute the enrichment adds.
CAR_PROFILE = _schema(
    "car_id int, driver_id int, brand_name string, model_name string, color_name string"
)

# Results depend on them ---------------------------------------

MODEL_ROWS = [
    (1, "Mazda", "3"),
    (2, "Mazda", "6"),
    (3, "Toyota", "Corolla"),
    (4, "Hyundai", "i20"),
    (5, "Kia", "Sportage"),
    (6, "Kia", "Rio"),
    (7, "Kia", "Picanto"),
]

COLOR_ROWS = [
    (1, "Black"),
    (2, "Red"),
    (3, "Gray"),
    (4, "White"),
    (5, "Green"),
    (6, "Blue"),
    (7, "Pink"),
]

SPEED_PER_GEAR = 30.0
MAX_SPEED = 120
MAX_RPM = 6000

WINDOW_LENGTH = "15 minutes"
WINDOW_SLIDE = "1 minute"
WATERMARK = "20 minutes"
REFRESH_EVERY = "60 seconds"

COUNTED_COLORS = ("black", "white", "silver")
MAXIMA = ("speed", "gear", "rpm")

RAW_TOPIC = "sensors-sample"
ENRICHED_TOPIC = "samples-enriched"
ALERT_TOPIC = "alert-data"
COUNTER_TOPICS = "anomaly-alerts,alert-data"
