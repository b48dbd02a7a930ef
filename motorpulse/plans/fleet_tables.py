"""The fleet's tables read from a star schema of events and customers.

A telemetry event is an event, a car is a customer with no debt (so that some
events meet no car), a model is one of the first nations (so that some cars meet
no model) and a color is a region.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..files import is_directory
from ..operators.dimensions import car_profile

ISO_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
COUNTED = ("asia", "europe", "africa")


# Declared and not inferred: inference runs a job of its own for every scan.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the star schema. Its times have no zone and are meant as UTC, which is
    therefore the session's zone from here on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def event_stream(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """The events as a file stream, whether stored as one file or as a directory."""
    path = f"{sf_dir}/events.parquet"
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    reader = spark.readStream.schema(SCHEMAS["events"]).options(**options)
    if is_directory(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def _time() -> Column:
    return F.col("ts").cast("timestamp")


def _parsed(events: DataFrame) -> DataFrame:
    """Events with the number ``k`` of their properties; read and parsed only if asked for."""
    kept = ("event_id", "ts", "user_id", "event_type", "value")
    return events.select(*kept, F.from_json("props", "k int")["k"].alias("k"))


def _telemetry(event_time: Column) -> list[Column]:
    return [
        F.col("event_id").cast("string").alias("event_id"),
        event_time.alias("event_time"),
        F.col("user_id").cast("int").alias("car_id"),
        F.floor("value").cast("int").alias("speed"),
        (F.col("k") * 80).alias("rpm"),
        (F.col("k") % 7 + 1).alias("gear"),
    ]


def _iso_text() -> Column:
    return F.concat(F.date_format(_time(), ISO_TEXT), F.lit("+00:00"))


def telemetry(events: DataFrame) -> DataFrame:
    """Raw telemetry events, in the columns of the raw message."""
    return _parsed(events).select(*_telemetry(_iso_text()))


def _in_envelope(text: Column) -> list[Column]:
    topic = F.when(F.col("event_type") == "error", "anomaly-alerts").otherwise("alert-data")
    return [
        topic.alias("topic"),
        _time().alias("timestamp"),
        text.cast("binary").alias("value"),
    ]


def messages(events: DataFrame) -> DataFrame:
    """The telemetry as JSON messages in their envelope."""
    return _parsed(events).select(*_in_envelope(F.to_json(F.struct(*_telemetry(_iso_text())))))


def mixed_time_text() -> Column:
    """Event times as producers may write them, by event type; some unreadable or missing."""
    kind = F.col("event_type")
    ahead = F.date_format(_time() + F.expr("interval 2 hours"), ISO_TEXT)
    return (
        F.when(kind == "view", F.lit("garbage"))
        .when(kind == "signup", F.lit(None).cast("string"))
        .when(kind == "purchase", F.concat(ahead, F.lit("+02:00")))
        .when(kind == "error", F.date_format(_time(), "yyyy-MM-dd"))
        .otherwise(_iso_text())
    )


def mixed_messages(events: DataFrame) -> DataFrame:
    """Messages with mixed event times; those of the type ``error`` are cut off."""
    text = F.to_json(F.struct(*_telemetry(mixed_time_text())))
    cut = F.when(F.col("event_type") == "error", F.substring(text, 1, 20)).otherwise(text)
    return _parsed(events).select(*_in_envelope(cut))


def faulty_messages(events: DataFrame) -> DataFrame:
    """Messages with a field of a wrong kind, by event type; those of type ``error`` are cut off."""
    plain = {c: F.col(c) for c in ("event_id", "event_time", "car_id", "speed", "rpm", "gear")}

    def text(**fields: Column) -> Column:
        return F.to_json(F.struct(*(c.alias(n) for n, c in (plain | fields).items())))

    kind = F.col("event_type")
    written = (
        F.when(kind == "view", text(speed=F.col("speed").cast("string")))
        .when(kind == "signup", text(gear=F.col("gear") + F.lit(0.5), car_id=F.col("car_id") > 0))
        .when(kind == "purchase", text(rpm=F.col("rpm") + F.lit(3_000_000_000)))
        .when(kind == "error", F.substring(text(), 1, 20))
        .otherwise(text(rpm=F.lit(None).cast("int"), gear=F.array("gear")))
    )
    rows = _parsed(events).select(kind, *_telemetry(_iso_text()))
    return rows.select("event_id", written.alias("value"))


def all_cars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_cars(table(spark, sf_dir, "customer"))


def cars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cars without debt, so that some events meet no car in the joins."""
    return _as_cars(table(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0))


def _as_cars(customers: DataFrame) -> DataFrame:
    key = F.col("c_custkey").cast("int")
    return customers.select(
        key.alias("car_id"),
        (key + 100_000_000).alias("driver_id"),
        F.col("c_nationkey").alias("model_id"),
        (key % 5).alias("color_id"),
    )


def models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "nation")
        .where(F.col("n_nationkey") < 20)
        .select(
            F.col("n_nationkey").alias("model_id"),
            F.concat(F.lit("BRAND_"), F.col("n_regionkey")).alias("brand_name"),
            F.col("n_name").alias("model_name"),
        )
    )


def colors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("color_id"), F.col("r_name").alias("color_name")
    )


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return car_profile(
        cars(spark, sf_dir), models(spark, sf_dir), colors(spark, sf_dir)
    )
