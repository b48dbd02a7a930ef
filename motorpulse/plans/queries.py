"""The registered queries: each runs one operator, or a job made of them, over whole tables.

Timestamps are handed out without a zone at the very end, as the tables have them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from functools import partial
from itertools import count
from os import getpid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import codec
from ..functions.codec import decode, encode
from ..functions.columns import alert_condition, color_of, event_timestamp, expected_gear
from ..operators.alerts import alerts
from ..operators.counts import latest_closed_window, latest_window, normalize, window_counts
from ..operators.dimensions import duplicate_keys, one_row_per_key, preview, write_dimension
from ..operators.enrich import attach_profile, enrich, frequent_keys
from ..operators.fleet_store import FleetStore
from ..schemas import CAR_COLORS, COLOR_ROWS, COUNTER_INPUT, ENRICHED_EVENT, RAW_EVENT
from ..session import shared_folder
from ..sources.messages import FileTopic, merge_topics
from ..sources.tables import literal_table, require_columns, require_rows
from ..streaming import (
    SnapshotTable,
    drain,
    fleet_steps,
    start_alerts,
    start_appending,
    start_enrichment,
    start_pane_counts,
    start_window_counts,
)
from ..streaming.jobs import windows_of_panes
from . import fleet_tables as fleet

Query = Callable[[SparkSession, str], DataFrame]
DRAIN = {"availableNow": True}
_runs = count()


def _without_zone(df: DataFrame) -> DataFrame:
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


def _folder(spark: SparkSession) -> str:
    """A folder of its own for every run, where all executors see it."""
    run = f"run-{spark.sparkContext.applicationId}-{getpid()}-{next(_runs)}"
    return f"{shared_folder(spark)}/{run}"


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return fleet.table(spark, sf, "events")


def _telemetry(spark: SparkSession, sf: str) -> DataFrame:
    return fleet.telemetry(_events(spark, sf))


def _messages(spark: SparkSession, sf: str) -> DataFrame:
    return fleet.messages(_events(spark, sf))


def _mixed(spark: SparkSession, sf: str) -> DataFrame:
    return fleet.mixed_messages(_events(spark, sf))


# Sources and sinks -----------------------------------------------------------


def dimension_scan(spark: SparkSession, sf: str) -> DataFrame:
    return fleet.all_cars(spark, sf)


def topic_union(spark: SparkSession, sf: str) -> DataFrame:
    """Two topics as one stream of messages, each still naming its topic."""
    both = _messages(spark, sf)
    split = [both.where(F.col("topic") == t) for t in ("anomaly-alerts", "alert-data")]
    rows = decode(merge_topics(split), RAW_EVENT, envelope=["topic"])
    return rows.select("topic", "event_id", "car_id")


def literal_colors(spark: SparkSession, sf: str) -> DataFrame:
    """Cars per color of the literal color table."""
    colors = literal_table(spark, COLOR_ROWS, CAR_COLORS)
    painted = fleet.all_cars(spark, sf).select((F.col("car_id") % 7 + 1).alias("color_id"))
    return painted.join(colors, "color_id", "left").groupBy("color_name").agg(
        F.count(F.lit(1)).alias("cars")
    )


def dimension_written_and_read(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{_folder(spark)}/cars"
    write_dimension(fleet.all_cars(spark, sf), path, "car_id")
    return spark.read.parquet(path)


def dimension_preview(spark: SparkSession, sf: str) -> DataFrame:
    return preview(fleet.all_cars(spark, sf), "car_id", rows=20)


def distinct_cars(spark: SparkSession, sf: str) -> DataFrame:
    cars = require_columns(_telemetry(spark, sf), ["car_id"])
    return require_rows(cars.select("car_id")).distinct()


# Projections and predicates --------------------------------------------------


def pruned_columns(spark: SparkSession, sf: str) -> DataFrame:
    return _telemetry(spark, sf).select("event_id", "car_id", "speed")


def renamed_models(spark: SparkSession, sf: str) -> DataFrame:
    nations = fleet.table(spark, sf, "nation")
    return nations.select(
        F.col("n_nationkey").alias("model_id"), F.col("n_name").alias("model_name")
    )


def computed_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Expected gear of every event."""
    rows = _telemetry(spark, sf).withColumns({"expected_gear": expected_gear()})
    return rows.select("event_id", "speed", "expected_gear")


def decoded_messages(spark: SparkSession, sf: str) -> DataFrame:
    """JSON to columns, malformed messages kept as rows of NULLs."""
    return decode(_mixed(spark, sf), RAW_EVENT)


def quarantined_messages(spark: SparkSession, sf: str) -> DataFrame:
    """JSON to columns, malformed messages set apart with their text."""
    return decode(_mixed(spark, sf), RAW_EVENT, on_malformed="quarantine")


def readable_messages(spark: SparkSession, sf: str) -> DataFrame:
    return decode(_mixed(spark, sf), RAW_EVENT, on_malformed="drop")


def encoded_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Enriched events as JSON text; events of unknown cars lack the attributes."""
    return encode(enriched(spark, sf))


def recoded_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Packed, encoded, decoded again: the same rows."""
    return decode(encode(enriched(spark, sf)), ENRICHED_EVENT)


def field_faults(spark: SparkSession, sf: str) -> DataFrame:
    """Fields that decoding makes NULL, with what the message has in their place."""
    messages = fleet.faulty_messages(_events(spark, sf))
    return codec.field_faults(messages, RAW_EVENT, envelope=["event_id"])


def window_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Start and end taken out of the window struct of every event's own minute."""
    rows = normalize(_telemetry(spark, sf).withColumn("color", F.lit(None).cast("string")))
    window = rows.select("event_id", F.window("event_ts", "1 minute").alias("window"))
    return _without_zone(
        window.select(
            "event_id",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
        )
    )


def alert_flags(spark: SparkSession, sf: str) -> DataFrame:
    """The alert predicate as a column, NULL where it is unknown."""
    events = decode(_mixed(spark, sf), RAW_EVENT)
    flagged = events.withColumn("expected_gear", expected_gear())
    return flagged.select("event_id", alert_condition().alias("is_alert"))


def timed_events(spark: SparkSession, sf: str) -> DataFrame:
    """Event time from text of many kinds; rows without one are dropped."""
    events = decode(_mixed(spark, sf), RAW_EVENT)
    timed = events.withColumn("event_ts", event_timestamp()).where(F.col("event_ts").isNotNull())
    return _without_zone(timed.select("event_id", "event_ts"))


def event_times(spark: SparkSession, sf: str) -> DataFrame:
    """Event time from text of many kinds, as read from the table and not from messages."""
    rows = _events(spark, sf).select("event_id", fleet.mixed_time_text().alias("event_time"))
    return _without_zone(rows.select("event_id", event_timestamp().alias("event_ts")))


def event_times_or_arrival(spark: SparkSession, sf: str) -> DataFrame:
    """Event time, or the message's own time where it cannot be read."""
    events = decode(_mixed(spark, sf), RAW_EVENT, envelope=["timestamp"])
    timed = events.select("event_id", event_timestamp(fallback="timestamp").alias("event_ts"))
    return _without_zone(timed)


def normalized_colors(spark: SparkSession, sf: str) -> DataFrame:
    """Lower-cased color; the named one wins over the plain one."""
    rows = enriched(spark, sf).withColumn("color", F.col("brand_name"))
    return rows.select("event_id", color_of("color_name", "color").alias("color_norm"))


# Joins -----------------------------------------------------------------------


def joined_cars(spark: SparkSession, sf: str) -> DataFrame:
    joined = attach_profile(_telemetry(spark, sf), one_row_per_key(fleet.cars(spark, sf), "car_id"))
    return joined.select("event_id", "car_id", "driver_id", "model_id", "color_id")


def joined_models(spark: SparkSession, sf: str) -> DataFrame:
    joined = attach_profile(
        joined_cars(spark, sf), one_row_per_key(fleet.models(spark, sf), "model_id"), key="model_id"
    )
    return joined.select("event_id", "model_id", "brand_name", "model_name")


def joined_colors(spark: SparkSession, sf: str) -> DataFrame:
    joined = attach_profile(
        joined_cars(spark, sf), one_row_per_key(fleet.colors(spark, sf), "color_id"), key="color_id"
    )
    return joined.select("event_id", "color_id", "color_name")


def car_profiles(spark: SparkSession, sf: str) -> DataFrame:
    return fleet.profile(spark, sf)


def enriched(spark: SparkSession, sf: str, **how) -> DataFrame:
    return enrich(_telemetry(spark, sf), fleet.profile(spark, sf), **how)


def enriched_with_hot_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Joined with the events of the most frequent cars spread out."""
    events = _telemetry(spark, sf)
    hot = frequent_keys(events, n=100)
    return enrich(events, fleet.profile(spark, sf), lookup="salted", hot_keys=hot)


# Aggregates, de-duplication, order ---------------------------------------------


def rows_per_model(spark: SparkSession, sf: str) -> DataFrame:
    return enriched(spark, sf).groupBy("model_name").agg(F.count(F.lit(1)).alias("num_of_rows"))


def colors_per_model(spark: SparkSession, sf: str) -> DataFrame:
    """Conditional counts."""
    rows = enriched(spark, sf).withColumn("color_norm", color_of("color_name"))
    counted = [F.count_if(F.col("color_norm") == c).alias(f"num_of_{c}") for c in fleet.COUNTED]
    return rows.groupBy("model_name").agg(*counted)


def maxima_per_model(spark: SparkSession, sf: str) -> DataFrame:
    maxima = [F.max(c).alias(f"maximum_{c}") for c in ("speed", "gear", "rpm")]
    return enriched(spark, sf).groupBy("model_name").agg(*maxima)


def events_per_car(spark: SparkSession, sf: str) -> DataFrame:
    return _telemetry(spark, sf).groupBy("car_id").count()


def one_event_per_car(spark: SparkSession, sf: str) -> DataFrame:
    """One row per key, where keys hold many rows."""
    return one_row_per_key(_telemetry(spark, sf).select("car_id", "speed", "gear", "rpm"), "car_id")


def repeated_cars(spark: SparkSession, sf: str) -> DataFrame:
    """Keys that occur more than once."""
    return duplicate_keys(_telemetry(spark, sf), "car_id")


# Alerts and counts ---------------------------------------------------------------


def fleet_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return alerts(enriched(spark, sf))


def _alert_rows(spark: SparkSession, sf: str) -> DataFrame:
    return normalize(fleet_alerts(spark, sf))


def alert_windows(spark: SparkSession, sf: str, **how) -> DataFrame:
    windows = window_counts(_alert_rows(spark, sf), counted=fleet.COUNTED, **how)
    return _without_zone(windows)


def message_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of messages of all kinds: malformed ones count at their arrival."""
    rows = decode(_mixed(spark, sf), COUNTER_INPUT, envelope=["timestamp"])
    windows = window_counts(normalize(rows, fallback="timestamp"))
    return _without_zone(windows)


def latest_alert_window(spark: SparkSession, sf: str) -> DataFrame:
    return latest_window(alert_windows(spark, sf))


def latest_closed_alert_window(spark: SparkSession, sf: str) -> DataFrame:
    return latest_closed_window(alert_windows(spark, sf))


# Versions of the dimensions ---------------------------------------------------------------


def _fleet_models(spark: SparkSession, sf: str) -> DataFrame:
    models = fleet.models(spark, sf)
    return models.withColumnsRenamed({"brand_name": "car_brand", "model_name": "car_model"})


def dimension_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Three versions of the fleet: its first cars, all others added, all drivers changed."""
    store = FleetStore(f"{_folder(spark)}/dims", buckets=8)
    everyone, first = fleet.all_cars(spark, sf), fleet.cars(spark, sf)
    models, colors = _fleet_models(spark, sf), fleet.colors(spark, sf)
    rest = everyone.join(first.select("car_id"), "car_id", "left_anti")
    made = [
        store.publish(spark, first, models, colors),
        store.publish(spark, new_cars=rest),
        store.publish(spark, everyone.withColumn("driver_id", F.col("driver_id") + 1)),
    ]
    rows = [v.read(spark, "profile").withColumn("version", F.lit(v.number)) for v in made]
    return merge_topics(rows).groupBy("version").agg(
        F.count(F.lit(1)).alias("cars"),
        F.count("brand_name").alias("known_models"),
        F.count("color_name").alias("known_colors"),
        F.sum("driver_id").alias("drivers"),
    )


def enriched_from_store(spark: SparkSession, sf: str) -> DataFrame:
    """Enriched with the stored profile, which is neither derived nor shuffled for it."""
    store = FleetStore(f"{_folder(spark)}/dims", buckets=8)
    store.publish(spark, fleet.cars(spark, sf), _fleet_models(spark, sf), fleet.colors(spark, sf))
    return enrich(_telemetry(spark, sf), store.profile(spark))


# Streams, each run until its input is used up ------------------------------------------

#: Micro-batches in which a stream gets the events, in order of time.
PARTS = 4


def _edges(spark: SparkSession, sf: str) -> list[datetime]:
    """The times at which the events are cut into parts of the same duration."""
    low, high = _events(spark, sf).agg(F.min("ts"), F.max("ts")).first()
    return [] if low is None else [low + (high - low) * k / PARTS for k in range(1, PARTS)]


def _parts(spark: SparkSession, sf: str) -> list[DataFrame]:
    """The events cut into stretches of time, those without a time in the first."""
    events = _events(spark, sf)
    edges = _edges(spark, sf)
    if not edges:
        return [events]
    place = sum(((F.col("ts") > F.lit(e)).cast("int") for e in edges), F.lit(0))
    place = F.coalesce(place, F.lit(0))
    return [events.where(place == k) for k in range(PARTS)]


def _event_stream(spark: SparkSession, sf: str, folder: str) -> DataFrame:
    """The events as a stream that brings them in several micro-batches."""
    files = 1
    for k, part in enumerate(_parts(spark, sf)):
        path = f"{folder}/parts/events.parquet/{k}"
        part.write.parquet(path)
        files = max(files, len(spark.read.schema(part.schema).parquet(path).inputFiles()))
    return fleet.event_stream(
        spark, f"{folder}/parts", recursiveFileLookup="true", maxFilesPerTrigger=str(files)
    )


def _message_stream(spark: SparkSession, sf: str, folder: str) -> DataFrame:
    return fleet.messages(_event_stream(spark, sf, folder))


def _enriched_topic(spark: SparkSession, sf: str, folder: str) -> FileTopic:
    topic = FileTopic(f"{folder}/enriched", "enriched")
    start_enrichment(
        _message_stream(spark, sf, folder),
        fleet.profile(spark, sf),
        topic,
        f"{folder}/checkpoints/enrich",
        trigger=DRAIN,
    ).awaitTermination()
    return topic


def _alert_stream(spark: SparkSession, sf: str, folder: str) -> DataFrame:
    """Alert messages straight from the event stream, at the times of their events."""
    events = fleet.telemetry(_event_stream(spark, sf, folder))
    found = alerts(enrich(events, fleet.profile(spark, sf)))
    return encode(
        found.withColumn("timestamp", event_timestamp()), envelope=["timestamp"]
    )


def streamed_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Raw messages through a topic and read back."""
    folder = _folder(spark)
    topic = FileTopic(f"{folder}/raw", "raw")
    start_appending(
        _message_stream(spark, sf, folder), topic, f"{folder}/checkpoints/raw", trigger=DRAIN
    ).awaitTermination()
    return decode(topic.batch(spark), RAW_EVENT)


def streamed_enrichment(spark: SparkSession, sf: str) -> DataFrame:
    return decode(_enriched_topic(spark, sf, _folder(spark)).batch(spark), ENRICHED_EVENT)


def streamed_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Enrichment that reads its dimensions anew in every micro-batch, malformed set apart.

    Returns both outputs: enriched events, and malformed messages with their text alone.
    """
    folder = _folder(spark)
    topic = FileTopic(f"{folder}/enriched", "enriched")
    bad = FileTopic(f"{folder}/malformed", "malformed")
    start_enrichment(
        fleet.mixed_messages(_event_stream(spark, sf, folder)),
        lambda session: fleet.profile(session, sf),
        topic,
        f"{folder}/checkpoints/enrich",
        quarantine=bad,
        trigger=DRAIN,
    ).awaitTermination()
    good = decode(topic.batch(spark), ENRICHED_EVENT).withColumn("malformed", F.lit(None).cast("string"))
    text = bad.batch(spark).select(F.col("value").cast("string").alias("malformed"))
    return good.unionByName(text, allowMissingColumns=True)


def streamed_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Enrichment while the cars are replaced: each micro-batch has the version of its time."""
    folder = _folder(spark)
    store = FleetStore(f"{folder}/dims", buckets=8)
    raw, enriched = FileTopic(f"{folder}/raw", "raw"), FileTopic(f"{folder}/enriched", "enriched")
    telemetry, cars = _telemetry(spark, sf), fleet.cars(spark, sf)
    for k in range(PARTS):
        renamed = cars.withColumn("driver_id", F.col("driver_id") + k)
        store.publish(spark, renamed, *((_fleet_models(spark, sf), fleet.colors(spark, sf)) if not k else ()))
        raw.append(encode(telemetry.where(F.col("event_id").cast("long") % PARTS == k)))
        start_enrichment(
            raw.stream(spark), store.profile, enriched, f"{folder}/checkpoints/enrich", trigger=DRAIN
        ).awaitTermination()
    return decode(enriched.batch(spark), ENRICHED_EVENT)


def streamed_once(spark: SparkSession, sf: str) -> DataFrame:
    """Enrichment of a topic that delivers every third message again, at once or later."""
    folder = _folder(spark)
    raw, enriched = FileTopic(f"{folder}/raw", "raw"), FileTopic(f"{folder}/enriched", "enriched")
    telemetry = _telemetry(spark, sf)
    number = F.col("event_id").cast("long")
    for k in range(PARTS):
        again = (number % 3 == 0) & (number % PARTS <= k)
        sent = telemetry.where(number % PARTS == k).unionByName(telemetry.where(again))
        raw.append(encode(sent))
        start_enrichment(
            raw.stream(spark),
            fleet.profile(spark, sf),
            enriched,
            f"{folder}/checkpoints/enrich",
            once_within="1 hour",
            trigger=DRAIN,
        ).awaitTermination()
    return decode(enriched.batch(spark), ENRICHED_EVENT)


def streamed_alerts(spark: SparkSession, sf: str) -> DataFrame:
    folder = _folder(spark)
    topic = FileTopic(f"{folder}/alerts", "alerts")
    start_alerts(
        _enriched_topic(spark, sf, folder).stream(spark),
        topic,
        f"{folder}/checkpoints/alerts",
        trigger=DRAIN,
    ).awaitTermination()
    return decode(topic.batch(spark), ENRICHED_EVENT)


def streamed_strays(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts of messages of which some arrive long after their event, or long before it.

    Returns the events of both outputs.
    """
    folder = _folder(spark)
    read, good, strays = (FileTopic(f"{folder}/{n}", n) for n in ("enriched", "alerts", "strays"))
    case = F.col("event_id").cast("long") % 7
    days = F.when(case == 0, 400).when(case == 1, -8).when(case == 2, 7).when(case == 3, -7).otherwise(0)
    arrival = event_timestamp() + F.make_dt_interval(days)
    read.append(
        encode(enriched(spark, sf).withColumn("timestamp", arrival), envelope=["timestamp"])
    )
    start_alerts(
        read.stream(spark),
        good,
        f"{folder}/checkpoints/alerts",
        strays=strays,
        within="7 days",
        trigger=DRAIN,
    ).awaitTermination()
    sent = [
        decode(topic.batch(spark), ENRICHED_EVENT).select(F.lit(topic is strays).alias("stray"), "*")
        for topic in (good, strays)
    ]
    return sent[0].unionByName(sent[1])


def streamed_windows(spark: SparkSession, sf: str, **how) -> DataFrame:
    """Window counts in one of the output modes."""
    folder = _folder(spark)
    table = SnapshotTable(f"{folder}/windows")
    start_window_counts(
        _alert_stream(spark, sf, folder),
        table,
        f"{folder}/checkpoints/counts",
        trigger=DRAIN,
        counted=fleet.COUNTED,
        **how,
    ).awaitTermination()
    return _without_zone(table.read(spark).drop("version"))


def streamed_panes(spark: SparkSession, sf: str) -> DataFrame:
    """Window counts from stored panes."""
    folder = _folder(spark)
    table = SnapshotTable(f"{folder}/panes")
    start_pane_counts(
        _alert_stream(spark, sf, folder),
        table,
        f"{folder}/checkpoints/panes",
        trigger=DRAIN,
        counted=fleet.COUNTED,
    ).awaitTermination()
    return _without_zone(windows_of_panes(table, spark))


def streamed_late(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts counted or late, where the newest part of the events comes first."""
    folder = _folder(spark)
    raw = FileTopic(f"{folder}/raw", "raw")
    late, table = FileTopic(f"{folder}/late", "late"), SnapshotTable(f"{folder}/panes")
    found = encode(fleet_alerts(spark, sf))
    edge = _edges(spark, sf)[-1].strftime("%Y-%m-%dT%H:%M:%S.%f+00:00")
    newest = F.get_json_object("value", "$.event_time") > edge
    for part in (newest, ~newest):
        raw.append(found.where(part))
        start_pane_counts(
            raw.stream(spark), table, f"{folder}/checkpoints/panes", late=late, trigger=DRAIN
        ).awaitTermination()
    counted = table.read(spark).agg(
        F.sum("num_of_rows").alias("counted"), F.max("maximum_speed").alias("maximum_speed")
    )
    behind = late.batch(spark).agg(F.count(F.lit(1)).alias("late"))
    both = counted.unionByName(behind, allowMissingColumns=True)
    return both.agg(*(f(c).alias(c) for c, f in zip(both.columns, (F.sum, F.max, F.sum))))


def chained_topics(spark: SparkSession, sf: str) -> DataFrame:
    """Enrich, alerts and counts chained by topics; the complete windows at the end."""
    folder = _folder(spark)
    raw = FileTopic(f"{folder}/raw", "raw")
    parts = _parts(spark, sf)
    for part in parts:
        raw.append(fleet.messages(part))
    # As many micro-batches as parts, however many files these have: each may broadcast the fleet.
    files = -(-len(raw.batch(spark).inputFiles()) // len(parts))
    raw = replace(raw, options={"maxFilesPerTrigger": str(max(1, files))})
    table = SnapshotTable(f"{folder}/windows")
    steps = fleet_steps(
        spark,
        raw=raw,
        enriched=FileTopic(f"{folder}/enriched", "enriched"),
        alert=FileTopic(f"{folder}/alerts", "alerts"),
        table=table,
        profile=fleet.profile(spark, sf),
        checkpoints=f"{folder}/checkpoints",
        trigger=DRAIN,
        enrichment={"lookup": "measured"},
        counted=fleet.COUNTED,
    )
    drain(steps)
    return _without_zone(table.read(spark).drop("version"))


QUERIES: dict[str, Query] = {
    "dimension_scan": dimension_scan,
    "topic_union": topic_union,
    "literal_colors": literal_colors,
    "dimension_written_and_read": dimension_written_and_read,
    "dimension_preview": dimension_preview,
    "distinct_cars": distinct_cars,
    "pruned_columns": pruned_columns,
    "renamed_models": renamed_models,
    "computed_columns": computed_columns,
    "decoded_messages": decoded_messages,
    "quarantined_messages": quarantined_messages,
    "readable_messages": readable_messages,
    "encoded_messages": encoded_messages,
    "recoded_messages": recoded_messages,
    "field_faults": field_faults,
    "window_fields": window_fields,
    "alert_flags": alert_flags,
    "timed_events": timed_events,
    "event_times": event_times,
    "event_times_or_arrival": event_times_or_arrival,
    "normalized_colors": normalized_colors,
    "joined_cars": joined_cars,
    "joined_models": joined_models,
    "joined_colors": joined_colors,
    "car_profiles": car_profiles,
    "enriched": enriched,
    "enriched_by_size": partial(enriched, lookup="measured"),
    "enriched_salted": partial(enriched, lookup="salted"),
    "enriched_with_hot_keys": enriched_with_hot_keys,
    "rows_per_model": rows_per_model,
    "colors_per_model": colors_per_model,
    "maxima_per_model": maxima_per_model,
    "events_per_car": events_per_car,
    "one_event_per_car": one_event_per_car,
    "repeated_cars": repeated_cars,
    "alerts": fleet_alerts,
    "alert_windows": alert_windows,
    "alert_windows_direct": partial(alert_windows, method="direct"),
    "alert_windows_uneven": partial(alert_windows, length="10 minutes", slide="4 minutes"),
    "message_windows": message_windows,
    "latest_window": latest_alert_window,
    "latest_closed_window": latest_closed_alert_window,
    "dimension_versions": dimension_versions,
    "enriched_from_store": enriched_from_store,
    "streamed_messages": streamed_messages,
    "streamed_enrichment": streamed_enrichment,
    "streamed_refresh": streamed_refresh,
    "streamed_versions": streamed_versions,
    "streamed_once": streamed_once,
    "streamed_alerts": streamed_alerts,
    "streamed_strays": streamed_strays,
    "streamed_windows_complete": partial(streamed_windows, mode="complete"),
    "streamed_windows_update": partial(streamed_windows, mode="update"),
    "streamed_windows_append": partial(streamed_windows, mode="append"),
    "streamed_windows_append_panes": partial(streamed_windows, mode="append", method="panes"),
    "streamed_latest_window": partial(streamed_windows, mode="complete", only_latest=True),
    "streamed_latest_window_bounded": partial(streamed_windows, mode="update", only_latest=True),
    "streamed_panes": streamed_panes,
    "streamed_late": streamed_late,
    "chained_topics": chained_topics,
}
