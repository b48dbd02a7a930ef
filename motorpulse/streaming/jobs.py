"""The jobs as streaming queries."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import timedelta
from inspect import signature

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..files import create_text, delete, names_in, read_text
from ..functions.codec import decode, encode
from ..functions.columns import stray_time
from ..operators.alerts import alerts
from ..operators.counts import (
    combine_panes,
    duration,
    latest_window,
    normalize,
    pane_counts,
    window_counts,
)
from ..operators.enrich import enrich
from ..plans.telemetry import alert_messages, counted_windows, enriched_messages
from ..schemas import COUNTER_INPUT, ENRICHED_EVENT, RAW_EVENT, REFRESH_EVERY, WATERMARK
from ..sources.messages import Topic
from .sinks import BatchWriter, Trigger, keep_settings, start_appending, start_writers
from .snapshots import SnapshotTable, day_of

MODES = ("complete", "update", "append")
#: How far an event's time may be from its arrival where that is checked.
STRAY_AFTER = "7 days"
EVERY_MINUTE = {"processingTime": REFRESH_EVERY}


def start_enrichment(
    messages: DataFrame,
    profile: DataFrame | Callable[[SparkSession], DataFrame],
    sink: Topic,
    checkpoint: str,
    *,
    on_malformed: str = "keep",
    quarantine: Topic | None = None,
    lookup: str = "auto",
    once_within: str | None = None,
    trigger: Trigger = None,
    name: str = "enrich",
    **how,
) -> StreamingQuery:
    """Raw messages to enriched messages.

    A profile given as a DataFrame is fixed at the start; replacing its files ends
    the query. Given as a function it is read anew in every micro-batch.
    ``quarantine`` receives the text of malformed messages instead of the sink.

    ``once_within`` drops messages that are delivered again: of those with one event id
    that arrive within this time (or some micro-batches more) the first counts. State holds
    the ids of that time only. Messages without an id all stay.

    Without that the query keeps no state, so Spark adapts its plan in every micro-batch
    and broadcasts a profile that turns out small; with it the profile is joined behind
    the state, in a plan that is adapted as well. ``how`` may name ``hot_keys`` and
    ``salts`` for ``lookup="salted"``.
    """
    how["lookup"] = lookup
    if once_within is not None:
        keep_settings(messages.sparkSession, checkpoint, {"once_within": duration(once_within)})
    elif not callable(profile) and quarantine is None:
        out = enriched_messages(messages, profile, on_malformed=on_malformed, **how)
        return start_appending(out, sink, checkpoint, trigger=trigger, name=name)

    def dimension(batch: DataFrame) -> DataFrame:
        return profile(batch.sparkSession) if callable(profile) else profile

    def write_events(batch: DataFrame, batch_id: int, writer: str) -> None:
        good = batch.where(F.col("malformed").isNull()) if quarantine else batch
        sink.append(encode(enrich(good, dimension(batch), **how)), batch_id, writer)

    def write_malformed(batch: DataFrame, batch_id: int, writer: str) -> None:
        bad = batch.where(F.col("malformed").isNotNull())
        quarantine.append(bad.select(F.col("malformed").alias("value")), batch_id, writer)

    events = decode(
        messages,
        RAW_EVENT,
        on_malformed="quarantine" if quarantine else on_malformed,
        envelope=["timestamp"] if once_within else (),
    )
    if once_within:
        events = first_deliveries(events, once_within)
    writers = [write_events, write_malformed] if quarantine else [write_events]
    return start_writers(events, writers, checkpoint, trigger=trigger, name=name)


def first_deliveries(
    events: DataFrame, within: str, *, key: str = "event_id", arrival: str = "timestamp"
) -> DataFrame:
    """Events without those that arrive again within a time; rows without a key all stay.

    The watermark is that of arrivals, which come in order but for the brokers' own
    disorder, and not of event times, so that no event is dropped for being old.
    """
    named = events.withColumn("delivery", F.coalesce(F.col(key), F.expr("uuid()")))
    first = named.withWatermark(arrival, within).dropDuplicatesWithinWatermark(["delivery"])
    return first.drop("delivery", arrival)


def start_alerts(
    messages: DataFrame,
    sink: Topic,
    checkpoint: str,
    *,
    strays: Topic | None = None,
    within: str = STRAY_AFTER,
    trigger: Trigger = None,
    name: str = "alerts",
    **limits,
) -> StreamingQuery:
    """Enriched messages to alert messages.

    With ``strays``, alerts whose time is further than ``within`` from the arrival of
    their message go to that topic instead. A single one far ahead would move the
    watermark of the counter past all others, and each wrong day costs a folder there;
    so the days of one micro-batch are no more than its arrivals span, and twice ``within``.
    """
    if strays is None:
        out = alert_messages(messages, **limits)
        return start_appending(out, sink, checkpoint, trigger=trigger, name=name)
    found = alerts(decode(messages, ENRICHED_EVENT, envelope=["timestamp"]), **limits)
    found = found.withColumn("stray", stray_time(duration(within)))

    def write_to(topic: Topic, rows: str) -> BatchWriter:
        fields = ENRICHED_EVENT.fieldNames()
        return lambda batch, batch_id, writer: topic.append(
            encode(batch.where(rows).select(*fields)), batch_id, writer
        )

    writers = [write_to(sink, "NOT stray"), write_to(strays, "stray")]
    return start_writers(found, writers, checkpoint, trigger=trigger, name=name)


def start_window_counts(
    messages: DataFrame,
    table: SnapshotTable,
    checkpoint: str,
    *,
    mode: str = "complete",
    only_latest: bool = False,
    trigger: Trigger = EVERY_MINUTE,
    name: str = "counts",
    **counts,
) -> StreamingQuery:
    """Alert messages to a table of window counts.

    ``complete`` counts rows of any age and keeps every window in state for good.
    ``update`` keeps a window until the watermark passes it and drops rows that
    come later than that. ``append`` adds each window once, when the watermark
    passes it. Both rewrite only the days that a micro-batch changes. ``only_latest``
    stores just the newest window. ``version`` in the table is the micro-batch that
    last changed a window.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    keep_settings(messages.sparkSession, checkpoint, _kept(mode, only_latest, counts))
    windows = counted_windows(messages, **counts)
    if only_latest and mode == "complete":
        windows = latest_window(windows)

    def merge(batch: DataFrame, batch_id: int, writer: str) -> None:
        rows = batch.withColumn("version", F.lit(batch_id).cast("long"))
        if mode != "complete" and not only_latest:
            _merge_days(rows, table, batch_id, writer, "window_start", _newest_versions)
            return
        stored = table.read(batch.sparkSession, before=batch_id) if mode != "complete" else None
        if stored is not None:
            rows = _newest_versions(stored.unionByName(rows))
        if only_latest:
            rows = latest_window(rows)
        table.write(rows, batch_id, writer)

    return start_writers(windows, [merge], checkpoint, mode=mode, trigger=trigger, name=name)


def _kept(mode: str, only_latest: bool, counts: dict) -> dict:
    """What the state and the result of window counts depend on, defaults included."""
    given = {k: p.default for k, p in signature(window_counts).parameters.items()} | counts
    method = given["method"] or "direct"
    kept = {"mode": mode, "only_latest": only_latest, "method": method}
    kept |= {k: given[k] and duration(given[k]) for k in ("length", "slide", "watermark")}
    return kept | {k: list(given[k]) for k in ("counted", "maxima")}


def _merge_days(
    rows: DataFrame,
    table: SnapshotTable,
    batch_id: int,
    writer: str,
    time: str,
    combine: Callable[[DataFrame], DataFrame],
) -> None:
    """Combine a batch's rows, few beside its events, with those stored for their days."""
    rows = rows.persist()
    try:
        days = [row[0] for row in rows.select(day_of(time)).distinct().collect()]
        stored = table.read(rows.sparkSession, before=batch_id, days=days)
        merged = rows if stored is None else combine(stored.unionByName(rows))
        table.write_days(merged, batch_id, writer, time=time)
    finally:
        rows.unpersist()


def _newest_versions(rows: DataFrame) -> DataFrame:
    bounds = ("window_start", "window_end")
    rest = ["version", *[c for c in rows.columns if c not in (*bounds, "version")]]
    newest = rows.groupBy(*bounds).agg(F.max(F.struct(*rest)).alias("newest"))
    return newest.select(*bounds, "newest.*").select(*rows.columns)


def start_pane_counts(
    messages: DataFrame,
    table: SnapshotTable,
    checkpoint: str,
    *,
    on_malformed: str = "keep",
    late: Topic | None = None,
    lateness: str = WATERMARK,
    trigger: Trigger = EVERY_MINUTE,
    name: str = "panes",
    **panes,
) -> StreamingQuery:
    """Alert messages to a table of counts per slide, without streaming state.

    Every micro-batch is grouped to panes on its own and added to those stored for its
    days; files of other days stay as they are.
    ``combine_panes(table.read(spark))`` then gives what the complete mode gives,
    rows of any age included, while a minute costs one stored row and no window
    stays in memory.

    With ``late``, rows that come later than ``lateness`` behind the newest event of the
    micro-batches before go to that topic, as messages, and are not counted: every row
    that has a time is either counted or there. A replay splits a micro-batch alike.
    """
    given = {k: p.default for k, p in signature(pane_counts).parameters.items()} | panes
    kept = {"panes": duration(given["slide"]), "lateness": late and duration(lateness), **{k: list(given[k]) for k in ("counted", "maxima")}}
    keep_settings(messages.sparkSession, checkpoint, kept)
    rows = decode(
        messages, COUNTER_INPUT, on_malformed=on_malformed, envelope=["timestamp"]
    )

    def merge(batch: DataFrame, batch_id: int, writer: str) -> None:
        timed = normalize(batch, fallback="timestamp")
        if late is not None:
            timed = timed.persist()
        try:
            if late is not None:
                timed = _on_time(timed, late, duration(lateness), checkpoint, batch_id, writer)
            _merge_days(pane_counts(timed, **panes), table, batch_id, writer, "pane_start", _added)
        finally:
            if late is not None:
                timed.unpersist()

    return start_writers(rows, [merge], checkpoint, trigger=trigger, name=name)


def _on_time(
    timed: DataFrame, late: Topic, lateness: timedelta, checkpoint: str, batch_id: int, writer: str
) -> DataFrame:
    """The rows not behind the watermark; the others are sent to ``late``.

    What the newest event of all micro-batches up to each one is, is kept beside the
    checkpoint for the next one, and for a replay of that.
    """
    spark = timed.sparkSession
    folder = f"{checkpoint}/newest"
    known = sorted(int(n) for n in names_in(spark, folder) if n.isdigit() and int(n) < batch_id)
    before = json.loads(read_text(spark, f"{folder}/{known[-1]}")) if known else None
    newest = timed.agg(F.unix_micros(F.max("event_ts"))).first()[0]
    newest = max((n for n in (before, newest) if n is not None), default=None)
    create_text(spark, f"{folder}/{batch_id}", json.dumps(newest))
    for old in known[:-1]:
        delete(spark, f"{folder}/{old}")
    if before is None:
        late.append(encode(timed.where("false").select(*COUNTER_INPUT.fieldNames())), batch_id, writer)
        return timed
    edge = F.timestamp_micros(F.lit(before - lateness // timedelta(microseconds=1)))
    behind = timed.where(F.col("event_ts") < edge)
    late.append(encode(behind.select(*COUNTER_INPUT.fieldNames())), batch_id, writer)
    return timed.where(F.col("event_ts") >= edge)


def _added(panes: DataFrame) -> DataFrame:
    totals = [
        (F.max if c.startswith("maximum_") else F.sum)(c).alias(c)
        for c in panes.columns
        if c != "pane_start"
    ]
    return panes.groupBy("pane_start").agg(*totals)


def windows_of_panes(table: SnapshotTable, spark: SparkSession, **windows) -> DataFrame | None:
    """The sliding windows held by a pane table, or None before the first micro-batch."""
    stored = table.read(spark)
    return None if stored is None else combine_panes(stored, **windows)
