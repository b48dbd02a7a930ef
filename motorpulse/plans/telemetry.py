"""The three jobs from messages to messages or counts; the same on tables and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.codec import decode, encode
from ..operators.alerts import alerts
from ..operators.counts import normalize, window_counts
from ..operators.enrich import enrich
from ..schemas import COUNTER_INPUT, ENRICHED_EVENT, MAX_RPM, MAX_SPEED, RAW_EVENT


def enriched_messages(
    messages: DataFrame, profile: DataFrame, *, on_malformed: str = "keep", **how
) -> DataFrame:
    """Raw messages to enriched messages. A malformed one becomes ``{}`` unless dropped.

    ``how`` says how the profile is joined, as in ``attach_profile``.
    """
    events = decode(messages, RAW_EVENT, on_malformed=on_malformed)
    return encode(enrich(events, profile, **how))


def alert_messages(
    messages: DataFrame, *, max_speed: int = MAX_SPEED, max_rpm: int = MAX_RPM
) -> DataFrame:
    """Enriched messages to alert messages. Malformed ones are never alerts."""
    return encode(alerts(decode(messages, ENRICHED_EVENT), max_speed, max_rpm))


def counted_windows(messages: DataFrame, *, on_malformed: str = "keep", **counts) -> DataFrame:
    """Alert messages to sliding counts.

    A message without a readable time counts at its arrival time, a malformed one
    included: it adds to ``num_of_rows`` only. ``counts`` go to ``window_counts``.
    """
    rows = decode(messages, COUNTER_INPUT, on_malformed=on_malformed, envelope=["timestamp"])
    return window_counts(normalize(rows, fallback="timestamp"), **counts)
