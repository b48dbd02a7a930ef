"""Column expressions of the domain. All are built-in functions, so they stay in codegen."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import MAX_RPM, MAX_SPEED, SPEED_PER_GEAR


def expected_gear(speed: str = "speed", speed_per_gear: float = SPEED_PER_GEAR) -> Column:
    """Gear that fits a speed. Halves round away from zero; NULL speed gives NULL."""
    return F.round(F.col(speed).cast("double") / speed_per_gear).cast("int")


def alert_condition(max_speed: int = MAX_SPEED, max_rpm: int = MAX_RPM) -> Column:
    """Too fast, wrong gear or over-revving, under SQL three-valued logic.

    One true arm decides; an unknown arm beside false ones leaves the row unknown,
    which a filter drops.
    """
    too_fast = F.col("speed") > max_speed
    wrong_gear = F.col("expected_gear") != F.col("gear")
    over_revving = F.col("rpm") > max_rpm
    return too_fast | wrong_gear | over_revving


def event_timestamp(text: str = "event_time", fallback: str | None = None) -> Column:
    """Event time from text; unreadable text gives NULL or the message's own time."""
    parsed = F.try_to_timestamp(F.col(text))
    return parsed if fallback is None else F.coalesce(parsed, F.col(fallback))


def stray_time(within: timedelta, text: str = "event_time", arrival: str = "timestamp") -> Column:
    """Whether an event's time is further than ``within`` from its arrival, before or after.

    Unreadable text has no time to be wrong, nor has an event without an arrival: false.
    """
    parsed, span = event_timestamp(text), F.lit(within)
    far = (parsed < F.col(arrival) - span) | (parsed > F.col(arrival) + span)
    return F.coalesce(far, F.lit(False))


def color_of(*columns: str) -> Column:
    """Lower-cased color, from the first of the columns that is not NULL."""
    return F.lower(F.coalesce(*[F.col(c) for c in columns]))
