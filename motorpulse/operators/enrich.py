"""Enrichment of events with the car profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import expected_gear
from ..schemas import ENRICHED_EVENT, SPEED_PER_GEAR
from .dimensions import car_profile

LOOKUPS = ("auto", "measured", "salted")
BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD = 32


def fits_broadcast(profile: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Measure whether a table stays within ``limit`` bytes when broadcast.

    One aggregate over the dimension side; the events are not touched.
    """
    width = F.lit(ROW_OVERHEAD)
    for field in profile.schema.fields:
        width = width + F.lit(8)
        if isinstance(field.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
    size = profile.agg(F.sum(width.cast("long"))).first()[0] or 0
    return size <= limit


def frequent_keys(events: DataFrame, key: str = "car_id", n: int = 1000) -> list:
    """The ``n`` keys with most rows. Any other key holds less than one row in ``n``.

    Counted before the shuffle and cut to ``n`` on the executors.
    """
    known = events.where(F.col(key).isNotNull()).groupBy(key).count()
    top = known.orderBy(F.col("count").desc(), F.col(key)).limit(n)
    return [row[key] for row in top.collect()]


def attach_profile(
    events: DataFrame,
    profile: DataFrame,
    *,
    key: str = "car_id",
    lookup: str = "auto",
    hot_keys: Sequence | None = None,
    salts: int | None = None,
) -> DataFrame:
    """Left-join a table that has one row per key; every event comes out exactly once.

    ``auto`` leaves the choice to Spark: by estimated and measured size, with skewed
    partitions split at run time, in batch and in streams without state.
    ``measured`` broadcasts a table that ``fits_broadcast`` and salts the join with
    any other.

    ``salted`` shuffles both sides on key and salt. Events of hot keys and those
    without a key are spread over ``salts`` salts, the width of the shuffle unless
    told; the profile rows of hot keys are copied to each of them. Other keys stay
    whole. ``hot_keys`` come from ``frequent_keys`` of an earlier run or from what is
    known of the fleet; without them only events without a key are spread.
    """
    if lookup not in LOOKUPS:
        raise ValueError(f"lookup must be one of {LOOKUPS}, not {lookup!r}")
    if lookup == "auto":
        return events.join(profile, key, "left")
    if lookup == "measured" and fits_broadcast(profile):
        return events.join(F.broadcast(profile), key, "left")

    salts = salts or int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.col(key).isin(list(hot_keys)) if hot_keys else F.lit(False)
    # The partition id separates copies of one message, which hash alike. It does
    # not depend on row order, so a recomputed task gives the same salts.
    spread = F.pmod(F.xxhash64(*events.columns, F.spark_partition_id()), F.lit(salts)).cast("int")
    salt = F.when(F.col(key).isNull() | hot, spread).otherwise(0)
    every = F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    copies = profile.where(F.col(key).isNotNull()).withColumn("salt", F.explode(every))
    # Told to merge: by the size of its files alone Spark may still send a large table to all.
    return events.withColumn("salt", salt).join(copies.hint("merge"), [key, "salt"], "left").drop("salt")


def enrich(
    events: DataFrame,
    cars: DataFrame,
    models: DataFrame | None = None,
    colors: DataFrame | None = None,
    *,
    speed_per_gear: float = SPEED_PER_GEAR,
    **how,
) -> DataFrame:
    """Add driver, brand, model, color and the expected gear to raw events.

    Takes the three dimensions, or a ready car profile alone. Events of unknown
    cars stay, with NULL attributes. ``how`` goes to ``attach_profile``.
    """
    if (models is None) != (colors is None):
        raise ValueError("give models and colors together, or neither with a car profile")
    profile = cars if models is None else car_profile(cars, models, colors)
    joined = attach_profile(events, profile, **how)
    return joined.withColumn(
        "expected_gear", expected_gear(speed_per_gear=speed_per_gear)
    ).select(*ENRICHED_EVENT.fieldNames())
