"""Sliding event-time counts of alerts."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import timedelta
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import color_of, event_timestamp
from ..schemas import COUNTED_COLORS, MAXIMA, WATERMARK, WINDOW_LENGTH, WINDOW_SLIDE

METHODS = ("direct", "panes")


def normalize(
    df: DataFrame,
    *,
    time: str = "event_time",
    fallback: str | None = None,
    colors: Sequence[str] = ("color_name", "color"),
) -> DataFrame:
    """Add ``event_ts`` and ``color_norm``; drop rows that have no time at all.

    Both come out of a generator, like decoded messages do. Otherwise the filter
    and the windows would each read the time text anew.
    """
    present = [c for c in colors if c in df.columns]
    added = F.struct(
        event_timestamp(time, fallback).alias("event_ts"), color_of(*present).alias("color_norm")
    )
    return df.select("*", F.inline(F.array(added))).where(F.col("event_ts").isNotNull())


def _measures(counted: Sequence[str], maxima: Sequence[str]) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("num_of_rows"),
        *[F.count_if(F.col("color_norm") == c).alias(f"num_of_{c}") for c in counted],
        *[F.max(m).alias(f"maximum_{m}") for m in maxima],
    ]


def _combined(columns: Sequence[str]) -> list[Column]:
    merge = {"num_of": F.sum, "maximum": F.max}
    return [
        merge["maximum" if c.startswith("maximum_") else "num_of"](c).alias(c) for c in columns
    ]


def _bounds(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c != "window"]
    return df.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest
    )


def duration(text: str) -> timedelta:
    """An interval of fixed length as Spark writes it, e.g. ``15 minutes`` or ``interval 1 hour``."""
    parts = re.findall(r"(\d+(?:\.\d+)?)\s*([a-z]+)", text.lower().removeprefix("interval"))
    units = {f"{name}s": {f"{name}s": 1} for name in ("week", "day", "hour", "minute", "second")}
    units |= {"milliseconds": {"milliseconds": 1}, "microseconds": {"microseconds": 1}}
    total = timedelta()
    for number, unit in parts:
        known = units.get(unit if unit.endswith("s") else f"{unit}s")
        if known is None:
            raise ValueError(f"no fixed length of time: {text!r}")
        total += float(number) * timedelta(**known)
    if not total:
        raise ValueError(f"no length of time: {text!r}")
    return total


def slides_per_window(length: str, slide: str) -> int:
    """How many slides a window spans; the slide has to divide the length."""
    whole, rest = divmod(duration(length), duration(slide))
    if rest or not whole:
        raise ValueError(f"slide {slide!r} does not divide length {length!r}")
    return whole


def pane_length(length: str, slide: str) -> str:
    """The longest stretch of time that both divides the windows and their slide."""
    micros = [d // timedelta(microseconds=1) for d in (duration(length), duration(slide))]
    if micros[1] > micros[0]:
        raise ValueError(f"slide {slide!r} is longer than length {length!r}")
    return f"{gcd(*micros)} microseconds"


def pane_counts(
    df: DataFrame,
    *,
    slide: str = WINDOW_SLIDE,
    counted: Sequence[str] = COUNTED_COLORS,
    maxima: Sequence[str] = MAXIMA,
) -> DataFrame:
    """Counts per slide of time. They combine into all windows whose length and slide are
    multiples of it."""
    panes = df.groupBy(F.window("event_ts", slide)).agg(*_measures(counted, maxima))
    rest = [c for c in panes.columns if c != "window"]
    return panes.select(F.col("window.start").alias("pane_start"), *rest)


def combine_panes(
    panes: DataFrame, *, length: str = WINDOW_LENGTH, slide: str = WINDOW_SLIDE
) -> DataFrame:
    """Sliding windows from panes; a pane may occur in several parts.

    The length of a pane has to divide both ``length`` and ``slide``.
    """
    pane_length(length, slide)
    measures = [c for c in panes.columns if c.startswith(("num_of_", "maximum_"))]
    windows = panes.groupBy(F.window("pane_start", length, slide))
    return _bounds(windows.agg(*_combined(measures)))


def window_counts(
    df: DataFrame,
    *,
    length: str = WINDOW_LENGTH,
    slide: str = WINDOW_SLIDE,
    watermark: str | None = WATERMARK,
    counted: Sequence[str] = COUNTED_COLORS,
    maxima: Sequence[str] = MAXIMA,
    method: str | None = None,
) -> DataFrame:
    """Rows, rows per counted color and maxima in every sliding window.

    ``direct`` copies each row into all its windows before grouping. ``panes``
    groups rows first, by slide or, where that does not divide the length, by the
    greatest stretch that divides both, and copies only those groups: the copies grow
    with time and no longer with the rows, and there are never more groups than rows.
    Batch uses panes. A stream that keeps all windows (complete mode) or
    updates them allows one aggregation only and so counts directly; in append
    mode ``panes`` may be asked for.
    """
    if method is None:
        method = "direct" if df.isStreaming else "panes"
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}, not {method!r}")

    timed = df.withWatermark("event_ts", watermark) if watermark and df.isStreaming else df
    if method == "direct":
        windows = timed.groupBy(F.window("event_ts", length, slide))
        return _bounds(windows.agg(*_measures(counted, maxima)))
    if not df.isStreaming:
        panes = pane_counts(timed, slide=pane_length(length, slide), counted=counted, maxima=maxima)
        return combine_panes(panes, length=length, slide=slide)

    pane = F.window("event_ts", pane_length(length, slide))
    panes = timed.groupBy(pane).agg(*_measures(counted, maxima))
    measures = [c for c in panes.columns if c != "window"]
    windows = panes.groupBy(F.window(F.window_time("window"), length, slide))
    return _bounds(windows.agg(*_combined(measures)))


def latest_window(windows: DataFrame) -> DataFrame:
    """The window that ends last.

    It starts with the newest row's minute, so it has only that minute's rows yet.
    """
    return windows.orderBy(F.col("window_end").desc()).limit(1)


def latest_closed_window(
    windows: DataFrame, *, length: str = WINDOW_LENGTH, slide: str = WINDOW_SLIDE
) -> DataFrame:
    """The last window that ends no later than the newest row's slide: a full length of rows.

    The newest row lies in ``length / slide`` windows one slide apart, all of which
    exist. The earliest of them is the closed one, so two small top-k steps find it
    without a second look at the rows. Needs all windows of ``window_counts``.
    """
    holding_newest = slides_per_window(length, slide)
    newest = windows.orderBy(F.col("window_end").desc()).limit(holding_newest)
    return newest.orderBy(F.col("window_end").asc()).limit(1)
