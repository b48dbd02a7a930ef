"""The jobs chained by topics: enrich, then alerts, then counts."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions.codec import decode
from ..operators.alerts import alerts
from ..operators.counts import latest_window
from ..operators.enrich import enrich
from ..plans.telemetry import counted_windows
from ..schemas import ENRICHED_EVENT, RAW_EVENT
from ..sources.messages import FileTopics, Topic
from .jobs import start_alerts, start_enrichment, start_pane_counts, start_window_counts
from .sinks import Trigger, start_console, start_preview
from .snapshots import SnapshotTable

STEPS = ("enrich", "alerts", "counts")
Starter = Callable[[], StreamingQuery]


def fleet_steps(
    spark: SparkSession,
    *,
    raw: Topic,
    enriched: Topic,
    alert: Topic,
    table: SnapshotTable,
    profile: DataFrame | Callable[[SparkSession], DataFrame],
    checkpoints: str,
    counter_input: Topic | FileTopics | None = None,
    panes: bool = False,
    preview: bool = False,
    trigger: Trigger = None,
    counter_trigger: Trigger = None,
    enrichment: Mapping | None = None,
    limits: Mapping | None = None,
    **counts,
) -> dict[str, Starter]:
    """How to start each step, in order. A step reads its topic only once it is started.

    The counter reads ``counter_input``, or the alert topic alone, and stores windows
    or, if asked to, ``panes``, every minute unless ``counter_trigger`` or ``trigger``
    says otherwise. ``counts`` go to the job that does it, ``enrichment`` (lookup, hot
    keys, malformed messages) and ``limits`` of the alerts, and where strays go, to theirs. ``preview`` also
    shows enriched events, alerts and the latest window on the console, by queries of
    their own.
    """
    start_counts = start_pane_counts if panes else start_window_counts
    counted = counter_trigger or trigger
    every = {"trigger": counted} if counted else {}
    # A checkpoint of its own for every kind of count: states do not fit each other.
    kind = "panes" if panes else counts.get("mode", "complete")

    def show_enriched() -> StreamingQuery:
        cars = profile(spark) if callable(profile) else profile
        rows = enrich(decode(raw.stream(spark), RAW_EVENT), cars, **{k: v for k, v in (enrichment or {}).items() if k in ("lookup", "hot_keys", "salts")})
        return start_preview(rows, trigger=trigger, name="enrich preview")

    def show_alerts() -> StreamingQuery:
        rows = alerts(decode(enriched.stream(spark), ENRICHED_EVENT))
        return start_preview(rows, trigger=trigger, name="alerts preview")

    steps = {
        "enrich": lambda: start_enrichment(
            raw.stream(spark), profile, enriched, f"{checkpoints}/enrich", trigger=trigger,
            **(enrichment or {}),
        ),
        "alerts": lambda: start_alerts(
            enriched.stream(spark), alert, f"{checkpoints}/alerts", trigger=trigger,
            **(limits or {}),
        ),
        "counts": lambda: start_counts(
            (counter_input or alert).stream(spark),
            table,
            f"{checkpoints}/counts-{kind}",
            **every,
            **counts,
        ),
    }
    if not preview:
        return steps

    def show_latest() -> StreamingQuery:
        measures = {k: v for k, v in counts.items() if k in ("counted", "maxima", "length", "slide")}
        rows = (counter_input or alert).stream(spark)
        windows = latest_window(counted_windows(rows, **measures))
        return start_console(windows, f"{checkpoints}/latest-preview", name="latest preview", **every)

    shown = {
        "enrich preview": show_enriched,
        "alerts preview": show_alerts,
        "latest preview": show_latest,
    }
    order = ("enrich", "enrich preview", "alerts", "alerts preview", "counts", "latest preview")
    return {name: (steps | shown)[name] for name in order}


def _from(steps: Mapping[str, Starter], first: str | None) -> dict[str, Starter]:
    names = list(steps)
    if first is not None and first not in names:
        raise ValueError(f"no step {first!r}; steps are {names}")
    begin = names.index(first) if first else 0
    return {n: steps[n] for n in names[begin:]}


def start(steps: Mapping[str, Starter], first: str | None = None) -> dict[str, StreamingQuery]:
    """Start the steps together in one session; if one cannot start, stop those before it."""
    running: dict[str, StreamingQuery] = {}
    try:
        for name, starter in _from(steps, first).items():
            running[name] = starter()
    except Exception:
        for query in running.values():
            query.stop()
        raise
    return running


def wait_for_any(spark: SparkSession, running: Mapping[str, StreamingQuery]) -> None:
    """Wait until any of these queries ends, then stop the others. A failure is raised.

    Queries of the session that are not among them neither end the wait nor are stopped.
    """
    try:
        while not any(query.awaitTermination(1) for query in running.values()):
            pass
    finally:
        for query in running.values():
            query.stop()


def drain(steps: Mapping[str, Starter], first: str | None = None) -> None:
    """Run the steps one after the other, each until its input is used up.

    For steps with the trigger ``{"availableNow": True}``.
    """
    for starter in _from(steps, first).values():
        starter().awaitTermination()
