"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_COPIES`` how
often every event occurs in the dense messages: the same minutes with more rows
each, which is how a larger fleet looks. Results go to Spark's no-op sink, so all
columns are computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from motorpulse.functions import decode  # noqa: E402
from motorpulse.operators import alerts, enrich, normalize, window_counts  # noqa: E402
from motorpulse.plans import alert_messages, enriched_messages, fleet_tables  # noqa: E402
from motorpulse.plans.queries import QUERIES  # noqa: E402
from motorpulse.schemas import RAW_EVENT  # noqa: E402
from motorpulse.session import shared_folder  # noqa: E402
from motorpulse.sources import FileTopic  # noqa: E402
from motorpulse.streaming import (  # noqa: E402
    SnapshotTable,
    start_pane_counts,
    start_window_counts,
)

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
COPIES = int(os.environ.get("BENCH_COPIES", "20"))
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))

BATCH = [
    "decoded_messages", "encoded_messages", "enriched", "enriched_by_size", "enriched_salted",
    "enriched_with_hot_keys", "one_event_per_car", "repeated_cars", "alerts", "alert_windows",
    "alert_windows_direct",
    "message_windows", "latest_window", "latest_closed_window",
]
STREAMS = [
    "streamed_enrichment", "streamed_alerts", "streamed_windows_complete",
    "streamed_windows_update", "streamed_panes", "chained_topics",
]


def seconds(build, repeats: int) -> float:
    """Best of some runs, planning included."""
    best = float("inf")
    for _ in range(repeats):
        begun = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        best = min(best, time.perf_counter() - begun)
    return round(best, 3)


def dense_messages(spark: SparkSession) -> tuple[str, int]:
    events = fleet_tables.table(spark, SF_DIR, "events")
    copies = events.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(COPIES))))
    spread = copies.repartition(2 * int(CPUS), "event_id", "copy")
    path = f"{shared_folder(spark)}/bench-{spark.sparkContext.applicationId}/messages"
    fleet_tables.messages(spread).write.parquet(path)
    return path, spark.read.parquet(path).count()


def state_rows(spark: SparkSession) -> dict[str, int]:
    """Rows kept by the counter after all alerts came in order of time, in five batches."""
    folder = f"{shared_folder(spark)}/bench-{spark.sparkContext.applicationId}"
    topic = FileTopic(f"{folder}/alerts", "alerts", options={"maxFilesPerTrigger": "1"})
    events = fleet_tables.table(spark, SF_DIR, "events")
    begin, end = events.agg(F.min("ts"), F.max("ts")).first()
    for part in range(5):
        since, until = (begin + (end - begin) * p / 5 for p in (part, part + 1))
        until = until if part < 4 else end + (end - begin)
        slice_ = events.where((F.col("ts") >= since) & (F.col("ts") < until))
        profile = fleet_tables.profile(spark, SF_DIR)
        found = alert_messages(enriched_messages(fleet_tables.messages(slice_), profile))
        topic.append(found.coalesce(1))

    kept = {}
    drain = {"availableNow": True}
    for mode in ("complete", "update"):
        table = SnapshotTable(f"{folder}/{mode}")
        query = start_window_counts(
            topic.stream(spark), table, f"{folder}/c-{mode}", mode=mode, trigger=drain
        )
        query.awaitTermination()
        kept[mode] = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    table = SnapshotTable(f"{folder}/panes")
    query = start_pane_counts(topic.stream(spark), table, f"{folder}/c-panes", trigger=drain)
    query.awaitTermination()
    state = sum(s["numRowsTotal"] for s in query.lastProgress["stateOperators"])
    return kept | {"panes": state, "panes_stored": table.read(spark).count()}


def dense_queries(spark: SparkSession, path: str) -> dict:
    def messages() -> DataFrame:
        return spark.read.parquet(path)

    def profile() -> DataFrame:
        return fleet_tables.profile(spark, SF_DIR)

    def counts(method: str) -> DataFrame:
        rows = normalize(alerts(enrich(decode(messages(), RAW_EVENT), profile())))
        return window_counts(rows, method=method, counted=fleet_tables.COUNTED)

    return {
        "dense_decode": lambda: decode(messages(), RAW_EVENT),
        "dense_enriched_messages": lambda: enriched_messages(messages(), profile()),
        "dense_alert_messages": lambda: alert_messages(enriched_messages(messages(), profile())),
        "dense_windows": lambda: counts("panes"),
        "dense_windows_direct": lambda: counts("direct"),
    }


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    events = fleet_tables.table(spark, SF_DIR, "events").count()

    taken = {n: seconds(lambda n=n: QUERIES[n](spark, SF_DIR), REPEATS) for n in BATCH}
    taken |= {n: seconds(lambda n=n: QUERIES[n](spark, SF_DIR), 1) for n in STREAMS}
    path, dense = dense_messages(spark)
    taken |= {n: seconds(q, 2) for n, q in dense_queries(spark, path).items()}
    state = state_rows(spark)
    spark.stop()

    rates = {n: round((dense if n.startswith("dense_") else events) / s) for n, s in taken.items()}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(taken.values()), 3),
                "unit": "sec",
                "queries": taken,
                "events_per_sec": rates,
                "state_rows": state,
                "events": events,
                "dense_events": dense,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
