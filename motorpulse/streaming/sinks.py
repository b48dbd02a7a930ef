"""Starting queries into sinks. A trigger is a dict for ``DataStreamWriter.trigger`` or None.

None starts the next micro-batch at once; ``{"processingTime": "60 seconds"}`` and
``{"availableNow": True}`` are the usual others.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..files import create_text, read_text
from ..schemas import REFRESH_EVERY
from ..sources.messages import FileTopic, Topic

Trigger = Mapping[str, object] | None
BatchWriter = Callable[[DataFrame, int, str], None]


def _start(
    writer: DataStreamWriter, checkpoint: str | None, trigger: Trigger, name: str | None
) -> StreamingQuery:
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    if name:
        writer = writer.queryName(name)
    return writer.start()


def start_appending(
    messages: DataFrame,
    sink: Topic,
    checkpoint: str,
    *,
    trigger: Trigger = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append messages to a topic."""
    if isinstance(sink, FileTopic):
        return start_writers(messages, [sink.append], checkpoint, trigger=trigger, name=name)
    return _start(sink.writer(messages).outputMode("append"), checkpoint, trigger, name)


def start_preview(
    df: DataFrame, *, rows: int = 20, trigger: Trigger = None, name: str | None = None
) -> StreamingQuery:
    """Show each micro-batch on the console, cells in full.

    This is a query of its own, which reads the source a second time from where it
    starts and keeps no checkpoint.
    """
    writer = (
        df.writeStream.format("console")
        .outputMode("append")
        .options(truncate="false", numRows=str(rows))
    )
    return _start(writer, None, trigger, name)


def start_console(
    windows: DataFrame,
    checkpoint: str,
    *,
    rows: int = 50,
    trigger: Trigger = {"processingTime": REFRESH_EVERY},
    name: str | None = None,
) -> StreamingQuery:
    """Show the complete result of a streaming aggregate after every refresh."""
    writer = (
        windows.writeStream.format("console")
        .outputMode("complete")
        .options(truncate="false", numRows=str(rows))
    )
    return _start(writer, checkpoint, trigger, name)


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the query when its checkpoint was made."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


class ChangedSettingsError(RuntimeError):
    pass


def keep_settings(spark: SparkSession, checkpoint: str, settings: Mapping) -> None:
    """Store what the state in a checkpoint depends on, or refuse to go on with something else.

    Spark itself notices a changed schema of the state, but not a window of another
    length, whose counts would be added to those before.
    """
    told = {k: str(v) if isinstance(v, timedelta) else v for k, v in settings.items()}
    file = f"{checkpoint}/settings.json"
    if create_text(spark, file, json.dumps(told)):
        return
    before = json.loads(read_text(spark, file))
    changed = [f"{k}={before.get(k)!r} and not {told.get(k)!r}" for k in {**before, **told} if before.get(k) != told.get(k)]
    if changed:
        raise ChangedSettingsError(
            f"the checkpoint {checkpoint} was made with {', '.join(changed)}; start anew with "
            "another checkpoint and another table"
        )


def start_writers(
    df: DataFrame,
    writers: Sequence[BatchWriter],
    checkpoint: str,
    *,
    mode: str = "append",
    trigger: Trigger = None,
    name: str | None = None,
) -> StreamingQuery:
    """Hand every micro-batch to several writers, computing it once.

    A failed micro-batch is replayed with its id, so writers have to be idempotent
    by id. They also get the id of the checkpoint, which tells a replay from the batch
    of another query with the same number.
    """
    ids: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        if not ids:
            ids.append(checkpoint_id(batch.sparkSession, checkpoint))
        shared = len(writers) > 1
        if shared:
            batch.persist()
        try:
            for writer in writers:
                writer(batch, batch_id, ids[0])
        finally:
            if shared:
                batch.unpersist()

    writer = df.writeStream.outputMode(mode).foreachBatch(write)
    return _start(writer, checkpoint, trigger, name)
