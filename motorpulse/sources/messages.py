"""Message topics: Spark's Kafka connector, or a directory of files standing in for one.

Both give the columns ``topic``, ``timestamp`` and ``value``, so the jobs do not
know which one they read.
"""

from __future__ import annotations

import json
import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..files import create_text, make_directory, move_into, names_in, path_exists
from ..schemas import ENVELOPE, FILE_MESSAGE


def split_topics(text: str) -> list[str]:
    """Topic names from a comma-separated setting; blanks are ignored."""
    names = [part.strip() for part in text.split(",")]
    names = [n for n in names if n]
    if not names:
        raise ValueError("no topic named")
    return names


@dataclass(frozen=True)
class KafkaTopic:
    """One or more topics (comma-separated) or, with ``pattern``, all that match.

    A pattern also picks up topics created after the query started, so a job need
    not wait for its producers. ``options`` go to the connector as they are, e.g.
    ``maxOffsetsPerTrigger`` or ``minPartitions``.
    """

    servers: str
    name: str
    pattern: bool = False
    starting: str = "latest"
    options: Mapping[str, str] = field(default_factory=dict)

    def source_options(self) -> dict[str, str]:
        chosen = (
            {"subscribePattern": self.name}
            if self.pattern
            else {"subscribe": ",".join(split_topics(self.name))}
        )
        return {
            "kafka.bootstrap.servers": self.servers,
            "startingOffsets": self.starting,
            **chosen,
            **self.options,
        }

    def sink_options(self) -> dict[str, str]:
        names = split_topics(self.name)
        if self.pattern or len(names) != 1:
            raise ValueError(f"a sink needs exactly one topic, not {self.name!r}")
        return {"kafka.bootstrap.servers": self.servers, "topic": names[0]}

    def stream(self, spark: SparkSession) -> DataFrame:
        reader = spark.readStream.format("kafka").options(**self.source_options())
        return reader.load().select(*ENVELOPE.fieldNames())

    def writer(self, messages: DataFrame) -> DataStreamWriter:
        return messages.select("value").writeStream.format("kafka").options(**self.sink_options())

    def append(
        self, messages: DataFrame, batch_id: int | None = None, writer: str = "batch"
    ) -> None:
        """Send one finished batch; a replayed micro-batch is sent again."""
        messages.select("value").write.format("kafka").options(**self.sink_options()).save()


#: Where a file topic keeps unfinished batches and its commit log. Readers of files pass
#: over names that begin like this.
STAGED, COMMITS = "_staged", "_commits"


@dataclass(frozen=True)
class FileTopic:
    """A directory of message files. The broker's time is stamped when they are written.

    Everything is added batch by batch, whatever writes it, so several jobs may write
    one topic and a job may change its options between two runs. A batch is staged where
    no reader looks, entered in the commit log and then moved as a whole to where readers
    see it. One that died before its entry was never visible and is staged anew; one that
    died later is only moved. So readers, streams too, get every message once.
    """

    path: str
    name: str
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)

    def exists(self, spark: SparkSession) -> bool:
        return path_exists(spark, self.path)

    def _load(self, reader) -> DataFrame:
        files = (
            reader.format(self.format)
            .schema(FILE_MESSAGE)
            .option("recursiveFileLookup", "true")
            .options(**self.options)
            .load(self.path)
        )
        return files.select(
            F.lit(self.name).alias("topic"), "timestamp", F.col("value").cast("binary")
        )

    def stream(self, spark: SparkSession) -> DataFrame:
        """Messages as they come. A topic that is not there yet is created."""
        make_directory(spark, self.path)
        return self._load(spark.readStream)

    def batch(self, spark: SparkSession) -> DataFrame:
        return self._load(spark.read)

    def _stamped(self, messages: DataFrame) -> DataFrame:
        if "timestamp" in messages.columns:
            return messages.select(F.col("value").cast("string"), "timestamp")
        return messages.select(
            F.col("value").cast("string"), F.current_timestamp().alias("timestamp")
        )

    def append(
        self, messages: DataFrame, batch_id: int | None = None, writer: str = "batch"
    ) -> None:
        """Add one finished batch. With ``batch_id`` a replay by the same writer adds nothing.

        ``writer`` is the id of a streaming query's checkpoint: a new checkpoint counts
        its batches from 0 again and must not be taken for a replay.
        """
        spark = messages.sparkSession
        if path_exists(spark, f"{self.path}/_spark_metadata"):
            raise RuntimeError(f"{self.path} was written by a file sink and shows only its files")
        name = f"writer={writer}/batch_id={uuid4().hex if batch_id is None else batch_id}"
        staged, shown = f"{self.path}/{STAGED}/{name}", f"{self.path}/{name}"
        # Batches from before there was a log were finished by a file of Spark's.
        if not self.committed(spark, name) and not path_exists(spark, f"{shown}/_SUCCESS"):
            self._stamped(messages).write.format(self.format).mode("overwrite").save(staged)
            files = sorted(n for n in names_in(spark, staged) if not n.startswith(("_", ".")))
            self._commit(spark, name, files)
        move_into(spark, staged, shown)

    def committed(self, spark: SparkSession, batch: str) -> bool:
        return path_exists(spark, f"{self.path}/{COMMITS}/{batch}")

    def _commit(self, spark: SparkSession, batch: str, files: list[str]) -> None:
        create_text(spark, f"{self.path}/{COMMITS}/{batch}", json.dumps({"files": files}))


@dataclass(frozen=True)
class FileTopics:
    """Several file topics read as one. One that comes later is read from then on."""

    topics: tuple[FileTopic, ...]

    def stream(self, spark: SparkSession) -> DataFrame:
        """All topics, so that a restart finds the same inputs; at least one must exist."""
        available_topics(spark, self.topics)
        return merge_topics([t.stream(spark) for t in self.topics])


Topic = KafkaTopic | FileTopic


def available_topics(spark: SparkSession, topics: Sequence[FileTopic]) -> list[FileTopic]:
    """Those topics that exist. Warns about the others; fails if none does."""
    found = [t for t in topics if t.exists(spark)]
    missing = [t.name for t in topics if t not in found]
    if not found:
        raise RuntimeError(f"none of the topics exists: {missing}")
    if missing:
        warnings.warn(f"topics not there yet: {missing}", stacklevel=2)
    return found


def merge_topics(frames: Sequence[DataFrame]) -> DataFrame:
    """All messages of several topics, copies included, each with its ``topic``."""
    return reduce(lambda left, right: left.unionByName(right), frames)
