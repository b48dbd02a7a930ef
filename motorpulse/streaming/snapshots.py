"""A Parquet table that every micro-batch replaces, as a whole or in the days it touches."""

from __future__ import annotations

import json
import time as clock
from dataclasses import dataclass
from itertools import takewhile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..files import (
    create_text,
    delete,
    make_directory,
    matching_names,
    matching_parents,
    matching_paths,
    modified,
    path_exists,
    read_text,
)

PREFIX = "batch_id="
CHANGED = "changed="
DAY = "day="
#: An empty table, read where no day is stored.
COLUMNS = "columns"
WRITER = "_writer="
#: One entry per batch: which batch has the newest files of every day.
LOG = "_log"


@dataclass(frozen=True)
class SnapshotTable:
    """One directory per micro-batch, the newest finished one being the table.

    A batch written by ``write_days`` holds just the days it touches. Its entry in the log
    says which batch has the newest files of every day, so files of other days stay as
    they are, and neither readers nor writers list folders: what a batch costs does not
    depend on how many days there are files of, but for the entry itself.

    A replayed batch finds its entry, or its directory finished, and leaves it, so each batch
    counts once; a table therefore belongs to one checkpoint, whose id it bears, and
    refuses another's batches: both start anew together. The last ``keep`` batches stay
    for readers that have begun with them, and in a table by days all that are younger than
    ``keep_seconds`` too. Meant for results that grow with time and not with events:
    ``files`` is how many files each snapshot has.
    """

    path: str
    keep: int = 2
    files: int = 4
    keep_seconds: int = 3600

    def _finished(self, spark: SparkSession, prefix: str = PREFIX) -> list[int]:
        done = matching_parents(spark, f"{self.path}/{prefix}*/_SUCCESS")
        return sorted(int(name.removeprefix(prefix)) for name in done)

    def _logged(self, spark: SparkSession) -> dict[int, int]:
        """Batches in the log, in ascending order, and when they were entered."""
        found = modified(spark, f"{self.path}/{LOG}")
        return {int(n): found[n] for n in sorted((n for n in found if n.isdigit()), key=int)}

    def _read_entry(self, spark: SparkSession, batch_id: int) -> tuple[dict[int, int], T.StructType]:
        entry = json.loads(read_text(spark, f"{self.path}/{LOG}/{batch_id}"))
        return {int(day): i for day, i in entry["days"].items()}, T.StructType.fromJson(entry["schema"])

    def _entry(self, spark: SparkSession, batch_id: int) -> dict[int, int]:
        return self._read_entry(spark, batch_id)[0]

    def _days(
        self, spark: SparkSession, before: int | None = None
    ) -> tuple[dict[int, int], T.StructType | None]:
        """The batch that has the newest files of every day, as of before a batch, and the
        columns of the table where the log tells them."""
        logged = list(self._logged(spark))
        if logged:
            older = [i for i in logged if before is None or i < before]
            return self._read_entry(spark, older[-1]) if older else ({}, None)
        return self._listed(spark, before), None

    def _listed(self, spark: SparkSession, before: int | None) -> dict[int, int]:
        """The same of a table from before there was a log: by its folders."""
        done = {i for i in self._finished(spark, CHANGED) if before is None or i < before}
        found: dict[int, int] = {}
        for path in matching_paths(spark, f"{self.path}/{CHANGED}*/{DAY}*") if done else ():
            batch, day = path.split("/")[-2:]
            batch_id, number = int(batch.removeprefix(CHANGED)), int(day.removeprefix(DAY))
            if batch_id in done:
                found[number] = max(batch_id, found.get(number, batch_id))
        return found

    def _by_days(self, spark: SparkSession) -> bool:
        return path_exists(spark, f"{self.path}/{LOG}") or bool(self._finished(spark, CHANGED))

    def read(
        self, spark: SparkSession, before: int | None = None, days: list[int] | None = None
    ) -> DataFrame | None:
        """The table, or what it was before a batch; None if there is none.

        ``days`` limits a table written by days to some of them.
        """
        newest, schema = self._days(spark, before)
        wanted = newest if days is None else newest.keys() & set(days)
        if wanted:
            parts = [f"{self.path}/{CHANGED}{newest[day]}/{DAY}{day}" for day in sorted(wanted)]
            reader = spark.read if schema is None else spark.read.schema(schema)
            return reader.parquet(*parts)
        if self._by_days(spark):
            return spark.read.parquet(f"{self.path}/{COLUMNS}")
        ids = [i for i in self._finished(spark) if before is None or i < before]
        return spark.read.parquet(f"{self.path}/{PREFIX}{ids[-1]}") if ids else None

    def _claim(self, spark: SparkSession, writer: str) -> None:
        owners = [n.removeprefix(WRITER) for n in matching_names(spark, f"{self.path}/{WRITER}*")]
        if not owners and (self._finished(spark) or self._by_days(spark)):
            owners = ["unknown"]
        if owners and owners != [writer]:
            raise RuntimeError(
                f"{self.path} belongs to the checkpoint {owners[0]} and not to {writer}; "
                "start the table and the checkpoint anew together"
            )
        make_directory(spark, f"{self.path}/{WRITER}{writer}")

    def write(self, df: DataFrame, batch_id: int, writer: str = "batch") -> None:
        spark = df.sparkSession
        self._claim(spark, writer)
        if self._by_days(spark):
            raise RuntimeError(f"{self.path} is written by days and cannot go on as a whole")
        target = f"{self.path}/{PREFIX}{batch_id}"
        if not path_exists(spark, f"{target}/_SUCCESS"):
            # By key and to few files, whatever the shuffle width.
            df.repartition(self.files, df.columns[0]).write.mode("overwrite").parquet(target)
        for old in self._finished(spark)[: -self.keep]:
            delete(spark, f"{self.path}/{PREFIX}{old}")

    def write_days(
        self, df: DataFrame, batch_id: int, writer: str = "batch", *, time: str
    ) -> None:
        """Replace the days that ``df`` has rows of, a day by UTC of the column ``time``.

        Rows without a time are in no day and refused. A day has one file.
        """
        spark = df.sparkSession
        self._claim(spark, writer)
        if self._finished(spark):
            raise RuntimeError(f"{self.path} is written as a whole and cannot go on by days")
        target = f"{self.path}/{CHANGED}{batch_id}"
        logged = self._logged(spark)
        if batch_id not in logged and not (not logged and path_exists(spark, f"{target}/_SUCCESS")):
            key = F.coalesce(day_of(time), F.raise_error(F.lit(f"{time} is null")).cast("long"))
            dealt = df.withColumn("day", key).repartition("day")
            if not path_exists(spark, f"{self.path}/{COLUMNS}/_SUCCESS"):
                none = spark.createDataFrame([], df.schema)
                none.write.mode("overwrite").parquet(f"{self.path}/{COLUMNS}")
            older, _ = self._days(spark, batch_id)
            to = dealt.write.mode("overwrite").option("partitionOverwriteMode", "static")
            to.partitionBy("day").parquet(target)
            written = [int(n.removeprefix(DAY)) for n in modified(spark, target) if n.startswith(DAY)]
            days = older | dict.fromkeys(written, batch_id)
            create_text(spark, f"{self.path}/{LOG}/{batch_id}", json.dumps({"days": days, "schema": df.schema.jsonValue()}))
        self._prune_days(spark)

    def _prune_days(self, spark: SparkSession) -> None:
        """Drop the entries that are neither among the last nor young, and their files."""
        logged = self._logged(spark)
        since = (clock.time() - self.keep_seconds) * 1000
        old = list(takewhile(lambda i: logged[i] < since, list(logged)[: -self.keep]))
        if not old:
            return
        # A later entry names what the first that stays names, or what came after that.
        kept = set(self._entry(spark, next(i for i in logged if i > old[-1])).items())
        gone = set().union(*(self._entry(spark, i).items() for i in old)) - kept
        for day, batch_id in gone:
            delete(spark, f"{self.path}/{CHANGED}{batch_id}/{DAY}{day}")
        for batch_id in {*old, *(i for _, i in gone)} - {i for _, i in kept}:
            delete(spark, f"{self.path}/{CHANGED}{batch_id}")
        for batch_id in old:
            delete(spark, f"{self.path}/{LOG}/{batch_id}")


def day_of(time: str) -> Column:
    """Number of the UTC day since 1970, whatever the session's time zone."""
    return F.floor(F.unix_seconds(F.col(time).cast("timestamp")) / 86400)
