"""Tables that are replaced or added to in versions, while jobs go on reading them."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..files import create_text, delete, names_in, path_exists, read_text
from ..sources.tables import require_columns
from .dimensions import DuplicateKeysError, require_unique

#: The log of finished versions. Readers of files pass over names that begin like this.
VERSIONS = "_versions"


class PublishedMeanwhileError(RuntimeError):
    pass


def keys_in_both(stored: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys of ``stored`` that ``new`` has too, without an aggregate of either.

    The range of the new keys goes to the scan of the stored table, where it skips files
    and row groups. Being selective, it also lets Spark put a Bloom filter of the new keys
    before the shuffle of a large stored table.
    """
    low, high = new.agg(F.min(key), F.max(key)).first()
    if low is None:
        return stored.select(key).limit(0)
    within = F.col(key).between(F.lit(low), F.lit(high))
    return stored.select(key).where(within).join(new.select(key).where(within), key, "left_semi")


@dataclass(frozen=True)
class Version:
    """One finished version: all its tables as they were when it was published."""

    number: int
    path: str
    tables: Mapping[str, Mapping] = field(hash=False)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        """A table of this version. A bucketed one comes dealt out by its key."""
        if name not in self.tables:
            raise KeyError(f"version {self.number} of {self.path} has {sorted(self.tables)} and no {name!r}")
        table = self.tables[name]
        folders = [f"{self.path}/{name}/{f}" for f in table["folders"]]
        schema = T.StructType.fromJson(table["schema"])
        if not table["buckets"]:
            return spark.read.schema(schema).parquet(*folders)
        registered = catalog_name(folders[0])
        if not spark.catalog.tableExists(registered):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            key = f"`{table['key']}`"
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {registered} ({columns}) USING parquet "
                f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {table['buckets']} BUCKETS "
                f"LOCATION '{folders[0]}'"
            )
        return spark.table(registered)


def catalog_name(folder: str) -> str:
    return f"motorpulse_{hashlib.md5(folder.encode()).hexdigest()}"


@dataclass(frozen=True)
class VersionedTables:
    """Tables under one path, replaced together by numbered versions.

    The files of a new version are staged in folders of their own, checked as they were
    written, and made current by one entry in the log of versions: readers see all of a
    version or nothing of it. A reader pins a version and keeps it while newer ones come;
    the last ``keep`` stay. A version that fails its checks leaves no trace.
    """

    path: str
    keep: int = 3

    def versions(self, spark: SparkSession) -> list[int]:
        names = names_in(spark, f"{self.path}/{VERSIONS}")
        return sorted(int(n) for n in names if n.isdigit())

    def current(self, spark: SparkSession, number: int | None = None) -> Version | None:
        """The newest finished version, or one that is still kept; None if there is none."""
        known = self.versions(spark)
        if not known:
            return None
        number = known[-1] if number is None else number
        if number not in known:
            raise KeyError(f"{self.path} keeps the versions {known} and no {number}")
        return Version(number, self.path, json.loads(read_text(spark, f"{self.path}/{VERSIONS}/{number}")))

    def publish(
        self,
        spark: SparkSession,
        replace: Mapping[str, DataFrame] | None = None,
        add: Mapping[str, DataFrame] | None = None,
        *,
        keys: Mapping[str, str],
        derive: Mapping[str, Callable[[Callable[[str], DataFrame]], DataFrame]] | None = None,
        buckets: Mapping[str, int] | None = None,
        files: Mapping[str, int] | None = None,
    ) -> Version:
        """Check and publish the next version; tables that are not named stay as they are.

        ``replace`` brings whole tables, ``add`` rows for stored ones, which are not written
        again: the new rows are checked against themselves and against the stored table.
        ``keys`` names the unique key of every table brought. ``derive`` makes tables from
        the new version's others, given as a function of their name. ``buckets`` deals a table out
        by its key into so many files, ``files`` limits their number.
        Every input is computed once: it is the written rows that are checked.
        """
        replace, add, derive = replace or {}, add or {}, derive or {}
        buckets, files = buckets or {}, files or {}
        base = self.current(spark)
        number = base.number + 1 if base else 1
        tables = dict(base.tables) if base else {}
        written: list[str] = []
        try:
            for name, df in [*replace.items(), *add.items()]:
                key = keys[name]
                require_columns(df, [key], name)
                part = self._stage(df, name, number, key, buckets.get(name), files.get(name), written)
                staged = Version(number, self.path, {name: part}).read(spark, name)
                require_unique(staged, key)
                if name in add:
                    if base is None or name not in base.tables:
                        raise KeyError(f"{self.path} has no table {name!r} to add to")
                    self._require_new(base.read(spark, name), staged, key)
                    if part["buckets"] or tables[name]["buckets"]:
                        raise ValueError(f"{name!r} is bucketed and can only be replaced")
                    if part["schema"] != tables[name]["schema"]:
                        raise ValueError(f"the rows added to {name!r} have other columns than the table")
                    part = {**part, "folders": [*tables[name]["folders"], *part["folders"]]}
                tables[name] = part
            for name, make in derive.items():
                made = make(lambda n: Version(number, self.path, tables).read(spark, n))
                tables[name] = self._stage(made, name, number, keys[name], buckets.get(name), files.get(name), written)
                require_unique(Version(number, self.path, tables).read(spark, name), keys[name])
            if not create_text(spark, f"{self.path}/{VERSIONS}/{number}", json.dumps(tables)):
                raise PublishedMeanwhileError(f"version {number} of {self.path} was published meanwhile")
        except BaseException:
            for folder in written:
                self._drop(spark, folder)
            raise
        self._prune(spark)
        return Version(number, self.path, tables)

    def _require_new(self, stored: DataFrame, staged: DataFrame, key: str) -> None:
        known = keys_in_both(stored, staged, key).take(1)
        if known:
            raise DuplicateKeysError(f"{key} is in the table already, e.g. {known[0][key]}")

    def _stage(
        self, df: DataFrame, name: str, number: int, key: str, buckets: int | None, files: int | None, written: list[str]
    ) -> dict:
        folder = f"{number}-{uuid4().hex}"
        target = f"{self.path}/{name}/{folder}"
        written.append(target)
        if buckets:
            # One task and so one file for every bucket; the table itself is registered where it is read.
            dealt = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
            dealt.option("path", target).format("parquet").saveAsTable(catalog_name(target))
        else:
            (df.coalesce(files) if files else df).write.parquet(target)
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
        return {"folders": [folder], "key": key, "buckets": buckets or 0, "schema": schema.jsonValue()}

    def _drop(self, spark: SparkSession, folder: str) -> None:
        spark.sql(f"DROP TABLE IF EXISTS {catalog_name(folder)}")
        if path_exists(spark, folder):
            delete(spark, folder)

    def _prune(self, spark: SparkSession) -> None:
        """Forget all but the last versions, and delete the files that only those had."""
        known = self.versions(spark)
        folders = lambda n: {
            f"{self.path}/{name}/{f}" for name, t in self.current(spark, n).tables.items() for f in t["folders"]
        }
        kept = set().union(*map(folders, known[-self.keep :]))
        for number in known[: -self.keep]:
            gone = folders(number) - kept
            delete(spark, f"{self.path}/{VERSIONS}/{number}")
            for folder in gone:
                self._drop(spark, folder)
