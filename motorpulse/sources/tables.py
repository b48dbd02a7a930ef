"""Tables at rest: Parquet scans, literal tables and the checks put in front of them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class MissingColumnsError(RuntimeError):
    pass


class EmptyTableError(RuntimeError):
    pass


def require_columns(df: DataFrame, names: Iterable[str], where: str = "table") -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise MissingColumnsError(f"{where} lacks {missing}; found {df.columns}")
    return df


def require_rows(df: DataFrame, where: str = "table") -> DataFrame:
    """Fail on an empty input. Reads no more than one row."""
    if df.isEmpty():
        raise EmptyTableError(f"{where} has no rows")
    return df


def read_table(
    spark: SparkSession, path: str, columns: Sequence[str] | Mapping[str, str] | None = None
) -> DataFrame:
    """Scan Parquet; ``columns`` lists what to read, or maps source names to new ones."""
    df = spark.read.parquet(path)
    if columns is None:
        return df
    names = columns if isinstance(columns, Mapping) else {c: c for c in columns}
    require_columns(df, names, path)
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def literal_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    return spark.createDataFrame(rows, schema=schema)
