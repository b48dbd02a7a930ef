"""Dimension tables: one row per key, uniqueness checks, load and write."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..files import delete, move_into
from ..schemas import CAR_COLORS, CAR_MODELS, CAR_PROFILE, COLOR_ROWS, MODEL_ROWS
from ..sources.tables import literal_table, read_table, require_columns

CARS_COLUMNS = ("car_id", "driver_id", "model_id", "color_id")
MODELS_COLUMNS = {"model_id": "model_id", "car_brand": "brand_name", "car_model": "model_name"}
COLORS_COLUMNS = ("color_id", "color_name")


class DuplicateKeysError(RuntimeError):
    pass


def one_row_per_key(df: DataFrame, key: str) -> DataFrame:
    """Keep one row per key: the smallest by the other columns in order, NULL first.

    A grouped minimum and not a ranking window: it is combined before the shuffle,
    so a key with very many copies costs each task one row.
    """
    others = [c for c in df.columns if c != key]
    if not others:
        return df.distinct()
    first = df.groupBy(key).agg(F.min(F.struct(*others)).alias("first"))
    return first.select(*[key if c == key else f"first.{c}" for c in df.columns])


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(key).count().where(F.col("count") > 1)


def require_unique(df: DataFrame, key: str) -> DataFrame:
    sample = duplicate_keys(df, key).take(1)
    if sample:
        raise DuplicateKeysError(f"{key} is not unique, e.g. {sample[0][key]}")
    return df


def load_dimension(
    spark: SparkSession, path: str, key: str, columns: Sequence[str] | Mapping[str, str]
) -> DataFrame:
    """Scan only the named columns of a dimension and keep one row per key."""
    return one_row_per_key(read_table(spark, path, columns), key)


def car_profile(
    cars: DataFrame, models: DataFrame, colors: DataFrame, *, unique: bool = False
) -> DataFrame:
    """Join the dimensions among themselves into one row per car.

    Model and color hang on the car alone, so the event side needs a single join
    with this table where three would each pass over every event. Cars without a
    known model or color stay, with NULLs. ``unique`` says that the keys are known
    to be unique, which spares an aggregate of each table.
    """
    one = (lambda df, _: df) if unique else one_row_per_key
    joined = (
        one(cars, "car_id")
        .join(one(models, "model_id"), "model_id", "left")
        .join(one(colors, "color_id"), "color_id", "left")
    )
    return joined.select(*CAR_PROFILE.fieldNames())


def load_profile(
    spark: SparkSession, cars_path: str, models_path: str, colors_path: str
) -> DataFrame:
    """The car profile from the three stored dimensions."""
    return car_profile(
        read_table(spark, cars_path, CARS_COLUMNS),
        read_table(spark, models_path, MODELS_COLUMNS),
        read_table(spark, colors_path, COLORS_COLUMNS),
    )


def write_dimension(df: DataFrame, path: str, key: str, *, files: int | None = None) -> None:
    """Replace a dimension after checking its key. ``files`` limits the file count.

    Without ``files`` the table is written in parallel. The rows are computed once: they
    are staged beside the table, checked as written, and then take its place. A query that
    has begun with the files before fails; jobs that must go on while tables are replaced
    read a ``FleetStore``.
    """
    spark = df.sparkSession
    require_columns(df, [key], path)
    staged = f"{path.rstrip('/')}-{uuid4().hex}"
    try:
        (df.coalesce(files) if files is not None else df).write.parquet(staged)
        require_unique(spark.read.schema(df.schema).parquet(staged), key)
        delete(spark, path)
        move_into(spark, staged, path)
    finally:
        delete(spark, staged)


def write_fixed_dimensions(spark: SparkSession, models_path: str, colors_path: str) -> None:
    """Write the model and color tables, whose rows are fixed."""
    models = literal_table(spark, MODEL_ROWS, CAR_MODELS)
    colors = literal_table(spark, COLOR_ROWS, CAR_COLORS)
    write_dimension(models, models_path, "model_id", files=1)
    write_dimension(colors, colors_path, "color_id", files=1)


def preview(df: DataFrame, key: str, rows: int = 20) -> DataFrame:
    """The first rows in key order: a top-k, not a full sort."""
    return df.orderBy(F.col(key).asc()).limit(rows)
