"""The fleet's dimensions and the car profile made of them, published together."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..schemas import CAR_COLORS, CAR_MODELS, COLOR_ROWS, MODEL_ROWS
from ..sources.tables import literal_table, require_columns
from .dimensions import CARS_COLUMNS, COLORS_COLUMNS, MODELS_COLUMNS, car_profile
from .versions import Version, VersionedTables

CARS, MODELS, COLORS, PROFILE = "cars", "car_models", "car_colors", "profile"
KEYS = {CARS: "car_id", MODELS: "model_id", COLORS: "color_id", PROFILE: "car_id"}


def _profile_of(read: Callable[[str], DataFrame]) -> DataFrame:
    models = read(MODELS)
    models = models.select(*[models[old].alias(new) for old, new in MODELS_COLUMNS.items()])
    # The keys were checked when the tables were staged, so nothing is de-duplicated here.
    return car_profile(read(CARS), models, read(COLORS), unique=True)


@dataclass(frozen=True)
class FleetStore:
    """Cars, models and colors by versions, each with its car profile ready to be joined.

    The profile is written once per version, bucketed by car, so a job that looks cars up
    in every micro-batch neither derives nor shuffles it. ``buckets`` should be at least
    the shuffle width of the jobs that read it, or Spark deals it out anew.
    """

    path: str
    buckets: int = 32
    keep: int = 3

    @property
    def tables(self) -> VersionedTables:
        return VersionedTables(self.path, self.keep)

    def exists(self, spark: SparkSession) -> bool:
        return bool(self.tables.versions(spark))

    def publish(
        self,
        spark: SparkSession,
        cars: DataFrame | None = None,
        models: DataFrame | None = None,
        colors: DataFrame | None = None,
        new_cars: DataFrame | None = None,
    ) -> Version:
        """The next version: replaced tables, or ``new_cars`` beside those stored.

        The first version has the fixed models and colors unless others are given. Keys are
        checked on the written rows; a repeated one raises and the version before stays.
        """
        first = not self.exists(spark)
        if first:
            models = literal_table(spark, MODEL_ROWS, CAR_MODELS) if models is None else models
            colors = literal_table(spark, COLOR_ROWS, CAR_COLORS) if colors is None else colors
            if cars is None:
                raise ValueError("the first version needs cars")
        wanted = {CARS: CARS_COLUMNS, MODELS: tuple(MODELS_COLUMNS), COLORS: COLORS_COLUMNS}
        pick = lambda df, name: require_columns(df, wanted[name], name).select(*wanted[name])
        given = {CARS: cars, MODELS: models, COLORS: colors}
        return self.tables.publish(
            spark,
            {n: pick(df, n) for n, df in given.items() if df is not None},
            {CARS: pick(new_cars, CARS)} if new_cars is not None else None,
            keys=KEYS,
            derive={PROFILE: _profile_of},
            buckets={PROFILE: self.buckets},
        )

    def profile(self, spark: SparkSession, number: int | None = None) -> DataFrame:
        """The car profile of the newest version, pinned: a job that calls this in every
        micro-batch reads one finished version in each."""
        version = self.tables.current(spark, number)
        if version is None:
            raise RuntimeError(f"{self.path} has no finished version yet")
        return version.read(spark, PROFILE)
