from __future__ import annotations

import random
import re
import sys

import pytest

from motorpulse.operators import (
    DuplicateKeysError,
    alerts,
    attach_profile,
    car_profile,
    duplicate_keys,
    enrich,
    fits_broadcast,
    frequent_keys,
    load_profile,
    one_row_per_key,
    preview,
    require_unique,
    write_dimension,
)
from motorpulse.schemas import (
    CAR_COLORS,
    CAR_MODELS,
    CARS,
    COLOR_ROWS,
    ENRICHED_EVENT,
    MODEL_ROWS,
    RAW_EVENT,
)
from motorpulse.sources import (
    EmptyTableError,
    MissingColumnsError,
    literal_table,
    read_table,
    require_columns,
    require_rows,
)

CAR_ROWS = [(100, 900, 3, 1), (101, 901, 6, 4), (102, 902, 99, 4), (103, 903, 3, 99)]


@pytest.fixture(scope="module")
def paths(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("dims")
    made = {n: str(root / n) for n in ("cars", "models", "colors")}
    write_dimension(literal_table(spark, CAR_ROWS, CARS), made["cars"], "car_id")
    write_dimension(literal_table(spark, MODEL_ROWS, CAR_MODELS), made["models"], "model_id")
    write_dimension(literal_table(spark, COLOR_ROWS, CAR_COLORS), made["colors"], "color_id")
    return made["cars"], made["models"], made["colors"]


def _events(spark, car_ids):
    rows = [(str(i), "2024-01-01", c, 50, 100, 2) for i, c in enumerate(car_ids)]
    return spark.createDataFrame(rows, RAW_EVENT)


def test_one_row_per_key_keeps_the_smallest_row(spark):
    rows = [(1, "b", 1), (1, "a", 9), (1, "a", None), (2, None, 5), (None, "x", 1), (None, "w", 2)]
    df = spark.createDataFrame(rows, "k int, a string, b int")
    found = sorted(map(tuple, one_row_per_key(df, "k").collect()), key=str)
    assert found == sorted([(1, "a", None), (2, None, 5), (None, "w", 2)], key=str)


def test_one_row_per_key_does_not_mix_rows_or_depend_on_order(spark):
    rng = random.Random(7)
    rows = [(rng.randrange(20), rng.randrange(5), rng.randrange(5)) for _ in range(2000)]
    wanted = {k: min(r[1:] for r in rows if r[0] == k) for k in {r[0] for r in rows}}
    for _ in range(2):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "k int, a int, b int").repartition(5)
        assert {r[0]: (r[1], r[2]) for r in one_row_per_key(df, "k").collect()} == wanted


def test_one_row_per_key_of_a_key_alone(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert sorted(r[0] for r in one_row_per_key(df, "k").collect()) == [1, 2]


def test_duplicates_are_reported_and_refused(spark, folder):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, a string")
    assert [tuple(r) for r in duplicate_keys(df, "k").collect()] == [(1, 2)]
    with pytest.raises(DuplicateKeysError):
        require_unique(df, "k")
    with pytest.raises(DuplicateKeysError):
        write_dimension(df, f"{folder}/x", "k")


def test_written_dimension_replaces_the_old_one(spark, folder):
    path = f"{folder}/colors"
    write_dimension(spark.createDataFrame([(9, "x")], CAR_COLORS), path, "color_id")
    write_dimension(literal_table(spark, COLOR_ROWS, CAR_COLORS), path, "color_id", files=1)
    found = spark.read.parquet(path)
    assert sorted(map(tuple, found.collect())) == COLOR_ROWS
    assert len(found.inputFiles()) == 1


def test_preview_is_sorted_and_cut(spark):
    df = spark.createDataFrame([(i,) for i in (5, 3, 1, 4)], "k int")
    assert [r[0] for r in preview(df, "k", rows=3).collect()] == [1, 3, 4]


def test_column_and_row_checks(spark, paths):
    with pytest.raises(MissingColumnsError, match="found .*car_id"):
        read_table(spark, paths[0], ["car_id", "owner"])
    with pytest.raises(EmptyTableError):
        require_rows(spark.createDataFrame([], CARS), "cars")
    df = spark.createDataFrame(CAR_ROWS, CARS)
    assert require_rows(require_columns(df, ["car_id"])) is df


def test_profile_of_stored_dimensions(spark, paths):
    found = {r.car_id: tuple(r)[1:] for r in load_profile(spark, *paths).collect()}
    assert found == {
        100: (900, "Toyota", "Corolla", "Black"),
        101: (901, "Kia", "Rio", "White"),
        102: (902, None, None, "White"),
        103: (903, "Toyota", "Corolla", None),
    }


@pytest.mark.parametrize("lookup", ["auto", "measured", "salted"])
def test_enrich_keeps_every_event_once(spark, paths, lookup):
    cars, models, colors = (spark.read.parquet(p) for p in paths)
    models = models.toDF("model_id", "brand_name", "model_name")
    repeated = [cars.union(cars.withColumn("driver_id", cars.driver_id + 50)), models, colors]
    events = _events(spark, [100, 101, 7, None, None, 100, 102, 103])
    rows = enrich(events, *repeated, lookup=lookup)
    assert rows.columns == ENRICHED_EVENT.fieldNames()
    found = sorted(tuple(r[c] for c in rows.columns if c != "event_time") for r in rows.collect())
    assert found == [
        ("0", 100, 50, 100, 2, 900, "Toyota", "Corolla", "Black", 2),
        ("1", 101, 50, 100, 2, 901, "Kia", "Rio", "White", 2),
        ("2", 7, 50, 100, 2, None, None, None, None, 2),
        ("3", None, 50, 100, 2, None, None, None, None, 2),
        ("4", None, 50, 100, 2, None, None, None, None, 2),
        ("5", 100, 50, 100, 2, 900, "Toyota", "Corolla", "Black", 2),
        ("6", 102, 50, 100, 2, 902, None, None, "White", 2),
        ("7", 103, 50, 100, 2, 903, "Toyota", "Corolla", None, 2),
    ]


def test_profile_join_equals_three_joins_in_a_row(spark, paths):
    cars, models, colors = (spark.read.parquet(p) for p in paths)
    models = models.toDF("model_id", "brand_name", "model_name")
    rng = random.Random(3)
    events = _events(spark, [rng.choice([100, 101, 102, 103, 104, None]) for _ in range(300)])
    stepwise = (
        events.join(cars, "car_id", "left").join(models, "model_id", "left")
        .join(colors, "color_id", "left")
    )
    names = ["event_id", "driver_id", "brand_name", "model_name", "color_name"]
    once = enrich(events, cars, models, colors)
    assert sorted(map(str, once.select(names).collect())) == sorted(
        map(str, stepwise.select(names).collect())
    )


@pytest.mark.parametrize("hot_keys", [None, [1, 2], [2], []])
def test_salted_join_spreads_hot_keys_copies_and_nulls(spark, hot_keys):
    """A third of the rows each: copies of one message, one key, and no key at all."""
    profile = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "car_id int, name string")
    n = 3000
    events = spark.range(3 * n).repartition(8).selectExpr(
        f"if(id < {n}, 0, id) as event_id",
        f"case when id < {n} then 1 when id < {2 * n} then 2 end as car_id",
    )
    joined = attach_profile(events, profile, lookup="salted", salts=16, hot_keys=hot_keys)
    counts = joined.groupBy("car_id", "name").count().collect()
    assert {tuple(r) for r in counts} == {(1, "a", n), (2, "b", n), (None, None, n)}
    if hot_keys and len(hot_keys) == 2:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            spread = joined.selectExpr("spark_partition_id() p").groupBy("p").count().collect()
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        assert max(r["count"] for r in spread) < 0.4 * 3 * n


def test_frequent_keys(spark):
    df = spark.createDataFrame([(k,) for k in [5, 5, 5, 2, 2, 9, 9, 1, None, None]], "car_id int")
    assert frequent_keys(df, n=3) == [5, 2, 9]
    assert frequent_keys(df.limit(0)) == []


def test_broadcast_follows_the_measured_size(spark):
    profile = spark.createDataFrame([(1, "x" * 100)], "car_id int, name string")
    assert fits_broadcast(profile)
    assert not fits_broadcast(profile, limit=100)
    assert fits_broadcast(profile.limit(0), limit=100)


def test_too_large_a_profile_is_not_broadcast(spark, monkeypatch):
    profile = spark.createDataFrame([(1, "x")], "car_id int, name string")
    events = spark.createDataFrame([(1,), (None,)], "car_id int")
    module = sys.modules["motorpulse.operators.enrich"]
    for fits, join in ((True, "BroadcastHashJoin"), (False, "SortMergeJoin")):
        monkeypatch.setattr(module, "fits_broadcast", lambda _, fits=fits: fits)
        joined = attach_profile(events, profile, lookup="measured")
        assert join in joined._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, joined.collect())) == sorted(
            ["Row(car_id=1, name='x')", "Row(car_id=None, name=None)"]
        )


def test_wrong_arguments_are_refused(spark):
    df = spark.createDataFrame([(1, 2)], "car_id int, x int")
    with pytest.raises(ValueError):
        attach_profile(df, df, lookup="nested")
    with pytest.raises(ValueError):
        enrich(df, df, models=df)


def test_alerts_filter_below_the_join(spark, paths, folder):
    _events(spark, [100]).write.parquet(f"{folder}/e")
    plan = alerts(enrich(spark.read.parquet(f"{folder}/e"), load_profile(spark, *paths)))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Join") < re.search(r"Filter \(+speed", text).start()


def test_car_profile_is_lazy_and_keyed(spark, paths):
    cars, models, colors = (spark.read.parquet(p) for p in paths)
    models = models.toDF("model_id", "brand_name", "model_name")
    assert require_unique(car_profile(cars.union(cars), models, colors), "car_id").count() == 4
