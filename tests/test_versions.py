"""Versions of dimension tables: checks, pointer, pinned readers, bucketed profile."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from motorpulse.__main__ import main
from motorpulse.functions import decode
from motorpulse.operators import (
    DuplicateKeysError,
    FleetStore,
    PublishedMeanwhileError,
    VersionedTables,
    enrich,
    keys_in_both,
    versions,
    write_dimension,
)
from motorpulse.schemas import CARS, ENRICHED_EVENT, RAW_EVENT
from motorpulse.session import state_store_settings
from motorpulse.sources import FileTopic, literal_table
from motorpulse.streaming import start_enrichment
from test_streaming import DRAIN, _event, _send

KEY = {"t": "k"}


def _rows(spark, *rows):
    return spark.createDataFrame(list(rows), "k int, v string")


def _found(df):
    return sorted(map(tuple, df.collect()))


def _folders(path, name="t"):
    return sorted(p.name for p in Path(path, name).iterdir())


def test_versions_are_pinned_kept_and_pruned(spark, folder):
    store = VersionedTables(folder, keep=2)
    assert store.current(spark) is None
    pinned = [store.publish(spark, {"t": _rows(spark, (n, "x"))}, keys=KEY) for n in range(2)]
    assert [v.number for v in pinned] == [1, 2]
    assert _found(pinned[0].read(spark, "t")) == [(0, "x")]
    assert _found(store.current(spark).read(spark, "t")) == [(1, "x")]
    store.publish(spark, {"u": _rows(spark, (5, "y"))}, keys={"u": "k"})
    assert store.versions(spark) == [2, 3] and len(_folders(folder)) == 1
    # A table that was not named is the same files in the new version.
    assert _found(store.current(spark).read(spark, "t")) == [(1, "x")]
    with pytest.raises(KeyError, match="keeps the versions"):
        store.current(spark, 1)
    with pytest.raises(KeyError, match="no 'w'"):
        store.current(spark).read(spark, "w")


def test_added_rows_are_checked_against_the_stored_table(spark, folder):
    store = VersionedTables(folder)
    store.publish(spark, {"t": _rows(spark, (1, "a"), (5, "b"))}, keys=KEY)
    before = _folders(folder)
    for bad in ([(3, "c"), (3, "d")], [(9, "c"), (5, "again")]):
        with pytest.raises(DuplicateKeysError):
            store.publish(spark, add={"t": _rows(spark, *bad)}, keys=KEY)
        assert store.versions(spark) == [1] and _folders(folder) == before
    store.publish(spark, add={"t": _rows(spark, (3, "c"))}, keys=KEY)
    store.publish(spark, add={"t": _rows(spark)}, keys=KEY)
    assert set(before) < set(_folders(folder))  # stored rows were not written again
    assert _found(store.current(spark).read(spark, "t")) == [(1, "a"), (3, "c"), (5, "b")]
    with pytest.raises(ValueError, match="other columns"):
        store.publish(spark, add={"t": spark.createDataFrame([(8, 1)], "k int, w int")}, keys=KEY)
    with pytest.raises(KeyError, match="no table"):
        store.publish(spark, add={"w": _rows(spark, (1, "a"))}, keys={"w": "k"})


def test_what_is_checked_is_what_was_written(spark, folder):
    """An input that gives other rows each time it is computed is computed once."""
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        runs.add(1)
        yield from batches

    once = _rows(spark, (1, "a"), (2, "b")).coalesce(1).mapInArrow(count, "k int, v string")
    VersionedTables(f"{folder}/s").publish(spark, {"t": once}, keys=KEY)
    assert runs.value == 1
    write_dimension(once, f"{folder}/d", "k")
    assert runs.value == 2 and _found(spark.read.parquet(f"{folder}/d")) == [(1, "a"), (2, "b")]


def test_a_version_that_fails_leaves_no_trace(spark, folder, monkeypatch):
    store = VersionedTables(folder)
    store.publish(spark, {"t": _rows(spark, (1, "a"))}, keys=KEY)
    before = sorted(map(str, Path(folder).rglob("*")))
    bad = _rows(spark, (1, "a")).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        store.publish(spark, {"u": _rows(spark, (1, "a")), "t": bad}, keys={"t": "k", "u": "k"})
    assert [p for p in Path(folder).rglob("*.parquet") if str(p) not in before] == []
    monkeypatch.setattr(versions, "create_text", lambda *_: False)
    with pytest.raises(PublishedMeanwhileError):
        store.publish(spark, {"t": _rows(spark, (2, "b"))}, keys=KEY)
    assert _found(store.current(spark).read(spark, "t")) == [(1, "a")]


def test_a_refused_table_stays_as_it_was(spark, folder):
    write_dimension(_rows(spark, (1, "a")), f"{folder}/d", "k")
    with pytest.raises(DuplicateKeysError):
        write_dimension(_rows(spark, (1, "a"), (1, "b")), f"{folder}/d", "k")
    assert _found(spark.read.parquet(f"{folder}/d")) == [(1, "a")]
    write_dimension(spark.read.parquet(f"{folder}/d").union(_rows(spark, (2, "b"))), f"{folder}/d", "k")
    assert _found(spark.read.parquet(f"{folder}/d")) == [(1, "a"), (2, "b")]
    assert [p.name for p in Path(folder).iterdir()] == ["d"]


def test_new_keys_are_looked_up_in_their_range_and_through_a_bloom_filter(spark, folder):
    stored = spark.range(5000).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("v"))
    stored.write.parquet(f"{folder}/stored")
    _rows(spark, (4000, "y"), (4100, "z"), (6000, "new")).write.parquet(f"{folder}/new")
    read = lambda n: spark.read.parquet(f"{folder}/{n}")
    scans = {
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    for key, value in scans.items():
        spark.conf.set(key, value)
    try:
        found = keys_in_both(read("stored"), read("new"), "k")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(k,4000)" in plan and "might_contain" in plan
        assert "v#" not in plan and _found(found) == [(4000,), (4100,)]
    finally:
        for key in scans:
            spark.conf.unset(key)
    assert _found(keys_in_both(read("stored"), read("new").where("k < 0"), "k")) == []


# The fleet ---------------------------------------------------------------------------


def _cars(spark, driver, *ids):
    return literal_table(spark, [(i, driver, 3, 1) for i in ids or (100, 101)], CARS)


def test_the_profile_is_neither_shuffled_nor_aggregated(spark, folder):
    cars = spark.range(2000).select(*(F.col("id").cast("int").alias(c) for c in CARS.fieldNames()))
    FleetStore(folder, buckets=8).publish(spark, cars)
    events = spark.range(500).select(*(F.col("id").cast(f.dataType).alias(f.name) for f in RAW_EVENT))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = enrich(events, FleetStore(folder).profile(spark))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Aggregate" not in plan and "Bucketed: true" in plan
        assert joined.where("driver_id = car_id").count() == 500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_cars_replaced_under_a_running_job_are_never_unknown(spark, folder):
    store = FleetStore(f"{folder}/dims", buckets=4, keep=2)
    raw, enriched = (FileTopic(f"{folder}/{n}", n) for n in ("raw", "enriched"))
    store.publish(spark, _cars(spark, 1))
    query = start_enrichment(raw.stream(spark), store.profile, enriched, f"{folder}/c")
    try:
        for n in range(2, 6):
            _send(spark, raw, _event(f"{n}a"), _event(f"{n}b", car=101))
            store.publish(spark, _cars(spark, n))  # while the micro-batch may be running
        query.processAllAvailable()
        _send(spark, raw, _event("last"))
        query.processAllAvailable()
    finally:
        query.stop()
    found = {r.event_id: r.driver_id for r in decode(enriched.batch(spark), ENRICHED_EVENT).collect()}
    assert len(found) == 9 and None not in found.values() and found["last"] == 5


def test_a_replay_reads_the_newest_finished_version(spark, folder):
    store = FleetStore(f"{folder}/dims", buckets=4)
    raw, enriched = (FileTopic(f"{folder}/{n}", n) for n in ("raw", "enriched"))
    store.publish(spark, _cars(spark, 1))
    with pytest.raises(DuplicateKeysError):
        store.publish(spark, new_cars=_cars(spark, 2, 101, 102))
    store.publish(spark, new_cars=_cars(spark, 2, 102))
    _send(spark, raw, _event("x"), _event("y", car=102))
    start_enrichment(raw.stream(spark), store.profile, enriched, f"{folder}/c", trigger=DRAIN).awaitTermination()
    found = {r.event_id: r.driver_id for r in decode(enriched.batch(spark), ENRICHED_EVENT).collect()}
    assert found == {"x": 1, "y": 2}


def test_a_fleet_needs_cars_first(spark, folder):
    store = FleetStore(folder)
    with pytest.raises(RuntimeError, match="no finished version"):
        store.profile(spark)
    with pytest.raises(ValueError, match="cars"):
        store.publish(spark)


def test_cars_are_published_from_a_file(spark, folder, capsys):
    Path(folder, "cars.csv").write_text("car_id,driver_id,model_id,color_id\n100,900,3,1\n")
    Path(folder, "more.json").write_text('{"car_id": 101, "driver_id": 901, "model_id": 6, "color_id": 4}\n')
    main(["dims", "--dims", f"{folder}/dims", "--cars", f"{folder}/cars.csv", "--buckets", "4"])
    main(["dims", "--dims", f"{folder}/dims", "--add-cars", f"{folder}/more.json", "--buckets", "4"])
    assert "version 2" in capsys.readouterr().out
    with pytest.raises(DuplicateKeysError):
        main(["dims", "--dims", f"{folder}/dims", "--add-cars", f"{folder}/cars.csv"])
    raw = FileTopic(f"{folder}/topics/sensors-sample", "raw")
    _send(spark, raw, _event("x"), _event("y", car=101))
    args = ["--files", f"{folder}/topics", "--dims", f"{folder}/dims", "--store", f"{folder}/store"]
    main(["run", *args, "--drain", "--counted", "alert-data"])
    topic = FileTopic(f"{folder}/topics/samples-enriched", "enriched")
    found = {r.event_id: (r.driver_id, r.color_name) for r in decode(topic.batch(spark), ENRICHED_EVENT).collect()}
    assert found == {"x": (900, "Black"), "y": (901, "White")}
    for key in state_store_settings():
        spark.conf.unset(key)
