"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from motorpulse.operators import fits_broadcast
from motorpulse.plans import queries
from motorpulse.plans.queries import QUERIES
from motorpulse.sources import FileTopic
from motorpulse.streaming import start_appending

TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "double": "DOUBLE",
}


@pytest.fixture(scope="module")
def tables(sf_dir):
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(v is not None, v) for v in r])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, tables, sf_dir, name):
    ours = contract.queries()[name](spark, sf_dir)
    ours = ours.select(*sorted(ours.columns))
    found = tables.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    order = sorted(range(len(columns)), key=columns.__getitem__)
    expected = [[row[i] for i in order] for row in found.fetchall()]

    assert ours.columns == [columns[i] for i in order]
    types = [str(found.description[i][1]) for i in order]
    assert [TYPES[f.dataType.simpleString()] for f in ours.schema.fields] == types
    assert _sorted(ours.collect()) == _sorted(expected)
    assert expected


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.oracle_sql())


PRUNED = (
    "pruned_columns computed_columns window_fields distinct_cars rows_per_model colors_per_model "
    "events_per_car repeated_cars joined_cars joined_models joined_colors normalized_colors"
).split()


@pytest.mark.parametrize("name", PRUNED)
def test_unused_properties_are_not_read(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema" in plan and "props" not in plan


def test_streams_get_several_micro_batches(spark, sf_dir, folder):
    topic = FileTopic(f"{folder}/raw", "raw")
    messages = queries._message_stream(spark, sf_dir, folder)
    start_appending(messages, topic, f"{folder}/c", trigger=queries.DRAIN).awaitTermination()
    with_rows = {p.parent.name for p in Path(folder, "raw").rglob("*.parquet")}
    assert len(with_rows) >= 3


def test_streams_keep_events_without_a_time(spark, sf_dir, folder):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").limit(40)
    late = events.withColumn("ts", F.when(F.col("event_id") % 4 > 0, F.col("ts")))
    late.write.parquet(f"{folder}/events.parquet")
    seen = [r["event_id"] for part in queries._parts(spark, folder) for r in part.collect()]
    assert late.where("ts IS NULL").count() > 0
    assert sorted(seen) == sorted(r["event_id"] for r in late.collect())


@pytest.mark.parametrize("limit", [2**26, 0])
def test_micro_batches_of_the_chain_follow_the_parts_and_not_the_files(spark, folder, monkeypatch, limit):
    monkeypatch.setattr(fits_broadcast, "__defaults__", (limit,))
    monkeypatch.setattr(queries, "_folder", lambda _: f"{folder}/run")
    minute = F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, cast(id % 50 as int))")
    events = spark.range(0, 600, 1, 12).select(
        F.col("id").alias("event_id"), minute.alias("ts"), (F.col("id") % 9).alias("user_id"),
        F.lit("click").alias("event_type"), F.lit(200.0).alias("value"), F.lit('{"k": 3}').alias("props"),
    )
    events.write.parquet(f"{folder}/events.parquet")
    cars = "select id c_custkey, cast(id % 3 as int) c_nationkey, 1.0D c_acctbal from range(6)"
    for name, rows in {
        "customer": cars,
        "nation": "select cast(id as int) n_nationkey, 'N' n_name, 0 n_regionkey from range(3)",
        "region": "select cast(id as int) r_regionkey, 'ASIA' r_name from range(5)",
    }.items():
        spark.sql(rows).write.parquet(f"{folder}/{name}.parquet")
    found = queries.chained_topics(spark, folder)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, queries.alert_windows(spark, folder).collect()))
    raw = list(Path(f"{folder}/run/raw").glob("writer=*/*/part-*"))
    batches = list(Path(f"{folder}/run/checkpoints/enrich/commits").glob("[0-9]*"))
    assert len(batches) <= queries.PARTS < len(raw)
