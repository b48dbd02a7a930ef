from __future__ import annotations

import json

import pytest

from motorpulse.__main__ import _arguments, _topics, main
from motorpulse.schemas import CARS
from motorpulse.session import state_store_settings
from motorpulse.sources import FileTopic
from motorpulse.streaming import SnapshotTable
from motorpulse.streaming.jobs import windows_of_panes


@pytest.fixture
def dims(spark, folder):
    main(["dims", "--dims", f"{folder}/dims"])
    cars = spark.createDataFrame([(100, 900, 3, 1)], CARS)
    cars.write.parquet(f"{folder}/dims/cars")
    yield f"{folder}/dims"
    for key in state_store_settings():
        spark.conf.unset(key)


def _send(spark, folder, topic, **fields):
    text = json.dumps({"event_time": "2024-01-01T00:00:30Z", **fields})
    df = spark.createDataFrame([(text,)], "value string")
    FileTopic(f"{folder}/topics/{topic}", topic).append(df)


@pytest.mark.parametrize(
    "extra", [[], ["--refresh"], ["--mode", "update", "--preview"], ["--only-latest"]]
)
def test_files_are_drained_to_counts(spark, folder, dims, extra):
    _send(spark, folder, "sensors-sample", car_id=100, speed=130, gear=4, rpm=1)
    _send(spark, folder, "sensors-sample", car_id=100, speed=100, gear=3, rpm=1)
    _send(spark, folder, "anomaly-alerts", color="white", speed=5)
    args = ["--files", f"{folder}/topics", "--dims", dims, "--store", f"{folder}/store"]
    main(["run", *args, "--drain", *extra])
    mode = "update" if "update" in extra else "complete"
    rows = SnapshotTable(f"{folder}/store/windows-{mode}").read(spark).collect()
    assert len(rows) == (1 if "--only-latest" in extra else 15)
    assert {(r.num_of_rows, r.num_of_black, r.num_of_white, r.maximum_speed) for r in rows} == {
        (2, 1, 1, 130)
    }


def test_panes_are_stored_instead_of_windows(spark, folder, dims):
    _send(spark, folder, "sensors-sample", car_id=100, speed=130, gear=4, rpm=1)
    args = ["--files", f"{folder}/topics", "--dims", dims, "--store", f"{folder}/store"]
    with pytest.warns(UserWarning, match="anomaly-alerts"):
        main(["run", *args, "--drain", "--mode", "panes"])
    windows = windows_of_panes(SnapshotTable(f"{folder}/store/panes"), spark)
    assert {(r.num_of_rows, r.num_of_black) for r in windows.collect()} == {(1, 1)}
    assert windows.count() == 15


def test_what_does_not_fit_goes_to_topics_of_its_own(spark, folder, dims):
    from datetime import UTC, datetime, timedelta

    now = datetime.now(UTC).replace(microsecond=0)
    fields = {"car_id": 100, "speed": 130, "gear": 4, "rpm": 1}
    raw = FileTopic(f"{folder}/topics/sensors-sample", "sensors-sample")
    args = ["--files", f"{folder}/topics", "--dims", dims, "--store", f"{folder}/store"]
    args += ["--drain", "--mode", "panes", "--counted", "alert-data", "--quarantine", "bad"]
    args += ["--strays", "strays", "--stray-after", "3 days", "--late", "late", "--once-within", "1 hour"]
    _send(spark, folder, "sensors-sample", event_id="old", **fields)
    raw.append(spark.createDataFrame([("not json",)], "value string"))
    for name in ("a", "a", "b"):
        _send(spark, folder, "sensors-sample", event_id=name, **fields | {"event_time": now.isoformat()})
    main(["run", *args])
    behind = (now - timedelta(hours=30)).isoformat()
    _send(spark, folder, "sensors-sample", event_id="late", **fields | {"event_time": behind})
    main(["run", *args])
    found = {
        n: [bytes(r.value).decode() for r in FileTopic(f"{folder}/topics/{n}", n).batch(spark).collect()]
        for n in ("bad", "strays", "late")
    }
    assert found["bad"] == ["not json"] and len(found["late"]) == 1
    assert [json.loads(v)["event_id"] for v in found["strays"]] == ["old"]
    panes = SnapshotTable(f"{folder}/store/panes").read(spark)
    assert panes.groupBy().sum("num_of_rows").first()[0] == 2
    with pytest.raises(SystemExit):
        _arguments(["run", "--files", "f", "--dims", "d", "--store", "s", "--late", "late"])


def test_kafka_topics_of_a_run():
    args = _arguments(
        ["run", "--servers", "h:1", "--dims", "d", "--store", "s", "--per-trigger", "9",
         "--counted", "a.b, c"]
    )
    topics = _topics(args)
    assert topics["raw"].source_options()["subscribe"] == "sensors-sample"
    assert topics["enriched"].sink_options()["topic"] == "samples-enriched"
    counted = topics["counter_input"].source_options()
    assert counted["subscribePattern"] == r"a\.b|c"
    assert counted["maxOffsetsPerTrigger"] == "9"
    # What the chain writes itself is read from its beginning.
    starts = {k: t.source_options()["startingOffsets"] for k, t in topics.items()}
    assert starts == {
        "raw": "latest", "enriched": "earliest", "alert": "earliest", "counter_input": "earliest"
    }


def test_a_drain_needs_offsets_with_something_to_read():
    args = ["run", "--servers", "h:1", "--dims", "d", "--store", "s", "--drain"]
    with pytest.raises(SystemExit):
        _arguments(args)
    assert _arguments([*args, "--starting", "earliest"]).drain


def test_a_run_needs_topics():
    with pytest.raises(SystemExit):
        _arguments(["run", "--dims", "d", "--store", "s"])
    with pytest.raises(SystemExit):
        _arguments(
            ["run", "--files", "f", "--dims", "d", "--store", "s", "--mode", "panes",
             "--only-latest"]
        )
