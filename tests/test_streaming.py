from __future__ import annotations

import json
import shutil
from datetime import UTC, datetime, timedelta
from pathlib import Path
from threading import Thread
from time import sleep

import pytest
from pyspark.errors import StreamingQueryException

from motorpulse.functions import decode
from motorpulse.operators import car_profile, load_profile, window_counts, write_dimension
from motorpulse.operators.counts import normalize
from motorpulse.schemas import (
    CAR_COLORS,
    CAR_MODELS,
    CARS,
    COLOR_ROWS,
    COUNTER_INPUT,
    ENRICHED_EVENT,
    MODEL_ROWS,
)
from motorpulse.plans import enriched_messages
from motorpulse.sources import FileTopic, literal_table
from motorpulse.sources.messages import FileTopics
from motorpulse.streaming import (
    STEPS,
    ChangedSettingsError,
    SnapshotTable,
    drain,
    fleet_steps,
    start,
    start_alerts,
    start_appending,
    start_console,
    start_enrichment,
    start_pane_counts,
    start_preview,
    start_window_counts,
    start_writers,
    wait_for_any,
)
from motorpulse.streaming import chain, snapshots
from motorpulse.streaming.jobs import windows_of_panes

DRAIN = {"availableNow": True}
START = datetime(2024, 1, 1, tzinfo=UTC)


def _at(text):
    h, m, s = map(int, text.split(":"))
    return START + timedelta(hours=h, minutes=m, seconds=s)


def _event(i, car=100, at="00:00:30", speed=130, rpm=100, gear=4):
    return json.dumps(
        {"event_id": str(i), "event_time": _at(at).isoformat(), "car_id": car,
         "speed": speed, "rpm": rpm, "gear": gear}
    )


def _send(spark, topic, *values):
    """One file, and so one micro-batch where a stream takes one file at a time."""
    df = spark.createDataFrame([(v,) for v in values], "value string").coalesce(1)
    topic.append(df)


def _profile(spark, driver=900):
    return car_profile(
        literal_table(spark, [(100, driver, 3, 1), (101, driver + 1, 6, 4)], CARS),
        literal_table(spark, MODEL_ROWS, CAR_MODELS).toDF("model_id", "brand_name", "model_name"),
        literal_table(spark, COLOR_ROWS, CAR_COLORS),
    )


@pytest.fixture
def topics(folder):
    one_by_one = {"maxFilesPerTrigger": "1"}
    return {
        n: FileTopic(f"{folder}/{n}", n, options=one_by_one)
        for n in ("raw", "enriched", "alerts", "malformed")
    }


def _rows(topic, spark):
    return {r["event_id"]: r for r in decode(topic.batch(spark), ENRICHED_EVENT).collect()}


# Enrichment and alerts -----------------------------------------------------------


def test_restart_neither_loses_nor_repeats(spark, topics, folder):
    raw, enriched = topics["raw"], topics["enriched"]

    def run():
        start_enrichment(
            raw.stream(spark), _profile(spark), enriched, f"{folder}/c", trigger=DRAIN
        ).awaitTermination()

    _send(spark, raw, _event(1), _event(2, car=5))
    run()
    run()
    _send(spark, raw, _event(3, car=101))
    run()
    assert enriched.batch(spark).count() == 3
    found = _rows(enriched, spark)
    assert [found[i]["driver_id"] for i in "123"] == [900, None, 901]
    assert [found[i]["color_name"] for i in "123"] == ["Black", None, "White"]


def test_malformed_passes_enrichment_and_ends_at_the_alerts(spark, topics, folder):
    raw, enriched, alert = topics["raw"], topics["enriched"], topics["alerts"]
    _send(spark, raw, "not json", _event(1), _event(2, speed=100, gear=3))
    start_enrichment(
        raw.stream(spark), _profile(spark), enriched, f"{folder}/c1", trigger=DRAIN
    ).awaitTermination()
    start_alerts(enriched.stream(spark), alert, f"{folder}/c2", trigger=DRAIN).awaitTermination()
    assert sorted(r.value.decode() for r in enriched.batch(spark).collect())[-1] == "{}"
    assert list(_rows(alert, spark)) == ["1"]


def test_quarantine_takes_malformed_text_apart(spark, topics, folder):
    raw = topics["raw"]
    _send(spark, raw, "not json", _event(1))
    _send(spark, raw, "{}", _event(2))
    start_enrichment(
        raw.stream(spark), _profile(spark), topics["enriched"], f"{folder}/c",
        quarantine=topics["malformed"], trigger=DRAIN,
    ).awaitTermination()
    assert sorted(_rows(topics["enriched"], spark)) == ["1", "2"]
    bad = topics["malformed"].batch(spark).collect()
    assert sorted(bytes(r.value).decode() for r in bad) == ["not json", "{}"]


def _write_dims(spark, folder, driver):
    paths = [f"{folder}/dims/{n}" for n in ("cars", "models", "colors")]
    write_dimension(literal_table(spark, [(100, driver, 3, 1)], CARS), paths[0], "car_id")
    write_dimension(literal_table(spark, MODEL_ROWS, CAR_MODELS), paths[1], "model_id")
    write_dimension(literal_table(spark, COLOR_ROWS, CAR_COLORS), paths[2], "color_id")
    return paths


def test_refreshed_dimensions_show_in_a_running_query(spark, topics, folder):
    raw, enriched = topics["raw"], topics["enriched"]
    paths = _write_dims(spark, folder, 900)
    _send(spark, raw, _event(1))
    query = start_enrichment(
        raw.stream(spark), lambda s: load_profile(s, *paths), enriched, f"{folder}/c"
    )
    try:
        query.processAllAvailable()
        _write_dims(spark, folder, 950)
        _send(spark, raw, _event(2))
        query.processAllAvailable()
    finally:
        query.stop()
    found = _rows(enriched, spark)
    assert [found[i]["driver_id"] for i in "12"] == [900, 950]


def test_replacing_static_dimensions_ends_the_query(spark, topics, folder):
    raw = topics["raw"]
    paths = _write_dims(spark, folder, 900)
    _send(spark, raw, _event(1))
    query = start_enrichment(
        raw.stream(spark), load_profile(spark, *paths), topics["enriched"], f"{folder}/c"
    )
    try:
        query.processAllAvailable()
        _write_dims(spark, folder, 950)
        _send(spark, raw, _event(2))
        with pytest.raises(StreamingQueryException):
            query.processAllAvailable()
    finally:
        query.stop()


def test_replayed_batch_is_added_once(spark, topics):
    df = spark.createDataFrame([("a",)], "value string")
    topics["raw"].append(df, 7)
    topics["raw"].append(df, 7)
    topics["raw"].append(df, 8)
    assert topics["raw"].batch(spark).count() == 2


# Counts --------------------------------------------------------------------------


def _counted(spark, topics, folder, name, files, **how):
    """Send one file after the other and give the stored counts per window start."""
    for n, times in enumerate(files):
        _send(spark, topics["alerts"], *[_event(f"{n}-{t}", at=t) for t in times])
    table = SnapshotTable(f"{folder}/{name}")
    start_window_counts(
        topics["alerts"].stream(spark), table, f"{folder}/c-{name}", trigger=DRAIN, **how
    ).awaitTermination()
    rows = table.read(spark).collect()
    return {r["window_start"]: r["num_of_rows"] for r in rows}, table


LATE = [["00:00:30"], ["05:00:30"], ["05:00:40"], ["00:00:45"]]
TUMBLING = {"length": "15 minutes", "slide": "15 minutes"}


def _naive(text):
    return _at(text).astimezone().replace(tzinfo=None)


def test_complete_counts_late_rows(spark, topics, folder):
    found, _ = _counted(spark, topics, folder, "w", LATE, mode="complete", **TUMBLING)
    assert found == {_naive("00:00:00"): 2, _naive("05:00:00"): 2}


def test_update_drops_late_rows(spark, topics, folder):
    found, _ = _counted(spark, topics, folder, "w", LATE, mode="update", **TUMBLING)
    assert found == {_naive("00:00:00"): 1, _naive("05:00:00"): 2}


@pytest.mark.parametrize("method", ["direct", "panes"])
def test_append_gives_passed_windows_without_late_rows(spark, topics, folder, method):
    found, _ = _counted(
        spark, topics, folder, "w", LATE, mode="append", method=method, **TUMBLING
    )
    assert found == {_naive("00:00:00"): 1}


def test_latest_window_in_both_modes(spark, topics, folder):
    complete, _ = _counted(spark, topics, folder, "a", LATE, mode="complete", only_latest=True)
    assert complete == {_naive("05:00:00"): 2}
    update, _ = _counted(spark, topics, folder, "b", [], mode="update", only_latest=True)
    assert update == {_naive("05:00:00"): 2}


def test_panes_count_late_rows_and_keep_no_state(spark, topics, folder):
    for n, times in enumerate(LATE):
        _send(spark, topics["alerts"], *[_event(f"{n}-{t}", at=t) for t in times])
    table = SnapshotTable(f"{folder}/panes")
    query = start_pane_counts(
        topics["alerts"].stream(spark), table, f"{folder}/c", trigger=DRAIN
    )
    query.awaitTermination()
    assert query.lastProgress["stateOperators"] == []
    windows = windows_of_panes(table, spark)
    rows = decode(topics["alerts"].batch(spark), COUNTER_INPUT, envelope=["timestamp"])
    batch = window_counts(normalize(rows, fallback="timestamp"))
    assert sorted(map(str, windows.collect())) == sorted(map(str, batch.collect()))
    assert table.read(spark).count() == 2


def test_watermark_bounds_the_state_of_update_mode(spark, topics, folder):
    for hour in range(6):
        _send(spark, topics["alerts"], _event(hour, at=f"{hour:02}:00:30"))

    def state_rows(mode):
        query = start_window_counts(
            topics["alerts"].stream(spark), SnapshotTable(f"{folder}/{mode}"),
            f"{folder}/c-{mode}", mode=mode, trigger=DRAIN,
        )
        query.awaitTermination()
        return query.lastProgress["stateOperators"][0]["numRowsTotal"]

    assert state_rows("complete") == 6 * 15
    assert state_rows("update") <= 2 * 15


def test_snapshots_are_replaced_read_back_and_pruned(spark, folder):
    table = SnapshotTable(f"{folder}/t")
    assert table.read(spark) is None
    for i in range(4):
        table.write(spark.createDataFrame([(i,)], "n int"), i)
    table.write(spark.createDataFrame([(99,)], "n int"), 3)
    assert table.read(spark).first()["n"] == 3
    assert table.read(spark, before=3).first()["n"] == 2
    assert table.read(spark, before=2) is None


def _files(folder):
    return {str(f): f.stat().st_mtime_ns for f in Path(folder).rglob("*.parquet")}


def test_a_batch_leaves_the_files_of_other_days(spark, folder):
    table = SnapshotTable(f"{folder}/t", keep_seconds=0)
    rows = lambda *days: spark.sql(
        "SELECT timestamp_seconds(86400L * day) AS at, n FROM VALUES "
        + ", ".join(f"({d}, {n})" for d, n in days) + " AS t(day, n)"
    )
    found = lambda **how: {r["n"] for r in table.read(spark, **how).collect()}
    table.write_days(rows((-1, 10), (1, 11), (2, 12)), 0, time="at")
    first = {f for f in _files(folder) if "day=2/" not in f and "/columns/" not in f}
    for batch in range(1, 5):
        before = _files(folder)
        table.write_days(rows((2, 20 + batch)), batch, time="at")
        assert {f: t for f, t in _files(folder).items() if f in first} == {f: before[f] for f in first}
    table.write_days(rows((2, 99)), 4, time="at")  # a replay counts once
    assert found() == {10, 11, 24} and found(before=4) == {10, 11, 23} and found(days=[1]) == {11}
    assert sum("day=2/" in f for f in _files(folder)) == table.keep
    table.write_days(rows((2, 0)).where("n > 0"), 5, time="at")
    assert found() == {10, 11, 24}
    with pytest.raises(RuntimeError, match="by days"):
        table.write(rows((2, 0)), 6)
    empty = SnapshotTable(f"{folder}/empty")
    empty.write_days(rows((2, 0)).where("n > 0"), 0, time="at")
    assert empty.read(spark).columns == ["at", "n"] and empty.read(spark).count() == 0


def _day_rows(spark, *days):
    values = ", ".join(f"({d}, {n})" for d, n in days)
    return spark.sql(f"SELECT timestamp_seconds(86400L * day) AS at, n FROM VALUES {values} AS t(day, n)")


def test_a_reader_goes_on_while_batches_come(spark, folder):
    young = SnapshotTable(f"{folder}/t")
    young.write_days(_day_rows(spark, (1, 1), (2, 2)), 0, time="at")
    reader = young.read(spark)
    for batch in range(1, 11):
        young.write_days(_day_rows(spark, (2, batch)), batch, time="at")
    assert sorted(r["n"] for r in reader.collect()) == [1, 2]
    # Once they are old, only the last entries, and the files that these name, stay.
    SnapshotTable(f"{folder}/t", keep_seconds=0).write_days(_day_rows(spark, (3, 3)), 11, time="at")
    assert sorted(int(p.name) for p in Path(folder, "t/_log").glob("[0-9]*")) == [10, 11]
    assert sorted(p.parent.name + "/" + p.name for p in Path(folder).glob("t/changed=*/day=*")) == [
        "changed=0/day=1", "changed=10/day=2", "changed=11/day=3"
    ]
    assert sorted(p.name for p in Path(folder).glob("t/changed=*")) == ["changed=0", "changed=10", "changed=11"]
    assert sorted(r["n"] for r in young.read(spark).collect()) == [1, 3, 10]


def test_a_batch_that_died_before_its_entry_is_not_read(spark, folder, monkeypatch):
    table = SnapshotTable(f"{folder}/t")
    table.write_days(_day_rows(spark, (1, 1)), 0, time="at")
    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "create_text", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.write_days(_day_rows(spark, (1, 9), (2, 9)), 1, time="at")
    assert [r["n"] for r in table.read(spark).collect()] == [1]
    table.write_days(_day_rows(spark, (1, 5)), 1, time="at")
    assert [r["n"] for r in table.read(spark).collect()] == [5]


def test_folders_are_not_listed_batch_after_batch(spark, folder, monkeypatch):
    table = SnapshotTable(f"{folder}/t")
    table.write_days(_day_rows(spark, *[(d, d) for d in range(40)]), 0, time="at")
    asked = []
    for name in ("matching_paths", "matching_parents"):
        plain = getattr(snapshots, name)
        monkeypatch.setattr(snapshots, name, lambda s, p, f=plain: asked.append(p) or f(s, p))
    table.write_days(_day_rows(spark, (7, 70)), 1, time="at")
    assert sum(r["n"] for r in table.read(spark).collect()) == sum(range(40)) + 63
    assert not [p for p in asked if "changed" in p]


def test_a_table_from_before_the_log_goes_on(spark, folder):
    table = SnapshotTable(f"{folder}/t")
    for batch in range(2):
        table.write_days(_day_rows(spark, (1, batch), (2 + batch, 5)), batch, time="at")
    shutil.rmtree(f"{folder}/t/_log")
    assert sorted(r["n"] for r in table.read(spark).collect()) == [1, 5, 5]
    table.write_days(_day_rows(spark, (2, 7)), 2, time="at")
    assert sorted(r["n"] for r in table.read(spark).collect()) == [1, 5, 7]


def test_a_table_refuses_another_checkpoint(spark, topics, folder):
    _send(spark, topics["alerts"], _event(1), _event(2), _event(3))
    table = SnapshotTable(f"{folder}/w")
    run = lambda c: start_window_counts(
        topics["alerts"].stream(spark), table, f"{folder}/{c}", trigger=DRAIN, **TUMBLING
    ).awaitTermination()
    run("first")
    run("first")
    with pytest.raises(Exception, match="belongs to the checkpoint"):
        run("second")
    assert [r["num_of_rows"] for r in table.read(spark).collect()] == [3]


def test_a_topic_takes_batches_of_every_kind_of_writer(spark, topics, folder):
    stream = lambda: topics["raw"].stream(spark)
    _send(spark, topics["raw"], _event(1))
    start_enrichment(stream(), _profile(spark), topics["enriched"], f"{folder}/c", trigger=DRAIN).awaitTermination()
    _send(spark, topics["raw"], _event(2))
    refreshed = lambda session: _profile(session)
    start_enrichment(stream(), refreshed, topics["enriched"], f"{folder}/c", trigger=DRAIN).awaitTermination()
    assert topics["enriched"].batch(spark).count() == 2
    # A new checkpoint numbers its batches anew and loses none of them.
    start_enrichment(stream(), refreshed, topics["enriched"], f"{folder}/d", trigger=DRAIN).awaitTermination()
    assert topics["enriched"].batch(spark).count() == 4


def test_a_topic_that_comes_later_is_read_after_a_restart(spark, topics, folder):
    late = FileTopic(f"{folder}/late", "late")
    both = FileTopics((topics["alerts"], late))
    _send(spark, topics["alerts"], _event(1))
    table = SnapshotTable(f"{folder}/w")
    run = lambda: start_window_counts(
        both.stream(spark), table, f"{folder}/c", trigger=DRAIN, **TUMBLING
    ).awaitTermination()
    with pytest.warns(UserWarning, match="late"):
        run()
    _send(spark, late, _event(2))
    run()
    assert [r["num_of_rows"] for r in table.read(spark).collect()] == [2]


def test_counts_refresh_every_minute_unless_told(spark, topics, folder, monkeypatch):
    seen = {}
    monkeypatch.setattr(chain, "start_window_counts", lambda *a, **how: seen.update(how))
    for topic in ("alerts",):
        topics[topic].stream(spark)
    _steps(spark, topics, folder)["counts"]()
    assert "trigger" not in seen  # the job's own default, a minute, holds
    _steps(spark, topics, folder, counter_trigger=DRAIN)["counts"]()
    assert seen["trigger"] == DRAIN


# Settings of a checkpoint, redelivery, late rows --------------------------------------------


@pytest.mark.parametrize(
    "changed",
    [{"slide": "5 minutes"}, {"length": "30 minutes"}, {"counted": ("red",)}, {"maxima": ("speed",)},
     {"watermark": "1 hour"}, {"mode": "update"}],
    ids=str,
)
def test_a_checkpoint_refuses_other_counts(spark, topics, folder, changed):
    _send(spark, topics["alerts"], _event(1))
    table = SnapshotTable(f"{folder}/w")
    run = lambda **how: start_window_counts(
        topics["alerts"].stream(spark), table, f"{folder}/c", trigger=DRAIN, **how
    ).awaitTermination()
    run()
    run(length="900 seconds", slide="interval 1 minute")  # the same in other words
    with pytest.raises(ChangedSettingsError, match=next(iter(changed))):
        run(**changed)
    _send(spark, topics["alerts"], _event(2))
    run()
    assert table.read(spark).first()["num_of_rows"] == 2


def test_a_checkpoint_of_panes_refuses_another_slide(spark, topics, folder):
    _send(spark, topics["alerts"], _event(1))
    run = lambda **how: start_pane_counts(
        topics["alerts"].stream(spark), SnapshotTable(f"{folder}/p"), f"{folder}/c", trigger=DRAIN, **how
    ).awaitTermination()
    run()
    with pytest.raises(ChangedSettingsError, match="panes='0:01:00' and not '0:02:00'"):
        run(slide="2 minutes")


def _arrive(spark, topic, *pairs):
    """Messages that arrive at the given times."""
    rows = [(value, _at(at)) for value, at in pairs]
    topic.append(spark.createDataFrame(rows, "value string, timestamp timestamp").coalesce(1))


@pytest.mark.parametrize("refreshed", [False, True])
def test_redelivered_messages_count_once(spark, topics, folder, refreshed):
    raw, enriched = topics["raw"], topics["enriched"]
    profile = (lambda s: _profile(s)) if refreshed else _profile(spark)
    run = lambda **how: start_enrichment(
        raw.stream(spark), profile, enriched, f"{folder}/c", trigger=DRAIN, **how
    )
    _arrive(spark, raw, (_event(1), "00:00:00"), (_event(1), "00:00:01"), ("not json", "00:00:02"))
    _arrive(spark, raw, (_event(1, at="00:09:00"), "00:05:00"), (_event(2), "00:05:00"), ("not json", "00:05:00"))
    for at in ("02:00:00", "02:30:00"):
        _arrive(spark, raw, (_event(at), at))
    # An old event that arrives now is no late one.
    _arrive(spark, raw, (_event(3, at="00:00:00"), "03:00:00"), (_event(2), "03:00:01"))
    query = run(once_within="10 minutes")
    query.awaitTermination()
    found = sorted(r["event_id"] or "-" for r in decode(enriched.batch(spark), ENRICHED_EVENT).collect())
    # The second 2 came hours later, when its id was forgotten.
    assert found == ["-", "-", "02:00:00", "02:30:00", "1", "2", "2", "3"]
    for minute in range(20):
        _arrive(spark, raw, *[(_event(f"{minute}-{k}"), f"{4 + minute}:00:00") for k in range(5)])
    query = run(once_within="10 minutes")
    query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 10
    with pytest.raises(ChangedSettingsError, match="once_within"):
        run(once_within="20 minutes")


def test_late_rows_go_to_a_topic_of_their_own(spark, topics, folder, monkeypatch):
    late, table = topics["malformed"], SnapshotTable(f"{folder}/panes")
    run = lambda: start_pane_counts(
        topics["alerts"].stream(spark), table, f"{folder}/c", late=late, lateness="20 minutes", trigger=DRAIN
    ).awaitTermination()
    for n, times in enumerate([["05:00:30", "00:00:10"], ["04:40:29", "04:40:30", "06:00:00"], ["05:39:59"]]):
        _send(spark, topics["alerts"], *[_event(f"{n}-{t}", at=t) for t in times])
    run()
    counted = lambda: table.read(spark).groupBy().sum("num_of_rows").first()[0]
    times = lambda: sorted(json.loads(bytes(r.value))["event_time"][11:19] for r in late.batch(spark).collect())
    # In the first micro-batch nothing is late: there is no newest event before it.
    assert counted() == 4 and times() == ["04:40:29", "05:39:59"]
    # A micro-batch that dies after its late rows were sent is split alike when replayed.
    _send(spark, topics["alerts"], _event("x", at="05:39:58"), _event("y", at="23:00:00"))
    with monkeypatch.context() as patch:
        patch.setattr(SnapshotTable, "write_days", lambda *_, **__: 1 / 0)
        with pytest.raises(StreamingQueryException):
            run()
    run()
    assert counted() == 5 and times() == ["04:40:29", "05:39:58", "05:39:59"]


@pytest.mark.parametrize("fails", [False, True])
def test_alerts_of_wrong_times_go_to_a_topic_of_their_own(spark, topics, folder, monkeypatch, fails):
    strays = topics["malformed"]
    run = lambda: start_alerts(
        topics["raw"].stream(spark), topics["alerts"], f"{folder}/c", strays=strays, within="2 hours", trigger=DRAIN
    ).awaitTermination()

    def alert(name, text):
        return json.dumps({"event_id": name, "event_time": text, "speed": 130, "rpm": 1, "gear": 4, "expected_gear": 4})

    times = {
        "now": "2024-01-01T05:00:00Z", "edge": "2024-01-01T03:00:00Z", "ahead": "2024-01-01T07:00:00Z",
        "old": "2024-01-01T02:59:59Z", "next": "2024-01-01T07:00:01Z", "far": "2999-01-01", "first": "0001-01-01",
        "huge": "+200000-01-01T00:00:00Z", "bad": "garbage", "none": None,
    }
    sent = [(alert(name, text), "05:00:00") for name, text in times.items()]
    _arrive(spark, topics["raw"], *sent, ("not json", "05:00:00"), (_event("slow", speed=1), "05:00:00"))
    if fails:
        append = FileTopic.append
        with monkeypatch.context() as patch:
            patch.setattr(FileTopic, "append", lambda t, *a: 1 / 0 if t is strays else append(t, *a))
            with pytest.raises(StreamingQueryException):
                run()
    run()
    ids = lambda t: sorted(r["event_id"] for r in decode(t.batch(spark), ENRICHED_EVENT).collect())
    assert ids(topics["alerts"]) == ["ahead", "bad", "edge", "none", "now"]
    assert ids(strays) == ["far", "first", "huge", "next", "old"]


def test_writers_share_one_batch(spark, topics, folder):
    _send(spark, topics["raw"], "a", "b")
    seen = []
    note = lambda name: lambda batch, i, _: seen.append((name, i, batch.count()))
    start_writers(
        topics["raw"].stream(spark),
        [note("x"), note("y")],
        f"{folder}/c",
        trigger=DRAIN,
    ).awaitTermination()
    assert seen == [("x", 0, 2), ("y", 0, 2)]


def test_console_sinks_run(spark, topics, folder):
    _send(spark, topics["raw"], _event(1))
    stream = topics["raw"].stream(spark)
    start_preview(stream.select("topic"), trigger=DRAIN).awaitTermination()
    rows = normalize(decode(stream, COUNTER_INPUT, envelope=["timestamp"]), fallback="timestamp")
    start_console(window_counts(rows), f"{folder}/c", trigger=DRAIN).awaitTermination()


# The chain -----------------------------------------------------------------------------


def _steps(spark, topics, folder, **how):
    return fleet_steps(
        spark, raw=topics["raw"], enriched=topics["enriched"], alert=topics["alerts"],
        table=SnapshotTable(f"{folder}/w"), profile=_profile(spark),
        checkpoints=f"{folder}/c", **how,
    )


def test_chain_drains_step_by_step_and_from_a_later_one(spark, topics, folder):
    _send(spark, topics["raw"], _event(1), _event(2, speed=100, gear=3), "not json")
    steps = _steps(spark, topics, folder, trigger=DRAIN)
    assert tuple(steps) == STEPS
    shown = _steps(spark, topics, folder, trigger=DRAIN, preview=True)
    assert [n for n in shown if n in STEPS] == list(STEPS) and len(shown) == 6
    drain(steps)
    rows = SnapshotTable(f"{folder}/w").read(spark).collect()
    assert {(r["num_of_rows"], r["num_of_black"]) for r in rows} == {(1, 1)}
    assert len(rows) == 15

    _send(spark, topics["raw"], _event(9))
    drain(steps, first="counts")
    counted = lambda: SnapshotTable(f"{folder}/w").read(spark).first()["num_of_rows"]
    assert counted() == 1
    drain(steps)
    assert counted() == 2
    with pytest.raises(ValueError):
        drain(steps, first="nothing")


def test_running_chain_stops_when_one_query_ends(spark, topics, folder):
    FileTopic(f"{folder}/foreign", "foreign").append(spark.createDataFrame([("x",)], "value string"))
    foreign = FileTopic(f"{folder}/foreign", "foreign").stream(spark)
    start_preview(foreign, trigger=DRAIN).awaitTermination()  # ends before the chain is waited for
    running = start(_steps(spark, topics, folder))
    _send(spark, topics["raw"], _event(1))
    for query in running.values():
        query.processAllAvailable()
    assert SnapshotTable(f"{folder}/w").read(spark).count() == 15
    waiter = Thread(target=wait_for_any, args=(spark, running))
    waiter.start()
    sleep(3)
    assert waiter.is_alive() and all(q.isActive for q in running.values())
    running["alerts"].stop()
    waiter.join(60)
    assert not any(q.isActive for q in running.values())


def test_chain_that_cannot_start_stops_what_it_started(spark, topics, folder):
    _send(spark, topics["raw"], _event(1))
    steps = _steps(spark, topics, folder)
    steps["alerts"] = lambda: 1 / 0
    before = {q.id for q in spark.streams.active}
    with pytest.raises(ZeroDivisionError):
        start(steps)
    assert {q.id for q in spark.streams.active} == before


def test_stream_equals_batch_in_any_cut(spark, topics, folder):
    """Enriched messages are the same whether read at once or file by file."""
    for n in range(4):
        _send(spark, topics["raw"], *[_event(f"{n}-{i}", car=100 + i % 3) for i in range(25)])
    start_enrichment(
        topics["raw"].stream(spark), _profile(spark), topics["enriched"], f"{folder}/c",
        trigger=DRAIN,
    ).awaitTermination()
    batch = enriched_messages(topics["raw"].batch(spark), _profile(spark))
    streamed = [bytes(r.value).decode() for r in topics["enriched"].batch(spark).collect()]
    assert sorted(streamed) == sorted(r.value for r in batch.collect())


def test_plain_messages_can_be_sent(spark, topics, folder):
    _send(spark, topics["raw"], "x")
    start_appending(
        topics["raw"].stream(spark), topics["enriched"], f"{folder}/c", trigger=DRAIN
    ).awaitTermination()
    assert [bytes(r.value) for r in topics["enriched"].batch(spark).collect()] == [b"x"]
