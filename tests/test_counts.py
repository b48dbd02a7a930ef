from __future__ import annotations

import random
from collections import defaultdict
from datetime import UTC, datetime, timedelta

import pytest

from motorpulse.functions import decode
from motorpulse.operators import (
    combine_panes,
    latest_closed_window,
    latest_window,
    normalize,
    pane_counts,
    window_counts,
)
from motorpulse.operators.counts import pane_length
from motorpulse.schemas import COUNTER_INPUT

SCHEMA = "event_time string, speed int, gear int, rpm int, color string, color_name string"
MINUTE = timedelta(minutes=1)


def _rows(spark, times, **values):
    row = {"speed": 1, "gear": 1, "rpm": 1, "color": None, "color_name": None, **values}
    return spark.createDataFrame([(t, *row.values()) for t in times], SCHEMA)


def _collected(windows):
    cols = [c for c in windows.columns if not c.startswith("window_")]
    rows = windows.selectExpr(
        "unix_seconds(window_start) s", "unix_seconds(window_end) e", *cols
    ).collect()
    return {(r["s"], r["e"]): tuple(r[c] for c in cols) for r in rows}


def _brute(rows, length=15, slide=1):
    """Every window of every row, in plain Python."""
    held = defaultdict(list)
    for row in rows:
        seconds = int(row["time"].timestamp())
        newest = seconds - seconds % (slide * 60)
        start = newest
        while start + length * 60 > seconds:
            held[start, start + length * 60].append(row)
            start -= slide * 60
    color = lambda rs, c: sum((r["color"] or "").lower() == c for r in rs)
    top = lambda rs, k: max((r[k] for r in rs if r[k] is not None), default=None)
    return {
        w: (
            len(rs), color(rs, "black"), color(rs, "white"), color(rs, "silver"),
            top(rs, "speed"), top(rs, "gear"), top(rs, "rpm"),
        )
        for w, rs in held.items()
    }


def _random_rows(seed, n=400):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1, tzinfo=UTC)
    pick = lambda *values: rng.choice([*values, None])
    return [
        {
            "time": start + timedelta(seconds=rng.randrange(3 * 3600)),
            "color": pick("Black", "WHITE", "silver", "Red"),
            "speed": pick(1, 50, 200),
            "gear": pick(1, 7),
            "rpm": pick(10, 8000),
        }
        for _ in range(n)
    ]


def _frame(spark, rows):
    values = [
        (r["time"].isoformat(), r["speed"], r["gear"], r["rpm"], r["color"], None) for r in rows
    ]
    return spark.createDataFrame(values, SCHEMA)


@pytest.mark.parametrize("method", ["direct", "panes"])
@pytest.mark.parametrize("length, slide", [(15, 1), (15, 5), (10, 10)])
def test_counts_equal_brute_force(spark, method, length, slide):
    rows = _random_rows(length + slide)
    windows = window_counts(
        normalize(_frame(spark, rows)),
        length=f"{length} minutes",
        slide=f"{slide} minutes",
        method=method,
    )
    assert _collected(windows) == _brute(rows, length, slide)


@pytest.mark.parametrize("method", ["direct", "panes", None])
@pytest.mark.parametrize("length, slide", [(15, 4), (10, 4), (7, 5), (9, 6)])
def test_a_slide_need_not_divide_the_length(spark, method, length, slide):
    rows = _random_rows(5 + slide)
    windows = window_counts(
        normalize(_frame(spark, rows)), length=f"{length} minutes", slide=f"{slide} minutes", method=method
    )
    assert _collected(windows) == _brute(rows, length, slide)


def test_panes_copy_groups_and_not_rows(spark):
    """Ten times the rows at the same times make no more copies of panes."""
    rows = _random_rows(3)

    def copied(times):
        panes = pane_counts(normalize(_frame(spark, rows * times)), slide=pane_length("10 minutes", "4 minutes"))
        return panes.count()

    assert copied(1) == copied(10) <= len(rows)


def test_pane_lengths():
    assert pane_length("10 minutes", "4 minutes") == f"{120 * 10**6} microseconds"
    assert pane_length("15 minutes", "1 minute") == f"{60 * 10**6} microseconds"
    assert pane_length("1 second", "300 milliseconds") == f"{10**5} microseconds"
    with pytest.raises(ValueError, match="longer"):
        pane_length("1 minute", "2 minutes")


def test_each_row_counts_in_fifteen_windows_in_any_order(spark):
    rows = _random_rows(11)
    first = _collected(window_counts(normalize(_frame(spark, rows))))
    assert sum(v[0] for v in first.values()) == 15 * len(rows)
    random.Random(1).shuffle(rows)
    assert _collected(window_counts(normalize(_frame(spark, rows).repartition(7)))) == first


def test_panes_combine_in_parts(spark):
    rows = _random_rows(13)
    parts = [pane_counts(normalize(_frame(spark, rows[i::3]))) for i in range(3)]
    together = combine_panes(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert _collected(together) == _brute(rows)


def test_names_and_types(spark):
    windows = window_counts(normalize(_rows(spark, ["2024-01-01"])))
    assert [(f.name, f.dataType.simpleString()) for f in windows.schema.fields] == [
        ("window_start", "timestamp"), ("window_end", "timestamp"), ("num_of_rows", "bigint"),
        ("num_of_black", "bigint"), ("num_of_white", "bigint"), ("num_of_silver", "bigint"),
        ("maximum_speed", "int"), ("maximum_gear", "int"), ("maximum_rpm", "int"),
    ]


def test_latest_and_latest_closed(spark):
    day = "2024-01-01T10:"
    rows = normalize(_rows(spark, [day + "00:10Z", day + "05:10Z", day + "14:10Z"]))
    windows = window_counts(rows)
    ten = int(datetime(2024, 1, 1, 10, tzinfo=UTC).timestamp())
    (latest,) = _collected(latest_window(windows)).items()
    (closed,) = _collected(latest_closed_window(windows)).items()
    assert (latest[0], latest[1][0]) == ((ten + 14 * 60, ten + 29 * 60), 1)
    assert (closed[0], closed[1][0]) == ((ten, ten + 15 * 60), 3)


@pytest.mark.parametrize("seed", range(4))
def test_latest_closed_equals_its_definition(spark, seed):
    rows = _random_rows(seed, n=3)
    windows = window_counts(normalize(_frame(spark, rows)))
    newest = max(r["time"] for r in rows).replace(second=0) + MINUTE
    wanted = max(w for w in _brute(rows) if w[1] <= newest.timestamp())
    assert list(_collected(latest_closed_window(windows))) == [wanted]


def test_latest_of_nothing_is_nothing(spark):
    windows = window_counts(normalize(_rows(spark, [])))
    assert latest_window(windows).count() == latest_closed_window(windows).count() == 0


def test_malformed_messages_count_at_their_arrival(spark):
    arrived = datetime(2024, 1, 1, tzinfo=UTC)
    messages = spark.createDataFrame(
        [("bad", arrived), ('{"event_time":"garbage","color":"Black","speed":9}', arrived)],
        "value string, timestamp timestamp",
    )
    rows = decode(messages, COUNTER_INPUT, envelope=["timestamp"])
    windows = _collected(window_counts(normalize(rows, fallback="timestamp")))
    assert windows[int(arrived.timestamp()), int(arrived.timestamp()) + 900] == (
        2, 1, 0, 0, 9, None, None,
    )


def test_rows_without_any_time_are_dropped(spark):
    assert normalize(_rows(spark, [None, "garbage", "2024-01-01"])).count() == 1


def test_counted_colors_and_maxima_are_parameters(spark):
    rows = normalize(_rows(spark, ["2024-01-01"], color_name="PINK", speed=7))
    windows = window_counts(rows, counted=("pink",), maxima=("speed",))
    assert set(_collected(windows).values()) == {(1, 1, 7)}


def test_a_hot_minute_reaches_each_reducer_as_one_row_per_task(spark):
    """All rows in one minute: the counts are combined before the shuffle."""
    rows = spark.range(50_000).selectExpr(
        "'2024-01-01T00:00:30Z' event_time", "int(id % 200) speed", "1 gear", "1 rpm",
        "'Black' color", "string(null) color_name",
    )
    windows = window_counts(normalize(rows))
    plan = windows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_count") and plan.count("Exchange hashpartitioning") == 2
    assert set(_collected(windows).values()) == {(50_000, 50_000, 0, 0, 199, 1, 1)}
    assert len(_collected(windows)) == 15
