from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from orderloom.operators import series as s
from orderloom.sources.events import event_times

START = datetime(2024, 1, 1)


def expected_points(times):
    times = sorted(times)
    return [(times[0], 0)] + [(t, i + 1) for i, t in enumerate(times)]


def expected_sample(points, most):
    if len(points) <= most:
        return points
    stride = len(points) / most
    return [points[int(i * stride)] for i in range(most)] + [points[-1]]


def frame(spark, times, kind="timestamp_ntz"):
    return spark.createDataFrame([(t,) for t in times], f"event_time {kind}")


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    offsets=st.lists(st.integers(0, 20_000), min_size=1, max_size=400),
    unit=st.sampled_from([1, 1_000, 1_000_000, 60_000_000]),
    most=st.sampled_from([1, 7, 200]),
)
def test_series_and_sample_match_counting(spark, offsets, unit, most):
    times = [START + timedelta(microseconds=o * unit) for o in offsets]
    points = expected_points(times)
    events = frame(spark, times)
    assert rows(s.cumulative_events(events)) == sorted(points, key=repr)
    assert rows(s.downsample(s.cumulative_totals(events), most)) == sorted(expected_sample(points, most), key=repr)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_both_timestamp_types(spark, kind):
    times = [START, START, START + timedelta(days=400, microseconds=5)]
    assert rows(s.cumulative_events(frame(spark, times, kind))) == sorted(expected_points(times), key=repr)


def test_one_time_holding_everything(spark, monkeypatch):
    monkeypatch.setattr(s, "_CHUNK", 100)
    events = spark.range(1050).select(F.lit(START).cast("timestamp_ntz").alias("event_time"))
    out = s.cumulative_events(events)
    assert out.agg(F.count("*"), F.min("total"), F.max("total"), F.countDistinct("total")).first()[:] == (1051, 0, 1050, 1051)


def test_missing_times_are_dropped(spark):
    records = spark.createDataFrame(
        [("2024-01-01T00:00:05Z",), (None,), ("",), ("2024-01-01T00:00:04Z",)], "starred_at string"
    )
    found = event_times(records, "starred_at")
    assert rows(found) == [(START + timedelta(seconds=4),), (START + timedelta(seconds=5),)]


def test_malformed_time_raises(spark):
    with pytest.raises(Exception):
        event_times(spark.createDataFrame([("yesterday",)], "starred_at string"), "starred_at").collect()
