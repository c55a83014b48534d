"""Answers from kept hourly counts and raw edges equal those from the raw log."""

from datetime import datetime, timedelta

import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from tilescope.functions.ranges import TimeRange, time_range
from tilescope.operators.frequency import frequency, multi_frequency, top_summary
from tilescope.operators.rollup import combine, cut_at_hours, frequency_from, hourly_rollup, multi_frequency_from, top_summary_from, write_rollup
from tilescope.sources.canvas import read_canvas

T = datetime(2024, 1, 10, 5)
RANGES = [
    TimeRange(T, T + timedelta(hours=30)),
    TimeRange(T + timedelta(minutes=1), T + timedelta(hours=30, minutes=7)),
    TimeRange(T + timedelta(microseconds=1), T + timedelta(hours=2) - timedelta(microseconds=1)),
    TimeRange(T + timedelta(minutes=10), T + timedelta(minutes=50)),  # inside an hour
    TimeRange(T + timedelta(minutes=50), T + timedelta(minutes=70)),  # over one hour's end
    TimeRange(T - timedelta(days=400), T + timedelta(days=400)),
]


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    canvas = read_canvas(spark, SF_SMALL)
    edges = [T, T + timedelta(hours=1), T + timedelta(hours=30), T + timedelta(microseconds=1), T + timedelta(hours=30, minutes=7), None]
    extra = spark.createDataFrame([(t, 1, 7, None, None) for t in edges for _ in range(3)], canvas.schema)
    canvas = canvas.unionAll(extra).cache()
    path = write_rollup(hourly_rollup(canvas), str(tmp_path_factory.mktemp("rollup") / "r"))
    return canvas, spark.read.parquet(path)


@pytest.mark.parametrize("bounds", ["both", "left"])
@pytest.mark.parametrize("rng", RANGES)
def test_same_answers(data, rng, bounds):
    canvas, kept = data
    for keys in (["pixel_color"], ["x_coord", "y_coord"]):
        assert rows(frequency_from(canvas, kept, keys, rng, bounds)) == rows(frequency(canvas, keys, rng, bounds))
    assert rows(multi_frequency_from(canvas, kept, rng, bounds)) == rows(multi_frequency(canvas, rng, bounds))
    assert rows(top_summary_from(canvas, kept, rng, bounds)) == rows(top_summary(canvas, rng, bounds))


@pytest.mark.parametrize("bounds", ["both", "left"])
@pytest.mark.parametrize("rng", RANGES)
def test_edges_are_less_than_two_hours_and_miss_nothing(data, rng, bounds):
    canvas, _ = data
    parts = cut_at_hours(rng, bounds)
    assert sum((e.end - e.start for e in parts.edges), timedelta()) < timedelta(hours=2)
    pieces = sorted([*parts.edges, *([parts.whole] if parts.whole else [])], key=lambda p: p.start)
    assert pieces[0].start == rng.start and all(a.end == b.start for a, b in zip(pieces, pieces[1:]))
    assert sum(time_range(canvas, p, "left").count() for p in pieces) == time_range(canvas, rng, bounds).count()


def test_rollups_of_parts_add_up(data):
    canvas, kept = data
    parts = [canvas.filter(F.col("timestamp") < F.lit(T)), canvas.filter(F.col("timestamp") >= F.lit(T))]
    assert rows(combine([hourly_rollup(p) for p in parts])) == rows(kept.drop("day"))


def test_the_rollup_is_pruned_by_day(data):
    canvas, kept = data
    plan = frequency_from(canvas, kept, ["pixel_color"], RANGES[1])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_refused_arguments(data):
    canvas, kept = data
    with pytest.raises(ValueError):
        cut_at_hours(RANGES[0], "text")
    with pytest.raises(ValueError):
        frequency_from(canvas, kept, ["user_id_encoded"], RANGES[0])
    empty = canvas.limit(0)
    assert rows(frequency_from(empty, hourly_rollup(empty), ["pixel_color"], RANGES[0])) == []
