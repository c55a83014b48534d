"""Sessions and gaps: F2 gap edges, F3 range edges, chunking equals the plain form."""

from datetime import timedelta

import pytest
from conftest import SF_ORACLE, rows
from plain_forms import sessions_by_lag, sessions_by_window

from tilescope.functions.ranges import TimeRange
from tilescope.operators.sessions import SPANS, event_gaps, merge_fragments, session_buckets, session_stats, sessions
from tilescope.sources.canvas import read_canvas
from pyspark.sql import Window, functions as F

F2 = [
    # user 1: 14:59.999999 gap (same session), then 15:00 exactly (same), then 15:00.000001 (new)
    ("2022-04-02 10:00:00", 1, 0, 0, "a"),
    ("2022-04-02 10:14:59.999999", 1, 0, 0, "a"),
    ("2022-04-02 10:29:59.999999", 1, 0, 0, "a"),
    ("2022-04-02 10:45:00.000000", 1, 0, 0, "a"),
    ("2022-04-02 11:00:00.000000", 1, 0, 0, "a"),
    # user 2: single event
    ("2022-04-02 10:00:00", 2, 0, 0, "a"),
    # user 3: repeated timestamp only -> zero length, dropped
    ("2022-04-02 10:00:00", 3, 0, 0, "a"),
    ("2022-04-02 10:00:00", 3, 0, 0, "a"),
    # NULL user: never a session
    ("2022-04-02 10:00:00", None, 0, 0, "a"),
    ("2022-04-02 10:05:00", None, 0, 0, "a"),
]


def test_gap_edges(canvas):
    got = rows(sessions(canvas(F2)).select("user_id_encoded", "events", "length_us"))
    # 10:00 -> 10:14:59.999999 -> 10:29:59.999999 (gap 15:00.000000 exactly, merges)
    # -> 10:45:00.000000 (gap 15:00.000001, splits) -> 11:00:00 (gap 15:00, merges)
    assert got == [(1, 2, 900_000_000), (1, 3, 1_799_999_999)]


def test_zero_length_kept_on_request(canvas):
    got = rows(sessions(canvas(F2), keep_zero_length=True).select("user_id_encoded", "events", "length_us"))
    assert (2, 1, 0) in got and (3, 2, 0) in got


def test_range_clips_sessions(canvas):
    rng = TimeRange.parse("2022-04-02 10", "2022-04-02 11")  # half-open: drops 11:00:00
    got = rows(sessions(canvas(F2), rng=rng).select("user_id_encoded", "events", "length_us"))
    # 11:00:00 falls outside, so the second session keeps one event and is dropped
    assert got == [(1, 3, 1_799_999_999)]


def test_session_spanning_many_buckets(canvas):
    data = [(f"2022-04-02 {h:02d}:{m:02d}:00", 7, 0, 0, "a") for h in range(9, 13) for m in range(0, 60, 10)]
    got = rows(sessions(canvas(data)).select("events", "length_us"))
    assert got == [(24, (3 * 60 + 50) * 60 * 1_000_000)]


def test_stats(canvas):
    got = rows(session_stats(sessions(canvas(F2))))
    assert got == [(2, (900_000_000 + 1_799_999_999) / 2 / 1e6)]
    empty = rows(session_stats(sessions(canvas(F2[5:6]))))
    assert empty == [(0, None)]


@pytest.mark.parametrize("minutes", [1, 15, 90])
def test_bucketed_sessions_equal_plain_sessions(spark, minutes):
    df = read_canvas(spark, SF_ORACLE)
    gap = timedelta(minutes=minutes)
    a = rows(sessions(df, gap=gap))
    assert a == rows(sessions_by_lag(df, gap=gap))
    assert a == rows(sessions_by_window(df, gap=gap))
    if minutes == 15:
        assert len(a) == 222


def test_sessions_preaggregate_before_shuffle(spark):
    df = read_canvas(spark, SF_ORACLE)
    plan = sessions(df)._jdf.queryExecution().executedPlan().toString()
    first_exchange = plan.rfind("Exchange hashpartitioning")
    assert "partial_min" in plan[first_exchange:]
    assert "MergingSessions" not in plan


def test_gaps_equal_plain_lag(spark):
    df = read_canvas(spark, SF_ORACLE)
    w = Window.partitionBy("user_id_encoded").orderBy("timestamp")
    plain = df.select("user_id_encoded", "timestamp", F.lag("timestamp").over(w).alias("p"))
    expected = rows(plain)
    for size in (None, 1, 3, 1000):
        got = rows(event_gaps(df, rows_per_slice=size).select("user_id_encoded", "timestamp", "prev_timestamp"))
        assert got == expected


def test_gaps_move_the_rows_once(spark):
    df = read_canvas(spark, SF_ORACLE)
    plan = event_gaps(df, rows_per_slice=20)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan") == 1


def test_gap_seconds(canvas):
    got = rows(event_gaps(canvas(F2[:3])).select("gap_seconds"))
    assert got == sorted([(None,), (899.999999,), (900.0,)], key=repr)


def test_custom_gap(canvas):
    got = rows(sessions(canvas(F2), gap=timedelta(hours=2)).select("user_id_encoded", "events"))
    assert got == [(1, 5)]


def test_wall_clock_under_dst_session_zone(spark, canvas):
    """Gaps and hours are wall-clock arithmetic on timestamp_ntz, whatever the session zone."""
    data = [
        ("2022-03-13 01:30:00", 1, 0, 0, "a"),  # New York skips 02:00-03:00 this night
        ("2022-03-13 03:30:00.5", 1, 0, 0, "a"),
        ("2022-11-06 01:30:00", 2, 0, 0, "a"),  # and repeats 01:00-02:00 this night
        ("2022-11-06 01:40:00", 2, 0, 0, "a"),
    ]
    from tilescope.functions.exprs import hour_of

    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = canvas(data)
        gaps = sorted(r[0] for r in event_gaps(df).select("gap_seconds").collect() if r[0] is not None)
        hours = sorted(r[0].hour for r in df.select(hour_of("timestamp")).collect())
        sess = rows(sessions(df).select("user_id_encoded", "length_us"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert gaps == [600.0, 7200.5]
    assert hours == [1, 1, 1, 3]
    assert sess == [(2, 600_000_000)]


def test_a_user_without_pause_is_spread_by_day(spark):
    """An event each minute for two years: one fragment a day is left for the last step."""
    minutes = 2 * 365 * 24 * 60
    df = spark.range(minutes).select(
        F.expr("timestamp_ntz'2020-01-01 00:00:30' + make_interval(0, 0, 0, 0, 0, id, 0)").alias("timestamp"), F.lit(1).cast("long").alias("user_id_encoded")
    )
    df = df.unionAll(df.limit(40).withColumn("user_id_encoded", F.lit(2).cast("long")))
    got = rows(sessions(df).select("user_id_encoded", "events", "length_us"))
    assert got == [(1, minutes, (minutes - 1) * 60_000_000), (2, 40, 39 * 60_000_000)]
    day = F.date_trunc("day", "_s")
    buckets = session_buckets(df).select("user_id_encoded", "_s", "_e", "_n", day.alias("_day"))
    assert merge_fragments(buckets, ["user_id_encoded", "_day"], 900_000_000).count() == 730 + 1
    assert SPANS[0] == 96


@pytest.mark.parametrize("minutes", [7, 15])
def test_fragments_meet_at_every_edge(spark, minutes):
    """Sessions that end and start around midnight, at 64 days, and before 1970."""
    gap = timedelta(minutes=minutes)
    times = []
    for start in ("1969-12-30", "1970-03-05", "2024-01-31", "2024-02-01"):
        for offset in (-1800.0, -900.000001, -900.0, -420.0, -0.000001, 0.0, 0.000001, 419.999999, 420.0, 900.0, 900.000001, 86399.0):
            times.append((start, offset))
    df = spark.createDataFrame(times, "day string, offset double").select(
        (F.col("day").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("offset").cast("decimal(18,6)"))).alias("timestamp"),
        F.explode(F.expr("array(1L, 2L)")).alias("user_id_encoded"),
    )
    df = df.filter("user_id_encoded = 1 or hash(timestamp) % 2 = 0")
    assert rows(sessions(df, gap=gap)) == rows(sessions_by_lag(df, gap=gap))
