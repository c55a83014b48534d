"""A user holding half of all rows: results stay exact and work stays split."""

from datetime import timedelta

import pytest
from conftest import SF_ORACLE, rows
from plain_forms import sessions_by_lag
from pyspark.sql import Window
from pyspark.sql import functions as F

from tilescope.operators.blocks import block_unique_users
from tilescope.operators.sessions import event_gaps, gap_slices, session_buckets, sessions
from tilescope.sources.canvas import read_canvas

HOT = -1


@pytest.fixture(scope="module")
def skewed(spark):
    canvas = read_canvas(spark, SF_ORACLE)
    return canvas.unionByName(canvas.withColumn("user_id_encoded", F.lit(HOT).cast("bigint")))


def test_hot_user_sessions_exact(skewed):
    assert rows(sessions(skewed)) == rows(sessions_by_lag(skewed))


def test_hot_user_reaches_merge_as_bucket_summaries(skewed):
    gap = timedelta(minutes=15)
    hot_rows = skewed.filter(F.col("user_id_encoded") == HOT).count()
    hot_buckets = session_buckets(skewed, gap).filter(F.col("user_id_encoded") == HOT).count()
    span = 30 * 24 * 3600  # the events table covers 30 days
    assert hot_rows == 10_000
    assert hot_buckets <= span // int(gap.total_seconds()) + 1
    assert hot_buckets < hot_rows


@pytest.mark.parametrize("rows_per_slice", [None, 4, 1000])
def test_hot_user_gaps_exact_and_split(skewed, rows_per_slice):
    w = Window.partitionBy("user_id_encoded").orderBy("timestamp")
    plain = skewed.select("user_id_encoded", "timestamp", F.lag("timestamp").over(w).alias("p"))
    got = event_gaps(skewed, rows_per_slice=rows_per_slice).select("user_id_encoded", "timestamp", "prev_timestamp")
    # equal multisets of (user, time, previous time)
    assert rows(got) == rows(plain)
    sizes = [r[0] for r in gap_slices(skewed, rows_per_slice).filter(F.col("user_id_encoded") == HOT).select("rows").collect()]
    assert sum(sizes) == 10_000
    if rows_per_slice is None:
        assert len(sizes) == 1
    else:
        assert max(sizes) < 15 * rows_per_slice and len(sizes) > 10_000 / rows_per_slice / 4


def test_hot_block_distinct_users(skewed):
    got = rows(block_unique_users(skewed))
    exact = rows(
        skewed.groupBy(
            F.floor(F.col("x_coord") / 100).cast("int").alias("block_x"),
            F.floor(F.col("y_coord") / 100).cast("int").alias("block_y"),
        ).agg(F.count(F.lit(1)).alias("placements"), F.countDistinct("user_id_encoded").alias("unique_users"))
    )
    assert got == exact


def test_a_burst_of_one_user_is_split_and_ties_stay_together(spark, canvas):
    data = [(f"2022-04-02 10:30:{s:02d}", 1, 0, 0, "a") for s in range(60)] * 3
    data += [(f"2022-04-02 10:{m:02d}:00", 1, 0, 0, "a") for m in (0, 5, 10, 15, 20, 40, 45, 50, 55, 59)]
    df = canvas(data)
    sizes = [r[0] for r in gap_slices(df, rows_per_slice=8).select("rows").collect()]
    assert sum(sizes) == 190 and len(sizes) >= 4 and max(sizes) < 120
    w = Window.partitionBy("user_id_encoded").orderBy("timestamp")
    plain = df.select("user_id_encoded", "timestamp", F.lag("timestamp").over(w).alias("p"))
    assert rows(event_gaps(df, rows_per_slice=8).select("user_id_encoded", "timestamp", "prev_timestamp")) == rows(plain)
