"""Operators run on any log with the five roles, whatever the column names."""

from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from tilescope.config import Columns
from tilescope.functions.ranges import TimeRange
from tilescope.operators import blocks, frequency, histogram, points, series, sessions, share
from tilescope.sources.canvas import read_canvas

OTHER = Columns(time="ts", user="uid", category="color", x="px", y="py")
RNG = TimeRange.parse("2024-01-05 00", "2024-01-20 00")


def renamed(spark):
    c = read_canvas(spark, SF_SMALL)
    return c, c.select(
        F.col("timestamp").alias("ts"),
        F.col("user_id_encoded").alias("uid"),
        F.col("pixel_color").alias("color"),
        F.col("x_coord").alias("px"),
        F.col("y_coord").alias("py"),
    )


def test_same_results_under_other_names(spark):
    base, other = renamed(spark)
    pts = [(704, 0), (1603, 30), (3, 30)]
    pairs = [
        (frequency.top_summary(base, RNG), frequency.top_summary(other, RNG, cols=OTHER)),
        (frequency.multi_frequency(base, RNG).drop("pixel_color", "x_coord", "y_coord"),
         frequency.multi_frequency(other, RNG, cols=OTHER).drop("color", "px", "py")),
        (share.category_share_at(base, "Click", 704, 0).drop("x_coord", "y_coord"),
         share.category_share_at(other, "Click", 704, 0, cols=OTHER).drop("px", "py")),
        (points.top_categories_at(base, pts).drop("x_coord", "y_coord", "pixel_color"),
         points.top_categories_at(other, pts, cols=OTHER).drop("px", "py", "color")),
        (series.hourly_series(base, pts), series.hourly_series(other, pts, cols=OTHER)),
        (histogram.user_histogram(base, F.col("x_coord") < 100), histogram.user_histogram(other, F.col("px") < 100, cols=OTHER)),
        (blocks.block_intensity(base), blocks.block_intensity(other, cols=OTHER)),
        (blocks.top_blocks(base), blocks.top_blocks(other, cols=OTHER)),
        (sessions.sessions(base).drop("user_id_encoded"), sessions.sessions(other, cols=OTHER).drop("uid")),
        (sessions.event_gaps(base).drop("user_id_encoded", "timestamp"),
         sessions.event_gaps(other, cols=OTHER).drop("uid", "ts")),
    ]
    for a, b in pairs:
        assert rows(a) == rows(b)
