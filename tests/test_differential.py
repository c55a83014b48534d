"""Differential checks from the survey's test strategy, on the driver's table."""

from conftest import SF_ORACLE, rows
from pyspark.sql import functions as F

from tilescope.functions.exprs import percentage
from tilescope.functions.ranges import TimeRange, time_range
from tilescope.operators.share import category_share_at
from tilescope.sources.canvas import read_canvas
from tilescope.sources.raw import raw_from_canvas

RANGES = [
    TimeRange.parse("2024-01-02 14", "2024-01-02 15"),
    TimeRange.parse("2024-01-03 02", "2024-01-03 05"),
    TimeRange.parse("2024-01-04 10", "2024-01-04 16"),
    TimeRange.parse("2024-01-01 00", "2024-01-31 00"),
]


def test_text_range_equals_typed_range_on_six_digit_text(spark):
    canvas = read_canvas(spark, SF_ORACLE)
    raw = raw_from_canvas(canvas)
    for rng in RANGES:
        typed = rows(raw_from_canvas(time_range(canvas, rng, "both")))
        assert rows(time_range(raw, rng, "text")) == typed


def test_one_scan_share_equals_two_scan_cross_join(spark):
    canvas = read_canvas(spark, SF_ORACLE)
    for value, x, y in [("Click", 704, 0), ("view", 900, 0), ("nothing", 704, 0), ("error", 7, 7)]:
        hit = F.lower(F.col("pixel_color")) == F.lower(F.lit(value))
        overall = canvas.agg(F.count_if(hit).alias("co"), F.count(F.lit(1)).alias("t"))
        at = canvas.filter((F.col("x_coord") == x) & (F.col("y_coord") == y)).agg(
            F.count_if(hit).alias("cl"), F.count(F.lit(1)).alias("tl")
        )
        literal = overall.crossJoin(at).select(
            "co", "t", percentage("co", "t").alias("op"), "cl", "tl", percentage("cl", "tl", 0.0).alias("lp")
        )
        one = category_share_at(canvas, value, x, y).select(
            "color_placements_overall", "total_placements_overall", "overall_percentage",
            "color_placements_at_location", "total_placements_at_location", "location_percentage",
        )
        assert rows(one) == rows(literal)
