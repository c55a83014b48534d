"""The hourly and session operators over a Structured Streaming source.

Same semantics as the batch operators for data that arrives in order; rows
later than the watermark are dropped by Spark, and state for closed hours /
sessions is evicted, so memory stays bounded on an unbounded stream.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilescope.config import CANVAS, Columns
from tilescope.functions.exprs import instant_of, micros_between, wall_clock
from tilescope.operators.sessions import DEFAULT_GAP


def _event_time(stream: DataFrame, cols: Columns) -> DataFrame:
    # Watermarks and event-time windows need a zoned timestamp column; it is taken as UTC.
    return stream.withColumn("_event_time", instant_of(cols.time))


def hourly_counts_stream(stream: DataFrame, watermark: str, cols: Columns = CANVAS) -> DataFrame:
    """Placements per (hour, x, y), emitted once an hour is past the watermark."""
    timed = _event_time(stream, cols).withWatermark("_event_time", watermark)
    agg = timed.groupBy(F.window("_event_time", "1 hour"), cols.x, cols.y).agg(
        F.count(F.lit(1)).alias("placement_count")
    )
    return agg.select(
        wall_clock("window.start").alias("hour"), cols.x, cols.y, "placement_count"
    )


def sessions_stream(
    stream: DataFrame, watermark: str, gap: timedelta = DEFAULT_GAP, cols: Columns = CANVAS
) -> DataFrame:
    """Inactivity sessions per user; a session is emitted when it closes."""
    gap_us = int(round(gap.total_seconds() * 1_000_000))
    timed = _event_time(stream.filter(F.col(cols.user).isNotNull()), cols).withWatermark("_event_time", watermark)
    agg = timed.groupBy(cols.user, F.session_window("_event_time", f"{gap_us} microseconds")).agg(
        F.min(cols.time).alias("session_start"), F.max(cols.time).alias("session_end"), F.count(F.lit(1)).alias("events")
    )
    out = agg.select(
        cols.user, "session_start", "session_end", "events",
        micros_between("session_start", "session_end").cast("bigint").alias("length_us"),
    )
    return out.filter(F.col("length_us") > 0)
