"""Hourly placement series at listed points (R9): counts, dense grid, wide, long."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tilescope.config import CANVAS, Columns, materialize
from tilescope.functions.exprs import hour_of, point_label
from tilescope.functions.ranges import TimeRange, time_range
from tilescope.operators.points import Points, at_points


def hourly_counts(
    df: DataFrame,
    points: Points | DataFrame | None = None,
    rng: TimeRange | None = None,
    bound: int | None = None,
    cols: Columns = CANVAS,
    ordered: bool = False,
) -> DataFrame:
    """Placements per (hour, x, y); ``hour`` stays ``timestamp_ntz``;
    ``ordered`` sorts by hour (then point)."""
    base = time_range(df, rng, "both", cols.time)
    if points is not None:
        base = at_points(base, points, bound, cols)
    out = base.groupBy(hour_of(cols.time).alias("hour"), cols.x, cols.y).agg(
        F.count(F.lit(1)).alias("placement_count")
    )
    return out.orderBy("hour", cols.x, cols.y) if ordered else out


def hourly_series(
    df: DataFrame,
    points: Points | DataFrame | None = None,
    rng: TimeRange | None = None,
    bound: int | None = None,
    cols: Columns = CANVAS,
) -> DataFrame:
    """Gap-free series: every hour from the first to the last observed hour, for
    every point that has at least one row, 0 where nothing was placed.

    The hourly counts (points x active hours, a small aggregate) are
    checkpointed once, so the base table is scanned once although the
    calendar bounds (scalar subqueries) and the series both read them.  Each
    counted hour of a point then generates itself and the empty hours up to the
    point's next one (the first also those before it), so no grid is made and
    nothing is joined.
    """
    counts = materialize(hourly_counts(df, points, rng, bound, cols))
    lo = counts.select(F.min("hour")).scalar()
    hi = counts.select(F.max("hour")).scalar()
    hour = F.expr("INTERVAL 1 HOUR")
    w = Window.partitionBy(cols.x, cols.y).orderBy(F.col("hour").asc_nulls_first())
    # a row without an hour is not counted in any, but its point is one of the series
    start = F.when(F.row_number().over(w) == 1, lo).otherwise(F.col("hour"))
    stop = F.coalesce(F.lead("hour").over(w) - hour, hi)
    spans = counts.select(cols.x, cols.y, F.col("hour").alias("_at"), "placement_count", start.alias("_start"), stop.alias("_stop"))
    hours = F.when(F.col("_stop") >= F.col("_start"), F.sequence("_start", "_stop", hour))
    dense = spans.select(cols.x, cols.y, "_at", "placement_count", F.explode(hours).alias("hour"))
    return dense.select(
        F.col("hour").cast("timestamp_ntz").alias("hour"),
        point_label(cols.x, cols.y).alias("pixel"),
        F.when(F.col("hour") == F.col("_at"), F.col("placement_count")).otherwise(F.lit(0)).cast("bigint").alias("placement_count"),
    )


def point_labels(points) -> list[str]:
    return [f"({int(x)}, {int(y)})" for x, y in points]


def hourly_wide(series: DataFrame, labels: Sequence[str] | None = None, ordered: bool = True) -> DataFrame:
    """One row per hour, one column per point label (missing -> 0).

    With ``labels`` (e.g. :func:`point_labels` of the listed points) the
    schema is fixed up front and no extra job runs; a listed point without
    rows is then a column of zeros.  Without labels the columns are the
    points present in the data (one extra pass to find them).  ``ordered``
    sorts the rows by hour.
    """
    pivoted = series.groupBy("hour").pivot("pixel", list(labels) if labels is not None else None)
    wide = pivoted.agg(F.first("placement_count"))
    value_cols = [c for c in wide.columns if c != "hour"]
    wide = wide.fillna(0, subset=value_cols)
    return wide.orderBy("hour") if ordered else wide


def hourly_melt(wide: DataFrame) -> DataFrame:
    """Wide hourly table back to (hour, pixel, placement_count)."""
    value_cols = [c for c in wide.columns if c != "hour"]
    return wide.unpivot(["hour"], value_cols, "pixel", "placement_count")


def hourly_map(series: DataFrame) -> DataFrame:
    """The wide form without a column a point: one row per hour with ``counts``, a map from
    point label to placements, keys in order.

    The points need not be known or few: nothing goes to the driver, and no pivot limit
    holds.  A row is as wide as the wide form's; it is put together by the hour's own task.
    """
    entries = F.sort_array(F.collect_list(F.struct("pixel", "placement_count")))
    return series.groupBy("hour").agg(F.map_from_entries(entries).alias("counts"))


def hourly_unmap(wide: DataFrame) -> DataFrame:
    """:func:`hourly_map` back to (hour, pixel, placement_count)."""
    return wide.select("hour", F.explode("counts").alias("pixel", "placement_count"))
