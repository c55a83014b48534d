"""Category share overall and at one point (R5, R6): one scan, one job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilescope.config import CANVAS, Columns
from tilescope.functions.exprs import percentage
from tilescope.functions.ranges import TimeRange, time_range


def _matches(cols: Columns, value: str):
    return F.lower(F.col(cols.category)) == F.lower(F.lit(value))


def category_share(
    df: DataFrame,
    value: str,
    rng: TimeRange | None = None,
    on_empty: float | None = None,
    cols: Columns = CANVAS,
) -> DataFrame:
    """Share of ``value`` (case-insensitive) among all rows.

    A value that matches nothing gives 0 and 0.0 %; only an empty input gives
    a NULL percentage (or ``on_empty``).
    """
    agg = time_range(df, rng, "both", cols.time).agg(
        F.count_if(_matches(cols, value)).alias("color_placements"),
        F.count(F.lit(1)).alias("total_placements"),
    )
    return agg.select(
        F.lit(value).alias("color"),
        "color_placements",
        "total_placements",
        percentage("color_placements", "total_placements", on_empty).alias("percentage"),
    )


def category_share_at(
    df: DataFrame,
    value: str,
    x: int,
    y: int,
    rng: TimeRange | None = None,
    cols: Columns = CANVAS,
) -> DataFrame:
    """Overall share and share at point (x, y), from a single conditional aggregate.

    The overall percentage is NULL on an empty input; the location percentage
    is 0.0 when the point has no rows.
    """
    hit = _matches(cols, value)
    at = (F.col(cols.x) == F.lit(x)) & (F.col(cols.y) == F.lit(y))
    agg = time_range(df, rng, "both", cols.time).agg(
        F.count_if(hit).alias("color_placements_overall"),
        F.count(F.lit(1)).alias("total_placements_overall"),
        F.count_if(at & hit).alias("color_placements_at_location"),
        F.count_if(at).alias("total_placements_at_location"),
    )
    return agg.select(
        F.lit(value).alias("color"),
        F.lit(x).alias(cols.x),
        F.lit(y).alias(cols.y),
        "color_placements_overall",
        "total_placements_overall",
        percentage("color_placements_overall", "total_placements_overall").alias("overall_percentage"),
        "color_placements_at_location",
        "total_placements_at_location",
        percentage("color_placements_at_location", "total_placements_at_location", on_empty=0.0).alias(
            "location_percentage"
        ),
    )
