"""Placements-per-user histogram (R10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilescope.config import CANVAS, Columns
from tilescope.constants import HISTOGRAM_CAP, SHARE_DECIMALS
from tilescope.functions.exprs import bin_label, percentage, share_annotation


def user_counts(df: DataFrame, where: Column | None = None, cols: Columns = CANVAS) -> DataFrame:
    """Placements per user among rows matching ``where`` (partial aggregate per user)."""
    base = df if where is None else df.filter(where)
    return base.groupBy(cols.user).agg(F.count(F.lit(1)).alias("placements"))


def placement_histogram(
    df: DataFrame, where: Column | None = None, cols: Columns = CANVAS, ordered: bool = False
) -> DataFrame:
    """(placements, num_users): how many users placed exactly n times."""
    out = user_counts(df, where, cols).groupBy("placements").agg(F.count(F.lit(1)).alias("num_users"))
    return out.orderBy("placements") if ordered else out


def user_histogram(
    df: DataFrame, where: Column | None = None, cap: int = HISTOGRAM_CAP, cols: Columns = CANVAS
) -> DataFrame:
    """Capped histogram: counts of ``cap`` or more share one bin labelled ``cap+``.

    The share uses a total over at most ``cap`` rows, so its window never
    holds more than ``cap`` rows.  Empty input -> empty result.
    """
    binned = user_counts(df, where, cols).select(F.least(F.col("placements"), F.lit(cap).cast("bigint")).alias("placements_bin"))
    hist = binned.groupBy("placements_bin").agg(F.count(F.lit(1)).alias("num_users"))
    total = F.sum("num_users").over(Window.partitionBy())
    return hist.select(
        "placements_bin",
        bin_label("placements_bin", cap).alias("bin_label"),
        "num_users",
        percentage("num_users", total).alias("percentage"),
        share_annotation("num_users", total, SHARE_DECIMALS).alias("annotation"),
    ).orderBy("placements_bin")
