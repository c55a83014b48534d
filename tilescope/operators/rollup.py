"""Kept partial counts by hour, and range answers that merge them with raw edge rows (AGG4).

A rollup has one row for each (hour, category) and each (hour, x, y) with its number of
events: the partial result of a count, kept on disk.  Counts are additive, so rollups of
parts of a log (a day's new file, say) are combined by summing, and a range is answered
from its whole hours in the rollup plus the raw rows before the first and after the last
of them: less than two hours of raw rows, whatever the length of the range.

Columns: hour (timestamp_ntz), grouping_set (``category`` or ``point``), the key columns
(NULL where the set does not have them; NULL keys are groups of their own), n.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilescope.config import CANVAS, Columns
from tilescope.functions.exprs import hour_of
from tilescope.functions.ranges import TimeRange, time_range
from tilescope.operators.frequency import summary_of
from tilescope.sources.sinks import export_parquet

HOUR = timedelta(hours=1)
ROLLUP_ROWS_PER_FILE = 5_000_000


def hourly_rollup(df: DataFrame, cols: Columns = CANVAS) -> DataFrame:
    """Counts by (hour, category) and by (hour, x, y), from one scan, combined map-side.

    Events without a time belong to no range and are left out.
    """
    base = df.filter(F.col(cols.time).isNotNull()).select(hour_of(cols.time).alias("hour"), cols.category, cols.x, cols.y)
    keys = ["hour", cols.category, cols.x, cols.y]
    agg = base.groupingSets([keys[:2], [keys[0], *keys[2:]]], *keys).agg(F.count(F.lit(1)).alias("n"), F.grouping(cols.category).alias("_g"))
    return agg.select("hour", F.when(F.col("_g") == 0, "category").otherwise("point").alias("grouping_set"), *keys[1:], "n")


def combine(rollups: Sequence[DataFrame]) -> DataFrame:
    """One rollup of several, which must be of parts of the log without common events."""
    both = reduce(DataFrame.unionByName, rollups)
    return both.groupBy([c for c in both.columns if c != "n"]).agg(F.sum("n").alias("n"))


def write_rollup(rollup: DataFrame, path: str, mode: str = "error") -> str:
    """Keep a rollup as day directories whose files follow each other by hour."""
    return export_parquet(rollup, path, time_col="hour", rows_per_file=ROLLUP_ROWS_PER_FILE, mode=mode)


@dataclass(frozen=True)
class Parts:
    """A range cut at hours: ``whole`` from the rollup, ``edges`` (half-open) from the raw log."""

    whole: TimeRange | None
    edges: tuple[TimeRange, ...]


def cut_at_hours(rng: TimeRange, bounds: str = "both") -> Parts:
    """The whole hours of a typed range and what is left before and after them."""
    if bounds not in ("both", "left"):
        raise ValueError(f"bounds must be 'both' or 'left', got {bounds!r}")
    end = rng.end + timedelta(microseconds=1) if bounds == "both" else rng.end  # from here on half-open
    floor = lambda t: datetime(t.year, t.month, t.day, t.hour)
    first, last = floor(rng.start), floor(end)
    first += HOUR if first < rng.start else timedelta(0)
    if first >= last:
        return Parts(None, (TimeRange(rng.start, end),))
    edges = [TimeRange(a, b) for a, b in ((rng.start, first), (last, end)) if a < b]
    return Parts(TimeRange(first, last), tuple(edges))


def _sets(df: DataFrame, cols: Columns) -> DataFrame:
    """Raw rows as uncombined rollup rows: one of each grouping set."""
    none = lambda c: F.lit(None).cast(df.schema[c].dataType).alias(c)
    category = F.struct(F.lit("category").alias("grouping_set"), F.col(cols.category).alias(cols.category), none(cols.x), none(cols.y))
    point = F.struct(F.lit("point").alias("grouping_set"), none(cols.category), F.col(cols.x).alias(cols.x), F.col(cols.y).alias(cols.y))
    return df.select(F.explode(F.array(category, point)).alias("_s")).select("_s.*", F.lit(1).cast("bigint").alias("n"))


def multi_frequency_from(df: DataFrame, rollup: DataFrame, rng: TimeRange, bounds: str = "both", cols: Columns = CANVAS, count: str = "count") -> DataFrame:
    """As :func:`tilescope.operators.frequency.multi_frequency`, from the rollup and the edges."""
    parts = cut_at_hours(rng, bounds)
    keys = ["grouping_set", cols.category, cols.x, cols.y]
    found = [_sets(time_range(df, edge, "left", cols.time), cols) for edge in parts.edges]
    if parts.whole:
        found.append(time_range(rollup, parts.whole, "left", "hour").select(*keys, "n"))
    return reduce(DataFrame.unionByName, found).groupBy(*keys).agg(F.sum("n").alias(count))


def frequency_from(
    df: DataFrame, rollup: DataFrame, keys: Sequence[str], rng: TimeRange, bounds: str = "both", cols: Columns = CANVAS, count: str = "count"
) -> DataFrame:
    """As :func:`tilescope.operators.frequency.frequency` for the category or the point."""
    wanted = {(cols.category,): "category", (cols.x, cols.y): "point"}
    if tuple(keys) not in wanted:
        raise ValueError(f"a rollup counts {sorted(wanted)}, not {tuple(keys)}")
    parts = cut_at_hours(rng, bounds)
    one = F.lit(1).cast("bigint").alias("n")
    found = [time_range(df, edge, "left", cols.time).select(*keys, one) for edge in parts.edges]
    if parts.whole:
        rows = rollup.filter(F.col("grouping_set") == wanted[tuple(keys)])
        found.append(time_range(rows, parts.whole, "left", "hour").select(*keys, "n"))
    return reduce(DataFrame.unionByName, found).groupBy(*keys).agg(F.sum("n").alias(count))


def top_summary_from(df: DataFrame, rollup: DataFrame, rng: TimeRange, bounds: str = "both", cols: Columns = CANVAS) -> DataFrame:
    """As :func:`tilescope.operators.frequency.top_summary`, from the rollup and the edges."""
    return summary_of(multi_frequency_from(df, rollup, rng, bounds, cols, count="n"), cols)
