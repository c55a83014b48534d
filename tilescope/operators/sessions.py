"""Per-user gaps and inactivity sessions (R4), split so no user fills one task.

A single user may own a large share of all rows, so neither operator ever
sends all rows of one user to one task.

Sessions: any two events of a user that fall into the same ``gap``-wide time
bucket are less than ``gap`` apart, so they always share a session.  Rows are
therefore first reduced to one (min, max, count) fragment per (user, bucket) with a
plain hash aggregate, which combines map-side before the shuffle.  Fragments are
merged by (user, day); only those within ``gap`` of their day's edges can belong to a
longer session, and go on to be merged by longer spans and at last by user.  So a
user's work is spread over tasks by day, and the last step sees at most one fragment
for each span of a user who never pauses.

Gaps: every event needs its predecessor, so rows cannot be reduced.  One event in
``rows_per_slice``, chosen by a hash of user and time, ends a slice of its user's
events.  A first scan finds these few events; a second moves every row once, to its
(user, slice), where ``lag`` runs.  The event before a slice is the one that ended the
slice before it, so nothing has to be carried over by another pass.
"""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilescope.config import CANVAS, Columns, broadcast_if_bounded, materialize
from tilescope.constants import SESSION_GAP
from tilescope.functions.exprs import micros_between, seconds_between
from tilescope.functions.ranges import TimeRange, time_range

DEFAULT_GAP = SESSION_GAP


def _micros(gap: timedelta) -> int:
    us = int(round(gap.total_seconds() * 1_000_000))
    if us <= 0:
        raise ValueError("gap must be positive")
    return us


def _epoch_micros(ts: str) -> Column:
    return micros_between(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(ts))


ROWS_PER_SLICE = 1_000_000


def _sliced(df: DataFrame, rows_per_slice: int | None, cols: Columns) -> DataFrame:
    """User and time of each event, its ``_slice``, and the event that ended the slice before it (``_before``).

    Slices end at events whose hash is 0 modulo ``rows_per_slice``, so their sizes are
    those of a geometric distribution with that mean, whatever the shape of a burst;
    all events of one microsecond of one user share a slice.  All ends together are about
    rows / rows_per_slice entries, broadcast under that bound if they are few.
    """
    base = df.filter(F.col(cols.user).isNotNull() & F.col(cols.time).isNotNull()).select(cols.user, cols.time)
    whole = base.select(cols.user, cols.time, F.lit(0).alias("_slice"), F.lit(None).cast("timestamp_ntz").alias("_before"))
    if rows_per_slice is None:
        return whole
    chosen = F.pmod(F.xxhash64(cols.user, _epoch_micros(cols.time)), F.lit(int(rows_per_slice))) == 0
    ends = base.filter(chosen).groupBy(cols.user).agg(F.array_sort(F.collect_set(cols.time)).alias("_ends"))
    ends = materialize(ends)
    users = ends.count()
    if users == 0:
        return whole
    t = F.col(cols.time)
    joined = base.join(broadcast_if_bounded(ends, users), cols.user, "left")
    number = F.when(F.col("_ends").isNull(), 0).otherwise(F.size(F.filter("_ends", lambda e: e < t)))
    joined = joined.withColumn("_slice", number)
    return joined.select(cols.user, cols.time, "_slice", F.when(F.col("_slice") > 0, F.get("_ends", F.col("_slice") - 1)).alias("_before"))


def gap_slices(df: DataFrame, rows_per_slice: int | None = ROWS_PER_SLICE, cols: Columns = CANVAS) -> DataFrame:
    """Rows per (user, slice): the task sizes of :func:`event_gaps`."""
    return _sliced(df, rows_per_slice, cols).groupBy(cols.user, "_slice").agg(F.count(F.lit(1)).alias("rows"))


def event_gaps(df: DataFrame, rows_per_slice: int | None = ROWS_PER_SLICE, cols: Columns = CANVAS) -> DataFrame:
    """Each event with its user's previous event time and the gap in seconds.

    Two scans, one shuffle of the rows by (user, slice), one sort.  Rows with a NULL user
    or time are skipped.  ``rows_per_slice=None`` leaves users whole and scans once.
    """
    w = Window.partitionBy(cols.user, "_slice").orderBy(cols.time)
    prev = F.coalesce(F.lag(cols.time).over(w), F.col("_before"))
    found = _sliced(df, rows_per_slice, cols).select(cols.user, cols.time, prev.alias("prev_timestamp"))
    return found.select("*", seconds_between("prev_timestamp", F.col(cols.time)).alias("gap_seconds"))


def session_buckets(df: DataFrame, gap: timedelta = DEFAULT_GAP, cols: Columns = CANVAS) -> DataFrame:
    """One row (user, _bucket, _s, _e, _n) per user and ``gap``-wide time bucket.

    A plain hash aggregate: it combines map-side, so a user's rows reach the
    shuffle as at most one row per bucket and task.
    """
    gap_us = _micros(gap)
    base = df.filter(F.col(cols.user).isNotNull() & F.col(cols.time).isNotNull())
    epoch = _epoch_micros(cols.time)
    bucket = (epoch - F.pmod(epoch, F.lit(gap_us))).alias("_bucket")
    return base.groupBy(cols.user, bucket).agg(
        F.min(cols.time).alias("_s"), F.max(cols.time).alias("_e"), F.count(F.lit(1)).alias("_n")
    )


# Widths of the spans in which fragments are merged: 96 gaps (a day of quarter hours),
# 64 of these, then all.
SPANS = (96, 64)


def merge_fragments(fragments: DataFrame, keys: list[str], gap_us: int) -> DataFrame:
    """Merge (first ``_s``, last ``_e``, count ``_n``) fragments that do not overlap, by ``keys``.

    Two that follow each other within the gap become one; the merge is associative, so
    it may run on any consecutive parts of a user's fragments first.
    """
    w = Window.partitionBy(*keys).orderBy("_s")
    previous = F.lag("_e").over(w)
    starts = F.when(previous.isNull() | (micros_between(previous, F.col("_s")) > F.lit(gap_us)), 1).otherwise(0)
    flagged = fragments.select(*keys, "_s", "_e", "_n", starts.alias("_new"))
    numbered = flagged.withColumn("_id", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    merged = numbered.groupBy(*keys, "_id").agg(F.min("_s").alias("_s"), F.max("_e").alias("_e"), F.sum("_n").alias("_n"))
    return merged.drop("_id")


def sessions(
    df: DataFrame,
    gap: timedelta = DEFAULT_GAP,
    rng: TimeRange | None = None,
    bounds: str = "left",
    keep_zero_length: bool = False,
    cols: Columns = CANVAS,
) -> DataFrame:
    """Sessions: a gap strictly longer than ``gap`` starts a new session.

    Output: user, session_start, session_end, events, length_us
    (last - first event, integer microseconds).  The range filter runs first,
    so sessions are clipped at the range edges.  NULL users are skipped;
    zero-length sessions are dropped unless ``keep_zero_length``.
    """
    gap_us = _micros(gap)
    left = session_buckets(time_range(df, rng, bounds, cols.time), gap, cols).select(cols.user, "_s", "_e", "_n")
    whole, span = [], gap_us
    for fan_out in SPANS:
        span *= fan_out
        at = _epoch_micros("_s")
        merged = merge_fragments(left.withColumn("_span", at - F.pmod(at, F.lit(span))), [cols.user, "_span"], gap_us)
        # Within the gap of an edge of its span a fragment may go on on the other side.
        edge = (at - F.col("_span") <= F.lit(gap_us)) | (F.col("_span") + F.lit(span) - _epoch_micros("_e") <= F.lit(gap_us))
        whole.append(merged.filter(~edge).drop("_span"))
        left = merged.filter(edge).drop("_span")
    merged = reduce(DataFrame.unionByName, whole, merge_fragments(left, [cols.user], gap_us))
    out = merged.select(
        cols.user,
        F.col("_s").alias("session_start"),
        F.col("_e").alias("session_end"),
        F.col("_n").cast("bigint").alias("events"),
        micros_between("_s", "_e").cast("bigint").alias("length_us"),
    )
    return out if keep_zero_length else out.filter(F.col("length_us") > 0)


def session_stats(sess: DataFrame) -> DataFrame:
    """(total_sessions, avg_session_seconds); the mean is sum of integer
    microseconds / count / 1e6, so it does not depend on row order."""
    agg = sess.agg(F.count(F.lit(1)).alias("total_sessions"), F.sum(F.col("length_us").cast("decimal(38,0)")).alias("_us"))
    return agg.select(
        "total_sessions",
        (F.try_divide(F.col("_us").cast("double"), F.col("total_sessions")) / F.lit(1e6)).alias("avg_session_seconds"),
    )
