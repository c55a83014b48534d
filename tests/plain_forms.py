"""Plain forms of operators, for comparison: each puts a whole user or table in one task."""

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tilescope.config import CANVAS, Columns
from tilescope.functions.exprs import micros_between
from tilescope.operators.sessions import DEFAULT_GAP, _micros


def sessions_by_lag(df: DataFrame, gap: timedelta = DEFAULT_GAP, cols: Columns = CANVAS) -> DataFrame:
    """lag + running sum, one user per window."""
    gap_us = _micros(gap)
    base = df.filter(F.col(cols.user).isNotNull())
    w = Window.partitionBy(cols.user).orderBy(cols.time)
    prev = F.lag(cols.time).over(w)
    brk = F.when(prev.isNull() | (micros_between(prev, F.col(cols.time)) > F.lit(gap_us)), 1).otherwise(0)
    numbered = base.withColumn("_brk", brk).withColumn(
        "_sid", F.sum("_brk").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    out = numbered.groupBy(cols.user, "_sid").agg(
        F.min(cols.time).alias("session_start"), F.max(cols.time).alias("session_end"), F.count(F.lit(1)).alias("events")
    )
    out = out.select(
        cols.user, "session_start", "session_end", "events",
        micros_between("session_start", "session_end").cast("bigint").alias("length_us"),
    )
    return out.filter(F.col("length_us") > 0)


def sessions_by_window(df: DataFrame, gap: timedelta = DEFAULT_GAP, cols: Columns = CANVAS) -> DataFrame:
    """Spark's own ``session_window`` per user."""
    gap_us = _micros(gap)
    base = df.filter(F.col(cols.user).isNotNull())
    out = base.groupBy(cols.user, F.session_window(cols.time, f"{gap_us} microseconds")).agg(
        F.min(cols.time).alias("session_start"), F.max(cols.time).alias("session_end"), F.count(F.lit(1)).alias("events")
    )
    out = out.select(
        cols.user, "session_start", "session_end", "events",
        micros_between("session_start", "session_end").cast("bigint").alias("length_us"),
    )
    return out.filter(F.col("length_us") > 0)


def dense_codes_window(df: DataFrame, key: str, code: str = "code") -> DataFrame:
    """``dense_rank`` over one partition."""
    w = Window.orderBy(F.col(key).asc_nulls_last())
    return df.select(key).distinct().select(key, F.dense_rank().over(w).cast("bigint").alias(code))
