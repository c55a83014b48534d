"""Parquet export of the compacted table (SNK1-SNK3)."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tilescope.config import broadcast_if_bounded, materialize, target_partitions
from tilescope.constants import PARQUET_COMPRESSION, ROW_GROUP_ROWS
from tilescope.functions.exprs import hour_of, instant_of
from tilescope.functions.ranges import DAY_COLUMN, DAY_KEY

DEFAULT_TEMPLATE = "placements_%Y%m%d_%H%M%S.parquet"
ROWS_PER_FILE = 10_000_000
# Files of fewer rows are written by one task until it has about this many rows.
TASK_ROWS = 100_000
# Ranks read from each hour's sketch; an hour is cut into at most this many pieces.
SKETCH_GRID = 1024


def stamped_path(directory: str, template: str = DEFAULT_TEMPLATE, now: datetime | None = None) -> str:
    """Run-stamped output path, e.g. ``dir/placements_20240101_120000.parquet``."""
    return f"{directory.rstrip('/')}/{(now or datetime.now()).strftime(template)}"


@dataclass(frozen=True)
class DayLayout:
    """Which file a row goes to: ``hours`` has one row an hour (hour, first, pieces, splits)."""

    hours: DataFrame
    files: int
    rows: int  # of ``hours``
    rows_per_file: int = ROWS_PER_FILE

    @property
    def files_per_task(self) -> int:
        return max(1, TASK_ROWS // self.rows_per_file)


def _micros(time_col: str):
    return F.unix_micros(instant_of(time_col))


def day_layout(df: DataFrame, time_col: str = "timestamp", rows_per_file: int = ROWS_PER_FILE) -> DayLayout:
    """Cut every day into consecutive time ranges of about ``rows_per_file`` rows.

    One scan of ``time_col``: counts and mergeable quantile sketches (KLL) by hour, both
    combined map-side.  What follows works on at most one row an hour of calendar.  A day
    of n rows gets ceil(n / rows_per_file) files; the j-th cut is at rank j * n / files,
    which falls into one hour, where the sketch gives the time of that rank.  Sizes vary
    by the sketch's rank error (about 1.3 % of an hour); ranges are exact whatever it says.
    """
    if rows_per_file < 1:
        raise ValueError("rows_per_file must be positive")
    grid = F.expr(f"array({', '.join(f'{i / SKETCH_GRID}D' for i in range(SKETCH_GRID + 1))})")
    base = df.select(hour_of(time_col).alias("hour"), _micros(time_col).alias("_us"))
    counted = base.groupBy("hour").agg(F.count(F.lit(1)).alias("_n"), F.kll_sketch_agg_bigint("_us").alias("_sketch"))
    ranks = F.when(F.col("hour").isNotNull(), F.kll_sketch_get_quantile_bigint("_sketch", grid))
    counted = counted.select("hour", F.to_date("hour").alias("_day"), "_n", ranks.alias("_times"))
    day = Window.partitionBy("_day")
    so_far = F.sum("_n").over(day.orderBy("hour").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = counted.select("*", F.sum("_n").over(day).alias("_all"), so_far.alias("_to"))
    pieces = F.expr(f"(_all + {rows_per_file - 1}) div {rows_per_file}")
    placed = placed.withColumn("_files", pieces).withColumn("_from", F.expr("_to - _n"))
    # Cuts j with _from < j * _all / _files <= _to; the last one is the end of the day.
    placed = placed.withColumn("_a", F.expr("_from * _files div _all")).withColumn("_b", F.expr("least(_to * _files div _all, _files - 1)"))
    cuts = F.expr(
        f"""CASE WHEN hour IS NULL OR _b <= _a THEN array()
            ELSE transform(sequence(_a + 1, _b), j -> _times[CAST(round(least(1, greatest(0, (j * _all / _files - _from) / _n)) * {SKETCH_GRID}) AS INT)]) END"""
    ).cast("array<bigint>")
    hours = materialize(placed.select("hour", "_day", "_a", F.col("_files").alias("pieces"), cuts.alias("splits")))
    days = hours.groupBy("_day").agg(F.max("pieces").alias("_k"))
    before = Window.orderBy(F.col("_day").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)  # one row a day
    offsets = days.select(F.col("_day").alias("_d"), F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_before"))
    joined = hours.join(offsets, F.col("_day").eqNullSafe(F.col("_d")))
    out = materialize(joined.select("hour", (F.col("_before") + F.col("_a")).alias("first"), "pieces", "splits"))
    files = days.agg(F.sum("_k")).first()[0] or 1
    return DayLayout(out, int(files), out.count(), rows_per_file)


def laid_out(df: DataFrame, layout: DayLayout, time_col: str = "timestamp") -> DataFrame:
    """``df`` with its day, one partition a file, or for each ``files_per_task`` files that follow each other.

    Rows of one instant that fills several files are dealt over these by hash; any
    two files of a day share at most an instant: such a one or, of a task's files, which
    are cut by their number of rows, the one at the cut.  Rows without a time are dealt
    over the files of their own directory.  One shuffle, no sampling.
    """
    at = F.col("_micros")
    low = F.size(F.filter("splits", lambda s: s < at))
    high = F.size(F.filter("splits", lambda s: s <= at))
    width = F.when(at.isNull(), F.col("pieces")).otherwise(F.greatest(high - low, F.lit(1)))
    start = F.when(at.isNull(), F.lit(0)).otherwise(low)
    spread = F.when(width > 1, F.pmod(F.xxhash64(*[F.col(f"d.`{c}`") for c in df.columns if c != time_col]), width)).otherwise(0)
    rows = df.select("*", hour_of(time_col).alias("_hour"), _micros(time_col).alias("_micros")).alias("d")
    hours = broadcast_if_bounded(layout.hours.withColumnRenamed("hour", "_h"), layout.rows)
    joined = rows.join(hours, F.col("_hour").eqNullSafe(F.col("_h")))
    dated = joined.select(
        *[F.col(f"d.`{c}`") for c in df.columns], F.to_date(F.col(f"d.`{time_col}`")).alias(DAY_COLUMN), (F.col("first") + start + spread).cast("int").alias("_file")
    )
    per = layout.files_per_task
    task = F.expr(f"cast(_file div {per} as int)")
    return dated.withColumn("_file", task).repartitionById(-(-layout.files // per), "_file").drop("_file")


def export_parquet(
    df: DataFrame,
    path: str,
    time_col: str | None = "timestamp",
    files: int | None = None,
    row_group_rows: int = ROW_GROUP_ROWS,
    mode: str = "error",
    day_partitions: bool = True,
    rows_per_file: int = ROWS_PER_FILE,
    layout: DayLayout | None = None,
) -> str:
    """Write ZSTD Parquet with bounded row groups.

    With ``time_col`` every file is sorted by time, so each row group covers
    a narrow time slice and range filters skip row groups by statistics.

    ``day_partitions`` (default) writes one ``day=YYYY-MM-DD`` directory per
    calendar day of ``time_col``, and in it files of about ``rows_per_file`` rows that
    follow each other in time (:func:`day_layout`, :func:`laid_out`), so a range query
    lists its days only and opens the files of its hours.  The time column of the
    written table says (in its metadata) that ``day`` is derived from it, which
    :func:`tilescope.functions.ranges.time_range` uses to prune directories.
    A table that has a ``day`` column of its own is refused.  ``layout`` may come from
    another frame with the same times that is cheaper to read.

    Without day directories the rows are range-partitioned by time (the
    other columns break ties), so files cover disjoint time slices; this
    costs a sampling pass.  ``files`` sets the number of range partitions
    (default: scanned bytes / 256 MB, at least the shuffle partitions).
    """
    out, writer = df, df.write
    if time_col is not None:
        keys = [time_col] + [c for c in df.columns if c != time_col]
        if day_partitions:
            if DAY_COLUMN in df.columns:
                raise ValueError(f"the table has a column {DAY_COLUMN!r} of its own; rename it or use day_partitions=False")
            layout = layout or day_layout(df, time_col, rows_per_file)
            # (day, time, ...) satisfies the partitioned writer's ordering, so
            # no second sort runs and every file is sorted by time.
            out = laid_out(df, layout, time_col).sortWithinPartitions(DAY_COLUMN, *keys)
            out = out.withMetadata(time_col, {**df.schema[time_col].metadata, DAY_KEY: DAY_COLUMN})
            writer = out.write.partitionBy(DAY_COLUMN)
            if layout.files_per_task > 1:
                # a task's rows are in the order of time, so it cuts them into files by their number
                writer = writer.option("maxRecordsPerFile", layout.rows_per_file)
        else:
            n = files or target_partitions(df)
            out = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
            writer = out.write
    (
        writer.mode(mode)
        .option("compression", PARQUET_COMPRESSION)
        .option("parquet.block.row.count.limit", row_group_rows)
        .parquet(path)
    )
    return path


def latest_export(spark, directory: str, prefix: str = "placements_") -> str | None:
    """Path of the newest run-stamped export under ``directory`` (names sort by time)
    that was finished (has its ``_SUCCESS`` mark).

    Lists one directory level through the Hadoop file system of the path, so
    it works on any shared store Spark can read; ``None`` if there is none.
    """
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(directory)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return None
    done = lambda path: fs.exists(jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS"))
    found = (st.getPath() for st in fs.listStatus(hpath) if st.getPath().getName().startswith(prefix))
    names = sorted(path.toString() for path in found if done(path))
    return names[-1] if names else None
