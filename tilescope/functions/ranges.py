"""Time-range arguments and the three boundary modes of the placement log.

``both``  closed ``[start, end]`` on the typed column (SQL ``BETWEEN``).
``left``  half-open ``[start, end)`` on the typed column (session analysis).
``text``  closed comparison on the raw text form
          ``YYYY-MM-DD HH:MM:SS.ffffff UTC``; a value with fewer fraction digits
          sorts below a bound it equals in time, so in effect ``(start, end]``.

All modes compile to plain comparisons, so both bounds reach the Parquet
scan's ``PushedFilters``.  On a table exported with day directories the typed modes
also bound its ``day`` column, which prunes whole directories when the query is
planned: :func:`partition_day` finds that column by itself, so every operator with a
range gets it.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilescope.constants import HOUR_ARGUMENT_FORMAT

HOUR_FORMAT = HOUR_ARGUMENT_FORMAT
DAY_COLUMN = "day"  # partition column written by sources.sinks.export_parquet
DAY_KEY = "tilescope.day"  # metadata of a time column: the partition column with its day
BOUNDS = ("both", "left", "text")


def _parse(value: str | datetime, fmt: str) -> datetime:
    if isinstance(value, datetime):
        return value
    try:
        return datetime.strptime(value, fmt)
    except ValueError as exc:
        raise ValueError(f"invalid time {value!r}; expected format {fmt}") from exc


@dataclass(frozen=True)
class TimeRange:
    start: datetime
    end: datetime

    def __post_init__(self) -> None:
        if self.end <= self.start:
            raise ValueError(f"end {self.end} must be after start {self.start}")

    @classmethod
    def parse(cls, start: str | datetime, end: str | datetime, fmt: str = HOUR_FORMAT) -> "TimeRange":
        """Hour-grain arguments such as ``2022-04-02 14``."""
        return cls(_parse(start, fmt), _parse(end, fmt))

    def text_bounds(self) -> tuple[str, str]:
        return (f"{self.start:%Y-%m-%d %H:%M:%S.%f} UTC", f"{self.end:%Y-%m-%d %H:%M:%S.%f} UTC")

    def literal_bounds(self) -> tuple[str, str]:
        return (f"{self.start:%Y-%m-%d %H:%M:%S.%f}", f"{self.end:%Y-%m-%d %H:%M:%S.%f}")

    def label(self) -> str:
        return f"{self.start:%Y-%m-%d %H:%M} to {self.end:%Y-%m-%d %H:%M}"


def ntz(value: str) -> Column:
    """A ``timestamp_ntz`` literal (folded to a constant by the optimizer)."""
    return F.lit(value).cast("timestamp_ntz")


def range_predicate(column: str | Column, rng: TimeRange, bounds: str = "both") -> Column:
    col = F.col(column) if isinstance(column, str) else column
    if bounds == "both":
        lo, hi = rng.literal_bounds()
        return col.between(ntz(lo), ntz(hi))
    if bounds == "left":
        lo, hi = rng.literal_bounds()
        return (col >= ntz(lo)) & (col < ntz(hi))
    if bounds == "text":
        lo, hi = rng.text_bounds()
        return col.between(F.lit(lo), F.lit(hi))
    raise ValueError(f"bounds must be one of {BOUNDS}, got {bounds!r}")


def partition_day(df: DataFrame, column: str = "timestamp") -> str | None:
    """The column of ``df`` that holds the day of ``column``, if that is certain.

    It is when ``column`` is, unchanged, a file column whose metadata names its day
    column, and ``df`` has, unchanged, the partition column of that name of the same
    files.  A column of the caller's own with that name is another attribute of the
    plan, as is a ``column`` that was computed anew; both give None, and so does a plan
    that cannot be inspected.
    """
    field = next((f for f in df.schema if f.name == column), None)
    name = (field.metadata or {}).get(DAY_KEY) if field else None
    if name is None or df.columns.count(name) != 1 or df.columns.count(column) != 1:
        return None
    try:
        plan = df._jdf.queryExecution().analyzed()
        ids = {a.name(): a.exprId().id() for a in _sequence(plan.output())}
        while plan.getClass().getSimpleName() in _KEEPS_ROWS:
            plan = plan.children().apply(0)
        if plan.getClass().getSimpleName() != "LogicalRelation":
            return None
        there = {a.exprId().id() for a in _sequence(plan.output())}
        partitions = list(plan.relation().partitionSchema().fieldNames())
        return name if {ids[column], ids[name]} <= there and name in partitions else None
    except Exception:  # noqa: BLE001 - no pruning without a plan to look at
        return None


# Plan nodes whose output rows are rows of their only child, attribute by attribute.
_KEEPS_ROWS = frozenset(
    ("Project", "Filter", "SubqueryAlias", "View", "Sort", "GlobalLimit", "LocalLimit", "Repartition", "RepartitionByExpression", "ResolvedHint", "Distinct")
)


def _sequence(scala_seq):
    return [scala_seq.apply(i) for i in range(scala_seq.size())]


def time_range(
    df: DataFrame, rng: TimeRange | None, bounds: str = "both", column: str = "timestamp", day_column: str | None = None
) -> DataFrame:
    """Rows of ``df`` inside ``rng``; ``None`` keeps everything.

    The typed modes also bound the day column of an export (:func:`partition_day`), or
    the DATE column that ``day_column`` names.
    """
    if bounds not in BOUNDS:
        raise ValueError(f"bounds must be one of {BOUNDS}, got {bounds!r}")
    if rng is None:
        return df
    pred = range_predicate(column, rng, bounds)
    if bounds != "text":
        day_column = day_column or partition_day(df, column)
    if bounds != "text" and day_column is not None:
        # the last day that can hold a row: an exclusive end at midnight
        # excludes that day's directory
        last = rng.end - timedelta(microseconds=1) if bounds == "left" else rng.end
        pred = pred & F.col(day_column).between(
            F.lit(rng.start.date().isoformat()).cast("date"), F.lit(last.date().isoformat()).cast("date")
        )
    return df.filter(pred)
