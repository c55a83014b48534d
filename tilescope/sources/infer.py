"""Types of text columns from counts of values that do not fit (SRC2).

For every column and every type of a short lattice one conditional count says how many
values are not of that type; the counts are one aggregate row, combined map-side.  The
first type that all values fit wins (``string`` if none does, or if there are no values).
The counts may be taken by an aggregate of their own, or observed while the text is
written somewhere anyway, and then cost no scan at all.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tilescope.functions.exprs import raw_time, zoned_time

# From narrow to wide; a value of an earlier type may be one of a later type too.
# The patterns come first because a cast that fails costs an exception.
# ``instant``: times that all say their offset; as a column they are UTC wall clocks.
LATTICE: dict[str, Callable[[Column], Column]] = {
    "bigint": lambda c: F.when(c.rlike(r"^[+-]?\d{1,19}$"), c.try_cast("bigint")),
    "double": lambda c: F.when(c.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d{1,3})?$"), c.try_cast("double")),
    "timestamp_ntz": raw_time,
    "instant": zoned_time,
    "boolean": lambda c: F.when(F.lower(c).isin("true", "false"), c.try_cast("boolean")),
}


def _key(column: str, kind: str) -> str:
    return f"{kind}:{column}"


def misfits(columns: Sequence[str]) -> list[Column]:
    """For each column the number of its values, and of those that are not of each type."""
    out = []
    for name in columns:
        c = F.col(f"`{name}`")
        out.append(F.count(c).alias(_key(name, "values")))
        out += [F.count_if(c.isNotNull() & fits(c).isNull()).alias(_key(name, kind)) for kind, fits in LATTICE.items()]
    return out


def narrowest(counts: Mapping[str, int], columns: Sequence[str]) -> dict[str, str]:
    """The type of each column."""
    kinds = {}
    for name in columns:
        fitting = (kind for kind in LATTICE if counts[_key(name, kind)] == 0)
        kinds[name] = next(fitting, "string") if counts[_key(name, "values")] else "string"
    return kinds


def infer_types(df: DataFrame) -> dict[str, str]:
    """Types of the text columns of ``df``: one scan, one row to the driver."""
    columns = [n for n, t in df.dtypes if t == "string"]
    return narrowest(df.agg(*misfits(columns)).first().asDict(), columns) if columns else {}


def observed(df: DataFrame, name: str = "types") -> tuple[DataFrame, Callable[[], dict[str, str]]]:
    """``df``, and a function that gives its types once an action has read it whole."""
    columns = [n for n, t in df.dtypes if t == "string"]
    watch = Observation(name)
    return df.observe(watch, *misfits(columns)), lambda: narrowest(watch.get, columns)


def typed(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """``df`` with its text columns as these types."""
    return df.select(*[LATTICE[kinds[n]](F.col(f"`{n}`")).alias(n) if kinds.get(n) in LATTICE else F.col(f"`{n}`") for n in df.columns])
