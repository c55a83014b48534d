"""The raw placement log: CSV text with a quoted ``x,y`` coordinate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tilescope.config import CANVAS, Columns
from tilescope.constants import RAW_TIME_SUFFIX, RAW_TIME_TEXT
from tilescope.sources.infer import infer_types, typed

RAW_DDL = "timestamp STRING, user_id STRING, pixel_color STRING, coordinate STRING"
RAW_COLUMNS = ("timestamp", "user_id", "pixel_color", "coordinate")
TEXT_TIME_PATTERN = RAW_TIME_TEXT
CORRUPT = "_corrupt_record"  # text of a line that has too few or too many fields


def _time_text(ts):
    """``YYYY-MM-DD HH:MM:SS.ffffff`` of a wall clock, from its text: no time zone is involved."""
    text = ts.cast("timestamp_ntz").cast("string")
    fraction = F.rpad(F.substring(text, 21, 6), 6, "0")
    return F.concat(F.substring(text, 1, 19), F.lit("."), fraction)


def raw_from_canvas(df: DataFrame, cols: Columns = CANVAS) -> DataFrame:
    """Render typed rows in the raw log's text form (six fraction digits + `` UTC``)."""
    return df.select(
        F.concat(_time_text(F.col(cols.time)), F.lit(RAW_TIME_SUFFIX)).alias("timestamp"),
        F.col(cols.user).cast("string").alias("user_id"),
        F.col(cols.category).alias("pixel_color"),
        F.concat(F.col(cols.x).cast("string"), F.lit(","), F.col(cols.y).cast("string")).alias("coordinate"),
    )


def read_raw_csv(spark: SparkSession, path: str, infer: bool = False, mode: str = "strict", check_lines: bool = True) -> DataFrame:
    """Scan the CSV log: header row, quoted fields, one record per line (splittable).

    ``infer=False`` gives the four text columns.  ``infer=True`` gives each the narrowest
    type that all its values fit (:mod:`tilescope.sources.infer`: one aggregate over the
    text); times are ``timestamp_ntz``.

    A line with too few or too many fields raises in ``strict``; in ``quarantine`` its
    text is in a further column, ``_corrupt_record``, which
    :func:`tilescope.plans.ingest.parse_raw` sends to the bad side.  A header with other
    names or another order than the fixed schema raises in both.  Lines are checked
    whole, so this scan parses all columns.  ``check_lines=False`` is for a log that was
    checked before: only the columns that a query uses are parsed.
    """
    if mode not in ("strict", "quarantine"):
        raise ValueError("mode must be 'strict' or 'quarantine'")
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", False)
    reader = reader.option("enforceSchema", False).option("columnPruning", not check_lines)
    schema = spark.createDataFrame([], RAW_DDL).schema
    if mode == "strict":
        df = reader.option("mode", "FAILFAST").schema(schema).csv(path)
    else:
        df = reader.option("columnNameOfCorruptRecord", CORRUPT).schema(StructType([*schema.fields, StructField(CORRUPT, StringType())])).csv(path)
    return typed(df, infer_types(df.select(*RAW_COLUMNS))) if infer else df


def write_raw_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """Write raw rows as CSV with a header; fields containing a comma are quoted."""
    df.write.mode(mode).option("header", True).option("quote", '"').csv(path)
