"""Ingest jobs: load the raw log into a named table (R2) and compact it (R3)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilescope.config import CANVAS
from tilescope.constants import RAW_TIME_SUFFIX
from tilescope.functions.exprs import raw_time
from tilescope.operators.encoding import encode
from tilescope.sources.commits import commit
from tilescope.sources.infer import observed
from tilescope.sources.raw import CORRUPT, read_raw_csv
from tilescope.sources.sinks import ROWS_PER_FILE, day_layout, export_parquet, stamped_path


@dataclass
class LoadedTable:
    name: str
    spark: SparkSession

    def describe(self) -> DataFrame:
        """(col_name, data_type) of the table."""
        return self.spark.sql("DESCRIBE TABLE IDENTIFIER(:name)", args={"name": self.name}).select("col_name", "data_type")

    def row_count(self) -> int:
        return self.spark.table(self.name).count()


def load_log(
    spark: SparkSession,
    path: str,
    table: str,
    infer: bool = False,
    persistent: bool = False,
    replace: bool = False,
    buckets: int | None = None,
    location: str | None = None,
) -> LoadedTable:
    """Read the CSV log into a named table.

    ``persistent=False`` registers a temporary view (nothing is copied);
    ``persistent=True`` writes a Parquet table (``catalog.schema.table`` is possible);
    one that exists already raises unless ``replace``.  ``location`` makes it an
    external table there.

    ``infer`` types the columns.  A persistent load writes the text once and counts on the
    way which types it fits, so the log is read once; the named table is then a view of
    casts over the text table ``<table>_text``.

    ``buckets`` lays the table out in that many buckets of users, each sorted by user and
    time, so that per-user operators on it need no shuffle.  A bucket is read by one task:
    not for a log where one user has a large share of the rows.
    """
    if not all(part.replace("_", "").isalnum() for part in table.split(".")):
        raise ValueError(f"invalid table name {table!r}")
    if not persistent:
        read_raw_csv(spark, path, infer=infer).createOrReplaceTempView(table)
        return LoadedTable(table, spark)
    df, kinds = read_raw_csv(spark, path), dict
    if infer:
        df, kinds = observed(df)
    if buckets:
        df = df.repartition(buckets, "user_id").sortWithinPartitions("user_id", "timestamp")
    writer = df.write.mode("overwrite" if replace else "error").format("parquet")
    if buckets:
        writer = writer.bucketBy(buckets, "user_id").sortBy("user_id", "timestamp")
    if location:
        writer = writer.option("path", location)
    text = f"{table}_text" if infer else table
    writer.saveAsTable(text)
    if infer:
        stored = spark.table(text)
        expressions = {n: RAW_CASTS.get(kinds()[n], "{0}").format(f"`{n}`") for n in stored.columns}
        columns = ", ".join(f"{e} AS `{n}`" for n, e in expressions.items())
        # The names are checked above; column names are those of the fixed schema.
        spark.sql(f"CREATE {'OR REPLACE ' if replace else ''}VIEW {table} AS SELECT {columns} FROM {text}")
    return LoadedTable(table, spark)


# How a stored text column becomes one of an inferred type, which all its values fit.
RAW_CASTS = {
    "bigint": "CAST({0} AS BIGINT)",
    "double": "CAST({0} AS DOUBLE)",
    "boolean": "CAST({0} AS BOOLEAN)",
    "instant": "timestampadd(MICROSECOND, unix_micros(CAST({0} AS TIMESTAMP)), TIMESTAMP_NTZ'1970-01-01 00:00:00')",
    "timestamp_ntz": f"CAST(regexp_replace({{0}}, '{RAW_TIME_SUFFIX}$', '') AS TIMESTAMP_NTZ)",
}


def parse_raw(raw: DataFrame, mode: str = "strict") -> tuple[DataFrame, DataFrame | None]:
    """Typed columns from the raw text form.

    The timestamp text (with its `` UTC`` suffix, or without) becomes ``timestamp_ntz``;
    ``x,y`` is split into two ints, extra parts ignored.  ``strict`` fails on
    a bad coordinate or time, also a time with another zone (:func:`raw_time`);
    ``quarantine`` returns bad rows separately, with those that the reader marked as
    corrupt.
    """
    if mode not in ("strict", "quarantine"):
        raise ValueError("mode must be 'strict' or 'quarantine'")
    part = lambda n: F.split_part(F.col("coordinate"), F.lit(","), F.lit(n))
    if mode == "strict":
        x, y = part(1).cast("int"), part(2).cast("int")
    else:
        x, y = part(1).try_cast("int"), part(2).try_cast("int")
    time = F.col("timestamp") if dict(raw.dtypes)["timestamp"] == "timestamp_ntz" else raw_time(F.col("timestamp").cast("string"), mode == "strict")
    parsed = raw.withColumn("_x", x).withColumn("_y", y).withColumn("_t", time)
    typed_cols = [
        F.col("_t").alias(CANVAS.time),
        F.col("user_id"),
        F.col("pixel_color").alias(CANVAS.category),
        F.col("_x").alias(CANVAS.x),
        F.col("_y").alias(CANVAS.y),
    ]
    if mode == "strict":
        return parsed.select(*typed_cols), None
    bad_pred = F.col("coordinate").isNotNull() & (F.col("_x").isNull() | F.col("_y").isNull())
    bad_pred = bad_pred | (F.col("timestamp").isNotNull() & F.col("_t").isNull())
    if CORRUPT in raw.columns:
        bad_pred = bad_pred | F.col(CORRUPT).isNotNull()
    return parsed.filter(~bad_pred).select(*typed_cols), parsed.filter(bad_pred).select(*raw.columns)


def compact(raw: DataFrame, mode: str = "strict") -> DataFrame | tuple[DataFrame, DataFrame]:
    """Raw log -> (timestamp, user_id_encoded, x_coord, y_coord, pixel_color).

    User ids become dense ranks in ascending text order (NULL last), computed
    on distinct users only (see :mod:`tilescope.operators.encoding`).
    """
    typed, bad = parse_raw(raw, mode)
    out = coded(typed)
    return out if mode == "strict" else (out, bad)


def coded(typed: DataFrame) -> DataFrame:
    """The compacted columns of parsed rows."""
    return encode(typed, "user_id", CANVAS.user).select(CANVAS.time, CANVAS.user, CANVAS.x, CANVAS.y, CANVAS.category)


def export(df: DataFrame, directory: str, template: str | None = None, **kwargs) -> str:
    """Write the compacted table under a run-stamped name and make it the directory's
    latest export (:func:`tilescope.sources.commits.commit`); returns the path."""
    path = stamped_path(directory, template) if template else stamped_path(directory)
    export_parquet(df, path, **kwargs)
    commit(df.sparkSession, directory, path)
    return path


def ingest_csv(
    spark: SparkSession, csv_path: str, directory: str, infer: bool = False, mode: str = "strict", rows_per_file: int = ROWS_PER_FILE, **kwargs
) -> str | tuple[str, str]:
    """Raw CSV log -> compacted, day-partitioned ZSTD Parquet under a run-stamped
    name in ``directory``; returns the written path.

    With ``mode="quarantine"`` damaged rows and lines are set aside, as Parquet under
    ``directory/rejected/`` with the name of the export; returns both paths.

    Three passes over the log: distinct users for the codes, times for the file layout,
    then encode and write.  ``kwargs`` go to
    :func:`tilescope.sources.sinks.export_parquet`.
    """
    raw = read_raw_csv(spark, csv_path, infer=infer, mode=mode)
    typed, bad = parse_raw(raw, mode)
    if kwargs.get("day_partitions", True) and kwargs.get("time_col", CANVAS.time) and "layout" not in kwargs:
        kwargs["layout"] = day_layout(typed, CANVAS.time, rows_per_file)  # before the codes are joined
    path = export(coded(typed), directory, **kwargs)
    if bad is None:
        return path
    rejected = f"{directory.rstrip('/')}/rejected/{path.rsplit('/', 1)[1]}"
    bad.write.parquet(rejected)
    return path, rejected
