"""Helpers that several of the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tilescope.config import checkpoint_dir


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def kept(df: DataFrame) -> DataFrame:
    """Compute once into the shared checkpoint folder; survives lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts`` (null for a null id)."""
    return F.crc32(doc_id.cast("string")) % F.lit(parts)


def ranked(df: DataFrame, group: list[str], bucket: Column, order: list[Column], rank: str, total: str | None = None) -> DataFrame:
    """Exact rank from 0 of every row in its group, without a window over a whole group.

    ``bucket`` must not decrease along ``order``.  Rows are counted by (group,
    bucket), running sums over these counts give each bucket's first rank, and
    row_number runs inside single buckets only.  The counts are computed first, so
    that (unless they are too many) they are broadcast and rows move once, for the
    window: a null-safe join would hash its sides otherwise than the window.
    ``total`` names a column for the group's row count.
    """
    keyed = df.withColumn("_bucket", bucket)
    sizes = keyed.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*(group or [F.lit(0)])).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*(group or [F.lit(0)]))
    sizes = sizes.select(
        *group, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias("_all")
    )
    sizes = small(kept(sizes))
    inside = F.row_number().over(Window.partitionBy(*group, "_bucket").orderBy(*order)) - F.lit(1)
    numbered = keyed.withColumn("_inside", inside)
    a, b = numbered.alias("a"), sizes.alias("b")
    same = F.lit(True)
    for k in [*group, "_bucket"]:
        same = same & F.col(f"a.`{k}`").eqNullSafe(F.col(f"b.`{k}`"))
    extra = [F.col("b._all").alias(total)] if total else []
    place = (F.col("b._before") + F.col("a._inside")).cast("long").alias(rank)
    return a.join(b, same).select(*[F.col(f"a.`{c}`") for c in df.columns], place, *extra)


def widened(schema: StructType, ddl: str) -> StructType:
    """``schema`` with the fields of a DDL string behind its own."""
    return StructType([*schema.fields, *StructType.fromDDL(ddl).fields])


def wrapped(df: DataFrame, **more: Column) -> DataFrame:
    """All columns of ``df`` as one, ``row``, and ``more``, whose names cannot clash with them then.

    ``select("row.*")`` gives the columns back.
    """
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[c.alias(k) for k, c in more.items()])


def unused(columns: list[str], *names: str) -> list[str]:
    """``names``, each with as many underscores before it as make it differ from ``columns``."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


BROADCAST_ROWS = 1_000_000


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if the rows, of a few fixed columns and computed already, are few enough."""
    return F.broadcast(df) if df.count() <= limit else df
