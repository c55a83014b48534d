"""Dense integer codes for a text key, without a single-partition window.

``dense_rank() OVER (ORDER BY key)`` has no partition, so Spark runs it in one
task over every row.  Here the ranking runs on the *distinct* keys only:

1. distinct keys (partial + final aggregate);
2. range-partition and sort them, tag each with ``monotonically_increasing_id``
   (partition index in the high bits, position in the low bits), and
   checkpoint so the sampled range bounds are fixed once;
3. per-partition counts (one row per partition) give offsets;
4. code = offset + position + 1; NULL sorts last and gets its own code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tilescope.config import broadcast_if_bounded, checkpoint_dir

_LOW_BITS = 33


def dense_codes(df: DataFrame, key: str, code: str = "code", partitions: int | None = None) -> tuple[DataFrame, int]:
    """(key, code) for every distinct key, code = dense rank ascending, NULL last.

    Returns the mapping and its row count (read from the checkpoint).
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.col(key).asc_nulls_last()
    ranged = (
        df.select(key)
        .distinct()
        .repartitionByRange(n, order)
        .sortWithinPartitions(order)
        .withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    located = ranged.select(
        key,
        F.shiftright("_mid", _LOW_BITS).alias("_pid"),
        F.col("_mid").bitwiseAND((1 << _LOW_BITS) - 1).alias("_pos"),
    )
    sizes = located.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        "_pid",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_off"),
    )
    codes = located.join(broadcast_if_bounded(offsets, n), "_pid").select(
        key, (F.col("_off") + F.col("_pos") + F.lit(1)).cast("bigint").alias(code)
    )
    total = located.count()
    return codes, total


def encode(df: DataFrame, key: str, code: str, partitions: int | None = None) -> DataFrame:
    """Replace ``key`` by its dense code (NULL-safe join back to every row).

    The mapping is broadcast when its proven row count is small; otherwise a
    shuffle join, where AQE splits a key that holds a large share of rows.
    """
    codes, total = dense_codes(df, key, "_code", partitions)
    codes = codes.withColumnRenamed(key, "_key")
    joined = df.join(broadcast_if_bounded(codes, total), df[key].eqNullSafe(codes["_key"]), "left")
    cols = [F.col("_code").alias(code) if c == key else F.col(c) for c in df.columns]
    return joined.select(*cols)
