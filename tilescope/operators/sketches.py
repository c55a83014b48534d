"""Distinct users of blocks from stored sketches that roll up to any larger block (AGG18).

Exact distinct counts of one block size say nothing about another: users of two blocks
overlap.  HyperLogLog sketches do: the union of the sketches of the blocks inside a larger
block is the sketch of the larger block.  So one scan at the finest size, kept on disk,
answers every multiple of that size, and new data is added by uniting sketches.

``lg_k`` sets the size and error of a sketch: at most about 2**lg_k bytes, relative
standard error 1.04 / sqrt(2**lg_k); few distinct users (an eighth of 2**lg_k and less) are
counted with far less error.  NULL users are not counted, as in ``count(DISTINCT)``.
"""

from __future__ import annotations

from math import sqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilescope.config import CANVAS, Columns
from tilescope.constants import BLOCK_SIZE
from tilescope.functions.exprs import block_index

LG_K = 12


def error_bound(lg_k: int = LG_K, deviations: float = 4.0) -> float:
    """Relative error that an estimate keeps within ``deviations`` standard errors."""
    return deviations * 1.04 / sqrt(1 << lg_k)


def user_sketches(df: DataFrame, size: int = BLOCK_SIZE, lg_k: int = LG_K, cols: Columns = CANVAS) -> DataFrame:
    """(block_x, block_y, placements, users): one sketch of users for each observed block.

    One aggregate; sketches are filled map-side, so a hot block or user costs one sketch a task.
    """
    blocks = [block_index(cols.x, size).alias("block_x"), block_index(cols.y, size).alias("block_y")]
    return df.groupBy(*blocks).agg(F.count(F.lit(1)).alias("placements"), F.hll_sketch_agg(cols.user, F.lit(lg_k)).alias("users"))


def roll_up(sketches: DataFrame, factor: int) -> DataFrame:
    """Sketches of blocks ``factor`` times as wide and high; 1 unites sketches of the same
    blocks, as of a table and the rows added to it since."""
    if factor < 1:
        raise ValueError("factor must be positive")
    wide = [F.floor(F.col(c) / F.lit(factor)).cast("int").alias(c) for c in ("block_x", "block_y")]
    return sketches.groupBy(*wide).agg(F.sum("placements").alias("placements"), F.hll_union_agg("users").alias("users"))


def estimated_users(sketches: DataFrame) -> DataFrame:
    """(block_x, block_y, placements, unique_users, ppu) with estimated users and placements per user."""
    users = F.hll_sketch_estimate("users")
    return sketches.select("block_x", "block_y", "placements", users.alias("unique_users")).withColumn(
        "ppu", F.try_divide(F.col("placements").cast("double"), F.col("unique_users"))
    )
