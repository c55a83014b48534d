"""Block heat-map data (R11-R13): counts, distinct users, intensity, grid, ranking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilescope.config import CANVAS, Columns, materialize
from tilescope.constants import BLOCK_SIZE, RATIO_DECIMALS, TOP_BLOCKS, TOP_INTENSITY_BLOCKS
from tilescope.functions.exprs import block_index, block_label, count_label, ratio_text, thousands
from tilescope.operators.frequency import top_k


def with_blocks(df: DataFrame, size: int = BLOCK_SIZE, cols: Columns = CANVAS) -> DataFrame:
    return df.withColumn("block_x", block_index(cols.x, size)).withColumn("block_y", block_index(cols.y, size))


_AXIS = "x"  # field that carries a column of the grid, null included


def block_counts(df: DataFrame, size: int = BLOCK_SIZE, cols: Columns = CANVAS, ordered: bool = False) -> DataFrame:
    """(block_x, block_y, placements) for observed blocks; ``ordered`` sorts by
    (block_y, block_x) (a range shuffle over at most canvas / size^2 rows)."""
    out = df.groupBy(block_index(cols.x, size).alias("block_x"), block_index(cols.y, size).alias("block_y")).agg(
        F.count(F.lit(1)).alias("placements")
    )
    return out.orderBy("block_y", "block_x") if ordered else out


def block_unique_users(df: DataFrame, size: int = BLOCK_SIZE, approx_rsd: float | None = None, cols: Columns = CANVAS) -> DataFrame:
    """Placements and distinct users per block.

    Exact distinct plans as a two-level aggregate (block, user) -> block, both
    levels with a map-side partial, so a hot block or user is collapsed before
    each shuffle.  ``approx_rsd`` switches to HyperLogLog++ (one level).
    """
    users = (
        F.approx_count_distinct(cols.user, approx_rsd) if approx_rsd is not None else F.count_distinct(F.col(cols.user))
    )
    return df.groupBy(block_index(cols.x, size).alias("block_x"), block_index(cols.y, size).alias("block_y")).agg(
        F.count(F.lit(1)).alias("placements"), users.alias("unique_users")
    )


def block_intensity(
    df: DataFrame, size: int = BLOCK_SIZE, k: int | None = TOP_INTENSITY_BLOCKS, approx_rsd: float | None = None, cols: Columns = CANVAS
) -> DataFrame:
    """Placements per user per observed block, optionally the top k by ratio.

    ``ppu`` is a double ratio; ``ppu_text`` its exact 2-decimal HALF_UP text;
    ``label`` letters the row by value and numbers columns from 1.
    """
    blocks = block_unique_users(df, size, approx_rsd, cols)
    out = blocks.select(
        block_label("block_y", "block_x", x_base=1).alias("label"),
        "block_x",
        "block_y",
        "placements",
        "unique_users",
        F.try_divide(F.col("placements").cast("double"), F.col("unique_users")).alias("ppu"),
        ratio_text("placements", "unique_users", RATIO_DECIMALS).alias("ppu_text"),
    )
    return out if k is None else top_k(out, k, "ppu", ["block_y", "block_x"])


def block_grid(df: DataFrame, size: int = BLOCK_SIZE, dense: bool = True, cols: Columns = CANVAS) -> DataFrame:
    """Long grid (block_y, block_x, placements).

    ``dense=True``: every observed row x every observed column, 0 where empty
    (the matrix a pivot + fill would give).  The block counts (bounded by the
    canvas area / size^2) are checkpointed once; the column set is one
    bounded array taken from them as a scalar subquery, and the grid is
    exactly as large as the output.
    """
    if not dense:
        return block_counts(df, size, cols).select("block_y", "block_x", "placements")
    counts = materialize(block_counts(df, size, cols))
    # collect_set leaves nulls out, a struct around them keeps them
    xs = counts.select(F.array_sort(F.collect_set(F.struct(F.col("block_x").alias(_AXIS))))).scalar()
    grid = counts.select("block_y").distinct().select("block_y", F.explode(xs).alias("_c")).select("block_y", F.col("_c")[_AXIS].alias("block_x"))
    c = counts.select(F.col("block_y").alias("_y"), F.col("block_x").alias("_x"), "placements")
    same = F.col("block_y").eqNullSafe(F.col("_y")) & F.col("block_x").eqNullSafe(F.col("_x"))
    return grid.join(c, same, "left").select(
        "block_y", "block_x", F.coalesce(F.col("placements"), F.lit(0)).cast("bigint").alias("placements")
    )


def block_matrix(
    df: DataFrame, size: int = BLOCK_SIZE, values: Sequence[int] | None = None, cols: Columns = CANVAS, value: str = "placements"
) -> DataFrame:
    """Wide matrix: one row per observed block_y, one column per block_x, 0 if empty.

    ``value`` is ``placements``, ``unique_users``, ``ppu`` or ``ppu_text``.
    Without ``values`` the pivot first reads the distinct block_x values
    (bounded by the canvas width / size) from the blocks, checkpointed so that
    the table is aggregated once.
    """
    if value not in ("placements", "unique_users", "ppu", "ppu_text"):
        raise ValueError(f"no block value {value!r}")
    cells = block_counts(df, size, cols) if value == "placements" else block_intensity(df, size, None, cols=cols)
    cells = cells.select("block_y", "block_x", value)
    if values is None:
        cells = materialize(cells)
    pivoted = cells.groupBy("block_y").pivot("block_x", list(values) if values is not None else None)
    wide = pivoted.agg(F.first(value))
    value_cols = [c for c in wide.columns if c != "block_y"]
    return wide.fillna("0.00" if value == "ppu_text" else 0, subset=value_cols).orderBy("block_y")


def block_labels(df: DataFrame, size: int = BLOCK_SIZE, cols: Columns = CANVAS) -> DataFrame:
    """(block_x, block_y, placements, placements_label): the short K/M label of every heat-map cell."""
    return block_counts(df, size, cols).withColumn("placements_label", count_label("placements"))


def top_blocks(df: DataFrame, size: int = BLOCK_SIZE, k: int = TOP_BLOCKS, dense: bool = True, cols: Columns = CANVAS) -> DataFrame:
    """Blocks ranked by placements (empty cells of the dense grid compete too).

    Empty cells only matter if fewer than ``k`` blocks are observed; then the
    k best are all of them, and the grid is built from these few rows.
    """
    ranked = top_k(block_counts(df, size, cols), k, "placements", ["block_y", "block_x"])
    if dense:
        found = ranked.agg(F.collect_list(F.struct("block_y", "block_x", "placements")).alias("cells"))
        cell = lambda y, x: F.struct(y.alias("block_y"), x.alias("block_x"), F.lit(0).cast("bigint").alias("placements"))
        ys, xs = F.array_distinct(F.col("cells.block_y")), F.array_distinct(F.col("cells.block_x"))
        grid = F.flatten(F.transform(ys, lambda y: F.transform(xs, lambda x: cell(y, x))))
        cells = F.when(F.size("cells") < k, F.concat("cells", grid)).otherwise(F.col("cells"))
        every = found.select(F.inline(cells)).groupBy("block_y", "block_x").agg(F.sum("placements").alias("placements"))
        ranked = top_k(every, k, "placements", ["block_y", "block_x"])
    return ranked.select(
        block_label("block_y", "block_x", x_base=0).alias("label"),
        "block_x",
        "block_y",
        "placements",
        thousands("placements").alias("placements_text"),
        count_label("placements").alias("placements_label"),
    )
