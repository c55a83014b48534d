"""Point sets: membership and top-k categories per point (R8)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tilescope.config import CANVAS, Columns, broadcast_if_bounded, materialize
from tilescope.constants import TOP_CATEGORIES_PER_POINT, TOP_POINTS
from tilescope.functions.exprs import point_label
from tilescope.operators.frequency import frequency, top_k

Points = Sequence[tuple[int, int]]

# A literal list up to this length becomes a plain predicate, which reaches the
# Parquet scan; longer lists and DataFrames become a semi join.
PREDICATE_POINTS = 64


def points_frame(spark: SparkSession, points: Points, cols: Columns = CANVAS) -> DataFrame:
    return spark.createDataFrame([(int(x), int(y)) for x, y in points], f"{cols.x} int, {cols.y} int")


def point_predicate(points: Points, cols: Columns = CANVAS):
    terms = [(F.col(cols.x) == F.lit(int(x))) & (F.col(cols.y) == F.lit(int(y))) for x, y in points]
    return reduce(lambda a, b: a | b, terms, F.lit(False))


def at_points(df: DataFrame, points: Points | DataFrame, bound: int | None = None, cols: Columns = CANVAS) -> DataFrame:
    """Rows of ``df`` at any of ``points``.

    A short literal list is an OR predicate (pushed to the scan).  A longer
    list, or a DataFrame of points, is a ``left_semi`` join; it is broadcast
    only when its row count is bounded (list length or the caller's ``bound``,
    e.g. the k of a top-k), otherwise AQE chooses from measured sizes.
    """
    if not isinstance(points, DataFrame):
        if len(points) <= PREDICATE_POINTS:
            return df.filter(point_predicate(points, cols))
        bound = len(points)
        points = points_frame(df.sparkSession, points, cols)
    keys = points.select(cols.x, cols.y)
    return df.join(broadcast_if_bounded(keys, bound), [cols.x, cols.y], "left_semi").select(*df.columns)


# A tile of the canvas: 256 x 128 cells, one bit each in 512 longs (4 KB).
TILE_WIDTH, TILE_HEIGHT = 256, 128
TILE_LIMIT = 16_384  # tiles that may be broadcast: 64 MB


def _tile(cols: Columns) -> tuple[Column, Column, Column, Column]:
    """Tile coordinates of a cell, the number of its long in the tile, and its bit there."""
    x, y = F.col(cols.x).cast("bigint"), F.col(cols.y).cast("bigint")
    cell = F.pmod(y, F.lit(TILE_HEIGHT)) * TILE_WIDTH + F.pmod(x, F.lit(TILE_WIDTH))
    return F.floor(x / TILE_WIDTH), F.floor(y / TILE_HEIGHT), F.shiftright(cell, 6).cast("int"), cell.bitwiseAND(F.lit(63)).cast("int")


def cell_bitmap(points: DataFrame, cols: Columns = CANVAS) -> DataFrame:
    """An exact bitmap of the cells in ``points``: one row (_tx, _ty, _bits) for each tile that has any.

    Bits are combined map-side into longs, longs into the tile's array of 512, so its size
    follows the occupied part of the canvas, not the number of points.
    """
    tx, ty, word, bit = _tile(cols)
    cells = points.filter(F.col(cols.x).isNotNull() & F.col(cols.y).isNotNull())
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    words = cells.select(tx.alias("_tx"), ty.alias("_ty"), word.alias("_word"), one.alias("_one"))
    words = words.groupBy("_tx", "_ty", "_word").agg(F.bit_or("_one").alias("_one"))
    tiles = words.groupBy("_tx", "_ty").agg(F.map_from_entries(F.collect_list(F.struct("_word", "_one"))).alias("_map"))
    size = TILE_WIDTH * TILE_HEIGHT // 64
    return tiles.select("_tx", "_ty", F.expr(f"transform(sequence(0, {size - 1}), i -> coalesce(_map[i], 0L))").alias("_bits"))


def in_cells(df: DataFrame, points: DataFrame, cols: Columns = CANVAS) -> DataFrame:
    """Rows of ``df`` at any cell of a large set of points, without a shuffle of ``df``.

    The set becomes a bitmap by tiles, computed once; up to ``TILE_LIMIT`` tiles are
    broadcast and each row tests its bit.  A set that is spread over more tiles is joined
    by a shuffle semi join.  Rows without a coordinate match nothing.
    """
    tiles = materialize(cell_bitmap(points, cols))
    if tiles.count() > TILE_LIMIT:
        return df.join(points.select(cols.x, cols.y), [cols.x, cols.y], "left_semi").select(*df.columns)
    tx, ty, word, bit = _tile(cols)
    joined = df.join(F.broadcast(tiles), (tx == F.col("_tx")) & (ty == F.col("_ty")))
    return joined.filter(F.call_function("bit_get", F.get("_bits", word), bit) == 1).select(*df.columns)


def top_points(df: DataFrame, k: int = TOP_POINTS, cols: Columns = CANVAS, count: str = "placement_count") -> DataFrame:
    """The k most used points (R7); ties go to the smaller (x, y)."""
    return top_k(frequency(df, [cols.x, cols.y], cols=cols, count=count), k, count, [cols.x, cols.y])


def top_categories_at(
    df: DataFrame,
    points: Points | DataFrame,
    k: int = TOP_CATEGORIES_PER_POINT,
    bound: int | None = None,
    cols: Columns = CANVAS,
    ordered: bool = False,
) -> DataFrame:
    """For each listed point, its k most frequent categories.

    Counts are aggregated first (one row per point and category), then
    ``row_number <= k`` plans as WindowGroupLimit (partial before the shuffle,
    final after), so a point's window holds at most one row per category.
    ``ordered`` sorts by point (NULL last), then rank.
    """
    counts = frequency(at_points(df, points, bound, cols), [cols.x, cols.y, cols.category], cols=cols, count="placement_count")
    w = Window.partitionBy(cols.x, cols.y).orderBy(
        F.col("placement_count").desc(), F.col(cols.category).asc_nulls_last()
    )
    ranked = counts.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= k)
    out = ranked.select(
        cols.x,
        cols.y,
        point_label(cols.x, cols.y).alias("pixel"),
        cols.category,
        "placement_count",
        F.col("rn").cast("int").alias("rn"),
    )
    return out.orderBy(F.col(cols.x).asc_nulls_last(), F.col(cols.y).asc_nulls_last(), "rn") if ordered else out
