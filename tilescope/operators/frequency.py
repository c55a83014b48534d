"""Frequencies, top-k and the one-scan "top colour and top pixel" summary (R1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilescope.config import CANVAS, Columns
from tilescope.functions.ranges import TimeRange, time_range


def frequency(
    df: DataFrame,
    keys: Sequence[str],
    rng: TimeRange | None = None,
    bounds: str = "both",
    cols: Columns = CANVAS,
    count: str = "count",
    ordered: bool = False,
) -> DataFrame:
    """Count rows per key inside an optional time range.

    Plan: pushed range filter -> partial HashAggregate -> Exchange(keys) ->
    final HashAggregate.  A hot key is collapsed map-side before the shuffle.
    NULL keys are kept as their own group (SQL semantics).  ``ordered`` sorts by
    descending count, then ascending keys.
    """
    out = time_range(df, rng, bounds, cols.time).groupBy(*keys).agg(F.count(F.lit(1)).alias(count))
    return out.orderBy(*by_count(count, keys)) if ordered else out


def by_count(count: str, keys: Sequence[str]) -> list[Column]:
    """Descending count, ties by ascending keys (NULL last)."""
    return [F.col(count).desc(), *(F.col(c).asc_nulls_last() for c in keys)]


def top_k(df: DataFrame, k: int, by: str, keys: Sequence[str]) -> DataFrame:
    """The k rows with the largest ``by``; ties broken by ascending keys.

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each task keeps
    its own k best rows, so only k rows per task meet in the final merge.
    """
    return df.orderBy(*by_count(by, keys)).limit(k)


def top_frequency(
    df: DataFrame,
    keys: Sequence[str],
    k: int = 10,
    rng: TimeRange | None = None,
    bounds: str = "both",
    cols: Columns = CANVAS,
    count: str = "count",
) -> DataFrame:
    return top_k(frequency(df, keys, rng, bounds, cols, count), k, count, keys)


def multi_frequency(
    df: DataFrame,
    rng: TimeRange | None = None,
    bounds: str = "both",
    cols: Columns = CANVAS,
    count: str = "count",
) -> DataFrame:
    """Category counts and point counts from one scan (GROUPING SETS).

    ``grouping_set`` is ``category`` or ``point``; the columns of the other set
    are NULL.  Expand doubles rows only inside the map-side stage, ahead of
    the partial aggregate, so the shuffle carries pre-aggregated rows.
    """
    filtered = time_range(df, rng, bounds, cols.time)
    agg = filtered.groupingSets([[cols.category], [cols.x, cols.y]], cols.category, cols.x, cols.y).agg(
        F.count(F.lit(1)).alias(count),
        F.grouping(cols.category).alias("_g"),
    )
    return agg.select(
        F.when(F.col("_g") == 0, F.lit("category")).otherwise(F.lit("point")).alias("grouping_set"),
        cols.category,
        cols.x,
        cols.y,
        count,
    )


def top_frequencies(
    df: DataFrame,
    rng: TimeRange | None = None,
    k: int = 10,
    bounds: str = "both",
    cols: Columns = CANVAS,
    count: str = "count",
) -> DataFrame:
    """The k most frequent categories and the k most frequent points, one scan.

    ``row_number() <= k`` per grouping set plans as WindowGroupLimit: each
    task keeps its k best rows per set before the exchange, so each set's
    final window sees at most k rows per task.  Ties go to the smallest key.
    """
    m = multi_frequency(df, rng, bounds, cols, count)
    w = Window.partitionBy("grouping_set").orderBy(
        F.col(count).desc(),
        F.col(cols.category).asc_nulls_last(),
        F.col(cols.x).asc_nulls_last(),
        F.col(cols.y).asc_nulls_last(),
    )
    ranked = m.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return ranked.withColumn("rank", F.col("rank").cast("int"))


def top_summary(
    df: DataFrame,
    rng: TimeRange | None = None,
    bounds: str = "both",
    cols: Columns = CANVAS,
) -> DataFrame:
    """One row: most frequent category and most frequent point in the range.

    Built on :func:`multi_frequency` (one scan) and a global ``min_by`` over a
    (-count, key) ordering, which is a partial + final aggregate, never a
    single-task sort.  Ties go to the smallest key.  Empty input -> no row.
    """
    return summary_of(multi_frequency(df, rng, bounds, cols, count="n"), cols)


def summary_of(m: DataFrame, cols: Columns = CANVAS) -> DataFrame:
    """:func:`top_summary` of counts that :func:`multi_frequency` made, in column ``n``."""
    is_cat = F.col("grouping_set") == "category"
    is_pt = ~is_cat
    def key(c: str):  # NULL keys sort last, as in top_k
        return [F.col(c).isNull().alias(f"{c}_null"), F.col(c).alias(c)]

    cat_order = F.when(is_cat, F.struct((-F.col("n")).alias("n"), *key(cols.category)))
    pt_order = F.when(is_pt, F.struct((-F.col("n")).alias("n"), *key(cols.x), *key(cols.y)))
    out = m.agg(
        F.min_by(cols.category, cat_order).alias("top_color"),
        F.max(F.when(is_cat, F.col("n"))).alias("color_count"),
        F.min_by(cols.x, pt_order).alias("top_x"),
        F.min_by(cols.y, pt_order).alias("top_y"),
        F.max(F.when(is_pt, F.col("n"))).alias("coord_count"),
    )
    return out.filter(F.col("color_count").isNotNull())


def key_concat(df: DataFrame, key: str, count: str = "count") -> DataFrame:
    """``key || ',' || count`` text next to the typed columns (no re-parsing)."""
    freq = frequency(df, [key], count=count)
    return freq.select(key, count, F.concat(F.col(key).cast("string"), F.lit(","), F.col(count).cast("string")).alias("key_count"))
