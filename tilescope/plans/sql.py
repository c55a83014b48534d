"""The range summary as one parameterised SQL statement (bound, never interpolated).

One scan: both frequencies come from GROUPING SETS, and each top-1 is a
global ``min_by`` over a (-count, key) ordering (ties to the smallest key).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tilescope.functions.ranges import TimeRange

TOP_SUMMARY_SQL = """
WITH filtered AS (
    SELECT pixel_color, x_coord, y_coord
    FROM IDENTIFIER(:table)
    WHERE `timestamp` BETWEEN CAST(:start AS TIMESTAMP_NTZ) AND CAST(:end AS TIMESTAMP_NTZ)
),
counts AS (
    SELECT pixel_color, x_coord, y_coord, GROUPING(pixel_color) AS by_point, COUNT(*) AS n
    FROM filtered
    GROUP BY GROUPING SETS ((pixel_color), (x_coord, y_coord))
)
SELECT
    min_by(pixel_color, CASE WHEN by_point = 0
        THEN named_struct('n', -n, 'kn', pixel_color IS NULL, 'k', pixel_color) END) AS top_color,
    max(CASE WHEN by_point = 0 THEN n END) AS color_count,
    min_by(x_coord, CASE WHEN by_point = 1
        THEN named_struct('n', -n, 'xn', x_coord IS NULL, 'x', x_coord, 'yn', y_coord IS NULL, 'y', y_coord) END) AS top_x,
    min_by(y_coord, CASE WHEN by_point = 1
        THEN named_struct('n', -n, 'xn', x_coord IS NULL, 'x', x_coord, 'yn', y_coord IS NULL, 'y', y_coord) END) AS top_y,
    max(CASE WHEN by_point = 1 THEN n END) AS coord_count
FROM counts
HAVING max(CASE WHEN by_point = 0 THEN n END) IS NOT NULL
"""


def sql_top_summary(spark: SparkSession, table: str, rng: TimeRange) -> DataFrame:
    """Top category and top point in ``rng`` over a registered table/view."""
    start, end = rng.literal_bounds()
    return spark.sql(TOP_SUMMARY_SQL, args={"table": table, "start": start, "end": end})
