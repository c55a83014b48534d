"""Registered queries (Spark) and their SQL oracles (DuckDB dialect).

Every query reads the driver's ``events`` table through the canvas view
(:func:`tilescope.sources.canvas.canvas_from_events`) and runs over the whole
table; the parameters below play the role of the reference's arguments.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tilescope.config import CANVAS, Columns, scratch_path
from tilescope.constants import BLOCK_SIZE, HISTOGRAM_CAP
from tilescope.functions.exprs import block_index, block_label, count_label, thousands
from tilescope.functions.ranges import TimeRange, time_range
from tilescope.operators import blocks, frequency, histogram, points, rollup, series, sessions, share, sketches
from tilescope.operators.encoding import dense_codes
from tilescope.plans.ingest import compact, export, load_log, parse_raw
from tilescope.plans.sql import sql_top_summary
from tilescope.sources.canvas import read_canvas, read_events
from tilescope.sources.commits import manifest_frame, read_latest
from tilescope.sources.raw import raw_from_canvas, read_raw_csv, write_raw_csv
from tilescope.sources.sinks import export_parquet, stamped_path

# Fixed query parameters (the reference passes these as script arguments).
RANGE = TimeRange.parse("2024-01-10 00", "2024-01-20 00")
RAGGED = TimeRange(datetime(2024, 1, 10, 0, 20, 30, 500_000), datetime(2024, 1, 19, 23, 47, 11))
POINTS = [(704, 0), (900, 0), (304, 30)]
SHARE_VALUE = "Click"
SHARE_POINT = (704, 0)
BUSY = 5  # events that make a point one of the large point set
HIST_BLOCK_X = 0
BLOCK = BLOCK_SIZE
CAP = HISTOGRAM_CAP

Query = Callable[[SparkSession, str], DataFrame]


def _canvas(spark: SparkSession, d: str) -> DataFrame:
    return read_canvas(spark, d)


def _hist_where():
    return block_index(CANVAS.x, BLOCK) == F.lit(HIST_BLOCK_X)


def _at_share_point():
    return (F.col(CANVAS.x) == F.lit(SHARE_POINT[0])) & (F.col(CANVAS.y) == F.lit(SHARE_POINT[1]))


def q_canvas_projection(spark, d):
    return _canvas(spark, d)


def q_coordinate_split(spark, d):
    typed, _ = parse_raw(raw_from_canvas(_canvas(spark, d)))
    return typed


def q_range_closed(spark, d):
    return time_range(_canvas(spark, d), RANGE, "both")


def q_range_half_open(spark, d):
    return time_range(_canvas(spark, d), RANGE, "left")


def q_range_text(spark, d):
    return time_range(raw_from_canvas(_canvas(spark, d)), RANGE, "text")


def q_category_frequency(spark, d):
    return frequency.frequency(_canvas(spark, d), [CANVAS.category], RANGE)


def q_point_frequency(spark, d):
    return frequency.frequency(_canvas(spark, d), [CANVAS.x, CANVAS.y], RANGE)


def q_text_coordinate_frequency(spark, d):
    raw = raw_from_canvas(_canvas(spark, d))
    return frequency.frequency(raw, ["coordinate"], RANGE, bounds="text", cols=Columns(time="timestamp"))


def q_multi_frequency(spark, d):
    return frequency.multi_frequency(_canvas(spark, d), RANGE)


def q_top_category(spark, d):
    return frequency.top_frequency(_canvas(spark, d), [CANVAS.category], k=1, rng=RANGE)


def q_top_points(spark, d):
    return points.top_points(_canvas(spark, d), k=10)


def q_top_frequencies(spark, d):
    return frequency.top_frequencies(_canvas(spark, d), RANGE, k=10)


def q_top_summary(spark, d):
    return frequency.top_summary(_canvas(spark, d), RANGE)


def q_category_share(spark, d):
    return share.category_share(_canvas(spark, d), SHARE_VALUE)


def q_category_share_at(spark, d):
    return share.category_share_at(_canvas(spark, d), SHARE_VALUE, *SHARE_POINT)


def q_points_semi_join(spark, d):
    canvas = _canvas(spark, d)
    return points.at_points(canvas, points.top_points(canvas, k=3), bound=3)


def q_points_by_bitmap(spark, d):
    canvas = _canvas(spark, d)
    busy = frequency.frequency(canvas, [CANVAS.x, CANVAS.y]).filter(F.col("count") >= BUSY)
    return points.in_cells(canvas, busy)


def q_top_categories_at(spark, d):
    return points.top_categories_at(_canvas(spark, d), POINTS, k=3)


def q_hourly_counts(spark, d):
    return series.hourly_counts(_canvas(spark, d), POINTS)


def q_hourly_series(spark, d):
    return series.hourly_series(_canvas(spark, d), POINTS)


def q_hourly_wide(spark, d):
    return series.hourly_wide(series.hourly_series(_canvas(spark, d), POINTS), series.point_labels(POINTS))


def q_hourly_map(spark, d):
    wide = series.hourly_map(series.hourly_series(_canvas(spark, d), POINTS))
    text = F.transform(F.map_entries("counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return wide.select("hour", F.size("counts").alias("points"), F.array_join(text, "; ").alias("counts"))


def q_hourly_melt(spark, d):
    series_ = series.hourly_series(_canvas(spark, d), POINTS)
    return series.hourly_melt(series.hourly_wide(series_, series.point_labels(POINTS), ordered=False))


def q_user_counts_at(spark, d):
    return histogram.user_counts(_canvas(spark, d), _at_share_point())


def q_placement_histogram(spark, d):
    return histogram.placement_histogram(_canvas(spark, d), _hist_where())


def q_placement_histogram_capped(spark, d):
    return histogram.user_histogram(_canvas(spark, d), _hist_where(), cap=CAP)


def q_placement_histogram_at_point(spark, d):
    return histogram.user_histogram(_canvas(spark, d), _at_share_point(), cap=CAP)


def q_block_counts(spark, d):
    return blocks.block_counts(_canvas(spark, d), BLOCK)


def q_block_matrix(spark, d):
    return blocks.block_matrix(_canvas(spark, d), BLOCK)


def q_block_ppu_matrix(spark, d):
    return blocks.block_matrix(_canvas(spark, d), BLOCK, values=range(20), value="ppu")


def q_block_count_labels(spark, d):
    return blocks.block_labels(_canvas(spark, d), BLOCK)


def q_block_grid_dense(spark, d):
    return blocks.block_grid(_canvas(spark, d), BLOCK, dense=True)


def q_top_blocks(spark, d):
    return blocks.top_blocks(_canvas(spark, d), BLOCK, k=20)


def q_block_unique_users(spark, d):
    return blocks.block_unique_users(_canvas(spark, d), BLOCK)


def q_block_users_sketched(spark, d):
    """Placements and exact distinct users of blocks of three sizes, and whether the estimate
    that sketches of the smallest size roll up to keeps within its error."""
    canvas = _canvas(spark, d)
    path = scratch_path(spark, "sketches")
    sketches.user_sketches(canvas, BLOCK).write.parquet(path)
    kept = spark.read.parquet(path)
    found = []
    for factor in (1, 2, 5):
        guess = sketches.estimated_users(sketches.roll_up(kept, factor)).select("block_x", "block_y", F.col("unique_users").alias("_guess"))
        exact = blocks.block_unique_users(canvas, BLOCK * factor)
        same = [exact[c].eqNullSafe(guess[c]) for c in ("block_x", "block_y")]
        near = F.abs(F.col("_guess") - F.col("unique_users")) <= F.lit(sketches.error_bound()) * F.col("unique_users")
        found.append(exact.join(guess, same).select(F.lit(BLOCK * factor).alias("size"), exact.block_x, exact.block_y, "placements", "unique_users", near.alias("within_error")))
    return reduce(DataFrame.unionByName, found)


def q_block_intensity(spark, d):
    return blocks.block_intensity(_canvas(spark, d), BLOCK, k=10)


def q_event_gaps(spark, d):
    return sessions.event_gaps(_canvas(spark, d))


def q_sessions(spark, d):
    return sessions.sessions(_canvas(spark, d))


def q_sessions_in_range(spark, d):
    return sessions.sessions(_canvas(spark, d), rng=RANGE, bounds="left")


def q_session_stats(spark, d):
    return sessions.session_stats(sessions.sessions(_canvas(spark, d)))


def q_user_encoding(spark, d):
    raw = raw_from_canvas(_canvas(spark, d))
    codes, _ = dense_codes(raw, "user_id", CANVAS.user)
    return codes


def q_compact_roundtrip(spark, d):
    path = scratch_path(spark, "compact")
    export_parquet(compact(raw_from_canvas(_canvas(spark, d))), path)
    return spark.read.parquet(path).drop("day")


def _exported(spark, d, **layout):
    path = scratch_path(spark, "export")
    export_parquet(_canvas(spark, d), path, **layout)
    return spark.read.parquet(path)


def q_export_time_disjoint(spark, d):
    """Per day of an export: rows, first and last time, and files that start before the one before them ends."""
    table = _exported(spark, d, rows_per_file=300).withColumn("_file", F.input_file_name())
    files = table.groupBy("day", "_file").agg(
        F.count(F.lit(1)).alias("_n"), F.min(CANVAS.time).alias("_first"), F.max(CANVAS.time).alias("_last")
    )
    before = F.max("_last").over(Window.partitionBy("day").orderBy("_first", "_last").rowsBetween(Window.unboundedPreceding, -1))
    return (
        files.withColumn("_overlaps", F.coalesce(F.col("_first") < before, F.lit(False)))
        .groupBy("day")
        .agg(
            F.sum("_n").alias("placements"),
            F.min("_first").alias("first_time"),
            F.max("_last").alias("last_time"),
            F.count_if("_overlaps").alias("overlapping_files"),
            (F.count(F.lit(1)) > 1).alias("is_split"),
        )
    )


def q_range_on_export(spark, d):
    return time_range(_exported(spark, d), RANGE).drop("day")


def q_summary_on_export(spark, d):
    return frequency.top_summary(_exported(spark, d), RANGE)


def q_sessions_on_export(spark, d):
    return sessions.sessions(_exported(spark, d), rng=RANGE, bounds="left")


def _kept_counts(spark, d):
    path = scratch_path(spark, "rollup")
    rollup.write_rollup(rollup.hourly_rollup(_canvas(spark, d)), path)
    return spark.read.parquet(path)


def q_rollup_frequency(spark, d):
    return rollup.frequency_from(_canvas(spark, d), _kept_counts(spark, d), [CANVAS.x, CANVAS.y], RAGGED)


def q_rollup_summary(spark, d):
    return rollup.top_summary_from(_exported(spark, d), _kept_counts(spark, d), RAGGED)


def q_csv_roundtrip(spark, d):
    path = scratch_path(spark, "rawlog")
    write_raw_csv(raw_from_canvas(_canvas(spark, d)), path)
    return read_raw_csv(spark, path)


def q_csv_inferred(spark, d):
    path = scratch_path(spark, "rawlog")
    write_raw_csv(raw_from_canvas(_canvas(spark, d)), path)
    return read_raw_csv(spark, path, infer=True)


def q_csv_quarantine(spark, d):
    """A log in which every seventh user's points lost a part and every eleventh user's times
    got an offset: good rows typed, bad rows as they came."""
    raw = raw_from_canvas(_canvas(spark, d))
    user = F.col("user_id").cast("bigint")
    raw = raw.withColumn("coordinate", F.when(user % 7 == 0, F.split_part("coordinate", F.lit(","), F.lit(1))).otherwise(F.col("coordinate")))
    raw = raw.withColumn("timestamp", F.when(user % 11 == 0, F.replace("timestamp", F.lit(" UTC"), F.lit("+02:00"))).otherwise(F.col("timestamp")))
    path = scratch_path(spark, "rawlog")
    write_raw_csv(raw, path)
    good, bad = parse_raw(read_raw_csv(spark, path, mode="quarantine"), "quarantine")
    none = F.lit(None)
    accepted = good.select(
        F.lit("good").alias("status"), "user_id", CANVAS.time, CANVAS.x, CANVAS.y, none.cast("string").alias("time_text"), none.cast("string").alias("coordinate")
    )
    rejected = bad.select(
        F.lit("bad").alias("status"),
        "user_id",
        none.cast("timestamp_ntz").alias(CANVAS.time),
        none.cast("int").alias(CANVAS.x),
        none.cast("int").alias(CANVAS.y),
        F.col("timestamp").alias("time_text"),
        "coordinate",
    )
    return accepted.unionByName(rejected)


def _loaded(spark, d, **kwargs):
    path = scratch_path(spark, "rawlog")
    write_raw_csv(raw_from_canvas(_canvas(spark, d)), path)
    table = "placement_log_" + path.rsplit("-", 1)[1]
    return load_log(spark, path, table, persistent=True, location=scratch_path(spark, "table"), **kwargs)


def q_table_load_persistent(spark, d):
    """Rows of a table loaded with inferred types, with the types as its DESCRIBE gives them and its row count."""
    table = _loaded(spark, d, infer=True)
    kinds = ", ".join(f"{r.col_name} {r.data_type}" for r in table.describe().collect())  # one row a column
    rows = spark.table(table.name).select(F.count(F.lit(1))).scalar()
    return spark.table(table.name).select("*", F.lit(kinds).alias("types"), rows.alias("row_count"))


def q_bucketed_user_counts(spark, d):
    table = _loaded(spark, d, buckets=4)
    return frequency.frequency(spark.table(table.name), ["user_id"], count="placements")


def q_latest_export(spark, d):
    """The second of two exports, read through the directory's pointer, with its manifest; a third, unfinished one is not seen."""
    directory = scratch_path(spark, "exports")
    canvas = _canvas(spark, d)
    export(time_range(canvas, RANGE), directory, "placements_1.parquet")
    export(canvas, directory, "placements_2.parquet")
    export_parquet(time_range(canvas, RANGE), stamped_path(directory, "placements_3.parquet"))
    rows = manifest_frame(spark, directory).select("rows").scalar()
    return read_latest(spark, directory).drop("day").withColumn("committed_rows", rows)


def q_table_describe(spark, d):
    path = scratch_path(spark, "rawlog")
    write_raw_csv(raw_from_canvas(_canvas(spark, d)), path)
    table = load_log(spark, path, "placement_log")
    rows = spark.table(table.name).select(F.count(F.lit(1))).scalar()
    return table.describe().withColumn("row_count", rows)


def q_number_labels(spark, d):
    canvas = blocks.with_blocks(_canvas(spark, d), BLOCK)
    agg = canvas.groupingSets([[CANVAS.category], ["block_x", "block_y"], []], CANVAS.category, "block_x", "block_y").agg(
        F.count(F.lit(1)).alias("count"), F.grouping(CANVAS.category).alias("_gc"), F.grouping("block_x").alias("_gb")
    )
    level = F.when(F.col("_gc") == 0, "category").when(F.col("_gb") == 0, "block").otherwise("total")
    key = (
        F.when(F.col("_gc") == 0, F.col(CANVAS.category))
        .when(F.col("_gb") == 0, block_label("block_y", "block_x", 0))
        .otherwise(F.lit("all"))
    )
    return agg.select(
        level.alias("level"),
        key.alias("key"),
        "count",
        count_label("count").alias("count_label"),
        thousands("count").alias("count_text"),
    )


def q_sql_parameters(spark, d):
    _canvas(spark, d).createOrReplaceTempView("placements_sql")
    return sql_top_summary(spark, "placements_sql", RANGE)


def q_table_scan(spark, d):
    _canvas(spark, d).createOrReplaceTempView("placements")
    return spark.table("placements")


def q_path_scan(spark, d):
    source = "parquet.`" + f"{d}/events.parquet".replace("`", "``") + "`"
    return spark.sql(
        """
        SELECT CAST(ts AS TIMESTAMP_NTZ) AS `timestamp`, user_id AS user_id_encoded,
               CAST(100 * (k % 20) + floor(k / 20) AS INT) AS x_coord,
               CAST(30 * floor(value / 10) AS INT) AS y_coord,
               event_type AS pixel_color
        FROM (SELECT *, CAST(get_json_object(props, '$.k') AS INT) AS k FROM IDENTIFIER(:source))
        """,
        args={"source": source},
    )


def q_pruned_scan(spark, d):
    ev = read_events(spark, d).select(F.col("ts").alias(CANVAS.time), F.col("user_id").alias(CANVAS.user))
    return time_range(ev, RANGE, "left")


def q_key_concat(spark, d):
    return frequency.key_concat(_canvas(spark, d), CANVAS.category)


def q_first_rows(spark, d):
    c = CANVAS
    return _canvas(spark, d).orderBy(c.time, c.user, c.x, c.y, c.category).limit(10)


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}


# ----------------------------------------------------------------------------
# DuckDB oracles
# ----------------------------------------------------------------------------

CANVAS_CTE = """canvas AS (
    SELECT ts AS "timestamp", user_id AS user_id_encoded,
           CAST(100 * (k % 20) + floor(k / 20) AS INTEGER) AS x_coord,
           CAST(30 * floor(value / 10) AS INTEGER) AS y_coord,
           event_type AS pixel_color
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e
)"""

RAW_CTE = """raw AS (
    SELECT strftime("timestamp", '%Y-%m-%d %H:%M:%S.%f') || ' UTC' AS "timestamp",
           CAST(user_id_encoded AS VARCHAR) AS user_id, pixel_color,
           CAST(x_coord AS VARCHAR) || ',' || CAST(y_coord AS VARCHAR) AS coordinate
    FROM canvas
)"""

_LO, _HI = RANGE.literal_bounds()
_TLO, _THI = RANGE.text_bounds()
IN_RANGE = f"\"timestamp\" BETWEEN TIMESTAMP '{_LO}' AND TIMESTAMP '{_HI}'"
IN_HALF_OPEN = f"\"timestamp\" >= TIMESTAMP '{_LO}' AND \"timestamp\" < TIMESTAMP '{_HI}'"
AT_POINTS = " OR ".join(f"(x_coord = {x} AND y_coord = {y})" for x, y in POINTS)
BLOCK_X = f"CAST(floor(x_coord / {BLOCK}) AS INTEGER)"
BLOCK_Y = f"CAST(floor(y_coord / {BLOCK}) AS INTEGER)"


def _pct(a: str, b: str) -> str:
    return f"round((100.0::DOUBLE * {a} / nullif({b}, 0)) * 100.0, 0) / 100.0"


def _fixed2(num: str, den: str, p: int) -> str:
    scaled = f"(({num}) * {p} * 2 + ({den})) // (({den}) * 2)"
    width = len(str(p)) - 1
    return f"CAST({scaled} // {p} AS VARCHAR) || '.' || lpad(CAST({scaled} % {p} AS VARCHAR), {width}, '0')"


def _count_label_sql(n: str) -> str:
    return f"""(SELECT CASE WHEN d > 0 THEN regexp_replace(regexp_replace(txt, '0+$', ''), '\\.$', '') ELSE txt END || sfx
  FROM (SELECT d, sfx, CASE WHEN d = 0 THEN CAST(sc AS VARCHAR)
                 ELSE CAST(sc // p AS VARCHAR) || '.' || lpad(CAST(sc % p AS VARCHAR), CAST(d AS INTEGER), '0') END AS txt
        FROM (SELECT d, sfx, p, ({n} * p * 2 + u) // (u * 2) AS sc
              FROM (SELECT d, sfx, u, CAST(pow(10, d) AS BIGINT) AS p
                    FROM (SELECT u, sfx, greatest(0, least(2, 4 - length(CAST({n} // u AS VARCHAR)))) AS d
                          FROM (SELECT CASE WHEN {n} >= 1000000 THEN 1000000 WHEN {n} >= 1000 THEN 1000 ELSE 1 END::BIGINT AS u,
                                       CASE WHEN {n} >= 1000000 THEN 'M' WHEN {n} >= 1000 THEN 'K' ELSE '' END AS sfx))))))"""


def _w(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join((CANVAS_CTE,) + ctes) + "\n" + body


_SERIES_CTES = (
    f"""h AS (SELECT date_trunc('hour', "timestamp") AS hour, x_coord, y_coord, count(*) AS placement_count
          FROM canvas WHERE {AT_POINTS} GROUP BY ALL)""",
    "b AS (SELECT min(hour) AS lo, max(hour) AS hi FROM h)",
    "p AS (SELECT DISTINCT x_coord, y_coord FROM h)",
    "g AS (SELECT p.x_coord, p.y_coord, unnest(generate_series(b.lo, b.hi, INTERVAL 1 HOUR)) AS hour FROM p, b)",
    """s AS (SELECT hour, '(' || x_coord || ', ' || y_coord || ')' AS pixel,
                 coalesce(h.placement_count, 0)::BIGINT AS placement_count
          FROM g LEFT JOIN h USING (hour, x_coord, y_coord))""",
)

_WIDE = "SELECT hour, " + ", ".join(
    f"coalesce(max(CASE WHEN pixel = '({x}, {y})' THEN placement_count END), 0) AS \"({x}, {y})\"" for x, y in POINTS
) + " FROM s GROUP BY hour"

_BLOCKS_CTE = f"bc AS (SELECT {BLOCK_X} AS block_x, {BLOCK_Y} AS block_y, count(*) AS placements FROM canvas GROUP BY 1, 2)"
_DENSE_CTE = """dg AS (SELECT ys.block_y, xs.block_x, coalesce(bc.placements, 0)::BIGINT AS placements
          FROM (SELECT DISTINCT block_y FROM bc) ys CROSS JOIN (SELECT DISTINCT block_x FROM bc) xs
          LEFT JOIN bc ON bc.block_y = ys.block_y AND bc.block_x = xs.block_x)"""

def _sessions_ctes(where: str = "TRUE") -> tuple[str, ...]:
    return (
        f"""gp AS (SELECT user_id_encoded, "timestamp" AS t,
              CASE WHEN lag("timestamp") OVER w IS NULL
                     OR epoch_us("timestamp") - epoch_us(lag("timestamp") OVER w) > 900000000 THEN 1 ELSE 0 END AS brk
           FROM canvas WHERE user_id_encoded IS NOT NULL AND ({where})
           WINDOW w AS (PARTITION BY user_id_encoded ORDER BY "timestamp"))""",
        """sn AS (SELECT user_id_encoded, t, sum(brk) OVER (PARTITION BY user_id_encoded ORDER BY t, brk DESC
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM gp)""",
        """ss AS (SELECT user_id_encoded, min(t) AS session_start, max(t) AS session_end, count(*) AS events,
                  epoch_us(max(t)) - epoch_us(min(t)) AS length_us
           FROM sn GROUP BY user_id_encoded, sid HAVING max(t) > min(t))""",
    )


_SESSIONS_CTES = _sessions_ctes()

_TOP_SUMMARY = _w(
    """SELECT tc.pixel_color AS top_color, tc.n AS color_count, tp.x_coord AS top_x, tp.y_coord AS top_y, tp.n AS coord_count
FROM (SELECT pixel_color, count(*) AS n FROM f GROUP BY 1 ORDER BY n DESC, pixel_color LIMIT 1) tc,
     (SELECT x_coord, y_coord, count(*) AS n FROM f GROUP BY 1, 2 ORDER BY n DESC, x_coord, y_coord LIMIT 1) tp""",
    f"f AS (SELECT * FROM canvas WHERE {IN_RANGE})",
)

def _top_summary_sql(where: str) -> str:
    return _TOP_SUMMARY.replace(IN_RANGE, where)


_RLO, _RHI = RAGGED.literal_bounds()
IN_RAGGED = f"\"timestamp\" BETWEEN TIMESTAMP '{_RLO}' AND TIMESTAMP '{_RHI}'"

_HIST_CTE = f"""u AS (SELECT user_id_encoded, count(*) AS placements FROM canvas
          WHERE {BLOCK_X} = {HIST_BLOCK_X} GROUP BY 1)"""

ORACLE_SQL: dict[str, str] = {
    "canvas_projection": _w("SELECT * FROM canvas"),
    "coordinate_split": _w(
        """SELECT CAST(replace("timestamp", ' UTC', '') AS TIMESTAMP) AS "timestamp", user_id, pixel_color,
       CAST(split_part(coordinate, ',', 1) AS INTEGER) AS x_coord,
       CAST(split_part(coordinate, ',', 2) AS INTEGER) AS y_coord FROM raw""",
        RAW_CTE,
    ),
    "range_closed": _w(f"SELECT * FROM canvas WHERE {IN_RANGE}"),
    "range_half_open": _w(f"SELECT * FROM canvas WHERE {IN_HALF_OPEN}"),
    "range_text": _w(f"SELECT * FROM raw WHERE \"timestamp\" BETWEEN '{_TLO}' AND '{_THI}'", RAW_CTE),
    "category_frequency": _w(f'SELECT pixel_color, count(*) AS "count" FROM canvas WHERE {IN_RANGE} GROUP BY 1'),
    "point_frequency": _w(f'SELECT x_coord, y_coord, count(*) AS "count" FROM canvas WHERE {IN_RANGE} GROUP BY 1, 2'),
    "text_coordinate_frequency": _w(
        f'''SELECT coordinate, count(*) AS "count" FROM raw
WHERE "timestamp" BETWEEN '{_TLO}' AND '{_THI}' GROUP BY coordinate''',
        RAW_CTE,
    ),
    "multi_frequency": _w(
        f"""SELECT CASE WHEN GROUPING(pixel_color) = 0 THEN 'category' ELSE 'point' END AS grouping_set,
       pixel_color, x_coord, y_coord, count(*) AS "count"
FROM canvas WHERE {IN_RANGE} GROUP BY GROUPING SETS ((pixel_color), (x_coord, y_coord))"""
    ),
    "top_category": _w(
        f'SELECT pixel_color, count(*) AS "count" FROM canvas WHERE {IN_RANGE} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1'
    ),
    "top_points": _w(
        "SELECT x_coord, y_coord, count(*) AS placement_count FROM canvas GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10"
    ),
    "top_summary": _TOP_SUMMARY,
    "top_frequencies": _w(
        f"""SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY grouping_set
         ORDER BY "count" DESC, pixel_color NULLS LAST, x_coord NULLS LAST, y_coord NULLS LAST) AS INTEGER) AS rank
  FROM (SELECT CASE WHEN GROUPING(pixel_color) = 0 THEN 'category' ELSE 'point' END AS grouping_set,
               pixel_color, x_coord, y_coord, count(*) AS "count"
        FROM canvas WHERE {IN_RANGE} GROUP BY GROUPING SETS ((pixel_color), (x_coord, y_coord))))
WHERE rank <= 10"""
    ),
    "category_share": _w(
        f"""SELECT '{SHARE_VALUE}' AS color, color_placements, total_placements,
       {_pct('color_placements', 'total_placements')} AS percentage
FROM (SELECT count(CASE WHEN lower(pixel_color) = lower('{SHARE_VALUE}') THEN 1 END) AS color_placements,
             count(*) AS total_placements FROM canvas)"""
    ),
    "category_share_at": _w(
        f"""SELECT '{SHARE_VALUE}' AS color, {SHARE_POINT[0]} AS x_coord, {SHARE_POINT[1]} AS y_coord,
       co AS color_placements_overall, t AS total_placements_overall, {_pct('co', 't')} AS overall_percentage,
       cl AS color_placements_at_location, tl AS total_placements_at_location,
       coalesce({_pct('cl', 'tl')}, 0.0) AS location_percentage
FROM (SELECT count(CASE WHEN lower(pixel_color) = lower('{SHARE_VALUE}') THEN 1 END) AS co, count(*) AS t FROM canvas) o,
     (SELECT count(CASE WHEN lower(pixel_color) = lower('{SHARE_VALUE}') THEN 1 END) AS cl, count(*) AS tl
      FROM canvas WHERE x_coord = {SHARE_POINT[0]} AND y_coord = {SHARE_POINT[1]}) l"""
    ),
    "points_semi_join": _w(
        """SELECT * FROM canvas c WHERE EXISTS (SELECT 1 FROM tp WHERE tp.x_coord = c.x_coord AND tp.y_coord = c.y_coord)""",
        "tp AS (SELECT x_coord, y_coord FROM canvas GROUP BY 1, 2 ORDER BY count(*) DESC, 1, 2 LIMIT 3)",
    ),
    "top_categories_at": _w(
        """SELECT x_coord, y_coord, '(' || x_coord || ', ' || y_coord || ')' AS pixel, pixel_color, placement_count,
       CAST(rn AS INTEGER) AS rn
FROM (SELECT *, row_number() OVER (PARTITION BY x_coord, y_coord ORDER BY placement_count DESC, pixel_color) AS rn
      FROM pc) WHERE rn <= 3""",
        f"pc AS (SELECT x_coord, y_coord, pixel_color, count(*) AS placement_count FROM canvas WHERE {AT_POINTS} GROUP BY ALL)",
    ),
    "hourly_counts": _w("SELECT * FROM h", _SERIES_CTES[0]),
    "hourly_series": _w("SELECT * FROM s", *_SERIES_CTES),
    "hourly_wide": _w(_WIDE, *_SERIES_CTES),
    "hourly_melt": _w("SELECT * FROM s", *_SERIES_CTES),
    "user_counts_at": _w(
        f"""SELECT user_id_encoded, count(*) AS placements FROM canvas
WHERE x_coord = {SHARE_POINT[0]} AND y_coord = {SHARE_POINT[1]} GROUP BY 1"""
    ),
    "placement_histogram": _w("SELECT placements, count(*) AS num_users FROM u GROUP BY 1", _HIST_CTE),
    "placement_histogram_capped": _w(
        f"""SELECT placements_bin,
       CASE WHEN placements_bin < {CAP} THEN CAST(placements_bin AS VARCHAR) ELSE '{CAP}+' END AS bin_label,
       num_users, {_pct('num_users', 'tot')} AS percentage,
       {_fixed2('num_users * 100', 'tot', 10)} || '%' || chr(10) || CAST(num_users AS VARCHAR) AS annotation
FROM (SELECT *, CAST(sum(num_users) OVER () AS BIGINT) AS tot FROM
      (SELECT least(placements, {CAP}) AS placements_bin, count(*) AS num_users FROM u GROUP BY 1))""",
        _HIST_CTE,
    ),
    "placement_histogram_at_point": _w(
        f"""SELECT placements_bin,
       CASE WHEN placements_bin < {CAP} THEN CAST(placements_bin AS VARCHAR) ELSE '{CAP}+' END AS bin_label,
       num_users, {_pct('num_users', 'tot')} AS percentage,
       {_fixed2('num_users * 100', 'tot', 10)} || '%' || chr(10) || CAST(num_users AS VARCHAR) AS annotation
FROM (SELECT *, CAST(sum(num_users) OVER () AS BIGINT) AS tot FROM
      (SELECT least(placements, {CAP}) AS placements_bin, count(*) AS num_users FROM (
         SELECT user_id_encoded, count(*) AS placements FROM canvas
         WHERE x_coord = {SHARE_POINT[0]} AND y_coord = {SHARE_POINT[1]} GROUP BY 1) GROUP BY 1))"""
    ),
    "block_counts": _w("SELECT * FROM bc", _BLOCKS_CTE),
    "block_matrix": _w(
        "SELECT block_y, "
        + ", ".join(f'coalesce(max(CASE WHEN block_x = {i} THEN placements END), 0) AS "{i}"' for i in range(20))
        + " FROM bc GROUP BY block_y",
        _BLOCKS_CTE,
    ),
    "block_ppu_matrix": _w(
        "SELECT block_y, "
        + ", ".join(f'coalesce(max(CASE WHEN block_x = {i} THEN ppu END), 0.0) AS "{i}"' for i in range(20))
        + " FROM pu GROUP BY block_y",
        f"""pu AS (SELECT {BLOCK_X} AS block_x, {BLOCK_Y} AS block_y,
               count(*)::DOUBLE / nullif(count(DISTINCT user_id_encoded), 0) AS ppu FROM canvas GROUP BY 1, 2)""",
    ),
    "block_count_labels": _w(
        "SELECT block_x, block_y, placements, " + _count_label_sql("placements") + " AS placements_label FROM bc", _BLOCKS_CTE
    ),
    "block_grid_dense": _w("SELECT * FROM dg", _BLOCKS_CTE, _DENSE_CTE),
    "top_blocks": _w(
        """SELECT chr(65 + block_y) || CAST(block_x AS VARCHAR) AS label, block_x, block_y, placements,
       format('{:,}', placements) AS placements_text, """
        + _count_label_sql("placements")
        + """ AS placements_label
FROM dg ORDER BY placements DESC, block_y, block_x LIMIT 20""",
        _BLOCKS_CTE,
        _DENSE_CTE,
    ),
    "block_unique_users": _w(
        f"""SELECT {BLOCK_X} AS block_x, {BLOCK_Y} AS block_y, count(*) AS placements,
       count(DISTINCT user_id_encoded) AS unique_users FROM canvas GROUP BY 1, 2"""
    ),
    "block_intensity": _w(
        f"""SELECT chr(65 + block_y) || CAST(block_x + 1 AS VARCHAR) AS label, block_x, block_y, placements, unique_users,
       placements::DOUBLE / nullif(unique_users, 0) AS ppu, {_fixed2('placements', 'unique_users', 100)} AS ppu_text
FROM (SELECT {BLOCK_X} AS block_x, {BLOCK_Y} AS block_y, count(*) AS placements,
             count(DISTINCT user_id_encoded) AS unique_users FROM canvas GROUP BY 1, 2)
ORDER BY ppu DESC, block_y, block_x LIMIT 10"""
    ),
    "event_gaps": _w(
        """SELECT user_id_encoded, "timestamp", lag("timestamp") OVER w AS prev_timestamp,
       (epoch_us("timestamp") - epoch_us(lag("timestamp") OVER w)) / 1e6 AS gap_seconds
FROM canvas WHERE user_id_encoded IS NOT NULL
WINDOW w AS (PARTITION BY user_id_encoded ORDER BY "timestamp")"""
    ),
    "sessions": _w("SELECT * FROM ss", *_SESSIONS_CTES),
    "sessions_in_range": _w("SELECT * FROM ss", *_sessions_ctes(IN_HALF_OPEN)),
    "session_stats": _w(
        "SELECT count(*) AS total_sessions, sum(length_us) / nullif(count(*), 0) / 1e6 AS avg_session_seconds FROM ss",
        *_SESSIONS_CTES,
    ),
    "user_encoding": """SELECT user_id, CAST(dense_rank() OVER (ORDER BY user_id NULLS LAST) AS BIGINT) AS user_id_encoded
FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS user_id FROM events)""",
    "compact_roundtrip": _w(
        """SELECT "timestamp", CAST(dense_rank() OVER (ORDER BY CAST(user_id_encoded AS VARCHAR) NULLS LAST) AS BIGINT)
       AS user_id_encoded, x_coord, y_coord, pixel_color FROM canvas"""
    ),
    "csv_roundtrip": _w("SELECT * FROM raw", RAW_CTE),
    "number_labels": _w(
        """SELECT level, "key", "count", """
        + _count_label_sql('"count"')
        + """ AS count_label, format('{:,}', "count") AS count_text
FROM (SELECT CASE WHEN GROUPING(pixel_color) = 0 THEN 'category' WHEN GROUPING(block_x) = 0 THEN 'block' ELSE 'total' END AS level,
             CASE WHEN GROUPING(pixel_color) = 0 THEN pixel_color
                  WHEN GROUPING(block_x) = 0 THEN chr(65 + block_y) || CAST(block_x AS VARCHAR) ELSE 'all' END AS "key",
             count(*) AS "count"
      FROM (SELECT *, """
        + BLOCK_X
        + " AS block_x, "
        + BLOCK_Y
        + """ AS block_y FROM canvas) cb
      GROUP BY GROUPING SETS ((pixel_color), (block_x, block_y), ()))"""
    ),
    "sql_parameters": _TOP_SUMMARY,
    "table_scan": _w("SELECT * FROM canvas"),
    "path_scan": _w("SELECT * FROM canvas"),
    "pruned_scan": f"""SELECT ts AS "timestamp", user_id AS user_id_encoded FROM events
WHERE ts >= TIMESTAMP '{_LO}' AND ts < TIMESTAMP '{_HI}'""",
    "key_concat": _w(
        """SELECT pixel_color, count(*) AS "count", pixel_color || ',' || CAST(count(*) AS VARCHAR) AS key_count
FROM canvas GROUP BY 1"""
    ),
    "first_rows": _w(
        """SELECT * FROM canvas ORDER BY "timestamp", user_id_encoded, x_coord, y_coord, pixel_color LIMIT 10"""
    ),
}

# The raw log's schema is fixed (RAW_DDL), so DESCRIBE of the loaded table is
# known; its row count comes from the events table.
ORACLE_SQL["table_describe"] = """SELECT col_name, data_type, (SELECT count(*) FROM events) AS row_count
FROM (VALUES ('timestamp', 'string'), ('user_id', 'string'), ('pixel_color', 'string'), ('coordinate', 'string'))
     AS d(col_name, data_type)"""

# About 300 rows a file, so a day of more rows is split.
ORACLE_SQL["export_time_disjoint"] = _w(
    """SELECT CAST("timestamp" AS DATE) AS day, count(*) AS placements, min("timestamp") AS first_time, max("timestamp") AS last_time,
       0::BIGINT AS overlapping_files, count(*) > 300 AS is_split FROM canvas GROUP BY 1"""
)
ORACLE_SQL["range_on_export"] = ORACLE_SQL["range_closed"]
ORACLE_SQL["summary_on_export"] = ORACLE_SQL["top_summary"]
ORACLE_SQL["sessions_on_export"] = ORACLE_SQL["sessions_in_range"]

ORACLE_SQL["rollup_frequency"] = ORACLE_SQL["point_frequency"].replace(IN_RANGE, IN_RAGGED)
ORACLE_SQL["rollup_summary"] = _top_summary_sql(IN_RAGGED)

_TYPED_RAW = """SELECT CAST(replace("timestamp", ' UTC', '') AS TIMESTAMP) AS "timestamp", CAST(user_id AS BIGINT) AS user_id,
       pixel_color, coordinate"""
ORACLE_SQL["csv_inferred"] = _w(f"{_TYPED_RAW} FROM raw", RAW_CTE)
ORACLE_SQL["table_load_persistent"] = _w(
    f"""{_TYPED_RAW}, 'timestamp timestamp_ntz, user_id bigint, pixel_color string, coordinate string' AS types,
       (SELECT count(*) FROM events) AS row_count FROM raw""",
    RAW_CTE,
)
ORACLE_SQL["bucketed_user_counts"] = _w("SELECT user_id, count(*) AS placements FROM raw GROUP BY 1", RAW_CTE)
ORACLE_SQL["csv_quarantine"] = _w(
    """SELECT CASE WHEN ok THEN 'good' ELSE 'bad' END AS status, user_id,
       CASE WHEN ok THEN CAST(replace("timestamp", ' UTC', '') AS TIMESTAMP) END AS "timestamp",
       CASE WHEN ok THEN CAST(split_part(coordinate, ',', 1) AS INTEGER) END AS x_coord,
       CASE WHEN ok THEN CAST(split_part(coordinate, ',', 2) AS INTEGER) END AS y_coord,
       CASE WHEN NOT ok THEN CASE WHEN CAST(user_id AS BIGINT) % 11 = 0 THEN replace("timestamp", ' UTC', '+02:00') ELSE "timestamp" END END AS time_text,
       CASE WHEN NOT ok THEN CASE WHEN CAST(user_id AS BIGINT) % 7 = 0 THEN split_part(coordinate, ',', 1) ELSE coordinate END END AS coordinate
FROM (SELECT *, CAST(user_id AS BIGINT) % 7 <> 0 AND CAST(user_id AS BIGINT) % 11 <> 0 AS ok FROM raw)""",
    RAW_CTE,
)
ORACLE_SQL["latest_export"] = _w("SELECT *, (SELECT count(*) FROM events) AS committed_rows FROM canvas")

ORACLE_SQL["points_by_bitmap"] = _w(
    "SELECT canvas.* FROM canvas JOIN busy USING (x_coord, y_coord)",
    f"busy AS (SELECT x_coord, y_coord FROM canvas GROUP BY 1, 2 HAVING count(*) >= {BUSY})",
)
ORACLE_SQL["hourly_map"] = _w(
    """SELECT hour, CAST(count(*) AS INTEGER) AS points, string_agg(pixel || '=' || CAST(placement_count AS VARCHAR), '; ' ORDER BY pixel) AS counts
FROM s GROUP BY hour""",
    *_SERIES_CTES,
)
ORACLE_SQL["block_users_sketched"] = _w(
    " UNION ALL ".join(
        f"""SELECT {BLOCK * f} AS size, CAST(floor(x_coord / {BLOCK * f}) AS INTEGER) AS block_x, CAST(floor(y_coord / {BLOCK * f}) AS INTEGER) AS block_y,
       count(*) AS placements, count(DISTINCT user_id_encoded) AS unique_users, true AS within_error FROM canvas GROUP BY 2, 3"""
        for f in (1, 2, 5)
    )
)

NO_ORACLE: set[str] = set()
