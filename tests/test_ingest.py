"""R2/R3: CSV scan, load into a table, compaction, export (F8, SNK1-SNK3)."""

from datetime import datetime

import pyarrow.parquet as pq
import pytest
from conftest import SF_ORACLE, SF_SMALL, rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tilescope.config import materialize, scratch_path
from tilescope.plans.ingest import compact, export, load_log, parse_raw
from tilescope.sources.canvas import read_canvas
from tilescope.sources.raw import RAW_DDL, raw_from_canvas, read_raw_csv, write_raw_csv
from tilescope.sources.sinks import day_layout, export_parquet, stamped_path


def write_csv(tmp_path, lines):
    p = tmp_path / "log.csv"
    p.write_text("timestamp,user_id,pixel_color,coordinate\n" + "\n".join(lines) + "\n")
    return str(p)


def test_quoted_coordinate_csv(spark, tmp_path):
    path = write_csv(tmp_path, ['2022-04-01 12:44:10.315 UTC,u1,#FF4500,"42,43"', '2022-04-01 12:44:11 UTC,u2,#000000,"0,0"'])
    raw = read_raw_csv(spark, path)
    assert rows(raw) == [
        ("2022-04-01 12:44:10.315 UTC", "u1", "#FF4500", "42,43"),
        ("2022-04-01 12:44:11 UTC", "u2", "#000000", "0,0"),
    ]
    typed, _ = parse_raw(raw)
    assert rows(typed)[0] == (datetime(2022, 4, 1, 12, 44, 10, 315000), "u1", "#FF4500", 42, 43)


def test_inferred_schema_gives_ntz(spark, tmp_path):
    path = write_csv(tmp_path, ['2022-04-01 12:44:10.315,u1,#FF4500,"42,43"'])
    df = read_raw_csv(spark, path, infer=True)
    assert dict(df.dtypes)["timestamp"] == "timestamp_ntz"


def test_bad_coordinates(spark):
    raw = spark.createDataFrame(
        [("2022-04-01 00:00:00 UTC", "a", "#000000", c) for c in ["12", "1,2,3,4", "", "5,6", None]], RAW_DDL
    )
    good, bad = parse_raw(raw, "quarantine")
    assert sorted((r[3:] for r in rows(good)), key=repr) == sorted([(1, 2), (5, 6), (None, None)], key=repr)
    assert sorted(r[3] for r in rows(bad)) == ["", "12"]
    strict, _ = parse_raw(raw, "strict")
    with pytest.raises(Exception):
        strict.collect()


def test_compact_roundtrip(spark):
    canvas = read_canvas(spark, SF_SMALL)
    compacted = compact(raw_from_canvas(canvas))
    assert compacted.columns == ["timestamp", "user_id_encoded", "x_coord", "y_coord", "pixel_color"]
    assert dict(compacted.dtypes)["user_id_encoded"] == "bigint"
    path = scratch_path(spark, "t-compact")
    export_parquet(compacted, path, row_group_rows=300)
    back = spark.read.parquet(path).drop("day")
    assert rows(back.drop("user_id_encoded")) == rows(canvas.drop("user_id_encoded"))
    # user codes are dense ranks of the user text
    users = sorted({str(r[0]) for r in canvas.select("user_id_encoded").collect()})
    expected = {u: i + 1 for i, u in enumerate(users)}
    pairs = {(str(a), b) for a, b in canvas.join(back, ["timestamp", "x_coord", "y_coord", "pixel_color"]).select(
        canvas.user_id_encoded, back.user_id_encoded).collect()}
    assert pairs == set(expected.items())


def test_export_layout(spark, tmp_path):
    canvas = read_canvas(spark, SF_SMALL)
    path = export(canvas, str(tmp_path), row_group_rows=300, files=2, day_partitions=False)
    assert "placements_" in path
    files = sorted(p for p in __import__("glob").glob(path + "/*.parquet"))
    assert len(files) == 2
    meta = pq.ParquetFile(files[0]).metadata
    assert meta.num_row_groups >= 2
    assert meta.row_group(0).column(0).compression == "ZSTD"
    assert meta.row_group(0).num_rows <= 300
    # time-sorted files: the second file starts after the first ends
    t0 = pq.read_table(files[0], columns=["timestamp"]).column(0).to_pylist()
    t1 = pq.read_table(files[1], columns=["timestamp"]).column(0).to_pylist()
    assert t0 == sorted(t0) and max(t0) <= min(t1)


def test_stamped_path():
    assert stamped_path("/x", now=datetime(2024, 1, 2, 3, 4, 5)) == "/x/placements_20240102_030405.parquet"


def test_missing_input_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        spark.read.parquet(str(tmp_path / "missing.parquet"))


def test_load_log_view_and_table(spark, tmp_path):
    canvas = read_canvas(spark, SF_SMALL)
    path = str(tmp_path / "csv")
    write_raw_csv(raw_from_canvas(canvas), path)
    t = load_log(spark, path, "log_view")
    assert rows(t.describe()) == sorted(
        [("timestamp", "string"), ("user_id", "string"), ("pixel_color", "string"), ("coordinate", "string")]
    )
    assert t.row_count() == 1000
    p = load_log(spark, path, "log_table", persistent=True)
    assert p.row_count() == 1000
    assert rows(spark.sql("SELECT count(*) FROM log_table")) == [(1000,)]
    with pytest.raises(ValueError):
        load_log(spark, path, "bad;name")


def test_latest_export(spark, tmp_path):
    from tilescope.sources.sinks import latest_export

    canvas = read_canvas(spark, SF_SMALL).limit(5)
    assert latest_export(spark, str(tmp_path)) is None
    a = export(canvas, str(tmp_path), template="placements_20240101_000000.parquet")
    b = export(canvas, str(tmp_path), template="placements_20240102_000000.parquet")
    assert latest_export(spark, str(tmp_path)).endswith(b.rsplit("/", 1)[1])
    assert a != b


def test_export_file_count_follows_size(spark):
    from tilescope.config import estimated_bytes, target_partitions

    canvas = read_canvas(spark, SF_SMALL)
    size = estimated_bytes(canvas)
    assert size and size > 0
    floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert target_partitions(canvas) == floor
    assert target_partitions(canvas, bytes_per_partition=max(1, size // 10)) >= 10


def test_day_directories_prune_ranges(spark, tmp_path):
    import glob

    from tilescope.functions.ranges import TimeRange, time_range

    canvas = read_canvas(spark, SF_SMALL)
    path = export_parquet(canvas, str(tmp_path / "byday"), files=4)
    days = sorted(glob.glob(path + "/day=*"))
    assert len(days) == 30
    for f in glob.glob(path + "/day=*/*.parquet"):
        ts = pq.read_table(f, columns=["timestamp"]).column(0).to_pylist()
        assert ts == sorted(ts)
    table = spark.read.parquet(path)
    assert dict(table.dtypes)["day"] == "date"
    rng = TimeRange.parse("2024-01-10 00", "2024-01-11 06")
    got = time_range(table, rng, day_column="day")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert rows(got.drop("day")) == rows(time_range(canvas, rng))
    assert rows(time_range(table, rng, "left", day_column="day").drop("day")) == rows(time_range(canvas, rng, "left"))
    midnight = TimeRange.parse("2024-01-10 00", "2024-01-12 00")
    left_plan = time_range(table, midnight, "left", day_column="day")._jdf.queryExecution().executedPlan().toString()
    assert "(day#" in left_plan and "<= 2024-01-11)" in left_plan
    assert rows(time_range(table, midnight, "left", day_column="day").drop("day")) == rows(time_range(canvas, midnight, "left"))
    assert rows(time_range(table, midnight, "both", day_column="day").drop("day")) == rows(time_range(canvas, midnight, "both"))


def _file_ranges(path):
    """(first, last, rows) of every file by day, from the footers."""
    import glob
    from collections import defaultdict

    days = defaultdict(list)
    for f in glob.glob(path + "/day=*/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        stats = [meta.row_group(i).column(0).statistics for i in range(meta.num_row_groups)]
        days[f.split("/")[-2]].append((min(x.min for x in stats), max(x.max for x in stats), meta.num_rows) if stats[0].has_min_max else (None, None, meta.num_rows))
    return days


def test_files_of_a_day_follow_each_other_in_time(spark, tmp_path):
    canvas = read_canvas(spark, SF_ORACLE)
    at = lambda df, t: df.withColumn("timestamp", F.lit(t).cast("timestamp_ntz"))
    # a burst in one instant, a burst in one second, and rows without a time
    canvas = canvas.unionAll(at(canvas.limit(300), "2024-01-15 10:10:10")).unionAll(at(canvas.limit(90), None))
    burst = at(canvas.limit(200), "2024-01-16 00:00:00").withColumn("timestamp", F.col("timestamp") + F.expr("make_interval(0, 0, 0, 0, 0, 0, rand(3))"))
    canvas = materialize(canvas.unionAll(burst))
    path = export_parquet(canvas, str(tmp_path / "x"), rows_per_file=50)
    days = _file_ranges(path)
    assert len(days.pop("day=__HIVE_DEFAULT_PARTITION__")) == 2
    assert len(days) == 30
    for day, files in days.items():
        files.sort()
        together = [(a, b) for a, b in zip(files, files[1:]) if a[1] >= b[0]]
        assert len(files) >= 7 and max(n for *_, n in files) <= 100
        # only files of one instant may share it
        assert all(a[1] == b[0] == datetime(2024, 1, 15, 10, 10, 10) for a, b in together), (day, together)
        assert bool(together) == (day == "day=2024-01-15")
    assert rows(spark.read.parquet(path).drop("day")) == rows(canvas)


def test_every_ranged_operator_reads_its_days_only(spark, tmp_path):
    from tilescope.functions.ranges import TimeRange, partition_day
    from tilescope.operators import blocks, frequency, series, sessions, share

    canvas = read_canvas(spark, SF_SMALL)
    table = spark.read.parquet(export_parquet(canvas, str(tmp_path / "x")))
    rng = TimeRange.parse("2024-01-10 00", "2024-01-11 06")
    assert partition_day(table) == "day"
    asked = {
        "summary": lambda df: frequency.top_summary(df, rng),
        "frequency": lambda df: frequency.frequency(df, ["pixel_color"], rng),
        "top": lambda df: frequency.top_frequencies(df, rng),
        "share": lambda df: share.category_share(df, "click", rng),
        "share_at": lambda df: share.category_share_at(df, "click", 704, 0, rng),
        "hours": lambda df: series.hourly_counts(df, [(704, 0), (900, 0)], rng),
        "sessions": lambda df: sessions.sessions(df, rng=rng),
    }
    for name, ask in asked.items():
        plan = ask(table)._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(day" in plan, name
        assert rows(ask(table)) == rows(ask(canvas)), name
    text = frequency.frequency(table.withColumn("timestamp", F.col("timestamp").cast("string")), ["pixel_color"], rng, "text")
    assert "PartitionFilters: []" in text._jdf.queryExecution().executedPlan().toString()


def test_a_day_that_is_not_the_partition_column_prunes_nothing(spark, tmp_path):
    from tilescope.functions.ranges import TimeRange, partition_day, time_range

    canvas = read_canvas(spark, SF_SMALL)
    table = spark.read.parquet(export_parquet(canvas, str(tmp_path / "x")))
    rng = TimeRange.parse("2024-01-10 00", "2024-01-11 06")
    want = rows(time_range(canvas, rng))
    others = [
        table.withColumn("day", F.lit("1999-01-01").cast("date")),
        table.drop("day"),
        table.withColumn("timestamp", F.col("timestamp") + F.expr("interval 0 second")),
        canvas.withColumn("day", F.lit("1999-01-01").cast("date")),
        table.unionByName(table.limit(0).withColumn("day", F.lit("1999-01-01").cast("date"))),
    ]
    for other in others:
        assert partition_day(other) is None
        assert rows(time_range(other, rng).drop("day")) == want
    shifted = table.withColumn("timestamp", F.col("timestamp") + F.expr("interval 5 day"))
    assert time_range(shifted, rng).count() == canvas.filter("timestamp between timestamp_ntz'2024-01-05' and timestamp_ntz'2024-01-06 06:00:00'").count()
    assert partition_day(table.filter("x_coord > 3").alias("t")) == "day"


def test_layout_of_an_empty_table(spark, tmp_path):
    empty = read_canvas(spark, SF_SMALL).limit(0)
    path = export_parquet(empty, str(tmp_path / "x"), day_partitions=False)
    assert spark.read.parquet(path).count() == 0
    assert day_layout(empty).files == 1


def test_ingest_csv_end_to_end(spark, tmp_path):
    from tilescope.plans.ingest import ingest_csv
    from tilescope.sources.sinks import latest_export

    canvas = read_canvas(spark, SF_SMALL)
    csv = str(tmp_path / "log")
    write_raw_csv(raw_from_canvas(canvas), csv)
    out = ingest_csv(spark, csv, str(tmp_path / "out"))
    assert latest_export(spark, str(tmp_path / "out")).endswith(out.rsplit("/", 1)[1])
    back = spark.read.parquet(out)
    assert back.count() == 1000
    assert rows(back.select("timestamp", "x_coord", "y_coord", "pixel_color")) == rows(
        canvas.select("timestamp", "x_coord", "y_coord", "pixel_color")
    )


def test_inferred_utc_text_under_other_session_zone(spark, tmp_path):
    path = write_csv(tmp_path, ['2022-04-01 12:44:10.315 UTC,1,#FF4500,"42,43"'])
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = read_raw_csv(spark, path, infer=True)
        got = df.collect()[0][0]
        typ = dict(df.dtypes)["timestamp"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    if typ == "timestamp_ntz":
        assert got == datetime(2022, 4, 1, 12, 44, 10, 315000)
    else:  # the reader kept it as text
        assert typ == "string"


def test_quarantine_keeps_null_coordinates_as_good_rows(spark):
    raw = spark.createDataFrame(
        [("2022-04-01 00:00:00 UTC", "a", "#000000", None), ("2022-04-01 00:00:01 UTC", "b", "#000000", "x,1")],
        RAW_DDL,
    )
    good, bad = parse_raw(raw, "quarantine")
    assert [r["user_id"] for r in good.collect()] == ["a"]
    assert [r["coordinate"] for r in bad.collect()] == ["x,1"]


def test_a_day_column_of_the_callers_own(spark, tmp_path, canvas):
    from datetime import date

    from pyspark.sql import functions as F
    from tilescope.functions.ranges import TimeRange, time_range

    own = canvas([("2022-04-04 10:30", 1, 0, 0, "red"), ("2022-04-04 10:40", 2, 0, 0, "red")]).withColumn("day", F.lit(date(1999, 1, 1)))
    rng = TimeRange.parse("2022-04-04 10", "2022-04-04 11")
    assert time_range(own, rng).count() == 2
    with pytest.raises(ValueError, match="day"):
        export_parquet(own, str(tmp_path / "x"))


def test_an_unfinished_export_is_not_the_latest(tmp_path, spark):
    from tilescope.sources.sinks import latest_export

    for name, mark in (("placements_1", True), ("placements_2", False)):
        (tmp_path / name / "_temporary").mkdir(parents=True)
        if mark:
            (tmp_path / name / "_SUCCESS").touch()
    assert latest_export(spark, str(tmp_path)).endswith("placements_1")


def test_nulls_stay_null_in_concatenated_text(spark, canvas):
    from tilescope.operators.frequency import key_concat
    from tilescope.sources.raw import raw_from_canvas

    df = canvas([("2022-04-04 10:30", 1, None, 5, None)])
    assert raw_from_canvas(df).first().coordinate is None
    assert key_concat(df, "pixel_color").first().key_count is None


def test_hours_and_text_in_a_skipped_hour(spark, canvas):
    from tilescope.functions.exprs import hour_of
    from tilescope.sources.raw import raw_from_canvas

    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = canvas([(f"2022-03-13 0{h}:30", 1, 0, 0, "red") for h in (1, 2, 3)])
        hours = sorted(str(r[0]) for r in df.select(hour_of("timestamp").cast("string")).collect())
        assert hours == [f"2022-03-13 0{h}:00:00" for h in (1, 2, 3)]
        text = sorted(r.timestamp for r in raw_from_canvas(df).collect())
        assert text == [f"2022-03-13 0{h}:30:00.000000 UTC" for h in (1, 2, 3)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_nulls_on_the_axes_keep_their_counts(spark, canvas):
    from tilescope.operators.blocks import block_counts, block_grid
    from tilescope.operators.series import hourly_counts, hourly_series

    df = canvas([("2022-04-04 10:30", 1, None, None, "red"), ("2022-04-04 11:30", 1, None, 5, "red"), ("2022-04-04 11:40", 1, 5, 5, "red")])
    total = lambda d, c: sum(r[c] for r in d.collect())
    assert total(block_grid(df), "placements") == total(block_counts(df), "placements") == 3
    points = [(5, 5)]
    assert total(hourly_series(df, points), "placement_count") == total(hourly_counts(df, points), "placement_count")


def test_session_mean_beyond_bigint(spark):
    from tilescope.operators.sessions import session_stats

    long = spark.range(4).selectExpr("9000000000000000000L AS length_us")
    assert session_stats(long).first().avg_session_seconds == 9e12


def test_ratio_text_is_exact(spark):
    from pyspark.sql import functions as F
    from tilescope.functions.exprs import ratio_text

    df = spark.createDataFrame([(5343234315116731, 917077201)], "a long, b long")
    assert df.select(ratio_text(F.col("a"), F.col("b"))).first()[0] == "5826373.51"


def test_damaged_lines_raise_or_are_set_aside(spark, tmp_path):
    good = '2022-04-01 12:44:10.315 UTC,u1,#FF4500,"42,43"'
    for bad in ("2022-04-01 12:44:10 UTC,u2", good + ",more", good.replace("2022", "20x2"), good.replace("43", "y")):
        path = write_csv(tmp_path, [good, bad])
        with pytest.raises(Exception):
            parse_raw(read_raw_csv(spark, path))[0].collect()
        kept, aside = parse_raw(read_raw_csv(spark, path, mode="quarantine"), "quarantine")
        assert [r.user_id for r in kept.collect()] == ["u1"] and kept.count() == 1
        assert aside.count() == 1 and "2022" in aside.first().timestamp or "20x2" in aside.first().timestamp
    with pytest.raises(Exception):
        read_raw_csv(spark, write_csv(tmp_path, [good, "2022-04-01 12:44:10 UTC,u2"])).select("user_id").collect()


def test_a_header_in_another_order_raises(spark, tmp_path):
    p = tmp_path / "other.csv"
    p.write_text('user_id,timestamp,pixel_color,coordinate\nu1,2022-04-01 12:44:10 UTC,#FF4500,"42,43"\n')
    for mode in ("strict", "quarantine"):
        with pytest.raises(Exception):
            read_raw_csv(spark, str(p), mode=mode).collect()


def test_inferred_instants_in_a_repeated_hour(spark, tmp_path):
    path = write_csv(tmp_path, [f'2022-11-06T0{h}:30:00.000Z,1,#FF4500,"42,43"' for h in (5, 6)])
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = read_raw_csv(spark, path, infer=True)
        assert dict(df.dtypes)["timestamp"] == "timestamp_ntz"
        assert sorted(str(r[0]) for r in df.select("timestamp").collect()) == [f"2022-11-06 0{h}:30:00" for h in (5, 6)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_a_persistent_load_does_not_overwrite(spark, tmp_path):
    path = write_csv(tmp_path, ['2022-04-01 12:44:10.315 UTC,u1,#FF4500,"42,43"'])
    t = load_log(spark, path, "default.kept_log", persistent=True)
    assert t.row_count() == 1 and t.describe().count() == 4
    with pytest.raises(AnalysisException):
        load_log(spark, path, "default.kept_log", persistent=True)


def test_small_files_share_tasks(spark, tmp_path):
    from tilescope.sources.sinks import laid_out

    canvas = materialize(read_canvas(spark, SF_ORACLE))
    layout = day_layout(canvas, rows_per_file=300)
    assert layout.files > 30 and laid_out(canvas, layout).rdd.getNumPartitions() == 1
    assert laid_out(canvas, day_layout(canvas)).rdd.getNumPartitions() == 30
    path = export_parquet(canvas, str(tmp_path / "x"), rows_per_file=300)
    days = _file_ranges(path)
    assert len(days) == 30 and max(n for f in days.values() for *_, n in f) <= 300
    assert all((len(f) > 1) == (sum(n for *_, n in f) > 300) for f in days.values())
    assert all(a[1] <= b[0] for f in days.values() for a, b in zip(sorted(f), sorted(f)[1:]))
    assert rows(spark.read.parquet(path).drop("day")) == rows(canvas)
