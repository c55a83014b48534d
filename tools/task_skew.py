"""Largest per-task work of the session and gap operators on skewed data.

Usage: python tools/task_skew.py [sf_dir] [out_dir]

Derives two tables from ``events``: one where a single user holds half of
all rows (the canvas plus a copy assigned to one user), one where a single
point does (the copy placed at (0, 0)).  Runs each variant with Spark's
event log on and reports the largest number of shuffle records a single task
read, and the total.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parents[1] / "tests")]

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def variants(hot_user, hot_point):
    from tilescope.operators.blocks import block_unique_users, top_blocks
    from tilescope.operators.histogram import user_histogram
    from tilescope.operators.points import top_categories_at, top_points
    from tilescope.operators.sessions import event_gaps, sessions

    from plain_forms import sessions_by_window

    w = Window.partitionBy("user_id_encoded").orderBy("timestamp")
    at_origin = (F.col("x_coord") == 0) & (F.col("y_coord") == 0)
    return {
        "hot user: sessions (bucket summaries)": lambda: sessions(hot_user),
        "hot user: Spark session_window per user": lambda: sessions_by_window(hot_user),
        "hot user: event_gaps (slices of 20k rows)": lambda: event_gaps(hot_user, rows_per_slice=20_000),
        "hot user: plain lag per user": lambda: hot_user.select("user_id_encoded", "timestamp", F.lag("timestamp").over(w)),
        "hot point: block_unique_users": lambda: block_unique_users(hot_point),
        "hot point: top_blocks (dense grid)": lambda: top_blocks(hot_point),
        "hot point: top_points": lambda: top_points(hot_point),
        "hot point: top_categories_at": lambda: top_categories_at(hot_point, [(0, 0), (704, 0)]),
        "hot point: user_histogram at the point": lambda: user_histogram(hot_point, at_origin),
        "hot point: plain rows per point (no combine)": lambda: hot_point.repartition("x_coord", "y_coord"),
    }


def _lines(path: str):
    if path.endswith(".zstd"):
        import io

        import zstandard

        with open(path, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="tilescope-skew-")
    os.environ["TILESCOPE_EVENT_LOG"] = f"{out}/events"
    from tilescope.config import local_session
    from tilescope.sources.canvas import read_canvas

    spark = local_session(8, 16, app="tilescope-skew")
    # Keep the hash partitions as planned: at this size AQE would merge them all
    # into one task and hide where the work goes.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    canvas = read_canvas(spark, sf_dir)
    hot_user = canvas.unionByName(canvas.withColumn("user_id_encoded", F.lit(-1).cast("bigint")))
    hot_point = canvas.unionByName(canvas.withColumn("x_coord", F.lit(0)).withColumn("y_coord", F.lit(0)))
    rows = canvas.count() * 2
    built = variants(hot_user, hot_point)
    names = list(built)
    for name, build in built.items():
        spark.sparkContext.setJobDescription(name)
        build().write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobDescription(None)
    spark.stop()

    stage_owner: dict[int, str] = {}
    per_task: dict[str, list[int]] = {n: [] for n in names}
    for path in glob.glob(f"{out}/events/**/*", recursive=True):
        if os.path.isdir(path) or "appstatus" in os.path.basename(path):
            continue
        for line in _lines(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                desc = (ev.get("Properties") or {}).get("spark.job.description")
                if desc in per_task:
                    for sid in ev.get("Stage IDs", []):
                        stage_owner[sid] = desc
            elif kind == "SparkListenerTaskEnd":
                owner = stage_owner.get(ev.get("Stage ID"))
                metrics = ev.get("Task Metrics") or {}
                read = (metrics.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                if owner and read:
                    per_task[owner].append(read)
    print(f"input rows: {rows}; the hot user (or point) holds {rows // 2}")
    print("| variant | largest task (shuffle records read) | all shuffle records read |")
    print("| --- | --- | --- |")
    for name in names:
        reads = per_task[name]
        print(f"| {name} | {max(reads) if reads else 0:,} | {sum(reads):,} |")


if __name__ == "__main__":
    main()
