"""The hourly and session operators over a Structured Streaming source."""

from conftest import SF_SMALL, rows

from tilescope.operators.series import hourly_counts
from tilescope.operators.sessions import sessions
from tilescope.sources.canvas import CANVAS_SCHEMA, read_canvas
from tilescope.streaming.live import hourly_counts_stream, sessions_stream


def run_stream(spark, df, tmp_path, name):
    q = df.writeStream.outputMode("append").format("memory").queryName(name).start()
    q.processAllAvailable()
    q.stop()
    return spark.table(name)


def test_stream_matches_batch(spark, tmp_path):
    batch = read_canvas(spark, SF_SMALL)
    src = str(tmp_path / "src")
    batch.write.parquet(src)
    stream = spark.readStream.schema(CANVAS_SCHEMA).parquet(src)
    hourly = run_stream(spark, hourly_counts_stream(stream, watermark="0 seconds"), tmp_path, "hourly_out")
    # with a zero watermark every hour but the last closes inside the batch
    got = rows(hourly)
    expected = rows(hourly_counts(batch))
    assert got and set(got) <= set(expected)
    assert len(got) >= len(expected) - 5
    sess = run_stream(spark, sessions_stream(stream, watermark="0 seconds"), tmp_path, "sess_out")
    got_s = set(rows(sess))
    assert got_s and got_s <= set(rows(sessions(batch)))


def test_session_stream_watermark_drops_late_rows(spark, tmp_path, canvas):
    src = str(tmp_path / "live")
    batch1 = [
        ("2022-04-02 10:00:00", 1, 0, 0, "a"),
        ("2022-04-02 10:05:00", 1, 0, 0, "a"),
        ("2022-04-02 12:00:00", 3, 0, 0, "a"),  # moves the watermark to 11:50
    ]
    canvas(batch1).write.parquet(f"{src}/b1")
    stream = spark.readStream.schema(CANVAS_SCHEMA).option("recursiveFileLookup", "true").parquet(src)
    q = (
        sessions_stream(stream, watermark="10 minutes")
        .writeStream.outputMode("append")
        .format("memory")
        .queryName("live_sessions")
        .option("checkpointLocation", str(tmp_path / "ckpt"))
        .start()
    )
    try:
        q.processAllAvailable()
        canvas([("2022-04-02 10:10:00", 1, 0, 0, "a")]).write.parquet(f"{src}/b2")  # later than the watermark
        q.processAllAvailable()
    finally:
        q.stop()
    got = rows(spark.table("live_sessions").select("user_id_encoded", "events", "length_us"))
    assert got == [(1, 2, 300_000_000)]
