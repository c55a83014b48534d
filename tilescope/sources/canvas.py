"""Typed canvas tables: the compacted schema and the view over ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilescope.config import CANVAS

CANVAS_SCHEMA = T.StructType(
    [
        T.StructField(CANVAS.time, T.TimestampNTZType()),
        T.StructField(CANVAS.user, T.LongType()),
        T.StructField(CANVAS.x, T.IntegerType()),
        T.StructField(CANVAS.y, T.IntegerType()),
        T.StructField(CANVAS.category, T.StringType()),
    ]
)


def canvas_from_events(events: DataFrame) -> DataFrame:
    """Map the generic ``events`` table onto the canvas roles.

    time = ts, user = user_id, category = event_type,
    x = 100*(k % 20) + floor(k / 20) with k = int(props.$.k),
    y = 30 * floor(value / 10).
    Only a projection: Catalyst prunes ``props``/``value`` when x/y are unused.
    """
    k = F.get_json_object(F.col("props"), "$.k").cast("int")
    return events.select(
        F.col("ts").cast("timestamp_ntz").alias(CANVAS.time),
        F.col("user_id").cast("bigint").alias(CANVAS.user),
        (F.lit(100) * (k % 20) + F.floor(k / F.lit(20))).cast("int").alias(CANVAS.x),
        (F.lit(30) * F.floor(F.col("value") / F.lit(10))).cast("int").alias(CANVAS.y),
        F.col("event_type").alias(CANVAS.category),
    )


def read_events(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def read_canvas(spark, sf_dir: str) -> DataFrame:
    return canvas_from_events(read_events(spark, sf_dir))
