"""Column roles, size bounds and shared-storage helpers.

Every operator is written against *roles* (time, user, category, x, y) rather
than fixed names, so it runs on any event log with those five columns.  The
defaults are the names of the compacted placement table.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Columns:
    time: str = "timestamp"
    user: str = "user_id_encoded"
    category: str = "pixel_color"
    x: str = "x_coord"
    y: str = "y_coord"


CANVAS = Columns()

# A side is broadcast only when its row count is known up front (a Python
# list, a top-k, a count read from a checkpoint) and stays below this bound.
# Anything else goes through a shuffle join and AQE decides at run time from
# measured shuffle sizes.
BROADCAST_ROW_LIMIT = 1_000_000


def broadcast_if_bounded(df: DataFrame, rows: int | None, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Hint a broadcast only for a side whose size bound is proven."""
    if rows is not None and rows <= limit:
        return F.broadcast(df)
    return df


TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Bytes of the files ``df`` reads: the sum over its file-scan leaves.

    Join and aggregate estimates of the optimizer can be off by orders of
    magnitude; the sizes of the scanned files come from the file listing
    and are exact.  ``None`` when the plan reads no files.
    """
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves().iterator()
        total = 0
        while leaves.hasNext():
            leaf = leaves.next()
            if leaf.getClass().getSimpleName() == "LogicalRelation":
                total += int(str(leaf.stats().sizeInBytes()))
        return total or None
    except Exception:  # noqa: BLE001 - an estimate is optional
        return None


def target_partitions(df: DataFrame, bytes_per_partition: int = TARGET_PARTITION_BYTES) -> int:
    """Partition count for an explicit repartition: enough for ~``bytes_per_partition``
    of scanned input each, never fewer than ``spark.sql.shuffle.partitions``."""
    floor = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = estimated_bytes(df)
    if size is None or size <= 0:
        return floor
    return max(floor, -(-size // bytes_per_partition))


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and scratch output.

    Taken from the session (``spark.checkpoint.dir`` or an already set
    checkpoint dir).  Only a local-mode session without one gets a private
    temporary folder; on a cluster an unset value is an error, since a
    machine-local folder would be lost with its executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tilescope-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder and cut its lineage.

    Used for small aggregated results that a plan reads several times (a
    scalar subquery plus the main query), so the base table is scanned once.
    A reliable checkpoint survives the loss of the executors that wrote it.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique output path under the shared checkpoint folder."""
    root = checkpoint_dir(spark).rstrip("/")
    return f"{root}/tilescope-scratch/{name}-{uuid.uuid4().hex[:12]}"


def session_defaults() -> dict[str, str]:
    """Settings the library expects from the caller's session."""
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
    }


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "tilescope") -> SparkSession:
    """Session for tests and the bench (the library never creates one)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TILESCOPE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tilescope-wh-"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in session_defaults().items():
        builder = builder.config(k, v)
    event_log = os.environ.get("TILESCOPE_EVENT_LOG")  # stage / task times without the UI
    if event_log:
        os.makedirs(event_log, exist_ok=True)
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark
