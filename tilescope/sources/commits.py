"""A stable name for the newest finished export (SNK2).

``commit`` looks at a finished export, writes a manifest beside its data and then moves a
small pointer file into place by one rename.  Readers follow the pointer, so an export
that failed, or is still being written, is never read, and a reader that has resolved the
pointer keeps its export while a newer one is committed.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINTER = "latest.json"
MANIFEST = "_manifest.json"  # readers of the data skip names with an underscore


@dataclass(frozen=True)
class Manifest:
    path: str  # of the export
    files: int
    bytes: int
    rows: int
    committed: str  # UTC


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def _put(spark: SparkSession, path: str, text: str) -> None:
    fs, target = _fs(spark, path)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def _get(spark: SparkSession, path: str) -> str | None:
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def _replace(spark: SparkSession, source: str, target: str) -> None:
    """Rename over the target in one step; a store without such a rename gets one whole put."""
    sc = spark.sparkContext
    jvm, conf = sc._jvm, sc._jsc.hadoopConfiguration()
    a, b = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    try:
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(b.toUri(), conf)
    except Exception as e:  # noqa: BLE001 - object stores: the put of one object is atomic
        if "UnsupportedFileSystem" not in str(e):
            raise
        _put(spark, target, _get(spark, source))
        b.getFileSystem(conf).delete(a, False)
        return
    kinds = jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename").getEnumConstants()
    options = sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = next(k for k in kinds if k.toString() == "OVERWRITE")
    context.rename(context.makeQualified(a), context.makeQualified(b), options)


def _files(spark: SparkSession, path: str) -> tuple[int, int]:
    """(number, bytes) of the data files under ``path``."""
    fs, root = _fs(spark, path)
    found, size = 0, 0
    entries = fs.listFiles(root, True)
    while entries.hasNext():
        entry = entries.next()
        if not entry.getPath().getName().startswith(("_", ".")):
            found, size = found + 1, size + entry.getLen()
    return found, size


def commit(spark: SparkSession, directory: str, path: str, pointer: str = POINTER) -> Manifest:
    """Make the finished export ``path`` the one that ``directory``'s pointer names.

    An export without its ``_SUCCESS`` mark is refused.
    """
    fs, root = _fs(spark, path)
    if not fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root, "_SUCCESS")):
        raise ValueError(f"{path} is not a finished export")
    files, size = _files(spark, path)
    rows = spark.read.parquet(path).count() if files else 0  # from the footers
    manifest = Manifest(path, files, size, rows, datetime.now(timezone.utc).isoformat())
    text = json.dumps(asdict(manifest))
    _put(spark, f"{path.rstrip('/')}/{MANIFEST}", text)
    waiting = f"{directory.rstrip('/')}/_{pointer}.{root.getName()}"
    _put(spark, waiting, text)
    _replace(spark, waiting, f"{directory.rstrip('/')}/{pointer}")
    return manifest


def committed(spark: SparkSession, directory: str, pointer: str = POINTER) -> Manifest | None:
    """The manifest of the export that the pointer names; None if nothing was committed."""
    text = _get(spark, f"{directory.rstrip('/')}/{pointer}")
    return Manifest(**json.loads(text)) if text else None


def read_latest(spark: SparkSession, directory: str, pointer: str = POINTER) -> DataFrame:
    """The newest committed export; raises if there is none, or if files of it are missing."""
    manifest = committed(spark, directory, pointer)
    if manifest is None:
        raise FileNotFoundError(f"no committed export in {directory}")
    if _files(spark, manifest.path) != (manifest.files, manifest.bytes):
        raise ValueError(f"the files of {manifest.path} are not those that were committed")
    return spark.read.parquet(manifest.path)


def manifest_frame(spark: SparkSession, directory: str, pointer: str = POINTER) -> DataFrame:
    """files and rows of the newest committed export, as a row."""
    manifest = committed(spark, directory, pointer)
    if manifest is None:
        raise FileNotFoundError(f"no committed export in {directory}")
    return spark.range(1).select(F.lit(manifest.files).cast("long").alias("files"), F.lit(manifest.rows).cast("long").alias("rows"))
