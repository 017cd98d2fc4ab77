"""Session settings the plans in this package count on."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Times are compared as UTC wall clock. Join skew is left to adaptive execution, and the force
# flag lets it split a hot key even where a second join on the same key must then shuffle again.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Batches of rows that go to Python are bounded by bytes, so that long texts fit in a worker.
BATCH_SETTINGS = {"spark.sql.execution.arrow.maxBytesPerBatch": str(1 << 19)}

LEGACY_DATE_SETTINGS = {
    "spark.sql.parquet.datetimeRebaseModeInRead": "LEGACY",
    "spark.sql.parquet.int96RebaseModeInWrite": "LEGACY",
}


def configure(spark: SparkSession, legacy_dates: bool = False) -> SparkSession:
    """Apply the runtime settings to a session that already exists."""
    settings = RUNTIME_SETTINGS | BATCH_SETTINGS | (LEGACY_DATE_SETTINGS if legacy_dates else {})
    for key, value in settings.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def hashed_joins(spark: SparkSession) -> Iterator[None]:
    """In the body, a join whose smaller side was written in shuffle partitions of at most 64 MB each
    hashes that side instead of sorting both. Hot keys of the other side are split as before."""
    key = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "64MB")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def bound_batches(spark: SparkSession) -> SparkSession:
    """The one setting that Python functions over texts need, always the same, in a session that is
    otherwise left as it is."""
    for key, value in BATCH_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app: str = "pulse",
    *,
    master: str | None = None,
    legacy_dates: bool = False,
    shuffle_partitions: int | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session. Set `shuffle_partitions` so that a shuffle partition stays near
    200 MB at the expected volume; adaptive execution merges the ones that turn out small."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return configure(builder.getOrCreate(), legacy_dates)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: `spark.checkpoint.dir`.

    Only where everything runs on one machine does a temporary folder do instead."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not re.fullmatch(r"local(\[.*\])?", context.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder all machines share")
            folder = tempfile.mkdtemp(prefix="checkpoints-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, deleted when the session's JVM ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4()}"
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = location.getFileSystem(spark._jsc.hadoopConfiguration())
    # Only what exists can be marked.
    files.mkdirs(location)
    files.deleteOnExit(location)
    return path
