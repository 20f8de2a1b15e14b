"""Session helpers: a local session for tests and the shared table folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


#: Temporary folders of local sessions without a shared folder, by application.
_fallback: dict[str, str] = {}


def local_session(cores: int = 8, app: str = "gradewell", memory: str = "4g", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.files.openCostInBytes", str(1 << 20))
        .config("spark.sql.codegen.cache.maxEntries", "2000")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        application = spark.sparkContext.applicationId
        if application not in _fallback:
            _fallback[application] = tempfile.mkdtemp(prefix="gradewell-")
        return _fallback[application]
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for the time of a block; what was there before comes back."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def scale_settings(input_bytes: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Session settings for an input size: shuffle partitions of a size a task can sort in memory.

    Adaptive execution merges partitions that turn out small and splits those a
    hot key makes large.
    """
    partitions = max(200, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.codegen.cache.maxEntries": "2000",
    }
