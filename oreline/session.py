"""Session settings and the shared folder for tables that cut lineage."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Recording the Python call site of every column expression doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(app_name: str = "oreline", cpus: int | str = "*", **extra: str) -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings its own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app_name)
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


SHUFFLE_TARGET = 1024**3


def fit_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Raise the number of shuffle partitions so that none gets more than its share of the input.

    The number is only ever raised: adaptive execution merges small partitions but cannot split
    those of a plain aggregation, and the default of 200 leaves 500 GB each for 100 TB.
    """
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    needed = max(current, -(-input_bytes // SHUFFLE_TARGET))
    if needed > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(needed))
    return needed


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of each action as it ends.

    Otherwise they stay until the driver collects its garbage, which it does by its own memory and not by the disks of the executors.
    """
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)


_scratch: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a session that names none (a test on one machine) gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _scratch:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        _scratch[app] = tempfile.mkdtemp(prefix="oreline-")
    return _scratch[app]
