"""Session helpers: build a local session for tests/bench and resolve the
shared checkpoint folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import contextlib
import tempfile
from collections.abc import Iterator

from pyspark.sql import SparkSession

_BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside give their shuffle files back as each ends, not when the driver next collects garbage.

    For jobs whose result is stored or returned (a write, a checkpoint): nothing reads their shuffles again.
    The session's own setting comes back afterwards."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "dealscope",
                  driver_memory: str = "16g") -> SparkSession:
    """Local session for tests and the benchmark (never used on a cluster)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app).config("spark.driver.memory", driver_memory)
    for k, v in _BASE_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is; a cluster without it is refused.  Only in local mode (tests, bench,
    one machine) a scratch folder is created where it is unset.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.master != "local" and not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    scratch = tempfile.mkdtemp(prefix="dealscope-ckpt-")
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir() or scratch
