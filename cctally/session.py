"""Session helpers.

Jobs never create their own session on a cluster; they take the one they are
given.  ``local_session`` exists for tests and benchmarks only.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed ones.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


def local_session(app: str = "cctally", cores: int | str = "*",
                  shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks (UI off, fixed time zone)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is configured by the platform and only read here.
    When it is unset (local tests) a private folder is created and set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith(("local[", "local")) or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        # only a local session (tests) gets here; a cluster names its folder
        configured = tempfile.mkdtemp(prefix="cctally-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


#: Lets a query's shuffle files go when the query ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries run inside leave no shuffle files behind.

    For a step whose written table is read from then on: without it the files
    stay until the driver happens to collect its garbage, so those of several
    steps lie on disk at once.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def staging_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder, for staged tables."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "staging", f"{name}-{uuid.uuid4().hex[:12]}")
