"""Session helpers: building a session for tests/bench and locating shared storage.

Library functions never create sessions; they take the caller's. The only
storage the library writes to is the shared folder named by
``spark.checkpoint.dir`` (the cluster's choice); a local fallback is created
only when that setting is absent, as in tests on ``local[*]``.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Files of a query's shuffles go when it ends, not when the driver's next garbage collection finds them unused.
SHUFFLES_GO_AT_ONCE = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "cadence") -> SparkSession:
    """Session used by tests and bench. On a cluster, the caller's session is used instead."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.ui.retainedExecutions", "50")
        .config("spark.ui.retainedJobs", "100")
        .config("spark.ui.retainedStages", "100")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only when unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    conf_value = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not conf_value:
        if not sc.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        conf_value = tempfile.mkdtemp(prefix="cadence-ckpt-")
    sc.setCheckpointDir(conf_value)
    return sc.getCheckpointDir() or conf_value


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path for a written table under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    # getCheckpointDir appends a per-application uuid folder; tables sit beside RDD checkpoints.
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the time of a block. A streaming query that is started in it keeps them."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def cut_lineage(df):
    """Materialise ``df`` in the shared checkpoint folder and return a frame that
    reads it back: the plan above it no longer repeats (or re-analyses) the
    lineage, and a lost executor does not force recomputation from the sources.
    Used on small, already aggregated intermediates that several branches reuse."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
