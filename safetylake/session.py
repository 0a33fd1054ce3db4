"""Session helpers: building a local session and locating shared scratch space.

Library code never creates a session on its own; callers pass one in. The
helpers here are for tests, the benchmark and command-line use.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "safetylake") -> SparkSession:
    """A local-mode session configured the way the tests and benchmark expect."""
    parts = shuffle_partitions or (os.cpu_count() if cores == "*" else int(cores))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SAFETYLAKE_DRIVER_MEMORY", "8g"))
    )
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and landed files.

    Read from ``spark.checkpoint.dir`` (a startup setting of the cluster; it
    cannot be changed at runtime). Only a local session that has none gets a
    fresh temporary folder; on any other master its absence is an error, as
    executors could not read the driver's folder.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None)
    try:
        sc = spark.sparkContext
    except Exception:        # Spark Connect: the server owns the context and its folder
        if not path:
            raise RuntimeError(f"{CHECKPOINT_CONF} is not set on the server") from None
        return path.rstrip("/")
    if path:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(path)
        return path.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="safetylake-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique sub-path of the shared folder for one landing or snapshot."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def snapshot(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts lineage, and
    later reads still prune columns and push filters down."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable, eager checkpoint into the shared folder (never a local one).

    Cuts lineage: later stages restart from these files, and a lost executor
    does not force recomputation of everything upstream.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
