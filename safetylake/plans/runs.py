"""Versioned runs of the pipeline: every run is a snapshot, and published tables carry a change feed.

A run builds all datasets in a folder of its own, so the tables of the run
before stay readable and unchanged while it works. When all are written, the
change feed of every dataset that keeps one is taken between the two
versions, and one row is appended to ``_runs``: that row is the pointer, and
appending it (one file, renamed into place when the job commits) is what
switches readers to the new run. A run that fails before has no row and is
never seen; running again starts a new folder. One publisher at a time.

    runs.publish(spark, {"products": ..., "enforcement": ..., "adverse": ...}, root)
    runs.table(spark, root, "gold_product_catalog")                 # the current version
    runs.feed(spark, root, "gold_product_catalog", since=3)         # changes of versions 4, 5, ...
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from safetylake.operators import changes
from safetylake.plans import pipeline

SCHEMA = "version bigint, folder string, published_at timestamp"


@dataclass(frozen=True)
class Run:
    version: int
    path: str


def _log(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(SCHEMA).parquet(f"{root.rstrip('/')}/_runs")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def published(spark: SparkSession, root: str) -> list[Run]:
    """All runs that were published and not removed, oldest first (one row a run, so the list is short)."""
    log = _log(spark, root)
    rows = [] if log is None else log.orderBy("version").collect()
    if len({r.version for r in rows}) < len(rows):
        raise ValueError(f"two runs under {root} were published as one version")
    return [Run(r.version, f"{root.rstrip('/')}/{r.folder}") for r in rows]


def current(spark: SparkSession, root: str) -> Run | None:
    runs = published(spark, root)
    return runs[-1] if runs else None


def _at(spark: SparkSession, root: str, version: int | None) -> Run:
    runs = published(spark, root)
    found = [r for r in runs if version in (None, r.version)]
    if not found:
        raise ValueError(f"{root} has no run" + ("" if version is None else f" of version {version}"))
    return found[-1]


def table(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """A dataset as of the current run, or of ``version``."""
    return spark.read.parquet(f"{_at(spark, root, version).path}/{name}")


def paths(spark: SparkSession, root: str, version: int | None = None) -> dict[str, str]:
    """Dataset name -> Parquet path of one run, as ``pipeline.register_tables`` takes it."""
    run = _at(spark, root, version)
    return {d.name: f"{run.path}/{d.name}" for d in pipeline.DATASETS}


def publish(spark: SparkSession, sources: dict[str, str], root: str, **options) -> Run:
    """Build all datasets from ``sources``, write the change feeds, switch readers to the new version.

    ``options`` go to ``pipeline.run``. The first run's feeds hold every row as
    an insert, so a copy can be built from feeds alone.
    """
    root = root.rstrip("/")
    before = current(spark, root)
    version = before.version + 1 if before else 1
    folder = f"run-{version:08d}-{uuid.uuid4().hex[:8]}"
    run = Run(version, f"{root}/{folder}")
    pipeline.run(spark, sources, run.path, **options)
    for ds in pipeline.DATASETS:
        if ds.change_feed:
            new = spark.read.parquet(f"{run.path}/{ds.name}")
            if before:
                rows = changes.snapshot_diff(spark.read.parquet(f"{before.path}/{ds.name}"), new, list(ds.primary_key))
            else:
                rows = new.withColumn(changes.CHANGE_TYPE, F.lit(changes.INSERT))
            rows.withColumn(changes.COMMIT_VERSION, F.lit(version).cast("bigint")).write.parquet(f"{run.path}/_changes/{ds.name}")
    (spark.range(1).select(F.lit(version).cast("bigint").alias("version"), F.lit(folder).alias("folder"),
                           F.current_timestamp().alias("published_at"))
     .coalesce(1).write.mode("append").parquet(f"{root}/_runs"))
    return run


def feed(spark: SparkSession, root: str, name: str, since: int = 0, until: int | None = None) -> DataFrame:
    """Change rows of ``name`` published after version ``since`` (up to ``until``), with ``_commit_version``."""
    if not pipeline.BY_NAME[name].change_feed:
        raise ValueError(f"{name} keeps no change feed")
    wanted = [r for r in published(spark, root) if r.version > since and (until is None or r.version <= until)]
    if not wanted:
        shape = table(spark, root, name).withColumns({changes.CHANGE_TYPE: F.lit(""), changes.COMMIT_VERSION: F.lit(0).cast("bigint")})
        return shape.limit(0)
    return reduce(DataFrame.unionByName, [spark.read.parquet(f"{r.path}/_changes/{name}") for r in wanted])
