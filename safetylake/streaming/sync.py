"""A keyed copy of a published table, kept in sync from its change feed.

The copy is a Parquet folder partitioned by a hash of the primary key. Every
row remembers the commit version that last changed its key, and a deleted key
stays as a row that is not live. So the copy itself is the state of the sync:

* applying a feed reads and rewrites only the partitions that hold a key of the
  feed (dynamic partition overwrite), whatever the size of the copy, and what
  it replaces is removed;
* for each key the highest version wins, between the feed and the copy as well
  as inside the feed, so commits may come late, in any order, in any grouping
  into micro-batches, or again.

A trigger is a streaming query with ``trigger(availableNow=True)`` over the feed
files (``start_sync``) or over the log of pipeline runs (``follow_runs``). A
batch that failed half way is run again by Spark; partitions that were already
replaced then come out the same. Readers during a write may see some
partitions before and some after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from safetylake.operators.changes import CHANGE_TYPE, COMMIT_VERSION, DELETE, PRE, latest_changes, snapshot_diff
from safetylake.session import snapshot

__all__ = ["COMMIT_VERSION", "apply_feed", "current", "follow_runs", "latest_changes", "publish_changes", "seed", "start_sync"]

#: Partitions of a copy; choose it so that one is some hundred MB. It is part of the folder's name.
BUCKETS = 64

LIVE, BUCKET = "_live", "_bucket"


def publish_changes(old: DataFrame, new: DataFrame, keys: list[str], version: int, feed_dir: str) -> None:
    """Append the diff between two snapshots to the feed folder as one commit."""
    feed = snapshot_diff(old, new, keys).withColumn(COMMIT_VERSION, F.lit(version).cast("long"))
    feed.write.mode("append").parquet(feed_dir)


def _folder(copy_dir: str, buckets: int) -> str:
    return f"{copy_dir.rstrip('/')}/of-{buckets}"


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def seed(base: DataFrame, keys: list[str], copy_dir: str, version: int = 0, buckets: int = BUCKETS) -> None:
    """Start a copy from a whole table as of commit ``version``."""
    rows = base.withColumns({COMMIT_VERSION: F.lit(version).cast("long"), LIVE: F.lit(True), BUCKET: _bucket(keys, buckets)})
    rows.limit(0).write.parquet(f"{copy_dir.rstrip('/')}/schema")        # a copy may start without rows
    rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(_folder(copy_dir, buckets))


def _held(spark: SparkSession, copy_dir: str, buckets: int) -> DataFrame:
    schema = spark.read.parquet(f"{copy_dir.rstrip('/')}/schema").schema
    return spark.read.schema(schema).parquet(_folder(copy_dir, buckets))


def current(spark: SparkSession, copy_dir: str, buckets: int = BUCKETS) -> DataFrame:
    """The live rows of the copy."""
    return _held(spark, copy_dir, buckets).filter(LIVE).drop(LIVE, BUCKET, COMMIT_VERSION)


def apply_feed(feed: DataFrame, keys: list[str], copy_dir: str, buckets: int = BUCKETS) -> list[int]:
    """Apply change rows of any commits to the copy; the partitions that were rewritten."""
    spark = feed.sparkSession
    held = _held(spark, copy_dir, buckets)
    data = [c for c in held.columns if c not in (LIVE, BUCKET)]
    rows = (feed.filter(F.col(CHANGE_TYPE) != PRE)
            .select(*data, (F.col(CHANGE_TYPE) != DELETE).alias(LIVE), _bucket(keys, buckets).alias(BUCKET)))
    rows = snapshot(rows, "sync-feed")          # read twice below, and a stream's batch should be read once
    touched = sorted(r[0] for r in rows.select(BUCKET).distinct().collect())        # at most ``buckets`` numbers
    if touched:
        rest = [c for c in data if c not in keys and c != COMMIT_VERSION]
        both = held.filter(F.col(BUCKET).isin(touched)).select(*data, LIVE, BUCKET).unionByName(rows)
        # one aggregate by key; a key changed in many commits leaves each task as one row
        last = both.groupBy(BUCKET, *keys).agg(
            F.max_by(F.struct(*rest, LIVE), COMMIT_VERSION).alias("_row"), F.max(COMMIT_VERSION).alias(COMMIT_VERSION))
        out = last.select(*[F.col(f"_row.{c}").alias(c) if c in rest else F.col(c) for c in data],
                          F.col(f"_row.{LIVE}").alias(LIVE), BUCKET)
        (out.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BUCKET).parquet(_folder(copy_dir, buckets)))
    return touched


def start_sync(spark: SparkSession, feed_dir: str, feed_schema, copy_dir: str, keys: list[str], checkpoint: str,
               buckets: int = BUCKETS) -> StreamingQuery:
    """Run a triggered sync over all feed files not yet applied; returns the query."""
    return (spark.readStream.schema(feed_schema).parquet(feed_dir)
            .writeStream.foreachBatch(lambda batch, _: apply_feed(batch, keys, copy_dir, buckets) and None)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def follow_runs(spark: SparkSession, root: str, name: str, copy_dir: str, checkpoint: str,
                buckets: int = BUCKETS) -> StreamingQuery:
    """Run a triggered sync of a published dataset over all pipeline runs not yet applied.

    What is streamed is the log of runs, so a run's changes are read when, and
    only if, it was published.
    """
    from safetylake.plans import pipeline, runs

    keys = list(pipeline.BY_NAME[name].primary_key)

    def apply_runs(batch: DataFrame, _: int) -> None:
        paths = [f"{root.rstrip('/')}/{r.folder}/_changes/{name}" for r in batch.select("folder").collect()]    # a row a run
        if paths:
            apply_feed(batch.sparkSession.read.parquet(*paths), keys, copy_dir, buckets)

    return (spark.readStream.schema(runs.SCHEMA).parquet(f"{root.rstrip('/')}/_runs")
            .writeStream.foreachBatch(apply_runs)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
