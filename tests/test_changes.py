"""Change feed, keyed apply, primary-key checks, triggered streaming sync."""

import os

from pyspark.sql import functions as F

from safetylake.operators import changes
from safetylake.streaming import sync

SCHEMA = "k string, a string, b int"


def snapshots(spark):
    old = spark.createDataFrame([("1", "x", 1), ("2", "y", 2), ("3", "z", None), ("4", "w", 4)], SCHEMA)
    new = spark.createDataFrame([("1", "x", 1), ("2", "Y", 2), ("3", "z", 3), ("5", "n", 5)], SCHEMA)
    return old, new


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_diff_has_all_four_kinds(spark):
    old, new = snapshots(spark)
    got = as_set(changes.snapshot_diff(old, new, ["k"]))
    assert got == {("2", "y", 2, "update_preimage"), ("2", "Y", 2, "update_postimage"),
                   ("3", "z", None, "update_preimage"), ("3", "z", 3, "update_postimage"),
                   ("4", "w", 4, "delete"), ("5", "n", 5, "insert")}


def test_apply_reproduces_new_and_is_idempotent(spark):
    old, new = snapshots(spark)
    feed = changes.snapshot_diff(old, new, ["k"])
    once = changes.apply_changes(old, feed, ["k"])
    assert as_set(once) == as_set(new)
    assert as_set(changes.apply_changes(once, feed, ["k"])) == as_set(new)


def test_pk_violations(spark):
    df = spark.createDataFrame([("1", "a", 1), ("1", "b", 2), (None, "c", 3), ("2", "d", 4)], SCHEMA)
    got = as_set(changes.pk_violations(df, ["k"], "t"))
    assert got == {("t", "1", 2), ("t", "", 1)}


def test_streaming_sync_applies_commits_in_order_and_replays_safely(spark, scratch):
    v0 = spark.createDataFrame([("1", "x", 1), ("2", "y", 2)], SCHEMA)
    v1 = spark.createDataFrame([("1", "x", 10), ("3", "z", 3)], SCHEMA)
    v2 = spark.createDataFrame([("1", "x", 11), ("3", "z", 3), ("4", "q", 4)], SCHEMA)
    feed, copy, ckpt = (f"{scratch}/{n}" for n in ("feed", "copy", "ckpt"))
    sync.seed(v0, ["k"], copy)
    sync.publish_changes(v0, v1, ["k"], 1, feed)
    sync.publish_changes(v1, v2, ["k"], 2, feed)
    schema = spark.read.parquet(feed).schema
    sync.start_sync(spark, feed, schema, copy, ["k"], ckpt).awaitTermination()
    assert as_set(sync.current(spark, copy)) == as_set(v2)
    # a trigger with nothing new, and a replay of everything, keep the copy
    sync.start_sync(spark, feed, schema, copy, ["k"], ckpt).awaitTermination()
    sync.apply_feed(spark.read.parquet(feed), ["k"], copy)
    assert as_set(sync.current(spark, copy)) == as_set(v2)


def commits(spark):
    versions = [spark.createDataFrame(rows, SCHEMA) for rows in (
        [("1", "a", 1), ("2", "b", 2), ("3", "c", 3)],
        [("1", "A", 1), ("3", "c", 3), ("4", "d", None)],          # 2 goes, 4 comes
        [("1", "A", 1), ("2", "again", 2), ("4", "d", 4)],         # 2 is back, 3 goes
        [("1", None, 9), ("2", "again", 2)])]
    return versions, [changes.snapshot_diff(a, b, ["k"]).withColumn(changes.COMMIT_VERSION, F.lit(i).cast("long"))
                      for i, (a, b) in enumerate(zip(versions, versions[1:]), 1)]


def test_commits_out_of_order_late_or_repeated_give_the_last_version(spark, scratch):
    versions, feeds = commits(spark)
    for n, order in enumerate([(2, 0, 1), (1, 2, 0, 1), (2, 1, 0), (0, 2, 2, 1)]):
        copy = f"{scratch}/copy{n}"
        sync.seed(versions[0], ["k"], copy, buckets=4)
        for i in order:
            sync.apply_feed(feeds[i], ["k"], copy, buckets=4)
        assert as_set(sync.current(spark, copy, buckets=4)) == as_set(versions[-1])


def test_streamed_commits_in_the_wrong_order(spark, scratch):
    versions, feeds = commits(spark)
    feed, copy, ckpt = (f"{scratch}/{n}" for n in ("feed", "copy", "ckpt"))
    sync.seed(versions[0], ["k"], copy)
    schema = feeds[0].schema
    for i in (2, 0, 1, 1):          # a trigger after each delivery, the last one repeated
        feeds[i].write.mode("append").parquet(feed)
        sync.start_sync(spark, feed, schema, copy, ["k"], ckpt).awaitTermination()
    assert as_set(sync.current(spark, copy)) == as_set(versions[-1])


def files(folder):
    return {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_a_one_key_feed_rewrites_one_partition_and_leaves_nothing_behind(spark, scratch):
    base = spark.range(500).selectExpr("CAST(id AS STRING) AS k", "'a' AS a", "CAST(id AS INT) AS b")
    copy = f"{scratch}/copy"
    sync.seed(base, ["k"], copy, buckets=16)
    before = files(f"{copy}/of-16")
    feed = spark.createDataFrame([("7", "new", 7, "update_postimage", 1)], SCHEMA + ", _change_type string, _commit_version long")
    assert len(sync.apply_feed(feed, ["k"], copy, buckets=16)) == 1
    after = files(f"{copy}/of-16")
    changed = {os.path.dirname(f) for f in before ^ after}
    assert len(changed) == 1 and len(after) == len(before) == 16
    want = as_set(base.filter("k <> '7'")) | {("7", "new", 7)}
    assert as_set(sync.current(spark, copy, buckets=16)) == want
    # the last row of a partition goes too
    gone = base.withColumns({"_change_type": F.lit("delete"), "_commit_version": F.lit(2).cast("long")})
    assert len(sync.apply_feed(gone, ["k"], copy, buckets=16)) == 16
    assert sync.current(spark, copy, buckets=16).count() == 0
    assert sync.apply_feed(gone.limit(0), ["k"], copy, buckets=16) == []


def test_latest_changes_prefers_later_commit(spark):
    rows = [("1", "a", 1, "update_postimage", 1), ("1", "a", 1, "update_preimage", 2),
            ("1", None, None, "delete", 2), ("2", "b", 2, "insert", 1)]
    feed = spark.createDataFrame(rows, SCHEMA + ", _change_type string, _commit_version long")
    got = {r.k: r._change_type for r in sync.latest_changes(feed, ["k"]).collect()}
    assert got == {"1": "delete", "2": "insert"}


def test_bucketed_snapshots_diff_without_exchange(spark, scratch):
    from safetylake.plans.pipeline import publish_bucketed
    spark.sql(f"CREATE DATABASE IF NOT EXISTS snapdb LOCATION '{scratch}/snapdb'")
    old = spark.range(0, 200).selectExpr("CAST(id AS STRING) AS k", "CAST(id % 7 AS STRING) AS a",
                                         "CAST(id AS INT) AS b")
    new = (old.filter("b % 10 <> 0")
              .selectExpr("k", "IF(b % 10 = 1, 'changed', a) AS a", "b")
              .union(spark.range(500, 510).selectExpr("CAST(id AS STRING)", "'n'", "CAST(id AS INT)")))
    publish_bucketed(old, "snapdb.v1", ["k"], 8)
    publish_bucketed(new, "snapdb.v2", ["k"], 8)
    diff = changes.snapshot_diff(spark.table("snapdb.v1"), spark.table("snapdb.v2"), ["k"])
    plan = diff._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert as_set(diff) == as_set(changes.snapshot_diff(old, new, ["k"]))


def test_batch_apply_of_multi_commit_feed(spark, scratch):
    v0 = spark.createDataFrame([("1", "x", 1), ("2", "y", 2)], SCHEMA)
    v1 = spark.createDataFrame([("1", "x", 10), ("3", "z", 3)], SCHEMA)
    v2 = spark.createDataFrame([("3", "z", 30), ("4", "q", 4)], SCHEMA)
    feed = f"{scratch}/feed"
    sync.publish_changes(v0, v1, ["k"], 1, feed)
    sync.publish_changes(v1, v2, ["k"], 2, feed)
    got = changes.apply_changes(v0, spark.read.parquet(feed), ["k"])
    assert as_set(got) == as_set(v2)
