"""Published runs: snapshots, the pointer, change feeds, copies that follow them."""

import pytest

from conftest import SF_SMALL
from safetylake.plans import catalog, pipeline, runs
from safetylake.sources import fixtures, ingest
from safetylake.streaming import sync

NAMES = list(catalog.GOLD_OF.values())


def as_set(df):
    return {tuple(r) for r in df.collect()}


def land(spark, folder, evolve=False):
    out = {}
    for w, build in fixtures.RAW_BUILDERS.items():
        raw = build(spark, SF_SMALL)
        out[w] = ingest.land_json(fixtures.NEXT_RAW[w](raw) if evolve else raw, f"{folder}/{w}")
    return out


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("runs"))
    first, second = land(spark, f"{folder}/1"), land(spark, f"{folder}/2", evolve=True)
    root = f"{folder}/out"
    runs.publish(spark, first, root, with_metrics=False)
    runs.publish(spark, second, root, with_metrics=False)
    runs.publish(spark, second | {"products": first["products"]}, root, with_metrics=False)     # products as at first
    return root, first, second


def test_versions_stay_readable_and_the_last_one_is_current(spark, published):
    root, _, _ = published
    assert [r.version for r in runs.published(spark, root)] == [1, 2, 3]
    first = as_set(catalog.gold_products(spark, SF_SMALL))
    assert as_set(runs.table(spark, root, NAMES[0], 1)) == first == as_set(runs.table(spark, root, NAMES[0]))
    assert as_set(runs.table(spark, root, NAMES[0], 2)) != first
    with pytest.raises(ValueError, match="no run of version 9"):
        runs.table(spark, root, NAMES[0], 9)
    with pytest.raises(ValueError, match="keeps no change feed"):
        runs.feed(spark, root, "clean_products")


def test_feeds_lead_from_any_version_to_any_later_one(spark, published):
    root, _, _ = published
    for name in NAMES:
        keys = list(pipeline.BY_NAME[name].primary_key)
        for since in (0, 1, 2):
            start = runs.table(spark, root, name, since or 1)
            copy = f"{root}/copy-{name}-{since}"
            sync.seed(start if since else start.limit(0), keys, copy, version=since)
            sync.apply_feed(runs.feed(spark, root, name, since=since), keys, copy)
            assert as_set(sync.current(spark, copy)) == as_set(runs.table(spark, root, name)), (name, since)
    kinds = {r[0] for r in runs.feed(spark, root, NAMES[0], since=1).select("_change_type").distinct().collect()}
    assert kinds == {"insert", "delete", "update_preimage", "update_postimage"}
    assert runs.feed(spark, root, NAMES[1], since=2).count() == 0       # nothing changed in the last run
    assert runs.feed(spark, root, NAMES[1], since=3).columns == runs.feed(spark, root, NAMES[1], since=2).columns


def test_a_run_that_fails_is_never_seen(spark, published, monkeypatch):
    root, first, _ = published
    before = runs.current(spark, root)
    with pytest.raises(Exception):
        runs.publish(spark, first | {"adverse": f"{root}/not-there"}, root, with_metrics=False)

    def fail(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(runs.changes, "snapshot_diff", fail)
    with pytest.raises(RuntimeError, match="lost"):
        runs.publish(spark, first, root, with_metrics=False)
    assert runs.current(spark, root) == before


def test_a_copy_follows_the_log_of_runs(spark, published):
    root, _, _ = published
    name = NAMES[2]
    keys, copy = list(pipeline.BY_NAME[name].primary_key), f"{root}/following"
    sync.seed(runs.table(spark, root, name, 1).limit(0), keys, copy)
    for _ in range(2):
        sync.follow_runs(spark, root, name, copy, f"{root}/following-checkpoint").awaitTermination()
        assert as_set(sync.current(spark, copy)) == as_set(runs.table(spark, root, name))


def test_no_run_yet(spark, scratch):
    assert runs.current(spark, scratch) is None
    with pytest.raises(ValueError, match="has no run"):
        runs.table(spark, scratch, NAMES[0])


def test_command_line_reads_the_current_run(spark, published, capsys):
    import json

    from safetylake.__main__ import main

    root, first, _ = published
    assert main(["stats", "--gold", root]) == 0
    assert json.loads(capsys.readouterr().out)["products"] == runs.table(spark, root, NAMES[0]).count()
    one = runs.paths(spark, root, 1)[NAMES[0]].rsplit("/", 1)[0]
    assert main(["products", "--gold", one, "--limit", "3"]) == 0
    assert json.loads(capsys.readouterr().out)["count"] == 3
    out = f"{root}/by-command"
    assert main(["publish", *[x for w, p in first.items() for x in (f"--{w}", p)], "--out", out]) == 0
    assert json.loads(capsys.readouterr().out)["version"] == 1 and runs.current(spark, out).version == 1
