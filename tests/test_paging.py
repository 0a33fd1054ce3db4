"""Distributed row numbering and the paged-reader stop rule, against a plain loop."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from safetylake.operators.paging import pages_to_read, verify_pages
from safetylake.session import shared_dir
from safetylake.sources import pages as page_files
from safetylake.sources.pages import cut_pages, row_index


def reader_loop(pages, limit=1000, page_size=100):
    """What a sequential client does: fetch while skip < limit, stop after a short page."""
    out, skip = [], 0
    by_skip = dict(pages)
    while skip < limit:
        results = by_skip.get(skip) or []
        out.extend(results)
        if len(results) < page_size:
            break
        skip += page_size
    return out


def test_row_index_is_dense_and_ordered(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("v")).repartition(7)
    got = row_index(df, ["v"]).orderBy("_idx").collect()
    assert [r._idx for r in got] == list(range(1000))
    assert [r.v for r in got] == sorted(r.v for r in got)


def envelopes(spark, pages):
    rows = [(skip, None if recs is None else [(r,) for r in recs]) for skip, recs in pages]
    return spark.createDataFrame(rows, "skip int, results array<struct<v:int>>")


LAYOUTS = {
    "all_full": [(s, list(range(s, s + 100))) for s in range(0, 1000, 100)],
    "short_in_middle": [(0, list(range(100))), (100, list(range(100, 140))), (200, list(range(200, 300)))],
    "missing_results": [(0, list(range(100))), (100, None), (200, list(range(200, 300)))],
    "over_limit": [(s, list(range(s, s + 100))) for s in range(0, 1500, 100)],
    "exactly_empty": [(0, [])],
    "last_short": [(0, list(range(100))), (100, list(range(100, 150)))],
}


@pytest.mark.parametrize("name", sorted(LAYOUTS))
@pytest.mark.parametrize("limit", [1000, 150, None])
def test_stop_rule_matches_loop(spark, name, limit):
    pages = LAYOUTS[name]
    got = sorted(r.v for r in pages_to_read(envelopes(spark, pages), limit).select(F.inline("results"))
                 .collect())
    expect = sorted(reader_loop(pages, limit if limit is not None else 10**9))
    assert got == expect


def test_cut_pages_round_trip(spark):
    df = spark.range(0, 250).select(F.col("id").cast("int").alias("v"), (F.col("id") % 3).alias("g"))
    env = cut_pages(df, ["v"], page_size=100)
    sizes = {r.skip: len(r.results) for r in env.collect()}
    assert sizes == {0: 100, 100: 100, 200: 50}
    short = cut_pages(df, ["v"], page_size=100, short_page=(1, 40))
    landed = pages_to_read(short).select(F.inline("results")).collect()
    assert sorted(r.v for r in landed) == list(range(140))


def stored_mb(folder):
    return sum(os.path.getsize(f"{d}/{f}") for d, _, names in os.walk(folder) for f in names) / 1e6


@pytest.mark.parametrize("short", [None, (3, 4)])
def test_parts_of_pages_keep_order_and_ties(spark, monkeypatch, short):
    """Null, repeated and equal keys at the edges of parts: pages are those of one sorted list."""
    monkeypatch.setattr(page_files, "PART_ROWS", 20)
    rng = random.Random(5)
    rows = [(rng.choice([None, "", "a", "a'b", "b", "\u00e9", "z"]), rng.choice([None, *range(-3, 12)]), i % 4) for i in range(597)]
    rows += [("k", 1, 9)] * 73 + [("m", i, 0) for i in range(130)]
    df = spark.createDataFrame(rows, "k string, s bigint, v int").repartition(5)
    assert len(page_files.page_starts(df.select("k", "s"), 10)[0]) > 5
    order = sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1] is not None, r[1] or 0))
    got = {r.skip: [tuple(x)[:2] for x in r.results] for r in cut_pages(df, ["k", "s"], 10, short).collect()}
    want = {i: [x[:2] for x in order[i:i + 10]] for i in range(0, len(rows) + 1, 10)}
    if short:
        want[30] = want[30][:4]
    assert len(rows) % 10 == 0 and got == want
    if not short:
        assert Counter(tuple(x) for r in cut_pages(df, ["k", "s"], 10).collect() for x in r.results) == Counter(rows)


def test_records_are_not_stored_to_be_numbered(spark):
    """Only the columns that tell the order are written before the pages, not the records."""
    rng = random.Random(6)
    df = spark.range(3000).select("id", F.lit("x").alias("k")).rdd.map(lambda r: (r.id, r.k, rng.randbytes(700).hex())).toDF("id bigint, k string, wide string")
    df = spark.createDataFrame(df.collect(), df.schema)
    before = stored_mb(shared_dir(spark))
    pages = cut_pages(df, ["id"])
    assert pages.count() == 31 and stored_mb(shared_dir(spark)) - before < 1


def test_offsets_beyond_int_range_are_kept(spark):
    far = 2147483700
    pages = [(far - 100, list(range(100))), (far, list(range(100, 200)))]
    env = spark.createDataFrame([(s, [(r,) for r in recs]) for s, recs in pages], "skip bigint, results array<struct<v:int>>")
    assert pages_to_read(env).select(F.inline("results")).count() == 200


@pytest.mark.parametrize("skips", [[0, 200, 300], [100, 200], [0, 100, 100], [0, 150]])
def test_missing_or_repeated_page_fails(spark, skips):
    with pytest.raises(ValueError, match="missing or repeated"):
        verify_pages(envelopes(spark, [(s, list(range(100))) for s in skips]))


def test_pages_beyond_the_stop_do_not_matter(spark):
    verify_pages(envelopes(spark, [(0, list(range(100))), (100, [1]), (700, [2])]))


@pytest.mark.parametrize("skips, limit", [([], None), ([], 100), ([0, 100], None), ([0, 100], 300)])
def test_a_feed_must_not_end_after_a_full_page(spark, skips, limit):
    with pytest.raises(ValueError, match="no page at"):
        verify_pages(envelopes(spark, [(s, list(range(100))) for s in skips]), limit)
    verify_pages(envelopes(spark, [(s, list(range(100))) for s in skips] + [(len(skips) * 100, [])]), limit)
    verify_pages(envelopes(spark, [(s, list(range(100))) for s in skips]), len(skips) * 100)


def test_full_pages_are_followed_by_an_empty_one(spark):
    for n in (0, 200):
        env = cut_pages(spark.range(n).select(F.col("id").cast("int").alias("v")), ["v"], page_size=100)
        assert {r.skip: len(r.results) for r in env.collect()} == {s: 100 for s in range(0, n, 100)} | {n: 0}
        verify_pages(env)


def test_unreadable_page_fails(spark, scratch):
    import json

    from safetylake.sources import ingest

    good = [json.dumps({"skip": s, "results": [{"product_ndc": str(s + i)} for i in range(100)]}) for s in (0, 200)]
    for broken in ('{"skip": 100, "results": [', '{"skip": 100, "results": 7}'):
        path = f"{scratch}/{abs(hash(broken))}"
        spark.createDataFrame([(x,) for x in [good[0], broken, good[1]]], "value string").write.text(path)
        with pytest.raises(ValueError):
            ingest.land_pages(spark, path, "products")
