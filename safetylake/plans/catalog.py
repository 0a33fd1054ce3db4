"""Named queries over a directory of driver tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame; landing, change
feed and sync entries write files to the shared folder while they are built. The raw
records are derived from the flat tables by ``sources.fixtures``; every
stage after that is the library's own pipeline, so each query's work grows
with the input tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from safetylake import schemas
from safetylake.operators import changes, clean, distinct, gold, pair_state, quality, queries, search_index
from safetylake.plans import pipeline, runs
from safetylake.session import scratch_path, snapshot
from safetylake.sources import fixtures, ingest, pages
from safetylake.streaming import landing, sync

Query = Callable[[SparkSession, str], DataFrame]


# ---- stage builders ------------------------------------------------------------

def silver_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_products(fixtures.raw_products(spark, sf_dir))


def silver_enforcement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_enforcement(fixtures.raw_enforcement(spark, sf_dir))


def silver_adverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_adverse_events(fixtures.raw_adverse(spark, sf_dir))


def gold_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.publish_products(silver_products(spark, sf_dir))


def gold_enforcement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.publish_enforcement(silver_enforcement(spark, sf_dir))


def gold_adverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.adverse_events_summary(silver_adverse(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "clean_products": silver_products,
    "gold_product_catalog": gold_products,
    "clean_enforcement": silver_enforcement,
    "gold_enforcement_actions": gold_enforcement,
    "clean_adverse_events": silver_adverse,
    "gold_adverse_events_summary": gold_adverse,
}


# ---- dashboard queries -----------------------------------------------------------

# Search terms of the registered search queries (fixed values shared with the
# oracle): a literal term holding a LIKE wildcard, a quote, and plain words.
RECALL_TERM = "50%"
RECALL_COUNT_TERM = "it's"
PRODUCT_TERM = "ring"
PRODUCT_LIKE_TERM = "r_d"


def _kpi_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries.kpi_stats(gold_products(spark, sf_dir), gold_enforcement(spark, sf_dir),
                             gold_adverse(spark, sf_dir))


QUERIES.update({
    "kpi_products": lambda s, d: queries.kpi_products(gold_products(s, d)),
    "kpi_recalls": lambda s, d: queries.kpi_recalls(gold_enforcement(s, d)),
    "kpi_adverse": lambda s, d: queries.kpi_adverse(gold_adverse(s, d)),
    "kpi_stats": _kpi_stats,
    "top_products": lambda s, d: queries.top_products(gold_adverse(s, d)),
    "top_pairs": lambda s, d: queries.top_pairs(gold_adverse(s, d)),
    "recent_recalls": lambda s, d: queries.recent_recalls(gold_enforcement(s, d)),
    "list_products": lambda s, d: queries.list_products(gold_products(s, d)),
    "search_recalls": lambda s, d: queries.search_recalls(gold_enforcement(s, d), RECALL_TERM),
    "search_recalls_like": lambda s, d: queries.search_recalls(gold_enforcement(s, d), RECALL_TERM,
                                                               mode="like"),
    "search_recalls_count": lambda s, d: queries.search_recalls_count(gold_enforcement(s, d),
                                                                      RECALL_COUNT_TERM),
    "search_products": lambda s, d: queries.search_products(gold_products(s, d), PRODUCT_TERM),
    "search_products_like": lambda s, d: queries.search_products(gold_products(s, d), PRODUCT_LIKE_TERM,
                                                                 mode="like"),
    "top_products_share": lambda s, d: queries.top_products_share(gold_adverse(s, d)),
    "top_pairs_share": lambda s, d: queries.top_pairs_share(gold_adverse(s, d)),
    "recall_badges": lambda s, d: queries.recall_badges(gold_enforcement(s, d)),
})


# ---- data quality and keys ------------------------------------------------------

def _dq_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.products_quality(fixtures.raw_products(spark, sf_dir))


def _dq_enforcement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.enforcement_quality(fixtures.raw_enforcement(spark, sf_dir))


def _dq_adverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.adverse_quality(fixtures.raw_adverse(spark, sf_dir))


def _pk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (changes.pk_violations(gold_products(spark, sf_dir), list(schemas.PK_PRODUCTS),
                                  "gold_product_catalog")
            .unionByName(changes.pk_violations(gold_enforcement(spark, sf_dir), list(schemas.PK_ENFORCEMENT),
                                               "gold_enforcement_actions"))
            .unionByName(changes.pk_violations(gold_adverse(spark, sf_dir), list(schemas.PK_ADVERSE),
                                               "gold_adverse_events_summary")))


def _raw_pk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same key check on the trimmed raw records: what dedupe and drop rules fix."""
    return (changes.pk_violations(clean.stage_products(fixtures.raw_products(spark, sf_dir)),
                                  list(schemas.PK_PRODUCTS), "raw_ndc_products")
            .unionByName(changes.pk_violations(
                clean.stage_enforcement(fixtures.raw_enforcement(spark, sf_dir)),
                list(schemas.PK_ENFORCEMENT), "raw_enforcement_actions")))


QUERIES.update({
    "dq_products": _dq_products,
    "dq_enforcement": _dq_enforcement,
    "dq_adverse": _dq_adverse,
    "pk_violations": _pk_violations,
    "pk_violations_raw": _raw_pk_violations,
})


# ---- ingest -------------------------------------------------------------------------

def _bronze(which: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = fixtures.RAW_BUILDERS[which](spark, sf_dir)
        return ingest.as_json_text(ingest.land_source(spark, raw, which))
    return run


# A short page in the middle of the product feed (fixed values): page 5 keeps
# 40 of its 100 records, so a paged reader stops there.
SHORT_PAGE = (5, 40)


def _landed_pages(spark: SparkSession, sf_dir: str, which: str,
                  short_page: tuple[int, int] | None = None) -> DataFrame:
    raw = fixtures.RAW_BUILDERS[which](spark, sf_dir, with_seq=True)
    path = pages.land_pages_files(spark, raw, which, short_page=short_page)
    return ingest.land_pages(spark, path, which)


def _landing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = ingest.land_all({w: (lambda w=w: _landed_pages(spark, sf_dir, w))
                              for w in ("products", "enforcement", "adverse")})
    return ingest.landing_counts({ingest.SOURCES[w][1]: df for w, df in landed.items()})


QUERIES.update({
    "bronze_products": _bronze("products"),
    "bronze_enforcement": _bronze("enforcement"),
    "bronze_adverse": _bronze("adverse"),
    "land_pages": lambda s, d: ingest.as_json_text(_landed_pages(s, d, "products")),
    "land_pages_short_page": lambda s, d: ingest.as_json_text(_landed_pages(s, d, "products", SHORT_PAGE)),
    "landing_counts": _landing_counts,
})


# ---- change feed and sync --------------------------------------------------------

# Snapshots are stored tables: the old one is written to the shared
# folder once, so the new snapshot and the diff read it instead of deriving
# the gold table again for every branch of the plan.

def _feed(gold_fn: Callable, evolve: Callable, keys: tuple[str, ...]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        old = snapshot(gold_fn(spark, sf_dir), "gold")
        return changes.snapshot_diff(old, evolve(old), list(keys))
    return run


def _sync(gold_fn: Callable, evolve: Callable, keys: tuple[str, ...]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        old = snapshot(gold_fn(spark, sf_dir), "gold")
        feed = snapshot(changes.snapshot_diff(old, evolve(old), list(keys)), "feed")
        return changes.apply_changes(old, feed, list(keys))
    return run


QUERIES.update({
    "change_feed_products": _feed(gold_products, fixtures.next_products, schemas.PK_PRODUCTS),
    "change_feed_enforcement": _feed(gold_enforcement, fixtures.next_enforcement, schemas.PK_ENFORCEMENT),
    "change_feed_adverse": _feed(gold_adverse, fixtures.next_adverse_summary, schemas.PK_ADVERSE),
    "sync_apply_products": _sync(gold_products, fixtures.next_products, schemas.PK_PRODUCTS),
    "sync_apply_enforcement": _sync(gold_enforcement, fixtures.next_enforcement, schemas.PK_ENFORCEMENT),
    "sync_apply_adverse": _sync(gold_adverse, fixtures.next_adverse_summary, schemas.PK_ADVERSE),
})


def _sync_stream_adverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The triggered streaming sync: publish the snapshot diff as one commit of
    the feed, run an ``availableNow`` sync over it, return the synced copy."""
    keys = list(schemas.PK_ADVERSE)
    old = snapshot(gold_adverse(spark, sf_dir), "sync-base")
    feed_dir, copy = scratch_path(spark, "sync-feed"), scratch_path(spark, "sync-copy")
    sync.publish_changes(old, fixtures.next_adverse_summary(old), keys, 1, feed_dir)
    sync.seed(old, keys, copy)
    sync.start_sync(spark, feed_dir, spark.read.parquet(feed_dir).schema, copy, keys,
                    scratch_path(spark, "sync-checkpoint")).awaitTermination()
    return sync.current(spark, copy)


QUERIES["sync_stream_adverse"] = _sync_stream_adverse


# ---- runs of the pipeline over stored JSON ------------------------------------------

GOLD_OF = {"products": "gold_product_catalog", "enforcement": "gold_enforcement_actions",
           "adverse": "gold_adverse_events_summary"}


def _two_runs(spark: SparkSession, sf_dir: str, which: str) -> str:
    """Land two deliveries of one feed as JSON (the others empty) and publish a run over each; the runs' folder."""
    root = scratch_path(spark, "runs")
    raw = {w: build(spark, sf_dir) if w == which else build(spark, sf_dir).limit(0) for w, build in fixtures.RAW_BUILDERS.items()}
    first = {w: ingest.land_json(df, f"{root}/landed-1/{w}") for w, df in raw.items()}
    runs.publish(spark, first, root, with_metrics=False)
    landed = spark.read.schema(ingest.SOURCES[which][0]).json(first[which])
    second = first | {which: ingest.land_json(fixtures.NEXT_RAW[which](landed), f"{root}/landed-2/{which}")}
    runs.publish(spark, second, root, with_metrics=False)
    return root


def _run_feed(which: str) -> Query:
    return lambda spark, sf_dir: runs.feed(spark, _two_runs(spark, sf_dir, which), GOLD_OF[which], since=1)


def _run_table(which: str) -> Query:
    """The published table of the current run, by its name in the catalog."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = _two_runs(spark, sf_dir, which)
        database = "runs_" + root.rsplit("-", 1)[1]
        pipeline.register_tables(spark, runs.paths(spark, root), database)
        return spark.table(pipeline.quoted_name("spark_catalog", database, GOLD_OF[which]))
    return run


def _run_sync(which: str) -> Query:
    """A copy that starts empty and follows the runs by triggers, the second run's before the first's."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root, name = _two_runs(spark, sf_dir, which), GOLD_OF[which]
        keys, copy = list(pipeline.BY_NAME[name].primary_key), scratch_path(spark, "copy")
        sync.seed(runs.table(spark, root, name).limit(0), keys, copy, buckets=8)
        sync.apply_feed(runs.feed(spark, root, name, since=1), keys, copy, buckets=8)
        sync.follow_runs(spark, root, name, copy, scratch_path(spark, "copy-checkpoint"), buckets=8).awaitTermination()
        return sync.current(spark, copy, buckets=8)
    return run


for _w in GOLD_OF:
    QUERIES[f"pipeline_change_feed_{_w}"] = _run_feed(_w)
    QUERIES[f"pipeline_gold_{_w}"] = _run_table(_w)
    QUERIES[f"pipeline_sync_{_w}"] = _run_sync(_w)


def _incremental_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pair summary after a second delivery, from the first one's state and the changed reports."""
    old = snapshot(fixtures.raw_adverse(spark, sf_dir), "reports")
    new = snapshot(fixtures.next_raw_adverse(old), "reports")
    state = snapshot(pair_state.merged(pair_state.entries(old)), "pair-state")
    return pair_state.summary(pair_state.merged(state, pair_state.delta(old, new)))


QUERIES["incremental_adverse_summary"] = _incremental_summary


# ---- whole records, drift, arrays -----------------------------------------------------

UNDECLARED = {"maker": ("$.openfda.maker", "string"), "words": ("$.openfda.count", "int"), "tag": ("$.openfda.tags[1]", "string")}


def _drifted(spark: SparkSession, sf_dir: str, which: str, columns: str = "*") -> DataFrame:
    schema, source, _ = ingest.SOURCES[which]
    path = ingest.land_json(fixtures.DRIFTED[which](fixtures.RAW_BUILDERS[which](spark, sf_dir)), scratch_path(spark, f"drifted-{which}"))
    return snapshot(ingest.bronze_records(spark, path, schema, source).select(columns), f"records-{which}")


def _undeclared(which: str) -> Query:
    """Fields that no schema declares, read from the stored records afterwards."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return ingest.projected(_drifted(spark, sf_dir, which), UNDECLARED, keep=[ingest.SOURCES[which][2]])
    return run


def _schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the whole records are stored and compared, not the declared columns read from them; the feeds run side by side
    parts = list(ingest.land_all({w: (lambda w=w, schema=schema, source=source: ingest.schema_drift(
        _drifted(spark, sf_dir, w, ingest.RECORD), schema, source)) for w, (schema, source, _) in ingest.SOURCES.items()}).values())
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _bronze_arrays(which: str) -> Query:
    """Bronze from JSON array files, each read by as many tasks as it has byte ranges."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        schema, source, _ = ingest.SOURCES[which]
        path = fixtures.array_files(fixtures.RAW_BUILDERS[which](spark, sf_dir), scratch_path(spark, f"arrays-{which}"))
        return ingest.as_json_text(ingest.bronze_records(spark, path, schema, source, arrays=True)
                                   .drop(ingest.RECORD, ingest.CORRUPT))
    return run


QUERIES["schema_drift"] = _schema_drift
for _w in GOLD_OF:
    QUERIES[f"bronze_undeclared_{_w}"] = _undeclared(_w)
    QUERIES[f"bronze_arrays_{_w}"] = _bronze_arrays(_w)


# ---- quarantine -------------------------------------------------------------------------

STAGED = {"products": (clean.stage_products, clean.PRODUCT_RULES + clean.PRODUCT_CHECKS),
          "enforcement": (lambda raw: clean.stage_enforcement(raw, keep_source=True), clean.ENFORCEMENT_RULES + clean.ENFORCEMENT_CHECKS),
          "adverse": (lambda raw: clean.stage_adverse_reports(raw, keep_source=True), clean.ADVERSE_RULES + clean.ADVERSE_CHECKS)}


def _routed(spark: SparkSession, sf_dir: str, which: str) -> tuple[DataFrame, str]:
    stage, rules = STAGED[which]
    path = scratch_path(spark, f"routed-{which}")
    _, rejected = quality.route(stage(fixtures.RAW_BUILDERS[which](spark, sf_dir)), rules, path)
    return rejected, path


def _quarantined(which: str, columns: list[str]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rejected, _ = _routed(spark, sf_dir, which)
        return rejected.select(*columns, F.array_join(quality.FAILED, ",").alias(quality.FAILED))
    return run


def _quarantine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [quality.routed_counts(spark, _routed(spark, sf_dir, w)[1], w) for w in STAGED]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


QUERIES.update({
    "quarantine_products": _quarantined("products", list(schemas.PRODUCT_COLUMNS)),
    "quarantine_enforcement": _quarantined("enforcement", list(schemas.ENFORCEMENT_COLUMNS)),
    "quarantine_adverse": _quarantined("adverse", ["is_serious", "receive_date", "patient_sex", "patient_age"]),
    "quarantine_counts": _quarantine_counts,
})


# ---- search by index, distinct counts from daily partials -------------------------------------

def _indexed(gold_fn: Callable, keys: tuple[str, ...], columns: list[str], search: Callable, term: str, mode: str = "literal") -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        index = search_index.build(snapshot(gold_fn(spark, sf_dir), "indexed"), list(keys), columns, scratch_path(spark, "index"), buckets=8)
        return search(spark, index, term, mode=mode)
    return run


_recalls = (gold_enforcement, schemas.PK_ENFORCEMENT, queries.RECALL_SEARCH_COLUMNS, search_index.search_recalls)
_products = (gold_products, schemas.PK_PRODUCTS, queries.PRODUCT_SEARCH_COLUMNS, search_index.search_products)
QUERIES.update({
    "search_recalls_indexed": _indexed(*_recalls, RECALL_TERM),
    "search_recalls_like_indexed": _indexed(*_recalls, RECALL_TERM, "like"),
    "search_products_indexed": _indexed(*_products, PRODUCT_TERM),
    "search_products_like_indexed": _indexed(*_products, PRODUCT_LIKE_TERM, "like"),
})


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = snapshot(pair_state.merged(pair_state.units(silver_adverse(spark, sf_dir))), "pair-state")
    return snapshot(distinct.daily(state, distinct.dictionary(state.select("reaction_name"))), "days")


QUERIES.update({
    "kpi_adverse_daily": lambda s, d: distinct.kpi(_days(s, d)),
    "top_products_daily": lambda s, d: queries.top_rollup(distinct.product_rollup(_days(s, d))),
})


# ---- landing while pages arrive ------------------------------------------------------------------

def _land_streamed(which: str) -> Query:
    """Pages landed by triggers of one file each, the query stopped and started again over one checkpoint."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = pages.land_pages_files(spark, fixtures.RAW_BUILDERS[which](spark, sf_dir, with_seq=True), which)
        target, checkpoint = scratch_path(spark, "streamed"), scratch_path(spark, "streamed-checkpoint")
        for _ in range(2):
            landing.start_landing(spark, path, which, target, checkpoint, files_per_trigger=1).awaitTermination()
        return ingest.as_json_text(landing.landed(spark, which, target))
    return run


for _w in GOLD_OF:
    QUERIES[f"land_pages_streamed_{_w}"] = _land_streamed(_w)
    if _w != "products":
        QUERIES[f"land_pages_{_w}"] = lambda s, d, w=_w: ingest.as_json_text(_landed_pages(s, d, w))
