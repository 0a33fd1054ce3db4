"""The dataset registry and a materializing run of the medallion pipeline.

Nine datasets, declared with name, comment, quality tier, inputs, primary
key and whether a change feed is kept. A run builds them in declared order
(inputs always come first; the three source chains concurrently), writes
each as Parquet under an output folder and reads the next stage from what
was written, so every stage starts from durable files: lineage is cut
between stages and a lost executor only recomputes its own stage. Quality
metrics for every dataset with rules, and primary-key violations of every
keyed gold table, are written next to the data.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from safetylake import schemas
from safetylake.operators import changes, clean, gold, quality
from safetylake.sources import ingest


@dataclass(frozen=True)
class Dataset:
    name: str
    comment: str
    tier: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    primary_key: tuple[str, ...] = ()
    change_feed: bool = False
    metrics: Callable[..., DataFrame] | None = None


RECORD_READABLE = quality.Rule("record_readable", f"{ingest.CORRUPT} IS NULL", quality.WARN)

DATASETS: list[Dataset] = [
    Dataset("raw_ndc_products", "Product records as landed, one row per JSON record", "bronze", ("@products",),
            lambda spark, path, ml: ingest.bronze(spark, path, schemas.RAW_PRODUCTS, schemas.SOURCE_PRODUCTS, ml, True)),
    Dataset("raw_enforcement_actions", "Recall records as landed, one row per JSON record", "bronze", ("@enforcement",),
            lambda spark, path, ml: ingest.bronze(spark, path, schemas.RAW_ENFORCEMENT,
                                                  schemas.SOURCE_ENFORCEMENT, ml, True)),
    Dataset("raw_adverse_events", "Report records as landed, patients nested", "bronze", ("@adverse",),
            lambda spark, path, ml: ingest.bronze(spark, path, schemas.RAW_ADVERSE, schemas.SOURCE_ADVERSE, ml, True)),
    Dataset("clean_products", "One row per trimmed product code, first route and ingredient as columns", "silver",
            ("raw_ndc_products",), clean.clean_products,
            metrics=clean.products_quality),
    Dataset("clean_enforcement", "One row per trimmed recall number, date texts as dates", "silver",
            ("raw_enforcement_actions",), clean.clean_enforcement,
            metrics=clean.enforcement_quality),
    Dataset("clean_adverse_events", "Reports expanded to drug x reaction rows, names trimmed and upper-cased", "silver",
            ("raw_adverse_events",), clean.clean_adverse_events,
            metrics=clean.adverse_quality),
    Dataset("gold_product_catalog", "Published products, keyed by product code", "gold",
            ("clean_products",), gold.publish_products, schemas.PK_PRODUCTS, True),
    Dataset("gold_enforcement_actions", "Published recalls, keyed by recall number", "gold",
            ("clean_enforcement",), gold.publish_enforcement, schemas.PK_ENFORCEMENT, True),
    Dataset("gold_adverse_events_summary", "Report counts and date range for each pair of product and reaction", "gold",
            ("clean_adverse_events",), gold.adverse_events_summary, schemas.PK_ADVERSE, True),
]

BY_NAME = {d.name: d for d in DATASETS}


def _chains() -> list[list[Dataset]]:
    """The datasets grouped into independent chains, one per raw source, in
    declared order (a dataset's inputs always precede it in its chain)."""
    chain_of: dict[str, int] = {}
    chains: list[list[Dataset]] = []
    for ds in DATASETS:
        if ds.tier == "bronze":
            chain_of[ds.name] = len(chains)
            chains.append([ds])
        else:
            i = chain_of[ds.inputs[0]]
            chain_of[ds.name] = i
            chains[i].append(ds)
    return chains


def _build_chain(spark: SparkSession, chain: list[Dataset], sources: dict[str, str], out_dir: str,
                 with_metrics: bool, multiline: bool, written: dict[str, str]) -> None:
    # A dataset's quality metrics read its inputs and its rows as written, while the next dataset is built.
    with ThreadPoolExecutor(max_workers=1) as side:
        pending: list = []
        for ds in chain:
            if ds.tier == "bronze":
                df = ds.build(spark, sources[ds.inputs[0][1:]], multiline)
            else:
                inputs = [spark.read.parquet(written[i]) for i in ds.inputs]
                df = ds.build(*inputs)
            path = f"{out_dir}/{ds.name}"
            df.write.mode("overwrite").parquet(path)
            written[ds.name] = path
            if with_metrics and ds.metrics is not None:
                # records that did not parse have no fields, so only their kept text tells of them
                metrics = ds.metrics(*inputs, spark.read.parquet(path)).unionByName(
                    quality.rule_metrics(inputs[0], [RECORD_READABLE], ds.name))
                pending.append(side.submit(
                    metrics.write.mode("overwrite").parquet, f"{out_dir}/_quality/{ds.name}"))
            if with_metrics and ds.primary_key:
                # The key contract the keyed sync relies on, checked on what was written.
                violations = changes.pk_violations(spark.read.parquet(path), list(ds.primary_key), ds.name)
                pending.append(side.submit(
                    violations.write.mode("overwrite").parquet, f"{out_dir}/_quality/{ds.name}_key_violations"))
        for f in pending:
            f.result()


def run(spark: SparkSession, sources: dict[str, str], out_dir: str,
        with_metrics: bool = True, multiline: bool = False, concurrent: bool = True) -> dict[str, str]:
    """Build every dataset; ``sources`` maps products / enforcement / adverse to
    raw JSON Lines folders (a single-line JSON array also reads as one record
    per element); ``multiline=True`` reads pretty-printed whole-file JSON
    arrays (one task per file). Returns dataset name -> Parquet path.

    The three source chains share nothing, so with ``concurrent`` their jobs
    are submitted from three driver threads and Spark runs them side by side
    on the same executors; within a chain, stages run in order.
    """
    out_dir = out_dir.rstrip("/")
    written: dict[str, str] = {}
    chains = _chains()
    if not concurrent:
        for chain in chains:
            _build_chain(spark, chain, sources, out_dir, with_metrics, multiline, written)
    else:
        with ThreadPoolExecutor(max_workers=len(chains)) as pool:
            futures = [pool.submit(_build_chain, spark, chain, sources, out_dir, with_metrics, multiline,
                                   written) for chain in chains]
            for f in futures:
                f.result()
    return {ds.name: written[ds.name] for ds in DATASETS}


def table(spark: SparkSession, paths: dict[str, str], name: str) -> DataFrame:
    return spark.read.parquet(paths[name])


def quoted_name(*parts: str) -> str:
    """A qualified table name with each part quoted (backticks inside doubled)."""
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def _quoted(text: str) -> str:
    """A string literal of the engine's SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_tables(spark: SparkSession, paths: dict[str, str], database: str) -> list[str]:
    """Register written datasets as external tables of ``database`` with their
    comment and properties (tier, primary key, change feed), so they resolve
    by name: ``spark.table(quoted_name("spark_catalog", database, name))``."""
    db = quoted_name(database)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    names = []
    for ds in DATASETS:
        if ds.name not in paths:
            continue
        props = {"quality": ds.tier}
        if ds.primary_key:
            props["primary_key"] = ",".join(ds.primary_key)
        if ds.change_feed:
            props["change_feed"] = "true"
        prop_sql = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in props.items())
        full = quoted_name(database, ds.name)
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        location, comment = _quoted(paths[ds.name]), _quoted(ds.comment)
        spark.sql(f"CREATE TABLE {full} USING parquet LOCATION {location} "
                  f"COMMENT {comment} TBLPROPERTIES ({prop_sql})")
        names.append(full)
    return names


def publish_bucketed(df: DataFrame, table_name: str, keys: list[str], buckets: int) -> str:
    """Save a keyed table bucketed and sorted by its key (a catalog table).

    Two snapshots saved this way with the same bucket count join on the key
    without shuffling either side, which is what the change feed between
    consecutive snapshots does.
    """
    (df.write.mode("overwrite").format("parquet")
       .bucketBy(buckets, *keys).sortBy(*keys)
       .saveAsTable(table_name))
    return table_name
