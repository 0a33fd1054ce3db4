"""Landing a paged feed while its pages arrive, with restarts.

Page envelopes are files that appear in a folder in any order. Each trigger
takes the files not taken yet and stores their pages; the stored pages are the
state: which offsets are there, and whether a short page has ended the feed. A
batch that is run again after a failure writes the same folder again, so a page
is never lost and never stored twice, and the checkpoint remembers the files of
finished batches. ``landed`` gives the records once the feed is whole, and
raises as long as a page is missing, by the rules of the batch landing.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from safetylake.functions.scalar import size0
from safetylake.operators.paging import pages_to_read, verify_pages
from safetylake.sources import ingest


def start_landing(spark: SparkSession, pages_dir: str, which: str, target: str, checkpoint: str,
                  files_per_trigger: int | None = None) -> StreamingQuery:
    """Store the pages of all envelope files not yet taken; returns the query."""
    stream = (spark.readStream.schema(ingest.envelope_schema(ingest.SOURCES[which][0]))
              .option("columnNameOfCorruptRecord", ingest.CORRUPT))
    if files_per_trigger:
        stream = stream.option("maxFilesPerTrigger", files_per_trigger)

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target.rstrip('/')}/batch={number}")

    return (stream.json(pages_dir).writeStream.foreachBatch(store)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def _pages(spark: SparkSession, which: str, target: str) -> DataFrame:
    schema = ingest.envelope_schema(ingest.SOURCES[which][0])
    try:
        return spark.read.schema(schema).parquet(target)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def progress(spark: SparkSession, which: str, target: str, page_size: int = 100) -> DataFrame:
    """One row: ``pages`` and ``records`` stored, and ``ends_at``, the offset of the page that ends the feed (null: none yet)."""
    n = size0("results")
    return _pages(spark, which, target).agg(
        F.count(F.lit(1)).alias("pages"), F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("records"),
        F.min(F.when(n < page_size, F.col("skip"))).alias("ends_at"))


def landed(spark: SparkSession, which: str, target: str, limit: int | None = None, page_size: int = 100) -> DataFrame:
    """Bronze records of a feed that is whole; raises while pages are missing, repeated or unreadable."""
    pages = _pages(spark, which, target)
    verify_pages(pages, limit, page_size, ingest.CORRUPT)
    return ingest.tag(pages_to_read(pages, limit, page_size).select(F.inline("results")), ingest.SOURCES[which][1])
