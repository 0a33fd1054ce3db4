"""Exact distinct counts from partials that can be stored and merged.

Counting distinct names over a longer span cannot add up the counts of shorter
ones. Here names get dense numbers from a dictionary, a set of names is a
bitmap over the numbers, and partials of any spans merge by OR. Bitmaps come in
buckets of 32,768 numbers, one row each, so a set of any size is many small
rows and no buffer grows with it.

``daily`` keeps, for each date and product, the event counts and the bitmap of
its reactions; ``product_rollup`` and ``kpi`` read any range of dates off the
daily rows without going back to the events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from safetylake.operators.pair_state import DATE
from safetylake.session import scratch_path


def dictionary(names: DataFrame) -> DataFrame:
    """``(name, id)``: a number from 0 up for each distinct name of the one column of ``names``, nulls left out.

    Stored, so every use sees the same numbers.
    """
    from safetylake.sources.pages import row_index

    path = scratch_path(names.sparkSession, "names")
    known = names.toDF("name").na.drop().distinct()
    row_index(known, ["name"], "id").select("name", F.col("id").cast("bigint").alias("id")).write.parquet(path)
    return names.sparkSession.read.parquet(path)


def daily(state: DataFrame, reactions: DataFrame) -> DataFrame:
    """Partials ``(receive_date, product_name, bucket, reactions, events, serious)`` of a pair state.

    ``reactions`` is the dictionary of reaction names. Bucket rows of a date and
    product add up to its events.
    """
    ids = reactions.select(F.col("name").alias("reaction_name"), "id")
    return (state.join(ids, "reaction_name")
            .groupBy(DATE, "product_name", F.bitmap_bucket_number("id").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("reactions"),
                 F.sum("events").alias("events"), F.sum("serious").alias("serious")))


def _span(days: DataFrame, since, until) -> DataFrame:
    """Rows of the dates from ``since`` to ``until``; without bounds all, undated ones too."""
    if since is not None:
        days = days.filter(F.col(DATE) >= F.lit(since))
    return days if until is None else days.filter(F.col(DATE) <= F.lit(until))


def product_rollup(days: DataFrame, since=None, until=None) -> DataFrame:
    """``product_name, total_events, serious_events, unique_reactions`` over a span of dates."""
    buckets = _span(days, since, until).groupBy("product_name", "bucket").agg(
        F.bitmap_or_agg("reactions").alias("reactions"), F.sum("events").alias("events"), F.sum("serious").alias("serious"))
    return buckets.groupBy("product_name").agg(
        F.sum("events").alias("total_events"), F.sum("serious").alias("serious_events"),
        F.sum(F.bitmap_count("reactions")).alias("unique_reactions"))


def kpi(days: DataFrame, since=None, until=None) -> DataFrame:
    """The adverse-event KPIs over a span of dates, as ``queries.kpi_adverse`` names them."""
    products = product_rollup(days, since, until)
    return products.agg(F.sum("total_events").alias("total_adverse_events"), F.sum("serious_events").alias("serious_events"),
                        F.count(F.lit(1)).alias("unique_products_with_ae"))
