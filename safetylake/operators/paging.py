"""Reading a paged feed as a sequential client would, without reading page by page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from safetylake.functions.scalar import size0


def _asked(envelopes: DataFrame, limit: int | None) -> DataFrame:
    return envelopes if limit is None else envelopes.filter(F.col("skip") < F.lit(limit))


def pages_to_read(envelopes: DataFrame, limit: int | None = None, page_size: int = 100) -> DataFrame:
    """The pages a sequential paged reader would have consumed.

    A reader asks for pages at skip = 0, page_size, ... while ``skip < limit``
    and stops after the first page shorter than ``page_size`` (a missing
    ``results`` counts as an empty page). That is: pages with
    ``skip < limit`` and ``skip <= min(skip of short pages)``. The minimum is
    one global aggregate evaluated as a scalar subquery; no join, no window
    and no ordering of the pages is needed. Without a short page every page
    is read.
    """
    pages = _asked(envelopes, limit)
    stop = pages.agg(F.min(F.when(size0("results") < page_size, F.col("skip")))).scalar()
    return pages.filter(F.coalesce(F.col("skip") <= stop, F.lit(True)))


def verify_pages(envelopes: DataFrame, limit: int | None = None, page_size: int = 100,
                 corrupt: str | None = None) -> None:
    """Raise unless the pages up to the stop are exactly 0, page_size, 2 * page_size, ...

    A client only stops at a short page or at ``limit``; after a full page it
    asks for the next one and fails if there is none. So a feed must end with a
    short page (an empty one, where the records fill their pages) or reach
    ``limit``. A page whose envelope does not parse (``corrupt`` names the column
    with its text) raises too, unless it is known to lie beyond the stop.
    """
    bad = F.lit(False) if corrupt is None else F.col(corrupt).isNotNull()
    pages = envelopes.select("skip", size0("results").alias("n"), (bad | F.col("skip").isNull()).alias("bad"))
    pages = pages.filter(F.col("bad") | (F.lit(True) if limit is None else F.col("skip") < limit))
    # one short page more or less moves the stop, so it is found first
    stop = pages.agg(F.min(F.when(~F.col("bad") & (F.col("n") < page_size), F.col("skip"))).alias("s")).first().s
    upto = F.lit(True) if stop is None else F.coalesce(F.col("skip") <= stop, F.lit(True))
    # the sum keeps ``results`` in the scan: a field that is not read cannot be found broken
    got = pages.filter(upto).agg(
        F.count_if("bad").alias("bad"), F.sum("n").alias("records"), F.count(F.lit(1)).alias("n"), F.count_distinct("skip").alias("d"),
        F.max("skip").alias("top"), F.count_if(F.pmod("skip", F.lit(page_size)) != 0).alias("off")).first()
    if got.bad:
        raise ValueError(f"{got.bad} page(s) cannot be read")
    reached = got.top + page_size if got.n else 0
    if stop is None and (limit is None or reached < limit):
        raise ValueError(f"the feed has no page at {reached}: pages are missing or repeated")
    if got.n and (got.n != got.d or got.off or got.top != (got.n - 1) * page_size):
        raise ValueError(f"pages are missing or repeated: {got.n} pages, {got.d} offsets, the last at {got.top}")
