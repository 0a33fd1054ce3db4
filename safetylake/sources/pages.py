"""Page fixtures: cut raw records into the page envelopes that the upstream API serves.

``row_index`` numbers rows 0..n-1 in a total order without a window over the
whole table: a range-partitioned sort, a stored copy (so both uses see
the same ids), a per-partition count, and a broadcast of those counts, which
are bounded by the partition count. Records are wide and their order is told by
few columns, so only these are numbered; the records go once through
a shuffle, to parts that hold whole pages, and are not stored on the way.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from safetylake.session import scratch_path, snapshot
from safetylake.sources.ingest import SOURCES, land_json

_LOW_BITS = 33
_LOW_MASK = (1 << _LOW_BITS) - 1


def row_index(df: DataFrame, order: list[Column | str], name: str = "_idx") -> DataFrame:
    tagged = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id())
    tagged = snapshot(tagged, "row-index")
    tagged = tagged.withColumn("_pid", F.shiftright("_mid", _LOW_BITS))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per input partition: the running sum runs over that small table.
    run = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0)
    offsets = counts.select("_pid", (F.sum("_n").over(run) - F.col("_n")).alias("_off"))
    return (tagged.join(F.broadcast(offsets), "_pid")
                  .withColumn(name, F.col("_off") + F.col("_mid").bitwiseAND(F.lit(_LOW_MASK)))
                  .drop("_pid", "_mid", "_off"))


#: Rows of a part at least, and how many parts at most: their starts travel inside the plan.
PART_ROWS, MOST_PARTS = 10_000, 1000


def page_starts(keys: DataFrame, page_size: int) -> tuple[list, int]:
    """Where parts of whole pages may start, as rows ``(*keys, _idx)`` in order, and the number of rows.

    ``keys`` are the columns to sort by. A part starts at a row that begins a page and
    is the first with its keys, so keys alone tell on which side of it a row lies.
    """
    names = keys.columns
    idx = row_index(keys, names)
    n = idx.count()
    rows = page_size * -(-max(PART_ROWS, n // MOST_PARTS) // page_size)
    at = F.broadcast(idx.where((F.col("_idx") > 0) & (F.col("_idx") % rows == 0)).select(*[F.col(c).alias(f"_{k}") for k, c in enumerate(names)]).distinct())
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{k}")) for k, c in enumerate(names)])
    first = idx.join(at, same, "left_semi").groupBy(*names).agg(F.min("_idx").alias("_idx"))
    return first.where((F.col("_idx") > 0) & (F.col("_idx") % page_size == 0)).orderBy("_idx").collect(), n


def _part_of(starts: list, keys: DataFrame) -> Column:
    """How many of the starts lie at or before a row, by halving: a few comparisons a row, each of single values."""
    known = {f.name: F.array(*[F.lit(s[f.name]).cast(f.dataType) for s in starts]) for f in keys.schema}
    halves = F.array(*[F.lit(1 << k) for k in reversed(range(len(starts).bit_length()))])

    def reached(at: Column) -> Column:
        out = F.lit(True)
        for name in reversed(keys.columns):
            start, row = F.get(known[name], at), F.col(name)
            out = (start < row) | (start.isNull() & row.isNotNull()) | (start.eqNullSafe(row) & out)
        return (at < len(starts)) & out

    return F.aggregate(halves, F.lit(0), lambda k, more: F.when(reached(k + more - 1), k + more).otherwise(k))


def cut_pages(records: DataFrame, order: list[str], page_size: int = 100,
              short_page: tuple[int, int] | None = None) -> DataFrame:
    """Page envelopes ``(skip bigint, results array<record>)`` of ``page_size`` records.

    ``order`` names the columns to sort by, ascending, nulls first.
    ``short_page=(page, rows)`` keeps only the first ``rows`` records of that
    page, to produce a short page in the middle of a feed. Each group holds at
    most ``page_size`` records. Where the records fill their pages, an empty page
    follows the last one, as the upstream answers a request beyond its end.
    """
    fields = records.columns
    keys = records.select(*order)
    starts, n = page_starts(keys, page_size)
    part = _part_of(starts, keys) if starts else F.lit(0)
    begin = F.get(F.array(*[F.lit(i).cast("bigint") for i in (0, *[s["_idx"] for s in starts])]), F.col("_part"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    idx = records.withColumn("_part", part).withColumn("_idx", begin + place - 1)
    page = F.floor(F.col("_idx") / page_size).cast("bigint")
    idx = idx.withColumn("_page", page)
    if short_page is not None:
        p, rows = short_page
        idx = idx.filter((F.col("_page") != p) | (F.col("_idx") - p * page_size < rows))
    # all rows of a page lie in one part, so they are together already
    grouped = idx.groupBy("_part", "_page").agg(
        F.sort_array(F.collect_list(F.struct(F.col("_idx").alias("_i"),
                                             *[F.col(c) for c in fields]))).alias("_recs"))
    pages = grouped.select(
        (F.col("_page") * page_size).alias("skip"),
        F.transform("_recs", lambda r: F.struct(*[r[c].alias(c) for c in fields])).alias("results"),
    )
    if n % page_size:
        return pages
    end = records.sparkSession.range(1).select(F.lit(n).cast("bigint").alias("skip"), F.array().cast(pages.schema["results"].dataType).alias("results"))
    return pages.unionByName(end)


def land_pages_files(spark: SparkSession, raw_with_seq: DataFrame, which: str, page_size: int = 100,
                     short_page: tuple[int, int] | None = None) -> str:
    """Cut raw records (ordered by key, then ``_seq``) into page envelopes and
    write them as JSON Lines, one envelope per line."""
    schema, _, key = SOURCES[which]
    recs = raw_with_seq.select(*schema.fieldNames(), "_seq")
    env = cut_pages(recs, [key, "_seq"], page_size, short_page)
    env = env.select("skip", F.transform("results", lambda r: F.struct(
        *[r[c].alias(c) for c in schema.fieldNames()])).alias("results"))
    return land_json(env, scratch_path(spark, f"pages-{which}"))
