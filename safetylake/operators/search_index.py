"""Substring search that reads only what can match: trigram postings over the searched columns.

A text contains a term only if it contains every three characters in a row of
it. ``build`` writes the rows, numbered and partitioned by a hash of the key,
and postings of the distinct trigrams of the lower-cased texts: one for each
trigram, searched column and block of 64 rows, with a bit for each row that has
it. They are sorted by trigram (so a lookup skips row groups by their minimum
and maximum). ``candidates`` takes some trigrams of the term, keeps the (row,
column) pairs that have them all, and reads only the partitions those rows are
in. That is a superset of the matches; the search function filters it by its own
predicate as it would the whole table. Terms without three characters in a row
that must match (short ones, or wildcards too close together) read the whole
table.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from safetylake.operators import queries

#: Partitions of the rows, and trigrams looked up for a term (a posting filter of few values is pushed into the scan).
BUCKETS = 64
LOOKED_UP = 8
#: Rows whose postings one task adds up: some ten million trigrams, which leave a few hundred MB of blocks.
ROWS_A_TASK = 200_000

#: Of a numbered row: its block, and its place there.
BLOCK, PLACE = "shiftright(_row, 6)", "CAST(_row & 63 AS INT)"


@dataclass(frozen=True)
class Index:
    path: str
    keys: tuple[str, ...]
    columns: tuple[str, ...]
    buckets: int = BUCKETS

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/rows")

    def postings(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/grams")


def grams(text: Column) -> Column:
    """The distinct trigrams of a text; none for a null or a shorter one."""
    return F.when(F.length(text) >= 3, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.length(text) - 2), lambda i: F.substring(text, i, F.lit(3))))).otherwise(F.array().cast("array<string>"))


def build(df: DataFrame, keys: list[str], columns: list[str], path: str, buckets: int = BUCKETS) -> Index:
    """Write the index of ``df`` to ``path``; ``keys`` place its rows."""
    spark, index = df.sparkSession, Index(path.rstrip("/"), tuple(keys), tuple(columns), buckets)
    rows = df.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).hint("rebalance", "_bucket")
    # numbered behind the sort, so that a block's rows are of one partition
    (rows.sortWithinPartitions("_bucket").withColumn("_row", F.monotonically_increasing_id())
     .write.partitionBy("_bucket").parquet(f"{index.path}/rows"))
    stored = index.rows(spark)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-stored.count() // ROWS_A_TASK))
    fields = F.array(*[F.struct(F.lit(i).alias("field"), grams(F.lower(c)).alias("grams")) for i, c in enumerate(columns)])
    # a block is in one task, which adds up its postings before they are shuffled
    placed = stored.select(*columns, "_row", F.expr(BLOCK).alias("block"), F.col("_bucket").alias("bucket")).repartition(tasks, "block")
    postings = (placed.select("block", "bucket", F.expr(f"shiftleft(1L, {PLACE})").alias("row"), F.inline(fields))
                .select("block", "bucket", "row", "field", F.explode("grams").alias("gram"))
                .groupBy("gram", "field", "bucket", "block").agg(F.bit_or("row").alias("rows")))
    # by ranges of trigram and block: a trigram that most rows have spreads over many files
    postings.orderBy("gram", "block").write.parquet(f"{index.path}/grams")
    return index


def _needed(spark: SparkSession, term: str, mode: str) -> list[str]:
    """Trigrams that every match has, at most ``LOOKED_UP``, spread over the term."""
    parts = re.split("[%_]", term.lower()) if mode == "like" else [term]
    found = spark.range(1).select(F.array_distinct(F.flatten(F.array(*[grams(F.lower(F.lit(p))) for p in parts])))).first()[0]
    step = -(-len(found) // LOOKED_UP)
    return found[::step] if found else []


def candidates(spark: SparkSession, index: Index, term: str | None, mode: str = "literal") -> DataFrame:
    """Rows of the indexed table among which all matches of ``term`` are."""
    term = queries.check_term(term)
    needed = _needed(spark, term, mode)
    rows = index.rows(spark)
    if not needed:
        return rows.drop("_bucket", "_row")
    hits = (index.postings(spark).filter(F.col("gram").isin(needed))
            .groupBy("bucket", "block", "field").agg(F.count(F.lit(1)).alias("n"), F.bit_and("rows").alias("rows"))
            .filter((F.col("n") == len(needed)) & (F.col("rows") != 0))
            .groupBy("bucket", "block").agg(F.bit_or("rows").alias("rows")))
    buckets = [r[0] for r in hits.select("bucket").distinct().collect()]        # at most ``index.buckets`` numbers
    found = (rows.filter(F.col("_bucket").isin(buckets))
             .join(hits, (F.col("_bucket") == F.col("bucket")) & (F.expr(BLOCK) == F.col("block"))))
    return found.filter(F.expr(f"shiftrightunsigned(rows, {PLACE}) & 1") == 1).select(rows.columns).drop("_bucket", "_row")


def search_recalls(spark: SparkSession, index: Index, term: str = "", limit: int = queries.RECALL_LIMIT[0],
                   mode: str = "literal") -> DataFrame:
    """``queries.search_recalls`` over an index of the recalls."""
    return queries.search_recalls(candidates(spark, index, term, mode), term, limit, mode)


def search_products(spark: SparkSession, index: Index, term: str = "", limit: int = queries.PRODUCT_LIMIT[0],
                    mode: str = "literal") -> DataFrame:
    """``queries.search_products`` over an index of the products."""
    return queries.search_products(candidates(spark, index, term, mode), term, limit, mode)
