"""Deterministic keep-one-row-per-key deduplication.

``dropDuplicates(keys)`` keeps an arbitrary row per key, so results can
change with partitioning. Here the kept row is the least one by all
remaining columns (NULL before values, column by column): the aggregate is
``min(struct(rest...))`` per key.

Unlike a ``row_number`` window this has map-side partial aggregation, so a
key holding a large share of all rows is reduced to one row per input
partition before the shuffle; no task ever holds a whole hot group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_least(df: DataFrame, keys: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    return (df.groupBy(*keys)
              .agg(F.min(F.struct(*rest)).alias("_row"))
              .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]))
