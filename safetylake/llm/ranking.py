"""Places of rows inside their groups, for groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

#: ``monotonically_increasing_id`` keeps the partition above these bits.
LOW_BITS = 33


def ranked(df: DataFrame, group: list[str], order: list[str], label: str, name: str = "_rank",
           drop: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with the place (0, 1, ...) of each row in its group, by ``order`` ascending, nulls first.

    No task holds a group: rows are dealt by ranges of (group, order, row
    number), so a group or a value with a third of all rows spreads over many
    partitions, and the sorted rows are written once. Each partition's part of
    a group is then counted, the parts before it are summed (a window over at
    most one row for each partition), and the sums are joined back. Rows equal
    in ``order`` come in any order; nulls in ``group`` are one group. Columns in
    ``drop`` only order the rows and are not written.
    """
    keys = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    placed = staged(df.withColumn("_tie", F.monotonically_increasing_id()).orderBy(*keys, "_tie").drop("_tie", *drop)
                    .withColumn("_at", F.monotonically_increasing_id()), label)
    part = F.shiftright("_at", LOW_BITS).alias("_part")
    parts = placed.groupBy(part, *group).agg(F.count(F.lit(1)).alias("_size"), F.min("_at").alias("_first"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(F.col("_part").alias("_p"), *[F.col(g).alias(f"_g_{i}") for i, g in enumerate(group)],
                          (F.coalesce(F.sum("_size").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    same = part == F.col("_p")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{i}"))
    return placed.join(starts, same).select(*[c for c in df.columns if c not in drop], (F.col("_at") + F.col("_shift")).alias(name))
