"""SimHash near-duplicate search by deletion-variant signatures.

Fingerprints are made in Arrow batches (``mapInPandas``), the search is DataFrame
joins. Equal fingerprints are collapsed first, so a large group of copies is one
index entry. The 64 bits are cut into ``distance // 2 + 1`` segments, fewer than
plain pigeonhole would need: of two fingerprints at ``distance`` or fewer bits, one
segment differs by at most one bit. Each segment is indexed under all its
one-wildcard variants (one bit blanked), variants are equality-joined and the full
distance verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import components, rows_of, staged

LANES = np.uint64(0x0101010101010101)


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the word shingles of one text; 0 where it has no words."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    h = xxhash.xxh64_intdigest
    grams = (zip(*(words[i:] for i in range(shingle))) if len(words) > shingle else [tuple(words)])
    n = max(1, len(words) - shingle + 1)
    a = np.fromiter((h(b" ".join(g), seed) for g in grams), dtype=np.uint64, count=n)
    total = np.zeros(64, dtype=np.int64)
    pad = -n % 255
    if pad:
        a = np.concatenate([a, np.zeros(pad, dtype=np.uint64)])
    block = a.reshape(-1, 255)
    for k in range(8):      # byte lanes: 255 hashes cannot overflow one
        lane = ((block >> np.uint64(k)) & LANES).sum(axis=1, dtype=np.uint64)
        total[k::8] = lane.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return int(np.bitwise_or.reduce(np.where(total * 2 > n, np.uint64(1) << np.arange(64, dtype=np.uint64), np.uint64(0))))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                 seed: int = 42, uid_col: str | None = None) -> DataFrame:
    """``(_uid, id, fp)``: one row per input row, ``fp`` the 64 bits as BIGINT."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = np.fromiter((fingerprint(t, shingle, seed) for t in b["t"]), dtype=np.uint64, count=len(b))
            yield pd.DataFrame({"_uid": b["_uid"], "id": b["id"], "fp": fp.view(np.int64)})

    return (rows_of(docs, uid_col, F.col(id_col).alias("id"), F.col(text_col).alias("t"))
            .mapInPandas(run, f"_uid bigint, id {kind}, fp bigint"))


def segments(distance: int) -> list[tuple[int, int]]:
    """``(low bit, width)`` of each segment of the 64 bits."""
    n = distance // 2 + 1
    edges = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def links(distinct: DataFrame, distance: int = 3) -> DataFrame:
    """Pairs ``(a, b)``, a < b, of distinct fingerprints at 1 to ``distance`` bits."""
    if distance < 1:
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    cut = segments(distance)
    mask = lambda w: (1 << w) - 1 if w < 64 else -1
    parts = [F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit(mask(w)).cast("bigint")) for lo, w in cut]

    def variants(k: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(cut[k][1] - 1)), lambda i: F.struct(
            (F.lit(64 * k) + i).cast("smallint").alias("slot"),
            parts[k].bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("bigint"), i))).alias("v")))

    rows = F.flatten(F.array(*[variants(k) for k in range(len(cut))]))
    index = distinct.select("fp", F.explode(rows).alias("r")).select("fp", "r.slot", "r.v")
    # most variants belong to one fingerprint: they are shuffled once, and only the shared ones are joined
    index = staged(index.withColumn("m", F.count("*").over(Window.partitionBy("slot", "v"))).where("m > 1").drop("m"), "simhash-shared")
    x, y = index.select("slot", "v", F.col("fp").alias("a")), index.select("slot", "v", F.col("fp").alias("b"))
    diff = F.col("a").bitwiseXOR(F.col("b"))

    def seg(k: int) -> Column:
        lo, w = cut[k]
        return F.shiftrightunsigned(diff, lo).bitwiseAND(F.lit(mask(w)).cast("bigint"))

    # Each pair is taken once: from the first segment that differs by at most one
    # bit, under the wildcard at that bit (the first wildcard if it is equal).
    once = F.lit(False)
    earlier = F.lit(True)
    for k in range(len(cut)):
        at_bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("slot") - 64 * k).cast("int"))
        here = (F.col("slot") >= 64 * k) & (F.col("slot") < 64 * (k + 1))
        equal_first = (seg(k) == 0) & (F.col("slot") == 64 * k)
        once = once | (here & earlier & (equal_first | (seg(k) == at_bit)))
        earlier = earlier & (F.bit_count(seg(k)) > 1)
    # the index is 64 times its table: never a broadcast by the table's size
    return (x.join(y.hint("merge"), ["slot", "v"])
            .where((F.col("a") < F.col("b")) & (F.bit_count(diff) <= distance) & once)
            .select("a", "b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    distance: int = 3, seed: int = 42, uid_col: str | None = None) -> DataFrame:
    """One row per input row: ``_uid`` (``uid_col``, if given), ``id_col``, ``fingerprint`` (16 hex digits), ``component_id``, ``kept``.

    ``component_id`` is the smallest id reachable over links of ``distance`` or
    fewer bits, the row's own included; ``kept`` marks one row of each component,
    the first with that id. Null and empty texts have fingerprint 0 and are
    linked like any other; rows with the same id and text are copies; a null id
    is smallest only where all ids are null. An empty table gives no rows. Other
    columns are not read.
    """
    fps = staged(fingerprints(docs, id_col, text_col, shingle, seed, uid_col), "simhash-fp")
    low = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "_uid"))
    rows = fps.count()
    groups = staged(fps.groupBy("fp").agg(low.alias("low")), "simhash-groups", rows)
    comp = components(links(groups.select("fp"), distance), "simhash-cc")
    known = (groups.join(comp.withColumnRenamed("id", "fp"), "fp", "left")
             .select("fp", "low", F.coalesce("component", "fp").alias("component")))
    least = staged(known.groupBy("component").agg(F.min("low").alias("least")), "simhash-least", rows)
    member = staged(known.select("fp", "component").join(least, "component")
                    .select("fp", F.col("least.id").alias("component_id"), F.col("least._uid").alias("keep_uid")),
                    "simhash-member", rows)
    return fps.join(member, "fp").select(
        "_uid", F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id", (F.col("_uid") == F.col("keep_uid")).alias("kept"))
