"""Helpers shared by the operators: staging, components, membership bits, word splitting."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from safetylake.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


FILE_ROWS = 25_000


def staged(df: DataFrame, label: str, rows: int | None = None, tasks: int = 1) -> DataFrame:
    """Write to the shared folder and read back.

    Cuts lineage like a reliable checkpoint, but keeps column pruning, and a
    join on the result has a plain exchange that AQE may split when skewed.
    Where it is known to have ``rows`` at most, a file holds ``FILE_ROWS`` of them or so and is
    not written for each shuffle partition: on a local file system every file costs the executor
    two forks, and each looks for a moment as large as the executor. No fewer tasks write than
    ``tasks`` a core.
    """
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(tasks * spark.sparkContext.defaultParallelism, -(-rows // FILE_ROWS)))
    path = scratch_path(spark, label)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def stored(df: DataFrame, label: str = "input") -> DataFrame:
    """The frame itself if it only projects or filters one stored table, else a written copy."""
    node = df._jdf.queryExecution().optimizedPlan()
    while node.nodeName() in ("Project", "Filter"):
        node = node.children().head()
    return df if node.nodeName() == "LogicalRelation" else staged(df, label)


def with_uid(df: DataFrame, name: str = "_uid") -> DataFrame:
    """A row number that tells repeated rows apart.

    Good for one scan only: even over a stored table a later scan may be split
    otherwise. What is joined again on the number takes it from ``numbered``.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def numbered(df: DataFrame, label: str, name: str = "_uid") -> DataFrame:
    """The frame written once with its row numbers, the same in every later scan."""
    return staged(with_uid(df, name), label)


MOST_FILES = 1000


def numbered_rows(df: DataFrame, label: str) -> DataFrame:
    """``(row, _uid)``: each row whole inside ``row``, under a number that is the same in every later scan.

    Rows of a stored Parquet table have the number of their place in it, files in
    the order of their paths, and are not written again. What is derived, is read
    twice from one file or lies in over ``MOST_FILES`` files is written once with its numbers.
    """
    whole = F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns]).alias("row")
    if df._jdf.queryExecution().analyzed().nodeName() == "LogicalRelation" and "_metadata" not in [c.lower() for c in df.columns]:
        try:
            placed = df.select(whole, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_place"))
        except AnalysisException:       # not Parquet
            return numbered(df.select(whole), label)
        files = (placed.groupBy("_file").agg(F.count("*").alias("n"), F.max("_place").alias("last"))
                 .orderBy("_file").limit(MOST_FILES + 1).collect())
        if 0 < len(files) <= MOST_FILES and all(f.n == f.last + 1 for f in files):
            starts, n = [], 0
            for f in files:
                starts += [F.lit(f._file), F.lit(n).cast("bigint")]
                n += f.n
            return placed.select("row", (F.create_map(*starts)[F.col("_file")] + F.col("_place")).alias("_uid"))
    return numbered(df.select(whole), label)


def rows_of(df: DataFrame, uid_col: str | None, *cols: Column) -> DataFrame:
    """``cols`` with ``_uid``: the stored number in ``uid_col``, or a new one for a single scan."""
    if uid_col is None:
        return with_uid(stored(df).select(*cols))
    return df.select(F.col(uid_col).alias("_uid"), *cols)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; other letters stay as they are."""
    return F.translate(c, UPPER, LOWER)


def membership(df: DataFrame, key: Column, bits: int = 1 << 20) -> Callable[[Column], Column]:
    """A one-hash Bloom filter over a BIGINT key, as a predicate builder.

    The bit array has a fixed size (128 KiB by default) whatever the data, so
    it can travel inside the plan. It has false positives and no false
    negatives: callers still join or verify what passes.
    """
    words = bits // 64
    h = F.pmod(F.xxhash64(key), F.lit(bits))
    rows = (df.select(h.alias("h"))
            .groupBy(F.shiftright("h", 6).alias("w"))
            .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("h") % 64).cast("int"))).alias("b"))
            .collect())
    array = [0] * words
    for r in rows:
        array[r.w] = r.b
    table = F.from_json(F.lit("[" + ",".join(map(str, array)) + "]"), "array<bigint>")

    def test(k: Column) -> Column:
        # call sites evaluate the hash twice; both are cheap next to a shuffle
        x = F.pmod(F.xxhash64(k), F.lit(bits))
        word = F.get(table, F.shiftright(x, 6).cast("int"))
        return F.call_function("shiftrightunsigned", word, (x % 64).cast("int")).bitwiseAND(F.lit(1)) == 1

    return test


def components(edges: DataFrame, label: str = "cc", rows: int | None = None) -> DataFrame:
    """Connected components of undirected edges ``(a, b)``: rows ``(id, component)``.

    ``component`` is the smallest id reachable. Each round lowers labels along
    edges, hooks the old label's own label, then jumps pointers, so rounds grow
    with the logarithm of the diameter. Every round is written to the shared
    folder. A hub's edges meet its label in a join of two written tables,
    which AQE can split; minima are combined before each shuffle. Null ends are
    ignored; no edges give no rows. ``rows``: how many edges there are at most, if known.
    """
    both = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    e = staged(both.union(both.select("b", "a")).distinct(), f"{label}-edges", rows and 2 * rows)
    most = e.count()        # ids have an edge each
    lab = staged(e.groupBy("a").agg(F.min("b").alias("m"))
                 .select(F.col("a").alias("id"), F.least("a", "m").alias("component")), f"{label}-0", most)
    step = 0
    while True:
        step += 1
        near = (e.join(lab.select(F.col("id").alias("b"), "component"), "b")
                .groupBy(F.col("a").alias("id")).agg(F.min("component").alias("m")))
        x = lab.join(near, "id")
        low = F.least("component", "m")
        msgs = (x.select("id", low.alias("c"), F.col("component").alias("prev"))
                .union(x.select(F.col("component"), low, F.lit(None).cast(lab.schema["component"].dataType))))
        hooked = staged(msgs.groupBy("id").agg(F.min("c").alias("component"), F.max("prev").alias("prev")),
                        f"{label}-{step}a", most)
        up = hooked.select(F.col("id").alias("component"), F.col("component").alias("up"))
        jumped = staged(hooked.join(up, "component")
                        .select("id", F.least("component", "up").alias("component"), "prev"), f"{label}-{step}b", most)
        changed = jumped.where("component <> prev").limit(1).count()
        lab = jumped.select("id", "component")
        if not changed:
            return lab
