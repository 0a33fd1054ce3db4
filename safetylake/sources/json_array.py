"""Files that hold JSON arrays of objects, read by many tasks.

``json.dumps(list)`` writes a feed as one line, which a JSON reader takes as
one record in one task. Here the file is cut at every ``}`` by Spark's text
reader, whose custom line separator lets it read byte ranges, and the cuts that
end a record are found from the string and bracket state in front of them:

* a fragment with an odd number of unescaped quotes flips "inside a string";
* outside strings, ``{[`` go one level down and ``}]`` one up;
* a record ends with a ``}`` outside strings that returns to the array's level.

Both states are running sums. They are summed inside pieces of a byte range,
once as if the piece started outside a string and once as if inside, and one
row a piece is left. These rows, summed in file order, tell how each piece
really starts and where its first record ends (``_starts``). Up to there the
text belongs to the piece in which that record starts, and is sent to it; every
piece then holds whole records and starts at the array's level, outside
strings. So the text is shuffled once, and no task needs more than a piece and
the end of its last record at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A piece has two to the power of this many fragments.
PIECE_BITS = 15
PIECE = ["_piece", "_file", "_start"]


def _count(c: Column, signs: str) -> Column:
    return F.length(c) - F.length(F.translate(c, signs, ""))


def fragments(spark: SparkSession, path: str) -> DataFrame:
    """The texts of each file up to its next ``}``, in byte ranges: ``_at`` orders them inside a range, a piece is a run of it."""
    return (spark.read.option("lineSep", "}").text(path)
            .select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"))
            .withColumn("_at", F.monotonically_increasing_id())
            .withColumn("_piece", F.shiftright("_at", PIECE_BITS)))


def _signs(df: DataFrame) -> DataFrame:
    """``_odd``: whether a fragment's quotes flip the state; ``_deeper0``, ``_deeper1``: the levels it goes down by its
    brackets, if it starts outside a string or inside one."""
    # without escapes every quote opens or closes a string
    df = df.withColumn("_signs", F.regexp_replace("value", r'\\.|[^"{}\[\]\\]+', ""))
    outside = [F.regexp_replace(text, '"[^"]*("|$)', "") for text in (F.col("_signs"), F.concat(F.lit('"'), "_signs"))]
    return df.withColumns({"_odd": (_count(F.col("_signs"), '"') % 2).cast("int")} | {
        f"_deeper{i}": _count(o, "{[") - _count(o, "}]") for i, o in enumerate(outside)}).drop("_signs")


def _level(i: int) -> Column:
    """What a fragment adds to the level, with the ``}`` behind it, if the piece starts outside a string (0) or inside (1)."""
    before = (F.col("_after") + F.col("_odd")) % 2
    return F.when(before == i, F.col("_deeper0")).otherwise(F.col("_deeper1")) - (F.col("_after") == i).cast("int")


def _starts(cut: DataFrame) -> DataFrame:
    """One row a piece: ``_end``, the fragment that ends its first record (null: none does), ``_first``, its first
    fragment, ``_from``, that of the piece in which the record at its start begins (negative: the file's first record),
    and ``_cut_off``, its file if that ends too early."""
    inside = Window.partitionBy(*PIECE).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    states = _signs(cut).withColumn("_after", F.sum("_odd").over(inside) % 2)      # 1: inside a string, if the piece starts outside
    states = states.withColumns({f"_level{i}": F.sum(_level(i)).over(inside) for i in (0, 1)})
    # a fragment closes an object for one of the two starts only
    level = F.when(F.col("_after") == 0, F.col("_level0")).otherwise(F.col("_level1"))
    last = ["_after", "_level0", "_level1"]
    found = (states.groupBy(*PIECE, F.col("_after").alias("_in"), level.alias("_level"))
             .agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"), *[F.max_by(c, "_at").alias(c) for c in last]))
    pieces = found.groupBy(*PIECE).agg(
        F.collect_list(F.struct("_in", "_level", "_first")).alias("_closed"),
        F.min("_first").alias("_first"), *[F.max_by(c, "_last").alias(c) for c in last])
    file = Window.partitionBy("_file").orderBy("_start", "_piece")
    before, whole = file.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("_file")
    pieces = pieces.withColumn("_in", F.coalesce(F.sum("_after").over(before), F.lit(0)) % 2)
    pieces = pieces.withColumn("_deeper", F.when(F.col("_in") == 0, F.col("_level0")).otherwise(F.col("_level1")))
    pieces = pieces.withColumns({"_depth": F.coalesce(F.sum("_deeper").over(before), F.lit(0)), "_total": F.sum("_deeper").over(whole)})
    ends = F.filter("_closed", lambda c: (c["_in"] == F.col("_in")) & (c["_level"] + F.col("_depth") == 1))
    pieces = pieces.withColumn("_end", F.get(ends, F.lit(0))["_first"])
    starts = F.last(F.when(F.col("_end").isNotNull(), F.col("_first")), ignorenulls=True).over(before)
    opening = -1 - F.first("_first").over(file.rowsBetween(Window.unboundedPreceding, 0))
    # what follows the last ``}`` of a whole file closes its array, and counts as a fragment that closes an object
    return pieces.select(*PIECE, "_end", "_first", F.coalesce(starts, opening).alias("_from"),
                         F.when(F.col("_total") != -1, F.col("_file")).alias("_cut_off"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row ``value`` (JSON text) for each object in the arrays of the files, in no order.

    White space and separators may be any that JSON allows, and a file may hold
    several arrays one after another. Objects, arrays and strings inside records
    may hold anything. An empty array or file has no rows. A file whose last
    array is not closed, or that ends inside a string, raises when its rows are read.
    """
    cut = fragments(spark, path)
    owner = F.when(F.col("_end").isNull() | (F.col("_at") <= F.col("_end")), F.col("_from")).otherwise(F.col("_first"))
    # the starts are few: a row for every 2 MB or so
    placed = cut.join(F.broadcast(_starts(cut)), PIECE).select(owner.alias("_owner"), "_start", "_at", "value", "_cut_off")
    inside = Window.partitionBy("_owner").orderBy("_start", "_at").rowsBetween(Window.unboundedPreceding, 0)
    found = _signs(placed.repartition("_owner")).withColumn("_after", F.sum("_odd").over(inside) % 2)
    depth = F.sum(_level(0)).over(inside) + (F.col("_owner") >= 0).cast("int")
    found = found.withColumn("_ends", (F.col("_after") == 0) & (depth == 1))
    found = found.withColumn("_record", F.count_if("_ends").over(inside) - F.col("_ends").cast("int"))
    whole = found.groupBy("_owner", "_record").agg(
        F.sort_array(F.collect_list(F.struct("_start", "_at", "value"))).alias("_parts"),
        F.max("_ends").alias("_ended"), F.any_value("_cut_off").alias("_cut_off"))
    text = F.array_join(F.transform("_parts", lambda p: F.concat(p["value"], F.lit("}"))), "")
    text = F.regexp_replace(text, r"^[\s,\[\]]*(?=\{)", "")         # commas and the ends and starts of arrays
    broken = F.raise_error(F.concat(F.lit("the JSON array ends too early in "), F.col("_cut_off"))).cast("string")
    return whole.filter(F.col("_ended") | F.col("_cut_off").isNotNull()).select(F.when(F.col("_cut_off").isNotNull(), broken).otherwise(text).alias("value"))
