"""Chat formatting in budgeted windows, in DataFrame functions only.

Turns are rendered with a template that marks role and end; the template's
control characters inside roles and texts are escaped as entities, reversibly.
Prefix sums of turn tokens place each turn on a line that is cut every ``span``
tokens: the turns that lie wholly between two cuts form one window, a turn that
crosses a cut is a window of its own, so a window's new turns never exceed the
span unless one turn alone does. Every window retains the conversation's system
turn and repeats up to ``history`` tokens of the turns before it. Assistant texts
are loss targets in the window where they are new; repeated ones are masked, so
each is a target once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed marks of the template; neither character can occur in an escaped text.
OPEN, SHUT, END = "<|im_start|>", "<|im_end|>", "\n"


def escape(c: Column) -> Column:
    """Entities for ``&``, ``<`` and ``[``, so that no control string is left."""
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;")):
        c = F.replace(c, F.lit(raw), F.lit(entity))
    return c


def unescape(c: Column) -> Column:
    for raw, entity in (("[", "&#91;"), ("<", "&lt;"), ("&", "&amp;")):
        c = F.replace(c, F.lit(entity), F.lit(raw))
    return c


def tokens(text: Column) -> Column:
    """Words and single marks: the unit of the budget."""
    return F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"))


def windows(turns: DataFrame, budget: int = 2048, history: int = 512, conv_col: str = "conv_id",
            turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per window: conv id, ``window`` (from 0), ``text``, ``loss`` (array of ``start``, ``length`` in
    code points of ``text``), ``n_repeated`` (leading turns that are repeats), ``n_new``, ``n_tokens``.

    Turns are ordered by turn, nulls first, then role and text; equal rows are
    separate turns. Null roles and texts are empty; a null conversation id is a
    conversation. The span is ``budget`` less the history and the system turn, at
    least 1. A conversation's system turn is its first turn with that role;
    further ones are ordinary turns. An empty table has no windows. Other
    columns are not read.
    """
    t = turns.select(F.col(conv_col).alias("c"), F.col(turn_col).alias("t"),
                     F.coalesce(F.col(role_col), F.lit("")).alias("r"), F.coalesce(F.col(text_col), F.lit("")).alias("x"))
    order = Window.partitionBy("c").orderBy(F.col("t").asc_nulls_first(), "r", "x")
    whole = Window.partitionBy("c")
    body = escape(F.col("x"))
    head = F.concat(F.lit(OPEN), F.replace(escape(F.col("r")), F.lit(END), F.lit("&#10;")), F.lit(END))
    t = (t.withColumn("i", F.row_number().over(order))
         .withColumn("head", head)
         .withColumn("block", F.concat(head, body, F.lit(SHUT + END)))
         .withColumn("n", tokens(F.col("block")).cast("bigint"))
         .withColumn("upto", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)))
         .withColumn("sys_i", F.min(F.when(F.col("r") == "system", F.col("i"))).over(whole))
         .withColumn("sys_n", F.coalesce(F.max(F.when(F.col("i") == F.col("sys_i"), F.col("n"))).over(whole), F.lit(0))))
    start = F.col("upto") - F.col("n")
    span = F.greatest(F.lit(budget - history) - F.col("sys_n"), F.lit(1))
    t = (t.withColumn("start", start)
         .withColumn("cell", F.floor(F.col("start") / span))
         .withColumn("cross", F.floor((F.col("upto") - 1) / span) > F.floor(F.col("start") / span)))
    # a new window starts where the cell changes or a turn crosses a cut
    before = F.lag("cell").over(order)
    fresh = before.isNull() | (before != F.col("cell")) | F.col("cross") | F.lag("cross").over(order)
    t = t.withColumn("fresh", fresh.cast("int")) \
         .withColumn("window", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    turn = F.struct("i", "n", "r", "head", "block", F.length("head").alias("skip"),
                    F.length(body).alias("len"), F.length("block").alias("size"))
    t = t.withColumn("turn", turn)
    # what may be repeated: turns that start at most ``history`` tokens earlier; a turn has tokens, so they are few
    recent = Window.partitionBy("c").orderBy("start").rangeBetween(-history, -1)
    other = F.when(F.col("sys_i").isNull() | (F.col("i") != F.col("sys_i")), F.col("turn"))
    t = t.withColumn("past", F.when(F.col("fresh") == 1, F.collect_list(other).over(recent)))
    system = F.max(F.when(F.col("i") == F.col("sys_i"), F.col("turn"))).over(whole)
    t = t.withColumn("system", F.when((F.col("fresh") == 1) & (F.col("sys_i") < F.col("i")), system))
    w = t.groupBy("c", "window").agg(
        F.sort_array(F.collect_list("turn")).alias("new"), F.max("past").alias("past"), F.max("system").alias("system"))
    repeated = F.concat(
        F.when(F.col("system").isNull(), F.array().cast(w.schema["new"].dataType)).otherwise(F.array("system")),
        F.filter(F.sort_array(F.coalesce("past", F.array().cast(w.schema["new"].dataType))),
                 lambda p: F.get(F.col("new"), F.lit(0))["i"] > p["i"]))
    w = w.withColumn("repeated", repeated).withColumn("all", F.concat("repeated", "new"))
    sizes = F.transform("all", lambda p: p["size"])
    # offsets of the new assistant texts, in code points
    spans = F.filter(F.transform("all", lambda p, k: F.struct(
        (F.aggregate(F.slice(sizes, F.lit(1), k), F.lit(0), lambda a, s: a + s) + p["skip"]).alias("start"),
        p["len"].alias("length"), ((p["r"] == "assistant") & (k >= F.size("repeated"))).alias("target"))),
        lambda s: s["target"])
    return w.select(
        F.col("c").alias(conv_col), "window",
        F.array_join(F.transform("all", lambda p: p["block"]), "").alias("text"),
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length"))).alias("loss"),
        F.size("repeated").alias("n_repeated"), F.size("new").alias("n_new"),
        F.aggregate(F.transform("all", lambda p: p["n"]), F.lit(0).cast("bigint"), lambda a, n: a + n).alias("n_tokens"))


def read_back(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """``(conv id, window, turns, targets, chars)`` from the formatted texts alone: the new turns as
    ``(role, text)`` and the texts under the loss mask, unescaped."""
    blocks = F.slice(F.split("text", F.lit(r"\Q" + OPEN + r"\E")), F.col("n_repeated") + 2, F.col("n_new"))

    def start(b: Column) -> Column:
        return F.length(F.substring_index(b, END, 1)) + 2

    parsed = F.transform(blocks, lambda b: F.struct(
        unescape(F.replace(F.substring_index(b, END, 1), F.lit("&#10;"), F.lit(END))).alias("role"),
        unescape(F.substr(b, start(b), F.length(b) - start(b) + 1 - len(SHUT + END))).alias("text")))
    return formatted.select(
        conv_col, "window", parsed.alias("turns"),
        F.transform("loss", lambda s: unescape(F.substr(F.col("text"), s["start"] + 1, s["length"]))).alias("targets"),
        F.length("text").alias("chars"))


def report(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Digest columns per conversation, read back from its windows."""
    per = read_back(formatted, conv_col).groupBy(conv_col).agg(
        F.sort_array(F.collect_list(F.struct("window", "turns", "targets"))).alias("w"), F.sum("chars").alias("formatted_chars"))
    turns = F.flatten(F.transform("w", lambda x: x["turns"]))
    target = F.array_join(F.flatten(F.transform("w", lambda x: x["targets"])), "")
    lines = F.array_join(F.transform(turns, lambda p: F.concat(p["role"], F.lit("\n"), p["text"], F.lit("\n"))), "")
    return per.select(
        conv_col, F.size(turns).cast("bigint").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length(target).cast("bigint").alias("loss_chars"), F.sha2(target.cast("binary"), 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("bigint"))

