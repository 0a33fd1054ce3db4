"""Named row-level quality rules and their metrics.

A rule is a SQL predicate with an action: ``drop`` removes failing rows,
``warn`` keeps them and only counts. Only TRUE passes; a predicate that
evaluates to NULL is counted separately as ``null_result`` (and is dropped
by a ``drop`` rule, as a filter would).

Metrics for any number of rules come from one aggregate pass: each rule
adds three conditional counts to a single global aggregation, which Spark
computes as map-side partials and one tiny final merge.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DROP = "drop"
WARN = "warn"


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str
    action: str = WARN

    def column(self) -> Column:
        return F.expr(self.predicate)


def apply_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Remove rows failing any ``drop`` rule (NULL counts as failing)."""
    out = df
    for r in rules:
        if r.action == DROP:
            out = out.filter(F.coalesce(r.column(), F.lit(False)))
    return out


FAILED, REJECTED = "failed_rules", "_rejected"


def judged(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """``df`` with the names of the rules each row does not pass, and whether one of them drops it."""
    def names(some: list[Rule]) -> Column:
        return F.filter(F.array(*[F.when(~F.coalesce(r.column(), F.lit(False)), F.lit(r.name)) for r in some]), lambda x: x.isNotNull())

    drops = [r for r in rules if r.action == DROP]
    return df.withColumns({FAILED: names(rules) if rules else F.array().cast("array<string>"),
                           REJECTED: F.size(names(drops)) > 0 if drops else F.lit(False)})


def route(df: DataFrame, rules: list[Rule], path: str) -> tuple[DataFrame, DataFrame]:
    """Write every row once, accepted and rejected ones to partitions of their own; the two as stored.

    Rejected rows keep ``failed_rules``, the names of all rules they fail, so they
    can be mended and sent again. One write decides both, so accepted plus
    rejected is the input whatever is retried, and counts (``routed_counts``)
    are of what was written.
    """
    judged(df, rules).write.mode("overwrite").partitionBy(REJECTED).parquet(path)
    rows = df.sparkSession.read.schema(judged(df, rules).schema).parquet(path)
    return rows.filter(~F.col(REJECTED)).drop(REJECTED, FAILED), rows.filter(REJECTED).drop(REJECTED)


def routed_counts(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """Rows written to each side and, for each rule, the rows of each side that fail it (rule null: all rows)."""
    rows = spark.read.parquet(path).select(REJECTED, F.explode(F.concat(F.array(F.lit(None).cast("string")), FAILED)).alias("rule"))
    return (rows.groupBy("rule").agg(F.count_if(~F.col(REJECTED)).alias("accepted"), F.count_if(REJECTED).alias("rejected"))
            .select(F.lit(dataset).alias("dataset"), "rule", "accepted", "rejected"))


INPUT, OUTPUT = "input", "output"


def rule_metrics(df: DataFrame, rules: list[Rule], dataset: str, weight: str | None = None,
                 stage: str = INPUT, output: list[Rule] | None = None) -> DataFrame:
    """One row per rule: dataset, stage, rule, action, total, passed, failed, null_result.

    ``stage`` names the population: rows before the drop rules and the dedupe
    (``input``) or the rows of the finished dataset (``output``). With
    ``output``, rules measured on the rows that pass the drop rules among them,
    rows of both stages come from the same pass; that is right where nothing but
    the drop rules removes rows.

    With ``weight``, each row stands for ``weight`` rows (e.g. a report for
    all the pairs it expands into) and counts become weighted sums.
    """
    kept = F.lit(True)
    for r in output or []:
        if r.action == DROP:
            kept = kept & F.coalesce(r.column(), F.lit(False))
    populations = [(stage, rules, F.lit(True))] + ([(OUTPUT, output, kept)] if output is not None else [])

    def count(cond: Column) -> Column:
        if weight is None:
            return F.count_if(cond)
        return F.coalesce(F.sum(F.when(cond, F.col(weight).cast("bigint"))), F.lit(0).cast("bigint"))

    aggs, rows = [], []
    for k, (name, some, among) in enumerate(populations):
        aggs.append(count(among).alias(f"_t{k}"))
        for i, r in enumerate(some):
            c = r.column()
            sides = {"passed": c, "failed": ~c, "null_result": c.isNull()}
            aggs += [count(among & side).alias(f"_{what}{k}_{i}") for what, side in sides.items()]
            rows.append(F.struct(F.lit(name).alias("stage"), F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"),
                                 F.col(f"_t{k}").alias("total"), *[F.col(f"_{what}{k}_{i}").alias(what) for what in sides]))
    return df.agg(*aggs).select(F.inline(F.array(*rows))).select(F.lit(dataset).alias("dataset"), "*")
