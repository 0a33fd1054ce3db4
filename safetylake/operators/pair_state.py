"""Mergeable state behind the product x reaction summary.

A state is a set of entries ``(product_name, reaction_name, receive_date,
events, serious)``: how many drug x reaction rows a pair has on a date, and how
many of them are serious. Any number of entries may stand for one pair and
date; entries add up, so

* every silver row is an entry of one event (``units``),
* states of parts of the data, or of added reports, are merged by a union,
* a removed report's entries are merged with negative counts (a retraction).

Counts alone could not give back the first and last date once a report is
retracted; the number of events on each date can. ``merged`` adds entries up
and drops dates that no event is left on; ``summary`` reads the published
columns off a state.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from safetylake.operators.clean import clean_adverse_events
from safetylake.schemas import PK_ADVERSE

PAIR = list(PK_ADVERSE)
DATE = "receive_date"


def units(silver: DataFrame, sign: int = 1) -> DataFrame:
    """One entry a silver row whose two names are known; ``sign=-1`` retracts the rows."""
    known = silver.na.drop(subset=PAIR)
    return known.select(*PAIR, DATE, F.lit(sign).cast("bigint").alias("events"),
                        F.when(F.col("is_serious") == 1, F.lit(sign)).otherwise(F.lit(0)).cast("bigint").alias("serious"))


def merged(*states: DataFrame) -> DataFrame:
    """One entry for each pair and date that still has events.

    Partial sums are taken before the shuffle, so a pair or a date with a third
    of all rows leaves each task as one entry. Raises if more was retracted
    than had been added.
    """
    every = reduce(DataFrame.unionByName, states)
    sums = every.groupBy(*PAIR, DATE).agg(F.sum("events").alias("events"), F.sum("serious").alias("serious"))
    below = F.raise_error(F.concat(F.lit("more events retracted than added: "), F.concat_ws(" / ", *PAIR)))
    return (sums.withColumn("events", F.when(F.col("events") < 0, below.cast("bigint")).otherwise(F.col("events")))
            .filter(F.col("events") != 0))


def summary(state: DataFrame) -> DataFrame:
    """The published columns of every pair in a state without retractions (``units`` or ``merged``)."""
    return state.groupBy(*PAIR).agg(
        F.sum("events").alias("event_count"), F.sum("serious").alias("serious_count"),
        F.min(DATE).alias("earliest_report"), F.max(DATE).alias("latest_report"))


def counted_fields(raw: DataFrame) -> DataFrame:
    """Raw reports with null in the fields that no entry is made of, so that they are not shuffled."""
    patient = F.struct(
        F.lit(None).cast("string").alias("patientsex"), F.lit(None).cast("string").alias("patientonsetage"),
        F.transform("patient.drug", lambda d: F.struct(
            d["medicinalproduct"].alias("medicinalproduct"), F.lit(None).cast("string").alias("drugindication"))).alias("drug"),
        F.col("patient.reaction").alias("reaction"))
    return raw.withColumn("patient", F.when(F.col("patient").isNotNull(), patient))


def entries(raw: DataFrame, sign: int = 1) -> DataFrame:
    """The ``units`` of raw reports, expanded by date: few partial sums a pair and date leave the tasks."""
    return units(clean_adverse_events(counted_fields(raw), by_date=True), sign)


def changed_reports(old: DataFrame, new: DataFrame, cut: Callable[[DataFrame], DataFrame] = lambda reports: reports) -> tuple[DataFrame, DataFrame]:
    """The raw reports of each of two snapshots that the other holds in another number.

    Reports are compared by a digest of the whole record (128 bits of its
    SHA-256), so no key is needed and repeated reports count as often as they
    occur. Digests are shuffled, then what ``cut`` leaves of the reports. Copies
    that both snapshots hold stay on both sides and cancel out.
    """
    cols = sorted(new.columns)
    digest = F.substring(F.unhex(F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)), 1, 16)
    old, new = old.withColumn("_digest", digest), new.withColumn("_digest", digest)
    differ = (old.select("_digest", F.lit(-1).alias("n")).unionByName(new.select("_digest", F.lit(1).alias("n")))
              .groupBy("_digest").agg(F.sum("n").alias("n")).filter("n <> 0").select("_digest"))
    return tuple(cut(side).join(differ, "_digest", "left_semi").drop("_digest") for side in (old, new))


def delta(old: DataFrame, new: DataFrame) -> DataFrame:
    """Entries that lead from the state of one raw snapshot to that of the next; only changed reports are expanded."""
    gone, come = changed_reports(old, new, counted_fields)
    return entries(come).unionByName(entries(gone, -1))
