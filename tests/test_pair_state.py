"""The summary from merged partial states equals the summary of all rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from safetylake import schemas
from safetylake.operators import clean, gold, pair_state
from safetylake.sources import fixtures

REPORT = schemas.RAW_ADVERSE


def as_set(df):
    return {tuple(r) for r in df.collect()}


def report(rng, i):
    names = [None, " aspirin", "Zinc ", "aspirin", "iron"]
    drugs = rng.choice([None, [], [(rng.choice(names), "pain") for _ in range(rng.randrange(1, 4))]])
    reactions = rng.choice([None, [], [(rng.choice([None, "Rash", "rash ", "fever"]),) for _ in range(rng.randrange(1, 4))]])
    return (rng.choice([None, str(i), str(i)]), rng.choice([None, "1", "2", "x"]),
            rng.choice([None, "", "20240101", "20240102", "20231231"]), (rng.choice(["0", None]), "30", drugs, reactions))


@pytest.mark.parametrize("seed", range(4))
def test_incremental_equals_full(spark, seed):
    rng = random.Random(seed)
    old = [report(rng, i) for i in range(60)]
    new = [r for r in old if rng.random() > 0.3] + [report(rng, 100 + i) for i in range(25)]
    new += rng.sample(old, 5) * 2               # copies count again
    a, b = spark.createDataFrame(old, REPORT), spark.createDataFrame(new, REPORT)
    state = pair_state.merged(pair_state.units(clean.clean_adverse_events(a)))
    now = pair_state.merged(state, pair_state.delta(a, b))
    assert as_set(pair_state.summary(now)) == as_set(gold.adverse_events_summary(clean.clean_adverse_events(b)))
    # parts in any grouping merge to one state
    parts = [pair_state.merged(pair_state.units(clean.clean_adverse_events(spark.createDataFrame(new[i::3], REPORT)))) for i in range(3)]
    assert as_set(pair_state.merged(parts[2], pair_state.merged(parts[0], parts[1]))) == as_set(now)
    # and back again
    assert as_set(pair_state.merged(now, pair_state.delta(b, a))) == as_set(state)


def test_dates_of_retracted_reports_are_given_up(spark):
    day = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    rows = spark.createDataFrame([("A", "R", d, 1, s) for d, s in zip(day, (1, 0, 0))], "product_name string, reaction_name string, receive_date date, events bigint, serious bigint")
    less = spark.createDataFrame([("A", "R", day[0], -1, -1)], rows.schema)
    assert as_set(pair_state.summary(pair_state.merged(rows, less))) == {("A", "R", 2, 0, day[1], day[2])}
    assert pair_state.merged(less, less, rows, rows).count() == 2
    with pytest.raises(Exception, match="more events retracted than added: A / R"):
        pair_state.merged(rows, less, less).collect()


def test_only_changed_reports_are_expanded(spark):
    old = fixtures.raw_adverse(spark, SF_SMALL)
    new = fixtures.next_raw_adverse(old)
    gone, come = pair_state.changed_reports(old, new)
    assert 0 < gone.count() < old.count() / 2 and 0 < come.count() < new.count() / 2
    assert [x.count() for x in pair_state.changed_reports(old, old)] == [0, 0]


def test_entries_of_a_date_are_expanded_together(spark):
    """A date's tiles lie in few partitions, so the sums by pair and date combine before their shuffle."""
    rows = [(str(i), "1", f"2024010{i % 2 + 1}", ("0", "30", [("iron", "pain")], [("Rash",)])) for i in range(4000)]
    raw = spark.createDataFrame(rows, REPORT)
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        placed = pair_state.entries(raw).select("receive_date", F.spark_partition_id().alias("p"))
        spread = {r.receive_date: r.n for r in placed.groupBy("receive_date").agg(F.countDistinct("p").alias("n")).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(spread) == 2 and all(1 < n <= clean.DATE_SHARES for n in spread.values())


def test_digests_and_fields_without_entries_are_not_shuffled_whole(spark):
    raw = spark.createDataFrame([("1", "1", "20240101", ("0", "30", [("iron", "pain")], [("Rash",)])), ("2", "1", None, None)], REPORT)
    cut = pair_state.counted_fields(raw)
    assert cut.schema.simpleString() == raw.schema.simpleString() and [r.patient and r.patient.drug[0].drugindication for r in cut.collect()] == [None, None]
    # a change in a field that no entry is made of still makes another report, and changes no sum
    new = raw.withColumn("patient", F.col("patient").withField("patientonsetage", F.lit("31")))
    assert [x.count() for x in pair_state.changed_reports(raw, new, pair_state.counted_fields)] == [1, 1]
    state = pair_state.merged(pair_state.entries(raw))
    assert as_set(pair_state.merged(state, pair_state.delta(raw, new))) == as_set(state) != set()
