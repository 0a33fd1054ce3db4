"""A key holding a third of all rows: results equal brute force in plain Python."""

import random

from pyspark.sql import functions as F

from safetylake.operators import clean, gold
from safetylake.operators.dedupe import keep_least


def _least(rows):
    # NULL first, column by column (the survivor rule).
    return min(rows, key=lambda r: tuple((v is not None, v) for v in r))


def test_hot_key_dedupe_equals_brute_force(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        key = "HOT" if i % 3 == 0 else f"K{i % 400}"
        rows.append((key, rnd.choice([None, "a", "b", "c"]), rnd.choice([None, 1, 2, 3]), f"v{rnd.randint(0, 50)}"))
    df = spark.createDataFrame(rows, "k string, a string, b int, c string").repartition(8)
    got = {r[0]: tuple(r[1:]) for r in keep_least(df, ["k"]).collect()}
    by_key: dict[str, list] = {}
    for r in rows:
        by_key.setdefault(r[0], []).append(r[1:])
    assert got == {k: _least(v) for k, v in by_key.items()}
    plan = keep_least(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def test_hot_pair_summary_equals_brute_force(spark):
    from safetylake import schemas
    rnd = random.Random(11)
    reports, expect = [], {}
    for i in range(600):
        hot = i % 3 == 0
        drugs = ["HOTDRUG"] * 2 if hot else [f"D{rnd.randint(0, 20)}" for _ in range(rnd.randint(0, 3))]
        reacts = ["HOTREACTION"] if hot else [f"R{rnd.randint(0, 9)}" for _ in range(rnd.randint(0, 2))]
        serious = rnd.choice(["1", "2", None])
        reports.append((str(i), serious, "20240101", ("1", "30", [(d, "x") for d in drugs], [(r,) for r in reacts])))
        for d in drugs:
            for r in reacts:
                c, s = expect.get((d, r), (0, 0))
                expect[(d, r)] = (c + 1, s + (serious == "1"))
    raw = spark.createDataFrame(reports, schemas.RAW_ADVERSE).repartition(8)
    summary = gold.adverse_events_summary(clean.clean_adverse_events(raw))
    got = {(r.product_name, r.reaction_name): (r.event_count, r.serious_count) for r in summary.collect()}
    assert got == expect
    assert got[("HOTDRUG", "HOTREACTION")][0] == 2 * 200
