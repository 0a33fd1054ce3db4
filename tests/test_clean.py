"""Silver and gold on hand-written raw rows (the traps of the cleaning stage)."""

import json

from pyspark.sql import Row

from safetylake import schemas
from safetylake.operators import clean, gold
from safetylake.sources import ingest


def product(ndc, brand="b", route=None, ingredients=None, generic="g"):
    return (ndc, brand, generic, " lab ", "T", "F", "C", route, ingredients)


def products_df(spark, rows):
    return spark.createDataFrame(rows, schemas.RAW_PRODUCTS)


def report(rid, drugs, reactions, serious="1", date="20240131", age="40"):
    d = None if drugs is None else [(p, "ind") for p in drugs]
    r = None if reactions is None else [(x,) for x in reactions]
    return (rid, serious, date, ("1", age, d, r))


def adverse_df(spark, rows):
    return spark.createDataFrame(rows, schemas.RAW_ADVERSE)


def test_empty_vs_null_arrays(spark):
    rows = [product("1", route=[], ingredients=[]),
            product("2", route=None, ingredients=None),
            product("3", route=["A", "B"], ingredients=[("x", "1 mg"), ("y", "2 mg")])]
    got = {r.product_ndc: r for r in clean.clean_products(products_df(spark, rows)).collect()}
    assert (got["1"].primary_route, got["1"].primary_ingredient, got["1"].ingredient_count) == (None, None, 0)
    assert (got["2"].primary_route, got["2"].primary_ingredient, got["2"].ingredient_count) == (None, None, None)
    assert (got["3"].primary_route, got["3"].primary_ingredient, got["3"].primary_strength,
            got["3"].ingredient_count) == ("A", "x", "1 mg", 2)


def test_keys_trim_spaces_only_and_blank_key_kept(spark):
    rows = [product("A"), product(" A "), product("   "), product("\tK\t"), product(None)]
    got = sorted(r.product_ndc for r in clean.clean_products(products_df(spark, rows)).collect())
    assert got == sorted(["", "A", "\tK\t"])


def test_conflicting_duplicates_pick_the_same_row_in_any_partitioning(spark):
    rows = [product("K", brand=b, generic=g) for b, g in
            [("zeta", "one"), ("alpha", "two"), (None, "three"), ("alpha", "one")]]
    outs = set()
    for n in (1, 2, 3, 5):
        df = products_df(spark, rows).repartition(n)
        outs.add(tuple(clean.clean_products(df).collect()[0]))
    assert len(outs) == 1
    (row,) = outs
    assert row[1] is None and row[2] == "THREE"      # NULL brand sorts first


def test_fan_out_and_counts(spark):
    rows = [report("r1", ["P1", "P2"], ["A", "B", "C"]),      # 2 x 3 = 6 pairs
            report("r2", ["X", "X"], ["R"]),                 # repeated drug counts twice
            report("r3", None, ["R"]),                       # no drugs: removed
            report("r4", ["Y"], []),                         # no reactions: silver only
            report("r5", ["Y"], None)]
    silver = clean.clean_adverse_events(adverse_df(spark, rows))
    pairs = silver.collect()
    assert sum(1 for p in pairs if p.report_id == "r1") == 6
    assert not [p for p in pairs if p.report_id == "r3"]
    assert {(p.report_id, p.reaction_name) for p in pairs if p.product_name == "Y"} == {("r4", None),
                                                                                         ("r5", None)}
    summary = {(r.product_name, r.reaction_name): r.event_count
               for r in gold.adverse_events_summary(silver).collect()}
    assert summary[("X", "R")] == 2
    assert ("Y", None) not in summary and len(summary) == 7


def test_same_report_twice_doubles_counts(spark):
    rows = [report("r1", ["P"], ["R"]), report("r1", ["P"], ["R"])]
    summary = gold.adverse_events_summary(clean.clean_adverse_events(adverse_df(spark, rows))).collect()
    assert [(r.event_count, r.serious_count) for r in summary] == [(2, 2)]


def test_tolerant_parsing_in_silver(spark):
    rows = [report("r1", ["P"], ["R"], serious="x", date="", age="1.5"),
            report(None, ["P"], ["R"])]
    (row,) = clean.clean_adverse_events(adverse_df(spark, rows)).collect()
    assert (row.is_serious, row.receive_date, row.patient_age) == (None, None, None)


def test_enforcement_dates_and_dedupe(spark):
    base = {f: None for f in schemas.RAW_ENFORCEMENT.fieldNames()}
    r1 = dict(base, recall_number=" F-1 ", recall_initiation_date="20241399", report_date="20240101",
              classification="Class I")
    r2 = dict(r1, recall_number="F-1")
    df = spark.createDataFrame([Row(**r1), Row(**r2)], schemas.RAW_ENFORCEMENT)
    (row,) = clean.clean_enforcement(df).collect()
    assert row.recall_number == "F-1" and row.recall_date is None and str(row.report_date) == "2024-01-01"


def test_json_absent_field_and_empty_file(spark, scratch):
    path = f"{scratch}/recalls"
    with open(f"{scratch}/one.json", "w") as f:
        f.write(json.dumps({"recall_number": "F-9", "status": "Ongoing"}) + "\n")
    df = ingest.bronze(spark, f"{scratch}/one.json", schemas.RAW_ENFORCEMENT, schemas.SOURCE_ENFORCEMENT)
    (row,) = clean.clean_enforcement(df).collect()
    assert row.termination_date is None and row.status == "Ongoing"
    with open(f"{scratch}/empty.json", "w") as f:
        f.write("[]")
    empty = ingest.bronze(spark, f"{scratch}/empty.json", schemas.RAW_ENFORCEMENT,
                          schemas.SOURCE_ENFORCEMENT, multiline=True)
    assert clean.clean_enforcement(empty).count() == 0
    assert clean.clean_enforcement(empty).columns == list(schemas.ENFORCEMENT_COLUMNS)
    del path


def test_json_array_file_round_trip(spark, scratch):
    recs = [{"safetyreportid": "1", "serious": "1", "receivedate": "20240102",
             "patient": {"patientsex": "2", "drug": [{"medicinalproduct": "a"}, {"medicinalproduct": "b"}],
                         "reaction": [{"reactionmeddrapt": "r"}]}}]
    with open(f"{scratch}/ae.json", "w") as f:
        f.write(json.dumps(recs))
    df = ingest.bronze(spark, f"{scratch}/ae.json", schemas.RAW_ADVERSE, schemas.SOURCE_ADVERSE,
                       multiline=True)
    summary = gold.adverse_events_summary(clean.clean_adverse_events(df)).collect()
    assert sorted((r.product_name, r.event_count) for r in summary) == [("A", 1), ("B", 1)]


def test_hot_report_is_tiled_with_identical_pairs(spark):
    drugs = [f"P{i % 7}" if i % 11 else None for i in range(40)]
    reactions = [f"R{j % 5}" for j in range(30)] + [None]
    rows = [report("hot", drugs, reactions), report("hot", drugs, reactions),
            report("small", ["A", "B"], ["X"]), report("none", ["A"], []), report("nul", ["A"], None)]
    raw = adverse_df(spark, rows)
    direct = clean.stage_adverse_events(raw, tile_side=None)
    tiled = clean.stage_adverse_events(raw, tile_side=4)
    a = sorted(map(tuple, direct.collect()), key=repr)
    b = sorted(map(tuple, tiled.collect()), key=repr)
    assert a == b and len(a) == 2 * 36 * 31 + 2 + 1 + 1
    plan = tiled._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "Union" not in plan
    # The hot report's tiles land on many partitions.
    tiles = clean._tiles(clean.stage_adverse_reports(raw), ["report_id"], 4)
    used = {r[0] for r in tiles.filter("report_id = 'hot'").selectExpr("spark_partition_id()").collect()}
    assert len(used) == int(spark.conf.get("spark.sql.shuffle.partitions"))      # 80 tiles reach every core


def test_strict_mode_raises_on_bad_input(spark):
    import pytest
    base = {f: None for f in schemas.RAW_ENFORCEMENT.fieldNames()}
    bad = spark.createDataFrame([Row(**dict(base, recall_number="F-1", recall_initiation_date="20241399"))],
                                schemas.RAW_ENFORCEMENT)
    assert clean.clean_enforcement(bad).collect()[0].recall_date is None
    with pytest.raises(Exception):
        clean.clean_enforcement(bad, strict=True).collect()
    rows = [report("r1", ["P"], ["R"], age="1.5")]
    with pytest.raises(Exception):
        clean.clean_adverse_events(adverse_df(spark, rows), strict=True).collect()


def test_pair_counts_beyond_int_range(spark):
    from pyspark.sql import functions as F

    from safetylake import schemas

    many = 50_000
    raw = spark.range(1).select(
        F.lit("1").alias("safetyreportid"), F.lit("1").alias("serious"), F.lit("20240101").alias("receivedate"),
        F.struct(F.lit("1").alias("patientsex"), F.lit("1").alias("patientonsetage"),
                 F.transform(F.sequence(F.lit(1), F.lit(many)), lambda i: F.struct(
                     F.lit("D").alias("medicinalproduct"), F.lit("I").alias("drugindication"))).alias("drug"),
                 F.transform(F.sequence(F.lit(1), F.lit(many)), lambda i: F.struct(
                     F.lit("R").alias("reactionmeddrapt"))).alias("reaction")).alias("patient"))
    assert raw.columns == schemas.RAW_ADVERSE.fieldNames()
    got = {r.stage: r.total for r in clean.adverse_quality(raw).filter("rule = 'has_report_id'").collect()}
    assert got == {"input": many * many, "output": many * many}
