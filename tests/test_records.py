"""Whole raw records, schema drift, JSON arrays read in byte ranges, quarantine."""

import json
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from safetylake import schemas
from safetylake.operators import quality
from safetylake.plans import catalog
from safetylake.sources import ingest, json_array

S = schemas


def as_set(df):
    return {tuple(r) for r in df.collect()}


def text(spark, lines, path):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


# --- records -----------------------------------------------------------------------------------

def test_undeclared_fields_survive_storage_and_later_projection(spark, scratch):
    lines = ['{"product_ndc": "1", "openfda": {"rx": ["a", "b"], "n": 7}}', '{"product_ndc": "2", "openfda": "text"}',
             '{"product_ndc": "3"}', "", "   ", '{"product_ndc": "4"', "nonsense"]
    bronze = ingest.bronze_records(spark, text(spark, lines, f"{scratch}/raw"), S.RAW_PRODUCTS, "tag")
    bronze.write.parquet(f"{scratch}/bronze")
    stored = spark.read.parquet(f"{scratch}/bronze")
    assert set(S.RAW_PRODUCTS.fieldNames()) < set(stored.columns)
    fields = {"second": ("$.openfda.rx[1]", "string"), "n": ("$.openfda.n", "int"), "all": ("$.openfda", "string")}
    got = {r.product_ndc: (r.second, r.n, r.all) for r in ingest.projected(stored, fields, ["product_ndc"]).collect()}
    assert got["1"][:2] == ("b", 7) and got["2"] == (None, None, "text") and got["3"] == (None, None, None)
    bad = stored.filter(F.col(ingest.CORRUPT).isNotNull())
    assert bad.count() == 2 and bad.filter(F.col(ingest.RECORD).isNotNull()).count() == 0


def test_drift_lists_new_missing_and_retyped_paths(spark, scratch):
    lines = [json.dumps(r) for r in (
        {"safetyreportid": 5, "serious": None, "receivedate": "20240101", "extra": {"a": 1},
         "patient": {"drug": [{"medicinalproduct": "x", "dose": {"mg": 1}}], "reaction": None}},
        {"safetyreportid": "6", "serious": None, "patient": {"drug": [], "note": None}})]
    bronze = ingest.bronze_records(spark, text(spark, lines, f"{scratch}/raw"), S.RAW_ADVERSE, "tag")
    got = {(r.path, r.declared, r.found, r.change) for r in ingest.schema_drift(bronze, S.RAW_ADVERSE, "tag").collect()}
    assert got == {("extra", None, "struct", "new"), ("patient.drug[].dose", None, "struct", "new"),
                   ("patient.drug[].drugindication", "string", None, "missing"), ("patient.patientonsetage", "string", None, "missing"),
                   ("patient.patientsex", "string", None, "missing"), ("safetyreportid", "string", "variant", "retyped")}
    none = ingest.bronze_records(spark, text(spark, [], f"{scratch}/none"), S.RAW_PRODUCTS, "tag")
    assert {r.change for r in ingest.schema_drift(none, S.RAW_PRODUCTS, "tag").collect()} == {"missing"}


# --- arrays --------------------------------------------------------------------------------------

def value(rng, depth=0):
    kind = rng.randrange(8)
    if kind < 3 or depth > 3:
        return rng.choice(["}, {", 'a"b', "\\", '\\"}', '[{"', "é", 1, 2.5, None, True, "", "x" * rng.randrange(30)])
    if kind < 5:
        return {rng.choice(["a", "b}", 'c"', "d["]): value(rng, depth + 1) for _ in range(rng.randrange(4))}
    return [value(rng, depth + 1) for _ in range(rng.randrange(4))]


@pytest.mark.parametrize("style", [{}, {"separators": (",", ":")}, {"indent": 1}])
@pytest.mark.parametrize("size", ["128m", "900b"])
def test_arrays_of_any_layout_are_read_in_ranges(spark, scratch, style, size):
    rng = random.Random(3)
    records = [{"id": i, "v": value(rng), "w": value(rng)} for i in range(120)]
    with open(f"{scratch}/a.json", "w") as f:
        f.write(json.dumps(records, **style))
    with open(f"{scratch}/b.json", "w") as f:       # several arrays, an empty one among them
        f.write("\n".join(json.dumps(x, **style) for x in (records[:7], [], records[7:20])) + "\n")
    for name, content in (("c", "[]"), ("d", " [ ] \n"), ("e", "")):
        with open(f"{scratch}/{name}.json", "w") as f:
            f.write(content)
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = json_array.read(spark, scratch)
        if size == "900b":
            assert spark.read.option("lineSep", "}").text(f"{scratch}/a.json").rdd.getNumPartitions() > 4
        got = sorted(json.dumps(json.loads(r.value), sort_keys=True) for r in rows.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == sorted(json.dumps(r, sort_keys=True) for r in records + records[:20])


@pytest.mark.parametrize("bad", ['[{"a": 1}, {"b": "', '[{"a": 1}, {"b": 2}', '[{"a": 1}, {"b": {"c": 2}', '[{"a": 1}, '])
def test_an_array_that_ends_early_fails(spark, scratch, bad):
    with open(f"{scratch}/a.json", "w") as f:
        f.write(bad)
    with pytest.raises(Exception, match="ends too early"):
        json_array.read(spark, scratch).collect()


def test_records_across_pieces_are_put_together_in_one_shuffle_of_the_text(spark, scratch, monkeypatch):
    rng = random.Random(5)
    records = [{"id": i, "v": [value(rng) for _ in range(6)], "w": [{"}": "]"}] * (i % 9)} for i in range(60)]
    for name, part in (("a", records[:50]), ("b", records[50:])):
        with open(f"{scratch}/{name}.json", "w") as f:
            f.write(json.dumps(part))
    for bits in (0, 1, 3, 6):
        monkeypatch.setattr(json_array, "PIECE_BITS", bits)
        rows = json_array.read(spark, scratch)
        got = sorted(json.dumps(json.loads(r.value), sort_keys=True) for r in rows.collect())
        assert got == sorted(json.dumps(r, sort_keys=True) for r in records), bits
    plan = rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("FileScan text") == 2          # one for the pieces' starts, one for the records


# --- quarantine -----------------------------------------------------------------------------------

def test_routing_keeps_every_row_once_and_names_all_failed_rules(spark, scratch):
    rows = [("1", 5), (None, 5), ("2", None), (None, -1), ("3", -1), ("3", -1)]
    df = spark.createDataFrame(rows, "k string, n int")
    rules = [quality.Rule("has_k", "k IS NOT NULL", quality.DROP), quality.Rule("positive", "n > 0"),
             quality.Rule("small", "n < 4 OR n IS NULL", quality.WARN)]
    for _ in range(2):          # a retry writes the same again
        accepted, rejected = quality.route(df, rules, f"{scratch}/routed")
        assert sorted(map(tuple, accepted.collect()), key=repr) == sorted([r for r in rows if r[0]], key=repr)
        assert {(r.k, r.n, tuple(r.failed_rules)) for r in rejected.collect()} == {
            (None, 5, ("has_k", "small")), (None, -1, ("has_k", "positive"))}
    got = {(r.rule, r.accepted, r.rejected) for r in quality.routed_counts(spark, f"{scratch}/routed", "t").collect()}
    assert got == {(None, 4, 2), ("has_k", 0, 2), ("positive", 3, 1), ("small", 1, 1)}
    empty, none = quality.route(df.limit(0), rules, f"{scratch}/empty")
    assert empty.count() == none.count() == 0


def test_quarantine_and_accepted_make_up_the_input(spark):
    counts = {r.dataset: r.accepted + r.rejected for r in catalog.QUERIES["quarantine_counts"](spark, SF_SMALL).filter("rule IS NULL").collect()}
    from safetylake.sources import fixtures

    assert counts == {w: b(spark, SF_SMALL).count() for w, b in fixtures.RAW_BUILDERS.items()}


def test_both_populations_come_from_one_pass(spark):
    from safetylake.operators import clean
    from safetylake.sources import fixtures

    plan = clean.adverse_quality(fixtures.raw_adverse(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet [o_orderkey") == 1


def test_drift_stores_whole_records_without_the_columns_read_from_them(spark, monkeypatch):
    seen, real = {}, ingest.schema_drift
    monkeypatch.setattr(ingest, "schema_drift", lambda rows, schema, source: seen.update({source: rows.columns}) or real(rows, schema, source))
    found = {(r.source, r.path, r.change) for r in catalog.QUERIES["schema_drift"](spark, SF_SMALL).collect()}
    assert {s for s, _, _ in found} == set(seen) and set(map(tuple, seen.values())) == {(ingest.RECORD,)}
