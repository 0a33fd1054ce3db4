"""Dashboard responses and the command line, over stored gold tables."""

import json

import pytest

from conftest import SF_SMALL
from safetylake import __main__ as cli
from safetylake.plans import catalog, endpoints, pipeline
from safetylake.sources import fixtures, ingest


@pytest.fixture(scope="module")
def gold_dir(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("gold"))
    srcs = {w: ingest.land_json(b(spark, SF_SMALL), f"{root}/land/{w}") for w, b in fixtures.RAW_BUILDERS.items()}
    pipeline.run(spark, srcs, f"{root}/out", with_metrics=False)
    return f"{root}/out"


def test_endpoint_shapes(spark, gold_dir):
    summ = spark.read.parquet(f"{gold_dir}/gold_adverse_events_summary")
    rec = spark.read.parquet(f"{gold_dir}/gold_enforcement_actions")
    prod = spark.read.parquet(f"{gold_dir}/gold_product_catalog")
    s = endpoints.stats(prod, rec, summ)
    assert list(s) == ["products", "total_recalls", "class_i_recalls", "active_recalls",
                       "total_adverse_events", "serious_events", "unique_products_with_ae"]
    assert s["products"] == catalog.gold_products(spark, SF_SMALL).count()
    e = endpoints.enforcement(rec, "defect", 5)
    assert e["count"] == 5 and set(e["results"][0]) == {
        "recall_number", "classification", "status", "recall_date", "recalling_firm", "city", "state",
        "product_description", "reason_for_recall"}
    assert isinstance(e["results"][0]["recall_date"], (str, type(None)))
    a = endpoints.adverse_events(summ, 20)
    counts = [r["event_count"] for r in a["results"]]
    assert a["count"] == 20 and counts == sorted(counts, reverse=True)
    assert len(endpoints.adverse_events_by_product(summ)["results"]) == 20
    assert endpoints.products(prod, "", 0) == {"results": [], "count": 0}
    json.dumps([s, e, a])


def test_cli(spark, gold_dir, capsys):
    assert cli.main(["adverse-events", "--gold", gold_dir, "--limit", "3"]) == 0
    out = json.loads(capsys.readouterr().out)
    assert out["count"] == 3
    assert cli.main(["products", "--gold", gold_dir, "--search", "r_d", "--like", "--limit", "2"]) == 0
    assert json.loads(capsys.readouterr().out)["count"] == 2


def test_single_line_json_array_reads_as_records(spark, tmp_path):
    recs = [{"recall_number": "F-1"}, {"recall_number": "F-2", "status": "Ongoing"}]
    path = tmp_path / "arr.json"
    path.write_text(json.dumps(recs))
    from safetylake import schemas
    df = ingest.bronze(spark, str(path), schemas.RAW_ENFORCEMENT, schemas.SOURCE_ENFORCEMENT)
    assert sorted(r.recall_number for r in df.collect()) == ["F-1", "F-2"]


def test_cli_pipeline(spark, tmp_path, capsys):
    srcs = {w: ingest.land_json(b(spark, SF_SMALL), str(tmp_path / "land" / w))
            for w, b in fixtures.RAW_BUILDERS.items()}
    args = ["pipeline", "--products", srcs["products"], "--enforcement", srcs["enforcement"],
            "--adverse", srcs["adverse"], "--out", str(tmp_path / "out"), "--database", "cli_db"]
    assert cli.main(args) == 0
    out = json.loads(capsys.readouterr().out)
    assert len(out["tables"]) == 9 and len(out["registered"]) == 9
    assert spark.table("cli_db.gold_adverse_events_summary").count() == \
        catalog.gold_adverse(spark, SF_SMALL).count()
