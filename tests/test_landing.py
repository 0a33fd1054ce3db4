"""Pages that arrive over time: restarts, order, missing and repeated pages."""

import json
import os

import pytest

from safetylake.sources import ingest
from safetylake.streaming import landing


def page(folder, skip, n):
    with open(f"{folder}/p{skip}-{n}.json", "w") as f:
        f.write(json.dumps({"skip": skip, "results": [{"product_ndc": str(skip + i)} for i in range(n)]}))


def trigger(spark, scratch):
    landing.start_landing(spark, f"{scratch}/pages", "products", f"{scratch}/landed", f"{scratch}/checkpoint", 2).awaitTermination()


def test_pages_land_once_in_any_order_and_only_whole_feeds_are_given_out(spark, scratch, tmp_path):
    import os

    folder = f"{scratch}/pages"
    os.mkdir(folder)
    assert tuple(landing.progress(spark, "products", f"{scratch}/landed").first()) == (0, 0, None)
    for s in (300, 0, 100):
        page(folder, s, 100)
    trigger(spark, scratch)
    with pytest.raises(ValueError, match="missing|no page"):
        landing.landed(spark, "products", f"{scratch}/landed")
    page(folder, 200, 100)
    trigger(spark, scratch)
    trigger(spark, scratch)         # nothing new
    assert tuple(landing.progress(spark, "products", f"{scratch}/landed").first()) == (4, 400, None)
    with pytest.raises(ValueError, match="no page at 400"):
        landing.landed(spark, "products", f"{scratch}/landed")
    assert landing.landed(spark, "products", f"{scratch}/landed", limit=400).count() == 400
    page(folder, 400, 0)
    page(folder, 500, 100)          # beyond the end
    trigger(spark, scratch)
    got = landing.landed(spark, "products", f"{scratch}/landed")
    assert sorted(int(r.product_ndc) for r in got.collect()) == list(range(400)) and "_source" in got.columns
    assert landing.progress(spark, "products", f"{scratch}/landed").first().ends_at == 400
    with open(f"{folder}/again.json", "w") as f:
        f.write(json.dumps({"skip": 100, "results": []}))
    trigger(spark, scratch)
    with pytest.raises(ValueError):
        landing.landed(spark, "products", f"{scratch}/landed", limit=400, page_size=100)


def test_landed_json_is_compressed_in_files_of_bounded_rows(spark, scratch, monkeypatch):
    monkeypatch.setattr(ingest, "ROWS_A_FILE", 300)
    rows = spark.range(1000).selectExpr("CAST(id AS STRING) AS safetyreportid", "'1' AS serious").coalesce(1)
    path = ingest.land_json(rows, f"{scratch}/landed")
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) == 4 and all(f.endswith(".json.gz") for f in files)
    text = sum(len('{"safetyreportid":"","serious":"1"}\n') + len(str(i)) for i in range(1000))
    assert sum(os.path.getsize(f"{path}/{f}") for f in files) < text / 3
    back = spark.read.schema(rows.schema).json(path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
