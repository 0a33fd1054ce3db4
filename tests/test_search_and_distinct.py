"""Search by trigram postings equals the scan; distinct counts from daily bitmaps equal the direct ones."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from safetylake import schemas
from safetylake.operators import distinct, pair_state, queries, search_index
from safetylake.plans import catalog


def rows_of(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def recalls(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("index"))
    odd = [("X1", "50%_off \\ it's"), ("X2", None), ("X3", "ab"), ("X4", "İstanbul ÉCOLE"), ("X5", ""), ("X6", "aaaa aaab")]
    base = catalog.gold_enforcement(spark, SF_SMALL)
    extra = spark.createDataFrame(odd, "recall_number string, reason_for_recall string")
    base.unionByName(extra, allowMissingColumns=True).write.parquet(f"{folder}/base")
    table = spark.read.parquet(f"{folder}/base")
    return table, search_index.build(table, list(schemas.PK_ENFORCEMENT), queries.RECALL_SEARCH_COLUMNS, f"{folder}/index", buckets=16)


def test_indexed_search_equals_the_scan(spark, recalls):
    table, index = recalls
    rng = random.Random(2)
    texts = [r[0] for r in table.select("product_description").na.drop().limit(40).collect()]
    terms = ["", "ab", "50%", "%_o", "it's", "\\ i", "É", "école", "istanbul", "aaab", "aaaaa", "nothing like this", "DEFECT", "x" * 200, None]
    terms += [t[i:i + rng.randrange(1, 12)] for t in rng.sample(texts, 4) for i in [rng.randrange(len(t))]]
    for term in terms:
        for mode in ("literal", "like"):
            assert rows_of(search_index.search_recalls(spark, index, term, 200, mode)) == rows_of(
                queries.search_recalls(table, term, 200, mode)), (term, mode)
    for term in ("lot 1_", "a%b", "_o_%", "l%t 1", "50%off"):
        assert rows_of(search_index.search_recalls(spark, index, term, 200, "like")) == rows_of(queries.search_recalls(table, term, 200, "like"))


def test_a_rare_term_reads_few_files(spark, recalls):
    table, index = recalls
    (key,) = table.filter("product_description IS NOT NULL").orderBy("recall_number").select("product_description").first()
    some = search_index.candidates(spark, index, key)
    assert 0 < some.select("recall_number").distinct().count() < table.count() / 10
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_bucket#", plan)        # not all partitions of the rows are read
    plan = index.postings(spark).filter(F.col("gram").isin(["abc"]))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(gram), EqualTo(gram,abc)]" in plan or "In(gram" in plan or "EqualTo(gram" in plan


def test_a_posting_holds_the_rows_of_a_block(spark, recalls):
    _, index = recalls
    bits = F.explode(F.expr("filter(sequence(0, 63), i -> shiftrightunsigned(rows, i) & 1 = 1)"))
    got = index.postings(spark).select("gram", "field", "bucket", "block", bits.alias("place"))
    texts = F.array(*[F.struct(F.lit(i).alias("field"), search_index.grams(F.lower(c)).alias("grams")) for i, c in enumerate(index.columns)])
    want = (index.rows(spark).select("_bucket", "_row", F.inline(texts))
            .select(F.explode("grams"), "field", "_bucket", F.shiftright("_row", 6), (F.col("_row") % 64).cast("int")))
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    assert index.postings(spark).count() < want.count() / 2         # fewer to sort and to read than one a row


def test_argument_rules_hold(spark, recalls):
    with pytest.raises(ValueError):
        search_index.search_recalls(spark, recalls[1], "x" * 201)
    with pytest.raises(ValueError):
        search_index.search_recalls(spark, recalls[1], "abc", 201)
    with pytest.raises(ValueError):
        queries.top_products(recalls[0], 101)


def test_daily_bitmaps_merge_to_exact_counts(spark):
    rng = random.Random(5)
    days = [None, *[dt.date(2024, 1, d) for d in range(1, 6)]]
    pairs = [(f"P{rng.randrange(6)}", f"r{rng.randrange(90_000)}" if rng.random() < 0.9 else "hot", rng.choice(days), rng.choice([1, 2, None]))
             for _ in range(3000)]
    silver = spark.createDataFrame(pairs, "product_name string, reaction_name string, receive_date date, is_serious int")
    state = pair_state.merged(pair_state.units(silver))
    partials = distinct.daily(state, distinct.dictionary(state.select("reaction_name")))
    for since, until in [(None, None), (days[2], days[4]), (days[3], days[3]), (days[5], days[1])]:
        chosen = [p for p in pairs if since is None or (p[2] is not None and since <= p[2] <= until)]
        want = {(p, sum(x[0] == p for x in chosen), sum(x[0] == p and x[3] == 1 for x in chosen),
                 len({x[1] for x in chosen if x[0] == p})) for p in {x[0] for x in chosen}}
        assert set(rows_of(distinct.product_rollup(partials, since, until))) == want
        total = distinct.kpi(partials, since, until).first()
        assert total.unique_products_with_ae == len(want) and (total.total_adverse_events or 0) == len(chosen)
    # more names than a bitmap holds
    many = spark.range(70_000).select(F.lit("P").alias("product_name"), F.concat(F.lit("r"), "id").alias("reaction_name"),
                                      F.lit(None).cast("date").alias("receive_date"), F.lit(1).alias("is_serious"))
    one = pair_state.merged(pair_state.units(many))
    assert distinct.product_rollup(distinct.daily(one, distinct.dictionary(one.select("reaction_name")))).first().unique_reactions == 70_000
