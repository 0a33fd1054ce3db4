"""Properties over the derived sf0.001 feeds."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from safetylake.operators import clean, gold
from safetylake.sources import fixtures


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_silver_row_count_formula(spark):
    raw = fixtures.raw_adverse(spark, SF_SMALL)
    named = F.size(F.filter("patient.drug", lambda d: d["medicinalproduct"].isNotNull()))
    reactions = F.greatest(F.coalesce(F.size("patient.reaction"), F.lit(0)), F.lit(1))
    expect = (raw.filter(F.col("safetyreportid").isNotNull())
                 .select(F.sum(F.coalesce(named, F.lit(0)) * reactions)).collect()[0][0])
    silver = clean.clean_adverse_events(raw)
    assert silver.count() == expect
    total = gold.adverse_events_summary(silver).agg(F.sum("event_count")).collect()[0][0]
    assert total == silver.filter(F.col("reaction_name").isNotNull()).count()


def test_repartitioning_never_changes_results(spark):
    raw_p = fixtures.raw_products(spark, SF_SMALL)
    raw_e = fixtures.raw_enforcement(spark, SF_SMALL)
    raw_a = fixtures.raw_adverse(spark, SF_SMALL)
    base = (as_set(clean.clean_products(raw_p)), as_set(clean.clean_enforcement(raw_e)),
            as_set(gold.adverse_events_summary(clean.clean_adverse_events(raw_a))))
    for n in (1, 3):
        again = (as_set(clean.clean_products(raw_p.repartition(n))),
                 as_set(clean.clean_enforcement(raw_e.repartition(n))),
                 as_set(gold.adverse_events_summary(clean.clean_adverse_events(raw_a.repartition(n)))))
        assert again == base


def test_doubled_input(spark):
    raw_p = fixtures.raw_products(spark, SF_SMALL)
    raw_e = fixtures.raw_enforcement(spark, SF_SMALL)
    raw_a = fixtures.raw_adverse(spark, SF_SMALL)
    assert as_set(clean.clean_products(raw_p.union(raw_p))) == as_set(clean.clean_products(raw_p))
    assert as_set(clean.clean_enforcement(raw_e.union(raw_e))) == as_set(clean.clean_enforcement(raw_e))
    one = {(r.product_name, r.reaction_name): (r.event_count, r.serious_count)
           for r in gold.adverse_events_summary(clean.clean_adverse_events(raw_a)).collect()}
    two = {(r.product_name, r.reaction_name): (r.event_count, r.serious_count)
           for r in gold.adverse_events_summary(clean.clean_adverse_events(raw_a.union(raw_a))).collect()}
    assert two == {k: (2 * a, 2 * b) for k, (a, b) in one.items()}


def test_all_four_change_kinds_occur(spark):
    from safetylake.operators import changes
    from safetylake.plans import catalog
    for key in ("change_feed_products", "change_feed_enforcement", "change_feed_adverse"):
        kinds = {r[0] for r in catalog.QUERIES[key](spark, SF_SMALL).select("_change_type").distinct()
                 .collect()}
        assert kinds == {"insert", "delete", "update_preimage", "update_postimage"}, key
    assert changes.INSERT == "insert"


def test_weighted_adverse_metrics_equal_exploded_counts(spark):
    from safetylake.operators.quality import WARN, Rule, rule_metrics
    raw = fixtures.raw_adverse(spark, SF_SMALL)
    rules = clean.ADVERSE_RULES + clean.ADVERSE_CHECKS
    exploded = rule_metrics(clean.stage_adverse_events(raw, keep_source=True), rules, "clean_adverse_events")
    assert as_set(clean.adverse_metrics(raw, rules)) == as_set(exploded)
    # A rule on a pair-level column falls back to counting exploded rows.
    pair_rule = rules + [Rule("has_reaction", "reaction_name IS NOT NULL", WARN)]
    exploded = rule_metrics(clean.stage_adverse_events(raw, keep_source=True), pair_rule, "clean_adverse_events")
    assert as_set(clean.adverse_metrics(raw, pair_rule)) == as_set(exploded)
