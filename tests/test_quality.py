from safetylake.operators.quality import DROP, WARN, Rule, apply_rules, rule_metrics


def test_metrics_count_pass_fail_and_null(spark):
    df = spark.createDataFrame([("Class I",), ("Other",), (None,), ("Class III",)], "c string")
    rules = [Rule("valid", "c IN ('Class I', 'Class II', 'Class III')", WARN),
             Rule("has_c", "c IS NOT NULL", DROP)]
    got = {r.rule: (r.total, r.passed, r.failed, r.null_result) for r in rule_metrics(df, rules, "t").collect()}
    assert got == {"valid": (4, 2, 1, 1), "has_c": (4, 3, 1, 0)}
    assert apply_rules(df, rules).count() == 3


def test_drop_rule_drops_null_results(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "x int")
    assert [r.x for r in apply_rules(df, [Rule("big", "x > 1", DROP)]).collect()] == [3]
