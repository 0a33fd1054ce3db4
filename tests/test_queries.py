"""Dashboard queries: argument rules, limits, ties, empty tables, shares."""

import datetime as dt

import pytest

from safetylake.operators import queries

SUMMARY = "product_name string, reaction_name string, event_count bigint, serious_count bigint, " \
          "earliest_report date, latest_report date"
PRODUCTS = ("product_ndc string, brand_name string, generic_name string, labeler_name string, "
            "product_type string, dosage_form string, marketing_category string, primary_route string, "
            "primary_ingredient string, primary_strength string, ingredient_count int")
RECALLS = ("recall_number string, classification string, status string, product_description string, "
           "reason_for_recall string, recalling_firm string, city string, state string, country string, "
           "distribution_pattern string, voluntary_mandated string, recall_date date, report_date date, "
           "termination_date date")


def summary_df(spark, rows):
    d = dt.date(2024, 1, 1)
    return spark.createDataFrame([(p, r, e, s, d, d) for p, r, e, s in rows], SUMMARY)


def recalls_df(spark, n=10):
    rows = []
    for i in range(n):
        date = None if i % 4 == 0 else dt.date(2024, 1, 1 + i)
        rows.append((f"F-{i}", "Class I" if i % 2 else "Class II", "Ongoing" if i % 3 == 0 else "Terminated",
                     f"Lot {i}", "defect 50%" if i == 5 else "defect", "Firm", "c", None, "x", "p", "v",
                     date, date, None))
    return spark.createDataFrame(rows, RECALLS)


@pytest.mark.parametrize("limit,ok", [(0, True), (1, True), (100, True), (101, False), (-1, False)])
def test_pair_limits(spark, limit, ok):
    df = summary_df(spark, [("A", "R", 1, 0)])
    if ok:
        assert queries.top_pairs(df, limit).count() == min(limit, 1)
    else:
        with pytest.raises(ValueError):
            queries.top_pairs(df, limit)


def test_term_length(spark):
    df = recalls_df(spark)
    queries.search_recalls(df, "x" * 200)
    with pytest.raises(ValueError):
        queries.search_recalls(df, "x" * 201)


def test_recent_recalls_nulls_last_and_count(spark):
    df = recalls_df(spark, 10)
    rows = queries.recent_recalls(df, 10).collect()
    assert [r.recall_number for r in rows][:2] == ["F-9", "F-7"]
    assert all(r.recall_date is None for r in rows[-3:])
    assert queries.search_recalls(df, "50%").count() == 1
    assert queries.search_recalls_count(df, "defect").collect()[0][0] == 10


def test_top_pairs_tie_break_by_key(spark):
    df = summary_df(spark, [("B", "R", 5, 0), ("A", "S", 5, 0), ("A", "R", 5, 1), ("C", "R", 9, 0)])
    got = [(r.product_name, r.reaction_name) for r in queries.top_pairs(df, 3).collect()]
    assert got == [("C", "R"), ("A", "R"), ("A", "S")]


def test_list_products_unbranded_first(spark):
    rows = [(str(i), b, "g", "l", "t", "f", "c", None, None, None, 1)
            for i, b in enumerate(["B", None, "A"])]
    df = spark.createDataFrame(rows, PRODUCTS)
    assert [r.brand_name for r in queries.list_products(df).collect()] == [None, "A", "B"]


def test_kpis_on_empty_tables(spark):
    empty_s = spark.createDataFrame([], SUMMARY)
    empty_p = spark.createDataFrame([], PRODUCTS)
    empty_r = spark.createDataFrame([], RECALLS)
    (row,) = queries.kpi_stats(empty_p, empty_r, empty_s).collect()
    assert list(row) == [0] * 7
    assert queries.top_products_share(empty_s).count() == 0


def test_kpis(spark):
    s = summary_df(spark, [("A", "R", 3, 1), ("A", "S", 2, 0), ("B", "R", 1, 1)])
    p = spark.createDataFrame([(str(i), "b", "g", "l", "t", "f", "c", None, None, None, 1) for i in range(4)],
                              PRODUCTS)
    (row,) = queries.kpi_stats(p, recalls_df(spark, 10), s).collect()
    assert row.asDict() == {"products": 4, "total_recalls": 10, "class_i_recalls": 5, "active_recalls": 4,
                            "total_adverse_events": 6, "serious_events": 2, "unique_products_with_ae": 2}


def test_shares_and_zero_maximum(spark):
    s = summary_df(spark, [("A", "R", 3, 1), ("A", "S", 5, 0), ("B", "R", 1, 1)])
    got = {r.product_name: (r.total_pct, r.serious_pct) for r in queries.top_products_share(s).collect()}
    assert got == {"A": (100, 13), "B": (13, 13)}
    z = summary_df(spark, [("A", "R", 0, 0), ("B", "R", 0, 0)])
    assert {r.event_pct for r in queries.top_pairs_share(z).collect()} == {None}
    flags = {r.product_name: r.severity for r in queries.top_pairs_share(s).collect() if r.reaction_name == "R"}
    assert flags == {"A": "serious", "B": "serious"}


def test_badges(spark):
    df = recalls_df(spark, 4).union(spark.createDataFrame(
        [("F-x", "Not Yet Classified", "", "d", "r", "f", "c", None, "x", "p", "v", None, None, None)], RECALLS))
    got = {r.recall_number: (r.class_badge, r.status_badge) for r in queries.recall_badges(df).collect()}
    assert got["F-0"] == ("class-ii", "ongoing")
    assert got["F-1"] == ("class-i", "terminated")
    assert got["F-x"] == (None, None)
