import datetime as dt

import pytest
from pyspark.sql import functions as F

from safetylake.functions import first_element, like_pattern, literal_contains, parse_date, parse_int


def test_tolerant_dates(spark):
    df = spark.createDataFrame([("20240131",), ("",), ("20241399",), (None,)], "d string")
    got = [r[0] for r in df.select(parse_date("d")).collect()]
    assert got == [dt.date(2024, 1, 31), None, None, None]


def test_strict_dates_raise(spark):
    df = spark.createDataFrame([("20241399",)], "d string")
    with pytest.raises(Exception):
        df.select(parse_date("d", strict=True)).collect()


def test_tolerant_ints(spark):
    df = spark.createDataFrame([("7",), (" 7 ",), ("abc",), ("1.5",), ("",), (None,)], "s string")
    assert [r[0] for r in df.select(parse_int("s")).collect()] == [7, 7, None, None, None, None]


def test_first_element_null_empty_filled(spark):
    df = spark.createDataFrame([([],), (None,), (["A", "B"],)], "a array<string>")
    assert [r[0] for r in df.select(first_element("a")).collect()] == [None, None, "A"]


TEXTS = ["Save 50% now", "A_B", "it's here", "back\\slash", "plain", None, "x' or 1=1 --"]


def _hits(spark, term, mode):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    cond = literal_contains(["t"], term) if mode == "literal" else F.coalesce(
        F.lower("t").like(like_pattern(term)), F.lit(False))
    return [r[0] for r in df.filter(cond).collect()]


@pytest.mark.parametrize("term,expected", [
    ("50%", ["Save 50% now"]),
    ("_", ["A_B"]),
    ("IT'S", ["it's here"]),
    ("\\", ["back\\slash"]),
    ("' or 1=1 --", ["x' or 1=1 --"]),
    ("\\' or 1=1 --", []),
])
def test_literal_search_is_literal(spark, term, expected):
    assert _hits(spark, term, "literal") == expected


def test_like_search_keeps_wildcards_but_backslash_is_literal(spark):
    assert _hits(spark, "a_b", "like") == ["A_B"]
    assert _hits(spark, "p_a", "like") == ["plain"]
    assert _hits(spark, "50%now", "like") == ["Save 50% now"]
    assert _hits(spark, "k\\s", "like") == ["back\\slash"]
