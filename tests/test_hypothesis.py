"""Randomized properties: apply(old, diff(old, new)) == new; page stop rule == a plain loop."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from safetylake.operators import changes
from safetylake.operators.paging import pages_to_read

SCHEMA = "k string, a string, b int"
FAST = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

rows = st.dictionaries(st.sampled_from([str(i) for i in range(12)]),
                       st.tuples(st.sampled_from([None, "x", "y"]), st.sampled_from([None, 1, 2])),
                       max_size=12)


@FAST
@given(old=rows, new=rows)
def test_apply_of_diff_reproduces_new(spark, old, new):
    o = spark.createDataFrame([(k, a, b) for k, (a, b) in old.items()], SCHEMA)
    n = spark.createDataFrame([(k, a, b) for k, (a, b) in new.items()], SCHEMA)
    feed = changes.snapshot_diff(o, n, ["k"])
    got = {tuple(r) for r in changes.apply_changes(o, feed, ["k"]).collect()}
    assert got == {(k, a, b) for k, (a, b) in new.items()}
    kinds = [r._change_type for r in feed.collect()]
    assert kinds.count("update_preimage") == kinds.count("update_postimage")


pages = st.lists(st.one_of(st.none(), st.integers(min_value=0, max_value=3)), min_size=1, max_size=6)


@FAST
@given(sizes=pages, limit=st.one_of(st.none(), st.integers(min_value=0, max_value=20)))
def test_stop_rule_matches_sequential_reader(spark, sizes, limit):
    page_size = 3
    layout = [(i * page_size, None if n is None else list(range(i * 10, i * 10 + n)))
              for i, n in enumerate(sizes)]
    env = spark.createDataFrame([(s, None if r is None else [(v,) for v in r]) for s, r in layout],
                                "skip int, results array<struct<v:int>>")
    got = sorted(r.v for r in pages_to_read(env, limit, page_size).select(F.inline("results")).collect())
    expect, skip, by_skip = [], 0, dict(layout)
    while skip < (limit if limit is not None else 10**9) and skip in by_skip:
        res = by_skip[skip] or []
        expect += res
        if len(res) < page_size:
            break
        skip += page_size
    assert got == sorted(expect)


ALPHABET = "aAbB%_'\\ -"
texts = st.lists(st.one_of(st.none(), st.text(alphabet=ALPHABET, max_size=8)), min_size=1, max_size=12)


@FAST
@given(rows=texts, term=st.text(alphabet=ALPHABET, min_size=1, max_size=3))
def test_literal_search_equals_python_substring(spark, rows, term):
    from safetylake.functions import literal_contains
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string")
    got = sorted(r.i for r in df.filter(literal_contains(["t"], term)).collect())
    assert got == [i for i, t in enumerate(rows) if t is not None and term.lower() in t.lower()]


@FAST
@given(rows=texts, term=st.text(alphabet=ALPHABET, min_size=1, max_size=3))
def test_like_search_equals_python_wildcards(spark, rows, term):
    import re
    from safetylake.functions import like_pattern
    rx = re.compile("".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in term.lower()),
                    re.DOTALL)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string")
    got = sorted(r.i for r in df.filter(F.lower("t").like(like_pattern(term))).collect())
    assert got == [i for i, t in enumerate(rows) if t is not None and rx.search(t.lower())]
