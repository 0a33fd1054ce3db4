"""Raw nested source tables derived, by Spark, from the driver's flat tables.

The upstream feeds (product listings, enforcement actions, adverse-event
reports) arrive as nested JSON. For testing and benchmarking we derive
records of exactly that shape from the TPC-H-like tables in ``sf_dir`` with
deterministic rules that plant the dirty cases the cleaning stage must
handle (padded keys, NULL and blank values, empty arrays, unparseable dates
and numbers, exact duplicate records).

Every rule below is a fixed value shared with the SQL oracle; both sides
must agree on them for results to match.

Scale notes: each derivation is a projection plus, for the adverse reports,
one shuffle join of line items with parts/suppliers and one group-by on the
order key. A report's drug and reaction arrays hold the lines of one order
(bounded by the order's line count); nothing is gathered per larger group.
Small dimension tables (nation: 25 rows) are left to Catalyst's
size-checked broadcast rule rather than forced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, listed anew for each session and query."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------------------
# Fixed derivation rules (must equal the oracle's; see FIXTURES.md), written
# as Spark SQL expressions over the driver tables.
# ---------------------------------------------------------------------------

PRODUCT_EXPRS = [
    "CASE WHEN pmod(p_partkey, 97) = 0 THEN NULL "
    "ELSE concat('  ', lpad(CAST(p_partkey AS STRING), 6, '0'), ' ') END AS product_ndc",
    "CASE WHEN pmod(p_partkey, 11) = 0 THEN NULL ELSE concat(' ', lower(p_brand)) END AS brand_name",
    "p_name AS generic_name",
    "concat('Labeler ', CAST(pmod(p_partkey, 10) AS STRING), ' ') AS labeler_name",
    "p_type AS product_type",
    "concat('FORM ', CAST(pmod(p_size, 5) AS STRING)) AS dosage_form",
    "concat('CAT ', CAST(pmod(p_partkey, 3) AS STRING)) AS marketing_category",
    "CASE WHEN pmod(p_partkey, 7) = 0 THEN NULL "
    "WHEN pmod(p_partkey, 5) = 0 THEN CAST(array() AS ARRAY<STRING>) "
    "ELSE array(concat('R', CAST(pmod(p_size, 4) AS STRING)), 'ORAL') END AS route",
    "CASE WHEN pmod(p_partkey, 13) = 0 THEN NULL "
    "WHEN pmod(p_partkey, 17) = 0 THEN CAST(array() AS ARRAY<STRUCT<name: STRING, strength: STRING>>) "
    "ELSE transform(split(p_name, ' '), w -> named_struct('name', w, "
    "'strength', concat(CAST(p_size AS STRING), ' mg'))) END AS active_ingredients",
    "p_partkey * 2 AS _seq",
    "pmod(p_partkey, 50) = 1 AND pmod(p_partkey, 97) <> 0 AS _dup",
]

_ORDER_DATE = "date_format(o_orderdate, 'yyyyMMdd')"

ENFORCEMENT_EXPRS = [
    "CASE WHEN pmod(o_orderkey, 101) = 0 THEN NULL "
    "ELSE concat(' F-', CAST(o_orderkey AS STRING)) END AS recall_number",
    "CASE o_orderpriority WHEN '1-URGENT' THEN 'Class I' WHEN '2-HIGH' THEN 'Class II' "
    "WHEN '3-MEDIUM' THEN 'Class III' WHEN '4-NOT SPECIFIED' THEN 'Not Yet Classified' END AS classification",
    "CASE o_orderstatus WHEN 'O' THEN 'Ongoing' WHEN 'F' THEN 'Terminated' WHEN 'P' THEN 'Completed' END "
    "AS status",
    "concat('Lot ', CAST(o_orderkey AS STRING), ' ', o_orderpriority) AS product_description",
    "CASE WHEN pmod(o_orderkey, 23) = 0 THEN concat(c_mktsegment, ' 50%_off') "
    "WHEN pmod(o_orderkey, 29) = 0 THEN 'It''s mislabeled' "
    "ELSE concat(c_mktsegment, ' defect') END AS reason_for_recall",
    "concat(c_name, ' ') AS recalling_firm",
    "n_name AS city",
    "CASE WHEN pmod(o_orderkey, 9) = 0 THEN NULL ELSE substring(n_name, 1, 2) END AS state",
    "n_name AS country",
    "CASE WHEN pmod(o_orderkey, 2) = 0 THEN 'Nationwide' ELSE 'Regional' END AS distribution_pattern",
    "CASE WHEN pmod(o_orderkey, 3) = 0 THEN 'Mandated' ELSE 'Voluntary' END AS voluntary_mandated",
    f"CASE WHEN pmod(o_orderkey, 31) = 0 THEN '' WHEN pmod(o_orderkey, 37) = 0 THEN '20241399' "
    f"ELSE {_ORDER_DATE} END AS recall_initiation_date",
    f"{_ORDER_DATE} AS report_date",
    f"CASE WHEN o_orderstatus = 'O' THEN NULL ELSE {_ORDER_DATE} END AS termination_date",
    "o_orderkey * 2 AS _seq",
    "pmod(o_orderkey, 40) = 1 AS _dup",
]

# One struct per line item; line number, part key and supplier key lead so
# that sorting the collected list orders it by line (line numbers repeat
# within an order in the driver data).
DRUG_EXPR = ("named_struct('ln', l_linenumber, 'pk', l_partkey, 'sk', l_suppkey, "
             "'medicinalproduct', CASE WHEN l_linenumber = 7 THEN NULL ELSE concat(' ', p_name) END, "
             "'drugindication', p_type)")
REACTION_EXPR = ("named_struct('ln', l_linenumber, 'pk', l_partkey, 'sk', l_suppkey, "
                 "'reactionmeddrapt', CASE WHEN l_linenumber = 6 THEN NULL ELSE concat(initcap(n_name), ' ') END)")

REPORT_EXPRS = [
    "CASE WHEN pmod(o_orderkey, 103) = 0 THEN NULL ELSE CAST(o_orderkey AS STRING) END AS safetyreportid",
    "CASE WHEN pmod(o_orderkey, 29) = 0 THEN NULL WHEN pmod(o_orderkey, 31) = 0 THEN 'x' "
    "WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN '1' ELSE '2' END AS serious",
    f"CASE WHEN pmod(o_orderkey, 37) = 0 THEN '' ELSE {_ORDER_DATE} END AS receivedate",
    "named_struct("
    "'patientsex', CAST(pmod(o_custkey, 3) AS STRING), "
    "'patientonsetage', CASE WHEN pmod(o_orderkey, 19) = 0 THEN '1.5' "
    "ELSE CAST(pmod(o_custkey, 90) AS STRING) END, "
    "'drug', drugs, "
    "'reaction', CASE WHEN pmod(o_orderkey, 7) = 0 "
    "THEN CAST(array() AS ARRAY<STRUCT<reactionmeddrapt: STRING>>) ELSE reactions END) AS patient",
    "o_orderkey AS _seq",
]


def _with_copies(base: DataFrame, with_seq: bool) -> DataFrame:
    """Emit each record once, or twice (an exact copy) where ``_dup`` holds.

    One scan: each row explodes into one or two copy indexes instead of a
    union that would read the source again.
    """
    cols = [c for c in base.columns if c not in ("_seq", "_dup")]
    out = (base.selectExpr(*cols, "_seq", "explode(IF(_dup, array(0, 1), array(0))) AS _copy")
               .selectExpr(*cols, "_seq + _copy AS _seq"))
    return out if with_seq else out.drop("_seq")


def raw_products(spark: SparkSession, sf_dir: str, with_seq: bool = False) -> DataFrame:
    """``raw_ndc_products`` records, one per part plus planted duplicates.

    ``with_seq`` keeps a hidden ``_seq`` column (source row id, copy flag)
    used only to cut records into pages in a stable order.
    """
    return _with_copies(table(spark, sf_dir, "part").selectExpr(*PRODUCT_EXPRS), with_seq)


def raw_enforcement(spark: SparkSession, sf_dir: str, with_seq: bool = False) -> DataFrame:
    """``raw_enforcement_actions`` records, one per order plus planted duplicates."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = (o.join(c, o.o_custkey == c.c_custkey, "left")
          .join(n, F.col("c_nationkey") == n.n_nationkey, "left"))
    return _with_copies(j.selectExpr(*ENFORCEMENT_EXPRS), with_seq)


def _report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: the drug and reaction arrays, each ordered by line."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    origin = s.join(n, F.col("s_nationkey") == n.n_nationkey, "left")
    # The line items meet the small suppliers, then the parts, and are placed by
    # order once, after the joins; the group-by reuses that placing instead of
    # shipping partial collect_list buffers, which do not shrink the data.
    lines = (li.join(origin, li.l_suppkey == F.col("s_suppkey"), "left")
               .join(p, li.l_partkey == p.p_partkey, "left")
               .repartition("l_orderkey"))
    grouped = lines.groupBy("l_orderkey").agg(
        F.expr(f"sort_array(collect_list({DRUG_EXPR}))").alias("_drugs"),
        F.expr(f"sort_array(collect_list({REACTION_EXPR}))").alias("_reactions"),
    )
    return grouped.selectExpr(
        "l_orderkey",
        "transform(_drugs, d -> named_struct('medicinalproduct', d.medicinalproduct, "
        "'drugindication', d.drugindication)) AS drugs",
        "transform(_reactions, r -> named_struct('reactionmeddrapt', r.reactionmeddrapt)) AS reactions",
    )


def raw_adverse(spark: SparkSession, sf_dir: str, with_seq: bool = False) -> DataFrame:
    """``raw_adverse_events`` reports, one per order, with nested patient data."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    lines = _report_lines(spark, sf_dir)
    out = o.join(lines, o.o_orderkey == lines.l_orderkey, "left").selectExpr(*REPORT_EXPRS)
    return out if with_seq else out.drop("_seq")


RAW_BUILDERS = {
    "products": raw_products,
    "enforcement": raw_enforcement,
    "adverse": raw_adverse,
}


# ---------------------------------------------------------------------------
# Second snapshot of a published table, for the change feed and the sync.
# Fixed rules, by h = a stable integer from the key (the digits of the key; for
# the pair table, those digits plus length(product_name) + length(reaction_name)):
#   h % 10 = 0  row removed                     (delete)
#   h % 10 = 1  one non-key column changed      (update)
#   h % 10 = 2  one nullable column set to NULL (update)
#   h % 10 = 3  row kept and a copy added under a new key (insert)
# ---------------------------------------------------------------------------

def _key_digits(c: str) -> Column:
    return F.regexp_replace(F.col(c), "[^0-9]", "").try_cast("bigint")


def _evolve(old: DataFrame, h: Column, changed: str, new_value: Column, nulled: str,
            new_key: str, new_key_value: Column) -> DataFrame:
    hm = F.pmod(h, F.lit(10))
    # One scan of the old snapshot: each row becomes no row (removed), itself,
    # or itself plus a copy under a new key (variant 1).
    variants = (F.when(hm == 0, F.array().cast("array<int>"))
                 .when(hm == 3, F.array(F.lit(0), F.lit(1)))
                 .otherwise(F.array(F.lit(0))))
    v = old.select("*", F.explode(variants).alias("_v"))
    out = []
    for c in old.columns:
        col = F.col(c)
        if c == changed:
            col = F.when((F.col("_v") == 0) & (hm == 1), new_value).otherwise(col)
        elif c == nulled:
            col = F.when((F.col("_v") == 0) & (hm == 2), F.lit(None)).otherwise(col)
        if c == new_key:
            col = F.when(F.col("_v") == 1, new_key_value).otherwise(col)
        out.append(col.alias(c))
    return v.select(*out)


def next_products(old: DataFrame) -> DataFrame:
    return _evolve(old, _key_digits("product_ndc"),
                   "labeler_name", F.concat(F.col("labeler_name"), F.lit(" (revised)")),
                   "brand_name", "product_ndc", F.concat(F.col("product_ndc"), F.lit("-R")))


def next_enforcement(old: DataFrame) -> DataFrame:
    return _evolve(old, _key_digits("recall_number"),
                   "product_description", F.concat(F.col("product_description"), F.lit(" (revised)")),
                   "city", "recall_number", F.concat(F.col("recall_number"), F.lit("-R")))


def _pair_h() -> Column:
    # Lengths alone give only a few residues on the driver data (no inserts or
    # NULL-updates would ever occur), so the digits of the key are added.
    digits = F.regexp_replace(F.concat("product_name", "reaction_name"), "[^0-9]", "").try_cast("bigint")
    return F.coalesce(digits, F.lit(0)) + F.length("product_name") + F.length("reaction_name")


def next_adverse_summary(old: DataFrame) -> DataFrame:
    return _evolve(old, _pair_h(),
                   "event_count", F.col("event_count") + 1,
                   "latest_report", "reaction_name", F.concat(F.col("reaction_name"), F.lit(" (NEW)")))


# ---------------------------------------------------------------------------
# Second delivery of a raw feed, by the same rules on the raw key's digits:
# what a later run of the pipeline reads. Copies under a new key keep their
# other fields. Records without a key stay as they are.
# ---------------------------------------------------------------------------

def next_raw_products(raw: DataFrame) -> DataFrame:
    return _evolve(raw, _key_digits("product_ndc"),
                   "labeler_name", F.concat(F.col("labeler_name"), F.lit("(revised)")),
                   "brand_name", "product_ndc", F.concat(F.rtrim("product_ndc"), F.lit("-R")))


def next_raw_enforcement(raw: DataFrame) -> DataFrame:
    return _evolve(raw, _key_digits("recall_number"),
                   "product_description", F.concat(F.col("product_description"), F.lit(" (revised)")),
                   "city", "recall_number", F.concat(F.col("recall_number"), F.lit("-R")))


def next_raw_adverse(raw: DataFrame) -> DataFrame:
    return _evolve(raw, _key_digits("safetyreportid"),
                   "serious", F.lit("1"), "receivedate",
                   "safetyreportid", F.concat(F.col("safetyreportid"), F.lit("9")))


NEXT_RAW = {
    "products": next_raw_products,
    "enforcement": next_raw_enforcement,
    "adverse": next_raw_adverse,
}


# ---------------------------------------------------------------------------
# A delivery whose records do not fit the declared schema: a nested field that
# is not declared (``openfda``, in records that have a
# key), a declared field that is gone, one that changed its type, and an
# undeclared field inside nested data of the reports.
# ---------------------------------------------------------------------------

def _undeclared(key: str, words: str) -> Column:
    return F.when(F.col(key).isNotNull(), F.struct(
        F.length(words).alias("count"), F.upper(words).alias("maker"), F.array(F.lit("a"), F.col(key)).alias("tags"))).alias("openfda")


def drifted_products(raw: DataFrame) -> DataFrame:
    return raw.drop("marketing_category").withColumn("dosage_form", F.length("dosage_form")).select(
        "*", _undeclared("product_ndc", "labeler_name"))


def drifted_enforcement(raw: DataFrame) -> DataFrame:
    return raw.drop("voluntary_mandated").withColumn("country", F.array("country")).select(
        "*", _undeclared("recall_number", "recalling_firm"))


def drifted_adverse(raw: DataFrame) -> DataFrame:
    patient = F.col("patient").dropFields("patientsex").withField("weight", F.length("receivedate").cast("double") + 0.5)
    return raw.withColumns({"patient": patient, "serious": F.col("serious") == "1"}).select(
        "*", _undeclared("safetyreportid", "receivedate"))


DRIFTED = {
    "products": drifted_products,
    "enforcement": drifted_enforcement,
    "adverse": drifted_adverse,
}


def array_files(raw: DataFrame, path: str, size: int = 500) -> str:
    """Write records as JSON array files, as ``json.dumps(list)`` would: ``size`` records an array, several arrays in a file."""
    text = raw.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("r"))
    parts = text.withColumn("_g", F.floor(F.monotonically_increasing_id() / size))
    (parts.groupBy("_g").agg(F.concat(F.lit("["), F.array_join(F.collect_list("r"), ", "), F.lit("]")).alias("value"))
     .select("value").write.mode("overwrite").text(path))
    return path
