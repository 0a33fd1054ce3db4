"""Explicit schemas for the three raw sources and the published tables.

Raw JSON is never schema-inferred: a field missing from every record would
leave an unresolvable column, and an empty array would infer an empty
struct. With a declared schema an absent field simply reads as NULL.
Raw scalars are strings because the cleaning stage parses them.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

# ---- raw (bronze) -----------------------------------------------------------

INGREDIENT = T.StructType([
    T.StructField("name", S),
    T.StructField("strength", S),
])

RAW_PRODUCTS = T.StructType([
    T.StructField("product_ndc", S),
    T.StructField("brand_name", S),
    T.StructField("generic_name", S),
    T.StructField("labeler_name", S),
    T.StructField("product_type", S),
    T.StructField("dosage_form", S),
    T.StructField("marketing_category", S),
    T.StructField("route", T.ArrayType(S)),
    T.StructField("active_ingredients", T.ArrayType(INGREDIENT)),
])

RAW_ENFORCEMENT = T.StructType([
    T.StructField(name, S) for name in (
        "recall_number", "classification", "status", "product_description",
        "reason_for_recall", "recalling_firm", "city", "state", "country",
        "distribution_pattern", "voluntary_mandated", "recall_initiation_date",
        "report_date", "termination_date",
    )
])

DRUG = T.StructType([
    T.StructField("medicinalproduct", S),
    T.StructField("drugindication", S),
])

REACTION = T.StructType([T.StructField("reactionmeddrapt", S)])

PATIENT = T.StructType([
    T.StructField("patientsex", S),
    T.StructField("patientonsetage", S),
    T.StructField("drug", T.ArrayType(DRUG)),
    T.StructField("reaction", T.ArrayType(REACTION)),
])

RAW_ADVERSE = T.StructType([
    T.StructField("safetyreportid", S),
    T.StructField("serious", S),
    T.StructField("receivedate", S),
    T.StructField("patient", PATIENT),
])

# Source tags written into ``_source`` (fixed values: they name the upstream
# endpoints the records come from).
SOURCE_PRODUCTS = "openFDA /drug/ndc.json"
SOURCE_ENFORCEMENT = "openFDA /food/enforcement.json"
SOURCE_ADVERSE = "openFDA /drug/event.json"

# ---- published (gold) keys ---------------------------------------------------

PK_PRODUCTS = ("product_ndc",)
PK_ENFORCEMENT = ("recall_number",)
PK_ADVERSE = ("product_name", "reaction_name")

PRODUCT_COLUMNS = (
    "product_ndc", "brand_name", "generic_name", "labeler_name", "product_type",
    "dosage_form", "marketing_category", "primary_route", "primary_ingredient",
    "primary_strength", "ingredient_count",
)

ENFORCEMENT_COLUMNS = (
    "recall_number", "classification", "status", "product_description",
    "reason_for_recall", "recalling_firm", "city", "state", "country",
    "distribution_pattern", "voluntary_mandated", "recall_date", "report_date",
    "termination_date",
)

ADVERSE_SILVER_COLUMNS = (
    "report_id", "is_serious", "receive_date", "patient_sex", "patient_age",
    "product_name", "drug_indication", "reaction_name",
)

ADVERSE_SUMMARY_COLUMNS = (
    "product_name", "reaction_name", "event_count", "serious_count",
    "earliest_report", "latest_report",
)
