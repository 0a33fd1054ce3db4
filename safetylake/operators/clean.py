"""Silver stage: flatten, clean, validate and deduplicate the raw sources.

Each ``stage_*`` function is the pure projection (trim, case, parse, first
element, explode); ``clean_*`` applies the drop rules and the keyed dedupe.
The ``stage_*`` output still holds rows that fail rules, so quality metrics
are measured on it.

Parsing is tolerant by default: a blank or impossible date or number turns
into NULL (and is counted by a parse rule) instead of failing the dataset.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from safetylake.functions.scalar import first_element, parse_date, parse_int, size0, upper_trim
from safetylake.operators.dedupe import keep_least
from safetylake.operators.quality import DROP, OUTPUT, WARN, Rule, apply_rules, rule_metrics
from safetylake.schemas import ADVERSE_SILVER_COLUMNS, ENFORCEMENT_COLUMNS, PRODUCT_COLUMNS

# Rules of the published pipeline (names and predicates are fixed values).
PRODUCT_RULES = [
    Rule("has_ndc", "product_ndc IS NOT NULL", DROP),
    Rule("has_brand", "brand_name IS NOT NULL", WARN),
]
ENFORCEMENT_RULES = [
    Rule("has_recall_number", "recall_number IS NOT NULL", DROP),
    Rule("valid_classification", "classification IN ('Class I', 'Class II', 'Class III')", WARN),
]
ADVERSE_RULES = [
    Rule("has_report_id", "report_id IS NOT NULL", DROP),
]

# Extra warn-only checks: blank keys pass IS NOT NULL, and tolerant parsing
# turns bad input into NULL; both are worth counting.
PRODUCT_CHECKS = [
    Rule("ndc_not_blank", "product_ndc <> ''", WARN),
]
ENFORCEMENT_CHECKS = [
    Rule("recall_number_not_blank", "recall_number <> ''", WARN),
    Rule("recall_date_parsed", "_src_recall_date IS NULL OR recall_date IS NOT NULL", WARN),
    Rule("report_date_parsed", "_src_report_date IS NULL OR report_date IS NOT NULL", WARN),
    Rule("termination_date_parsed",
         "_src_termination_date IS NULL OR termination_date IS NOT NULL", WARN),
]
ADVERSE_CHECKS = [
    Rule("serious_parsed", "_src_serious IS NULL OR is_serious IS NOT NULL", WARN),
    Rule("receive_date_parsed", "_src_receivedate IS NULL OR receive_date IS NOT NULL", WARN),
    Rule("patient_age_parsed", "_src_age IS NULL OR patient_age IS NOT NULL", WARN),
]


def _size_or_null(c: str) -> Column:
    # NULL array -> NULL whatever the session's legacy sizeOfNull setting.
    return F.when(F.col(c).isNull(), F.lit(None).cast("int")).otherwise(F.size(c))


# ---- products ----------------------------------------------------------------

def stage_products(raw: DataFrame) -> DataFrame:
    head = first_element("active_ingredients")
    return raw.select(
        F.trim("product_ndc").alias("product_ndc"),
        upper_trim("brand_name").alias("brand_name"),
        upper_trim("generic_name").alias("generic_name"),
        F.trim("labeler_name").alias("labeler_name"),
        F.col("product_type"),
        F.col("dosage_form"),
        F.col("marketing_category"),
        first_element("route").alias("primary_route"),
        head.getField("name").alias("primary_ingredient"),
        head.getField("strength").alias("primary_strength"),
        _size_or_null("active_ingredients").alias("ingredient_count"),
    )


def clean_products(raw: DataFrame) -> DataFrame:
    """``clean_products``: one row per trimmed NDC, deterministic survivor."""
    kept = apply_rules(stage_products(raw), PRODUCT_RULES)
    return keep_least(kept, ["product_ndc"]).select(*PRODUCT_COLUMNS)


# ---- enforcement -------------------------------------------------------------

def stage_enforcement(raw: DataFrame, strict: bool = False, keep_source: bool = False) -> DataFrame:
    cols = [
        F.trim("recall_number").alias("recall_number"),
        F.col("classification"),
        F.col("status"),
        F.col("product_description"),
        F.col("reason_for_recall"),
        F.trim("recalling_firm").alias("recalling_firm"),
        F.col("city"),
        F.col("state"),
        F.col("country"),
        F.col("distribution_pattern"),
        F.col("voluntary_mandated"),
        parse_date("recall_initiation_date", strict).alias("recall_date"),
        parse_date("report_date", strict).alias("report_date"),
        parse_date("termination_date", strict).alias("termination_date"),
    ]
    if keep_source:
        cols += [
            F.col("recall_initiation_date").alias("_src_recall_date"),
            F.col("report_date").alias("_src_report_date"),
            F.col("termination_date").alias("_src_termination_date"),
        ]
    return raw.select(*cols)


def clean_enforcement(raw: DataFrame, strict: bool = False) -> DataFrame:
    """``clean_enforcement``: one row per trimmed recall number, dates parsed."""
    kept = apply_rules(stage_enforcement(raw, strict), ENFORCEMENT_RULES)
    return keep_least(kept, ["recall_number"]).select(*ENFORCEMENT_COLUMNS)


# ---- adverse events ------------------------------------------------------------

def stage_adverse_reports(raw: DataFrame, strict: bool = False, keep_source: bool = False) -> DataFrame:
    """One row per report: parsed scalars, the drug structs, the reaction names,
    and ``_pairs``, the number of silver rows the report expands into
    (drugs with a product name x max(1, reactions))."""
    extra = []
    if keep_source:
        extra = [
            F.col("serious").alias("_src_serious"),
            F.col("receivedate").alias("_src_receivedate"),
            F.col("patient.patientonsetage").alias("_src_age"),
        ]
    named = size0(F.filter(F.col("patient.drug"), lambda d: d["medicinalproduct"].isNotNull()))
    reactions = F.greatest(size0("patient.reaction"), F.lit(1))
    return raw.select(
        F.col("safetyreportid").alias("report_id"),
        parse_int("serious", strict).alias("is_serious"),
        parse_date("receivedate", strict).alias("receive_date"),
        parse_int("patient.patientsex", strict).alias("patient_sex"),
        parse_int("patient.patientonsetage", strict).alias("patient_age"),
        F.col("patient.drug").alias("drugs"),
        F.col("patient.reaction.reactionmeddrapt").alias("reaction_names"),
        *extra,
        (named.cast("bigint") * reactions.cast("bigint")).alias("_pairs"),
    )


# Reports are expanded in tiles of at most TILE_SIDE drugs x TILE_SIDE
# reactions (an ordinary report is one tile).
TILE_SIDE = 3000
DATE_SHARES = 8


def _expand_pairs(reports: DataFrame, keep: list[str]) -> DataFrame:
    """drugs x reaction_names for each row (both outer), NULL products removed
    between the two explodes so they are never multiplied."""
    per_drug = (reports
                .select(*keep, "reaction_names", F.explode_outer("drugs").alias("drug"))
                .select(*keep, "reaction_names",
                        upper_trim(F.col("drug.medicinalproduct")).alias("product_name"),
                        F.col("drug.drugindication").alias("drug_indication"))
                .filter(F.col("product_name").isNotNull()))
    return per_drug.select(*keep, "product_name", "drug_indication",
                           F.explode_outer("reaction_names").alias("_reaction"))


def _tiles(reports: DataFrame, keep: list[str], side: int, by_date: bool = False) -> DataFrame:
    """Cut each report into tiles of at most ``side`` drugs x ``side`` reactions
    and spread the tiles over partitions.

    Every tile is a row holding two array slices; together a report's tiles
    expand into exactly its pairs. An ordinary report is a single tile. The
    shuffle has an explicit partition count: tiles are few bytes but can be
    much work, so AQE must not coalesce them; each (report, tile) hashes to
    its own partition, so one hot report is expanded by many tasks.

    ``by_date`` places the tiles of a date in at most ``DATE_SHARES`` shares, so
    that sums by date combine before they are shuffled; a hot date or report is
    still expanded by many tasks.
    """
    nd = size0("drugs")
    nr = F.greatest(size0("reaction_names"), F.lit(1))
    td = F.greatest(F.ceil(nd / side).cast("int"), F.lit(1))
    tr = F.ceil(nr / side).cast("int")
    t = reports.select(*keep, "drugs", "reaction_names", tr.alias("_tr"),
                       F.explode(F.sequence(F.lit(0), td * tr - 1)).alias("_t"))
    has_reactions = size0("reaction_names") > 0
    tiles = t.select(
        *keep,
        F.slice("drugs", F.floor(F.col("_t") / F.col("_tr")).cast("int") * side + 1, side).alias("drugs"),
        F.when(has_reactions, F.slice("reaction_names", F.pmod(F.col("_t"), F.col("_tr")) * side + 1, side))
         .otherwise(F.col("reaction_names")).alias("reaction_names"),
        F.col("_t"),
    )
    spread = _spread(reports.sparkSession)
    if by_date:
        share = F.pmod(F.xxhash64("report_id", "is_serious"), F.lit(DATE_SHARES))
        return tiles.repartition(spread, F.xxhash64("receive_date", share, "_t")).drop("_t")
    return tiles.repartition(spread, F.xxhash64(*[F.col(c) for c in keep], F.col("_t"))).drop("_t")


def _spread(spark) -> int:
    """Partitions to spread tiles over: the session's own shuffle width, as sized for its data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stage_adverse_events(raw: DataFrame, strict: bool = False, keep_source: bool = False,
                         tile_side: int | None = TILE_SIDE, by_date: bool = False) -> DataFrame:
    """One row per report x drug x reaction (both explodes are outer).

    Only the fields used downstream travel through the explodes: the drug
    structs are cut to two fields and the reactions to an array of names.
    Rows whose product is NULL are removed between the two explodes, which
    gives the same rows as removing them at the end without multiplying them
    first.

    Reports are first cut into tiles of at most ``tile_side`` x ``tile_side``
    pairs (one tile for an ordinary report) and the tiles are spread over
    partitions, so a report holding a large share of all drug entries is
    expanded by many tasks, and the expansion and the aggregation after it
    run in parallel whatever the input's file layout. ``tile_side=None``
    expands every report where it is read, with no shuffle; ``by_date`` spreads
    the tiles by date, for sums by date.
    """
    reports = stage_adverse_reports(raw, strict, keep_source)
    keep = [c for c in reports.columns if c not in ("drugs", "reaction_names", "_pairs")]
    if tile_side is not None:
        reports = _tiles(reports, keep, tile_side, by_date)
    pairs = _expand_pairs(reports, keep)
    scalars = [c for c in keep if not c.startswith("_src")]
    sources = [c for c in keep if c.startswith("_src")]
    return pairs.select(*scalars, "product_name", "drug_indication",
                        upper_trim("_reaction").alias("reaction_name"), *sources)


#: Columns that differ between the pairs of one report.
PAIR_COLUMNS = ("product_name", "drug_indication", "reaction_name")


def adverse_metrics(raw: DataFrame, rules: list[Rule], dataset: str = "clean_adverse_events",
                    output: list[Rule] | None = None) -> DataFrame:
    """Rule metrics over the pair rows of ``clean_adverse_events``.

    When every rule reads only report-level columns, all pairs of a report
    share its verdict, so the metrics are sums over reports weighted by the
    pairs each expands into: the same numbers without exploding anything.
    Otherwise they are counted over the exploded rows.
    """
    reads = re.compile(rf"\b({'|'.join(PAIR_COLUMNS)})\b", re.IGNORECASE)
    if any(reads.search(r.predicate) for r in [*rules, *(output or [])]):
        return rule_metrics(stage_adverse_events(raw, keep_source=True), rules, dataset, output=output)
    return rule_metrics(stage_adverse_reports(raw, keep_source=True), rules, dataset, weight="_pairs", output=output)


def clean_adverse_events(raw: DataFrame, strict: bool = False, by_date: bool = False) -> DataFrame:
    """``clean_adverse_events``: drug x reaction pairs; no key and no dedupe."""
    return apply_rules(stage_adverse_events(raw, strict, by_date=by_date), ADVERSE_RULES).select(*ADVERSE_SILVER_COLUMNS)


# ---- quality metrics of both populations -------------------------------------------

def products_quality(raw: DataFrame, silver: DataFrame | None = None) -> DataFrame:
    """Rule metrics of ``clean_products`` before its drop rules and dedupe, and of its rows (``silver`` if they are stored)."""
    rules, name = PRODUCT_RULES + PRODUCT_CHECKS, "clean_products"
    return (rule_metrics(stage_products(raw), rules, name)
            .unionByName(rule_metrics(clean_products(raw) if silver is None else silver, rules, name, stage=OUTPUT)))


def enforcement_quality(raw: DataFrame, silver: DataFrame | None = None) -> DataFrame:
    """The same for ``clean_enforcement``; the parse checks need source texts, so only the input has them."""
    name = "clean_enforcement"
    after = ENFORCEMENT_RULES + [c for c in ENFORCEMENT_CHECKS if "_src_" not in c.predicate]
    return (rule_metrics(stage_enforcement(raw, keep_source=True), ENFORCEMENT_RULES + ENFORCEMENT_CHECKS, name)
            .unionByName(rule_metrics(clean_enforcement(raw) if silver is None else silver, after, name, stage=OUTPUT)))


def adverse_quality(raw: DataFrame, silver: DataFrame | None = None) -> DataFrame:
    """The same for ``clean_adverse_events``: it has no dedupe, so its rows are the pairs of reports that
    pass, and one pass over the reports measures both populations."""
    return adverse_metrics(raw, ADVERSE_RULES + ADVERSE_CHECKS, output=ADVERSE_RULES)
