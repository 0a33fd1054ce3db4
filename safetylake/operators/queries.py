"""Questions asked of the gold tables: KPIs, top-N rankings, searches.

Every function takes typed arguments and builds a DataFrame; no SQL text
is ever assembled from user input, so search terms cannot change a query's
meaning. Each top-N is ``orderBy(...).limit(k)``, which Spark plans as a
``TakeOrderedAndProject`` (per-partition top-k, then one merge) rather than a
full sort. Ties are broken by the table's primary key so results are stable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from safetylake.functions.scalar import like_pattern, literal_contains

MAX_TERM = 200
RECALL_LIMIT = (50, 200)      # default, maximum
PRODUCT_LIMIT = (50, 200)
PAIR_LIMIT = (30, 100)
TOP_PRODUCTS = 20

RECALL_SEARCH_COLUMNS = ["product_description", "recalling_firm", "reason_for_recall"]
PRODUCT_SEARCH_COLUMNS = ["brand_name", "generic_name", "labeler_name"]

RECALL_VIEW = ["recall_number", "classification", "status", "recall_date", "recalling_firm",
               "city", "state", "product_description", "reason_for_recall"]
PAIR_VIEW = ["product_name", "reaction_name", "event_count", "serious_count",
             "earliest_report", "latest_report"]
PRODUCT_VIEW = ["product_ndc", "brand_name", "generic_name", "labeler_name", "product_type",
                "dosage_form", "primary_route", "primary_ingredient", "ingredient_count"]


# ---- argument rules ---------------------------------------------------------------

def check_term(term: str | None) -> str:
    term = term or ""
    if len(term) > MAX_TERM:
        raise ValueError(f"search term longer than {MAX_TERM} characters")
    return term


def check_limit(limit: int, maximum: int) -> int:
    if isinstance(limit, bool) or not isinstance(limit, int):
        raise ValueError("limit must be an integer")
    if limit < 0 or limit > maximum:
        raise ValueError(f"limit must be between 0 and {maximum}")
    return limit


def _match(columns: list[str], term: str, mode: str) -> Column | None:
    if not term:
        return None                          # empty term: no filter
    if mode == "literal":
        return literal_contains(columns, term)
    if mode == "like":
        pat = like_pattern(term)
        cond = None
        for c in columns:
            hit = F.coalesce(F.lower(F.col(c)).like(pat), F.lit(False))
            cond = hit if cond is None else (cond | hit)
        return cond
    raise ValueError("mode must be 'literal' or 'like'")


# ---- KPIs ----------------------------------------------------------------------------

def kpi_products(products: DataFrame) -> DataFrame:
    return products.agg(F.count(F.lit(1)).alias("products"))


def kpi_recalls(recalls: DataFrame) -> DataFrame:
    return recalls.agg(
        F.count(F.lit(1)).alias("total_recalls"),
        F.sum(F.when(F.col("classification") == "Class I", 1).otherwise(0)).alias("class_i_recalls"),
        F.sum(F.when(F.col("status") == "Ongoing", 1).otherwise(0)).alias("active_recalls"),
    )


def kpi_adverse(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.sum("event_count").alias("total_adverse_events"),
        F.sum("serious_count").alias("serious_events"),
        F.count_distinct("product_name").alias("unique_products_with_ae"),
    )


KPI_FIELDS = ["products", "total_recalls", "class_i_recalls", "active_recalls",
              "total_adverse_events", "serious_events", "unique_products_with_ae"]


def kpi_stats(products: DataFrame, recalls: DataFrame, summary: DataFrame) -> DataFrame:
    """The seven-field KPI record; a NULL sum (empty table) reads as 0.

    The three one-row aggregates are stacked with a union and folded into one
    row by a global ``max``: no join between them is needed.
    """
    parts = (kpi_products(products)
             .unionByName(kpi_recalls(recalls), allowMissingColumns=True)
             .unionByName(kpi_adverse(summary), allowMissingColumns=True))
    return parts.agg(*[F.coalesce(F.max(c), F.lit(0)).cast("bigint").alias(c) for c in KPI_FIELDS])


# ---- top-N -----------------------------------------------------------------------------

def top_pairs(summary: DataFrame, limit: int = PAIR_LIMIT[0]) -> DataFrame:
    limit = check_limit(limit, PAIR_LIMIT[1])
    return (summary.select(*PAIR_VIEW)
            .orderBy(F.col("event_count").desc_nulls_last(), "product_name", "reaction_name")
            .limit(limit))


def product_rollup(summary: DataFrame) -> DataFrame:
    """Per product: total events, serious events, distinct reactions."""
    return (summary.groupBy("product_name")
            .agg(F.sum("event_count").alias("total_events"),
                 F.sum("serious_count").alias("serious_events"),
                 F.count_distinct("reaction_name").alias("unique_reactions")))


def top_products(summary: DataFrame, limit: int = TOP_PRODUCTS) -> DataFrame:
    limit = check_limit(limit, PAIR_LIMIT[1])
    return top_rollup(product_rollup(summary), limit)


def top_rollup(rollup: DataFrame, limit: int = TOP_PRODUCTS) -> DataFrame:
    return (rollup
            .orderBy(F.col("total_events").desc_nulls_last(), F.col("product_name").asc_nulls_first())
            .limit(check_limit(limit, PAIR_LIMIT[1])))


def recent_recalls(recalls: DataFrame, limit: int = RECALL_LIMIT[0]) -> DataFrame:
    return search_recalls(recalls, "", limit)


def search_recalls(recalls: DataFrame, term: str = "", limit: int = RECALL_LIMIT[0],
                   mode: str = "literal") -> DataFrame:
    """Recalls whose description, firm or reason contains ``term`` (case-insensitive),
    newest first (undated last)."""
    term, limit = check_term(term), check_limit(limit, RECALL_LIMIT[1])
    cond = _match(RECALL_SEARCH_COLUMNS, term, mode)
    df = recalls if cond is None else recalls.filter(cond)
    return (df.select(*RECALL_VIEW)
            .orderBy(F.col("recall_date").desc_nulls_last(), "recall_number")
            .limit(limit))


def search_recalls_count(recalls: DataFrame, term: str = "", mode: str = "literal") -> DataFrame:
    """Total number of matching recalls (the search itself returns at most ``limit``)."""
    term = check_term(term)
    cond = _match(RECALL_SEARCH_COLUMNS, term, mode)
    df = recalls if cond is None else recalls.filter(cond)
    return df.agg(F.count(F.lit(1)).alias("total_matches"))


def list_products(products: DataFrame, limit: int = PRODUCT_LIMIT[0]) -> DataFrame:
    return search_products(products, "", limit)


def search_products(products: DataFrame, term: str = "", limit: int = PRODUCT_LIMIT[0],
                    mode: str = "literal") -> DataFrame:
    """Products whose brand, generic name or labeler contains ``term``, by brand
    (unbranded first)."""
    term, limit = check_term(term), check_limit(limit, PRODUCT_LIMIT[1])
    cond = _match(PRODUCT_SEARCH_COLUMNS, term, mode)
    df = products if cond is None else products.filter(cond)
    return (df.select(*PRODUCT_VIEW)
            .orderBy(F.col("brand_name").asc_nulls_first(), "product_ndc")
            .limit(limit))


# ---- presentation columns ------------------------------------------------------------

def _pct(part: str, whole: Column) -> Column:
    # round(part / max * 100), half up; NULL when the maximum is 0.
    return F.round(F.try_divide(F.col(part).cast("double"), whole) * 100).cast("bigint")


def top_products_share(summary: DataFrame) -> DataFrame:
    """Top products with each bar's share of the largest total (and the serious share)."""
    top = top_products(summary)
    # The window sees only the <= 20 rows that survive the limit.
    mx = F.max("total_events").over(Window.partitionBy(F.lit(0)))
    return top.select("*", _pct("total_events", mx).alias("total_pct"),
                      _pct("serious_events", mx).alias("serious_pct"))


def top_pairs_share(summary: DataFrame, limit: int = PAIR_LIMIT[0]) -> DataFrame:
    """Top pairs with the share of the largest count and a severity flag."""
    top = top_pairs(summary, limit)
    mx = F.max("event_count").over(Window.partitionBy(F.lit(0)))
    return top.select("*", _pct("event_count", mx).alias("event_pct"),
                      F.when(F.col("serious_count") > 0, "serious").otherwise("total").alias("severity"))


# Fixed labels for recall classes and statuses.
CLASS_BADGES = {"Class I": "class-i", "Class II": "class-ii", "Class III": "class-iii"}


def recall_badges(recalls: DataFrame) -> DataFrame:
    """Per recall: a class badge (none for other classes) and a status badge
    (none for NULL or blank status, ``ongoing`` for Ongoing, else ``terminated``)."""
    cls = None
    for k, v in CLASS_BADGES.items():
        cls = F.when(F.col("classification") == k, v) if cls is None else cls.when(F.col("classification") == k, v)
    status = (F.when(F.col("status").isNull() | (F.col("status") == ""), F.lit(None).cast("string"))
               .when(F.col("status") == "Ongoing", "ongoing").otherwise("terminated"))
    return recalls.select("recall_number", "classification", "status",
                          cls.alias("class_badge"), status.alias("status_badge"))
