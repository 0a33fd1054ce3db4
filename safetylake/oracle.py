"""Independent SQL statement of every registered query, for DuckDB.

The oracle derives the same raw records from the flat driver tables with
plain SQL (same fixed rules as ``sources.fixtures``) and then restates each
stage in SQL, so a Spark result can be compared value by value.

Dialect notes: DuckDB sorts NULLs last in both directions (NULLS FIRST is
stated where Spark's ascending default needs it); ``SUM`` returns HUGEINT
and is cast to BIGINT; ``try_cast('1.5' as int)`` rounds in DuckDB while
Spark gives NULL, so integer parsing is guarded by a pattern.
"""

from __future__ import annotations

import re

# --- shared expressions ---------------------------------------------------------


def _int(x: str) -> str:
    return (f"CASE WHEN regexp_full_match(trim({x}), '[+-]?[0-9]+') "
            f"THEN TRY_CAST(trim({x}) AS INTEGER) END")


def _date(x: str) -> str:
    return f"CAST(try_strptime({x}, '%Y%m%d') AS DATE)"


def _initcap(x: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({x}), ' '), "
            f"lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ')")


_YMD = "strftime(o_orderdate, '%Y%m%d')"

# --- common table expressions: name -> (deps, body) ------------------------------

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, body: str, *deps: str) -> None:
    CTES[name] = (deps, body)


_cte("rp_base", """
SELECT p_partkey,
  CASE WHEN p_partkey % 97 = 0 THEN NULL
       ELSE '  ' || lpad(CAST(p_partkey AS VARCHAR), 6, '0') || ' ' END AS product_ndc,
  CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE ' ' || lower(p_brand) END AS brand_name,
  p_name AS generic_name,
  'Labeler ' || CAST(p_partkey % 10 AS VARCHAR) || ' ' AS labeler_name,
  p_type AS product_type,
  'FORM ' || CAST(p_size % 5 AS VARCHAR) AS dosage_form,
  'CAT ' || CAST(p_partkey % 3 AS VARCHAR) AS marketing_category,
  CASE WHEN p_partkey % 7 = 0 THEN NULL
       WHEN p_partkey % 5 = 0 THEN CAST([] AS VARCHAR[])
       ELSE ['R' || CAST(p_size % 4 AS VARCHAR), 'ORAL'] END AS route,
  CASE WHEN p_partkey % 13 = 0 THEN NULL
       WHEN p_partkey % 17 = 0 THEN CAST([] AS STRUCT(name VARCHAR, strength VARCHAR)[])
       ELSE list_transform(string_split(p_name, ' '),
              lambda w: {'name': w, 'strength': CAST(p_size AS VARCHAR) || ' mg'}) END AS active_ingredients
FROM part""")

_cte("raw_products", """
SELECT * EXCLUDE (p_partkey), p_partkey * 2 AS _seq FROM rp_base
UNION ALL
SELECT * EXCLUDE (p_partkey), p_partkey * 2 + 1 AS _seq FROM rp_base
WHERE p_partkey % 50 = 1 AND p_partkey % 97 <> 0""", "rp_base")

_cte("stage_products", """
SELECT trim(product_ndc) AS product_ndc,
  upper(trim(brand_name)) AS brand_name,
  upper(trim(generic_name)) AS generic_name,
  trim(labeler_name) AS labeler_name,
  product_type, dosage_form, marketing_category,
  route[1] AS primary_route,
  active_ingredients[1].name AS primary_ingredient,
  active_ingredients[1].strength AS primary_strength,
  CAST(len(active_ingredients) AS INTEGER) AS ingredient_count
FROM raw_products""", "raw_products")

_PRODUCT_REST = ("brand_name", "generic_name", "labeler_name", "product_type", "dosage_form",
                 "marketing_category", "primary_route", "primary_ingredient", "primary_strength",
                 "ingredient_count")

_cte("clean_products", f"""
SELECT product_ndc, {', '.join(_PRODUCT_REST)} FROM stage_products
WHERE product_ndc IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY product_ndc
  ORDER BY {', '.join(c + ' ASC NULLS FIRST' for c in _PRODUCT_REST)}) = 1""", "stage_products")

_cte("re_base", f"""
SELECT o_orderkey,
  CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE ' F-' || CAST(o_orderkey AS VARCHAR) END AS recall_number,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Class I' WHEN '2-HIGH' THEN 'Class II'
       WHEN '3-MEDIUM' THEN 'Class III' WHEN '4-NOT SPECIFIED' THEN 'Not Yet Classified' END AS classification,
  CASE o_orderstatus WHEN 'O' THEN 'Ongoing' WHEN 'F' THEN 'Terminated'
       WHEN 'P' THEN 'Completed' END AS status,
  'Lot ' || CAST(o_orderkey AS VARCHAR) || ' ' || o_orderpriority AS product_description,
  CASE WHEN o_orderkey % 23 = 0 THEN c_mktsegment || ' 50%_off'
       WHEN o_orderkey % 29 = 0 THEN 'It''s mislabeled'
       ELSE c_mktsegment || ' defect' END AS reason_for_recall,
  c_name || ' ' AS recalling_firm,
  n_name AS city,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE substr(n_name, 1, 2) END AS state,
  n_name AS country,
  CASE WHEN o_orderkey % 2 = 0 THEN 'Nationwide' ELSE 'Regional' END AS distribution_pattern,
  CASE WHEN o_orderkey % 3 = 0 THEN 'Mandated' ELSE 'Voluntary' END AS voluntary_mandated,
  CASE WHEN o_orderkey % 31 = 0 THEN '' WHEN o_orderkey % 37 = 0 THEN '20241399'
       ELSE {_YMD} END AS recall_initiation_date,
  {_YMD} AS report_date,
  CASE WHEN o_orderstatus = 'O' THEN NULL ELSE {_YMD} END AS termination_date
FROM orders LEFT JOIN customer ON o_custkey = c_custkey
            LEFT JOIN nation ON c_nationkey = n_nationkey""")

_cte("raw_enforcement", """
SELECT * EXCLUDE (o_orderkey), o_orderkey * 2 AS _seq FROM re_base
UNION ALL
SELECT * EXCLUDE (o_orderkey), o_orderkey * 2 + 1 AS _seq FROM re_base WHERE o_orderkey % 40 = 1""",
     "re_base")

_cte("stage_enforcement", f"""
SELECT trim(recall_number) AS recall_number, classification, status, product_description,
  reason_for_recall, trim(recalling_firm) AS recalling_firm, city, state, country,
  distribution_pattern, voluntary_mandated,
  {_date('recall_initiation_date')} AS recall_date,
  {_date('report_date')} AS report_date,
  {_date('termination_date')} AS termination_date,
  recall_initiation_date AS _src_recall_date,
  report_date AS _src_report_date,
  termination_date AS _src_termination_date
FROM raw_enforcement""", "raw_enforcement")

_ENF_REST = ("classification", "status", "product_description", "reason_for_recall",
             "recalling_firm", "city", "state", "country", "distribution_pattern",
             "voluntary_mandated", "recall_date", "report_date", "termination_date")

_cte("clean_enforcement", f"""
SELECT recall_number, {', '.join(_ENF_REST)} FROM stage_enforcement
WHERE recall_number IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY recall_number
  ORDER BY {', '.join(c + ' ASC NULLS FIRST' for c in _ENF_REST)}) = 1""", "stage_enforcement")

_cte("ae_lines", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE ' ' || p_name END AS medicinalproduct,
  p_type AS drugindication,
  CASE WHEN l_linenumber = 6 THEN NULL ELSE {_initcap('n_name')} || ' ' END AS reactionmeddrapt
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
              LEFT JOIN supplier ON l_suppkey = s_suppkey
              LEFT JOIN nation ON s_nationkey = n_nationkey""")

_cte("ae_reports", f"""
SELECT o_orderkey,
  CASE WHEN o_orderkey % 103 = 0 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS safetyreportid,
  CASE WHEN o_orderkey % 29 = 0 THEN NULL WHEN o_orderkey % 31 = 0 THEN 'x'
       WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN '1' ELSE '2' END AS serious,
  CASE WHEN o_orderkey % 37 = 0 THEN '' ELSE {_YMD} END AS receivedate,
  CAST(o_custkey % 3 AS VARCHAR) AS patientsex,
  CASE WHEN o_orderkey % 19 = 0 THEN '1.5' ELSE CAST(o_custkey % 90 AS VARCHAR) END AS patientonsetage
FROM orders""")

_cte("stage_adverse", f"""
SELECT r.safetyreportid AS report_id,
  {_int('r.serious')} AS is_serious,
  {_date('r.receivedate')} AS receive_date,
  {_int('r.patientsex')} AS patient_sex,
  {_int('r.patientonsetage')} AS patient_age,
  upper(trim(a.medicinalproduct)) AS product_name,
  a.drugindication AS drug_indication,
  upper(trim(b.reactionmeddrapt)) AS reaction_name,
  r.serious AS _src_serious, r.receivedate AS _src_receivedate, r.patientonsetage AS _src_age
FROM ae_reports r
JOIN ae_lines a ON a.l_orderkey = r.o_orderkey
LEFT JOIN ae_lines b ON b.l_orderkey = r.o_orderkey AND r.o_orderkey % 7 <> 0
WHERE a.medicinalproduct IS NOT NULL""", "ae_reports", "ae_lines")

_cte("clean_adverse", """
SELECT report_id, is_serious, receive_date, patient_sex, patient_age, product_name,
  drug_indication, reaction_name
FROM stage_adverse WHERE report_id IS NOT NULL""", "stage_adverse")

_cte("gold_summary", """
SELECT product_name, reaction_name,
  COUNT(*) AS event_count,
  CAST(SUM(CASE WHEN is_serious = 1 THEN 1 ELSE 0 END) AS BIGINT) AS serious_count,
  MIN(receive_date) AS earliest_report,
  MAX(receive_date) AS latest_report
FROM clean_adverse
WHERE product_name IS NOT NULL AND reaction_name IS NOT NULL
GROUP BY product_name, reaction_name""", "clean_adverse")


def with_ctes(select: str, *needed: str) -> str:
    """``WITH`` clause holding ``needed`` and everything they depend on, then ``select``."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for d in CTES[name][0]:
            visit(d)
        order.append(name)

    for n in needed:
        visit(n)
    body = ",\n".join(f"{n} AS ({CTES[n][1]}\n)" for n in order)
    return f"WITH {body}\n{select}"


# --- registered statements -------------------------------------------------------

STATEMENTS: dict[str, str] = {}


def _stmt(key: str, select: str, *needed: str) -> None:
    STATEMENTS[key] = with_ctes(select, *needed)


_stmt("clean_products", "SELECT * FROM clean_products", "clean_products")
_stmt("gold_product_catalog", "SELECT * FROM clean_products", "clean_products")
_stmt("clean_enforcement", "SELECT * FROM clean_enforcement", "clean_enforcement")
_stmt("gold_enforcement_actions", "SELECT * FROM clean_enforcement", "clean_enforcement")
_stmt("clean_adverse_events", "SELECT * FROM clean_adverse", "clean_adverse")
_stmt("gold_adverse_events_summary", "SELECT * FROM gold_summary", "gold_summary")


# --- dashboard queries ---------------------------------------------------------------

def _lit(term: str) -> str:
    return "'" + term.replace("'", "''") + "'"


def _contains(cols: list[str], term: str) -> str:
    t = _lit(term.lower())
    return " OR ".join(f"coalesce(contains(lower({c}), {t}), false)" for c in cols)


def _like(cols: list[str], term: str) -> str:
    pat = _lit("%" + term.lower().replace("\\", "\\\\") + "%")
    return " OR ".join(f"coalesce(lower({c}) LIKE {pat} ESCAPE '\\', false)" for c in cols)


_RECALL_COLS = ["product_description", "recalling_firm", "reason_for_recall"]
_PRODUCT_COLS = ["brand_name", "generic_name", "labeler_name"]
_RECALL_VIEW = ("recall_number, classification, status, recall_date, recalling_firm, city, state, "
                "product_description, reason_for_recall")
_PRODUCT_VIEW = ("product_ndc, brand_name, generic_name, labeler_name, product_type, dosage_form, "
                 "primary_route, primary_ingredient, ingredient_count")


def recall_search_sql(where: str | None, limit: int = 50) -> str:
    w = f"WHERE {where}" if where else ""
    return (f"SELECT {_RECALL_VIEW} FROM clean_enforcement {w} "
            f"ORDER BY recall_date DESC NULLS LAST, recall_number LIMIT {limit}")


def product_search_sql(where: str | None, limit: int = 50) -> str:
    w = f"WHERE {where}" if where else ""
    return (f"SELECT {_PRODUCT_VIEW} FROM clean_products {w} "
            f"ORDER BY brand_name ASC NULLS FIRST, product_ndc LIMIT {limit}")


_cte("kpi_products", "SELECT COUNT(*) AS products FROM clean_products", "clean_products")
_cte("kpi_recalls", """
SELECT COUNT(*) AS total_recalls,
  CAST(SUM(CASE WHEN classification = 'Class I' THEN 1 ELSE 0 END) AS BIGINT) AS class_i_recalls,
  CAST(SUM(CASE WHEN status = 'Ongoing' THEN 1 ELSE 0 END) AS BIGINT) AS active_recalls
FROM clean_enforcement""", "clean_enforcement")
_cte("kpi_adverse", """
SELECT CAST(SUM(event_count) AS BIGINT) AS total_adverse_events,
  CAST(SUM(serious_count) AS BIGINT) AS serious_events,
  COUNT(DISTINCT product_name) AS unique_products_with_ae
FROM gold_summary""", "gold_summary")
_cte("top_products", """
SELECT product_name, CAST(SUM(event_count) AS BIGINT) AS total_events,
  CAST(SUM(serious_count) AS BIGINT) AS serious_events,
  COUNT(DISTINCT reaction_name) AS unique_reactions
FROM gold_summary GROUP BY product_name
ORDER BY total_events DESC, product_name LIMIT 20""", "gold_summary")
_cte("top_pairs", """
SELECT product_name, reaction_name, event_count, serious_count, earliest_report, latest_report
FROM gold_summary ORDER BY event_count DESC, product_name, reaction_name LIMIT 30""", "gold_summary")

_stmt("kpi_products", "SELECT * FROM kpi_products", "kpi_products")
_stmt("kpi_recalls", "SELECT * FROM kpi_recalls", "kpi_recalls")
_stmt("kpi_adverse", "SELECT * FROM kpi_adverse", "kpi_adverse")
_stmt("kpi_stats", """
SELECT CAST(coalesce(p.products, 0) AS BIGINT) AS products,
  CAST(coalesce(r.total_recalls, 0) AS BIGINT) AS total_recalls,
  CAST(coalesce(r.class_i_recalls, 0) AS BIGINT) AS class_i_recalls,
  CAST(coalesce(r.active_recalls, 0) AS BIGINT) AS active_recalls,
  CAST(coalesce(a.total_adverse_events, 0) AS BIGINT) AS total_adverse_events,
  CAST(coalesce(a.serious_events, 0) AS BIGINT) AS serious_events,
  CAST(coalesce(a.unique_products_with_ae, 0) AS BIGINT) AS unique_products_with_ae
FROM kpi_products p, kpi_recalls r, kpi_adverse a""", "kpi_products", "kpi_recalls", "kpi_adverse")
_stmt("top_products", "SELECT * FROM top_products", "top_products")
_stmt("top_pairs", "SELECT * FROM top_pairs", "top_pairs")
_stmt("recent_recalls", recall_search_sql(None), "clean_enforcement")
_stmt("list_products", product_search_sql(None), "clean_products")
_stmt("search_recalls", recall_search_sql(_contains(_RECALL_COLS, "50%")), "clean_enforcement")
_stmt("search_recalls_like", recall_search_sql(_like(_RECALL_COLS, "50%")), "clean_enforcement")
_stmt("search_recalls_count",
      f"SELECT COUNT(*) AS total_matches FROM clean_enforcement WHERE {_contains(_RECALL_COLS, 'it' + chr(39) + 's')}",
      "clean_enforcement")
_stmt("search_products", product_search_sql(_contains(_PRODUCT_COLS, "ring")), "clean_products")
_stmt("search_products_like", product_search_sql(_like(_PRODUCT_COLS, "r_d")), "clean_products")
_stmt("top_products_share", """
SELECT *,
  CAST(round(total_events / max(total_events) OVER () * 100) AS BIGINT) AS total_pct,
  CAST(round(serious_events / max(total_events) OVER () * 100) AS BIGINT) AS serious_pct
FROM top_products""", "top_products")
_stmt("top_pairs_share", """
SELECT *,
  CAST(round(event_count / max(event_count) OVER () * 100) AS BIGINT) AS event_pct,
  CASE WHEN serious_count > 0 THEN 'serious' ELSE 'total' END AS severity
FROM top_pairs""", "top_pairs")
_stmt("recall_badges", """
SELECT recall_number, classification, status,
  CASE classification WHEN 'Class I' THEN 'class-i' WHEN 'Class II' THEN 'class-ii'
       WHEN 'Class III' THEN 'class-iii' END AS class_badge,
  CASE WHEN status IS NULL OR status = '' THEN NULL WHEN status = 'Ongoing' THEN 'ongoing'
       ELSE 'terminated' END AS status_badge
FROM clean_enforcement""", "clean_enforcement")


# --- data quality ------------------------------------------------------------------

def _metrics(dataset: str, source: str, rules: list[tuple[str, str, str]], stage: str = "input") -> str:
    parts = []
    for name, action, pred in rules:
        parts.append(
            f"SELECT '{dataset}' AS dataset, '{stage}' AS stage, '{name}' AS rule, '{action}' AS action, "
            f"COUNT(*) AS total, CAST(count_if(({pred}) IS TRUE) AS BIGINT) AS passed, "
            f"CAST(count_if(({pred}) IS FALSE) AS BIGINT) AS failed, "
            f"CAST(count_if(({pred}) IS NULL) AS BIGINT) AS null_result FROM {source}")
    return "\nUNION ALL\n".join(parts)


# Rule names, actions and predicates (fixed values of the pipeline).
_stmt("dq_products", _metrics("clean_products", "stage_products", [
    ("has_ndc", "drop", "product_ndc IS NOT NULL"),
    ("has_brand", "warn", "brand_name IS NOT NULL"),
    ("ndc_not_blank", "warn", "product_ndc <> ''"),
]) + "\nUNION ALL\n" + _metrics("clean_products", "clean_products", [
    ("has_ndc", "drop", "product_ndc IS NOT NULL"),
    ("has_brand", "warn", "brand_name IS NOT NULL"),
    ("ndc_not_blank", "warn", "product_ndc <> ''"),
], "output"), "stage_products", "clean_products")
_stmt("dq_enforcement", _metrics("clean_enforcement", "stage_enforcement", [
    ("has_recall_number", "drop", "recall_number IS NOT NULL"),
    ("valid_classification", "warn", "classification IN ('Class I', 'Class II', 'Class III')"),
    ("recall_number_not_blank", "warn", "recall_number <> ''"),
    ("recall_date_parsed", "warn", "_src_recall_date IS NULL OR recall_date IS NOT NULL"),
    ("report_date_parsed", "warn", "_src_report_date IS NULL OR report_date IS NOT NULL"),
    ("termination_date_parsed", "warn", "_src_termination_date IS NULL OR termination_date IS NOT NULL"),
]) + "\nUNION ALL\n" + _metrics("clean_enforcement", "clean_enforcement", [
    ("has_recall_number", "drop", "recall_number IS NOT NULL"),
    ("valid_classification", "warn", "classification IN ('Class I', 'Class II', 'Class III')"),
    ("recall_number_not_blank", "warn", "recall_number <> ''"),
], "output"), "stage_enforcement", "clean_enforcement")
_stmt("dq_adverse", _metrics("clean_adverse_events", "stage_adverse", [
    ("has_report_id", "drop", "report_id IS NOT NULL"),
    ("serious_parsed", "warn", "_src_serious IS NULL OR is_serious IS NOT NULL"),
    ("receive_date_parsed", "warn", "_src_receivedate IS NULL OR receive_date IS NOT NULL"),
    ("patient_age_parsed", "warn", "_src_age IS NULL OR patient_age IS NOT NULL"),
]) + "\nUNION ALL\n" + _metrics("clean_adverse_events", "clean_adverse", [
    ("has_report_id", "drop", "report_id IS NOT NULL"),
], "output"), "stage_adverse", "clean_adverse")


def _pk(table_name: str, source: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    nulls = " OR ".join(f"{c} IS NULL" for c in keys)
    return (f"SELECT '{table_name}' AS table_name, concat_ws(' | ', {k}) AS key, COUNT(*) AS n_rows "
            f"FROM {source} GROUP BY {k} HAVING COUNT(*) > 1 OR {nulls}")


_stmt("pk_violations", "\nUNION ALL\n".join([
    _pk("gold_product_catalog", "clean_products", ["product_ndc"]),
    _pk("gold_enforcement_actions", "clean_enforcement", ["recall_number"]),
    _pk("gold_adverse_events_summary", "gold_summary", ["product_name", "reaction_name"]),
]), "clean_products", "clean_enforcement", "gold_summary")
_stmt("pk_violations_raw", "\nUNION ALL\n".join([
    _pk("raw_ndc_products", "stage_products", ["product_ndc"]),
    _pk("raw_enforcement_actions", "stage_enforcement", ["recall_number"]),
]), "stage_products", "stage_enforcement")


# --- ingest ----------------------------------------------------------------------------

_cte("ae_nested", """
SELECT l_orderkey,
  list({'medicinalproduct': medicinalproduct, 'drugindication': drugindication}
       ORDER BY l_linenumber, l_partkey, l_suppkey) AS drug,
  list({'reactionmeddrapt': reactionmeddrapt} ORDER BY l_linenumber, l_partkey, l_suppkey) AS reaction
FROM ae_lines GROUP BY l_orderkey""", "ae_lines")

_cte("raw_adverse", """
SELECT r.safetyreportid, r.serious, r.receivedate,
  {'patientsex': r.patientsex, 'patientonsetage': r.patientonsetage, 'drug': n.drug,
   'reaction': CASE WHEN r.o_orderkey % 7 = 0 THEN CAST([] AS STRUCT(reactionmeddrapt VARCHAR)[])
                    ELSE n.reaction END} AS patient,
  r.o_orderkey AS _seq
FROM ae_reports r LEFT JOIN ae_nested n ON n.l_orderkey = r.o_orderkey""", "ae_reports", "ae_nested")

# Source tags (fixed values).
_SOURCE = {
    "products": "openFDA /drug/ndc.json",
    "enforcement": "openFDA /food/enforcement.json",
    "adverse": "openFDA /drug/event.json",
}
_RAW = {
    "products": ("raw_products", "product_ndc",
                 "product_ndc, brand_name, generic_name, labeler_name, product_type, dosage_form, "
                 "marketing_category, to_json(route) AS route, "
                 "to_json(active_ingredients) AS active_ingredients"),
    "enforcement": ("raw_enforcement", "recall_number",
                    "recall_number, classification, status, product_description, reason_for_recall, "
                    "recalling_firm, city, state, country, distribution_pattern, voluntary_mandated, "
                    "recall_initiation_date, report_date, termination_date"),
    "adverse": ("raw_adverse", "safetyreportid",
                "safetyreportid, serious, receivedate, to_json(patient) AS patient"),
}

for _w, (_src, _key, _cols) in _RAW.items():
    _stmt(f"bronze_{_w}", f"SELECT {_cols}, '{_SOURCE[_w]}' AS _source FROM {_src}", _src)


def landed_sql(which: str, page_size: int = 100, short_page: tuple[int, int] | None = None,
               select: str | None = None) -> str:
    src, key, cols = _RAW[which]
    cut = ""
    if short_page:
        p, rows = short_page
        cut = f"WHERE NOT (_idx // {page_size} = {p} AND _idx - {p * page_size} >= {rows})"
    return f"""
WITH numbered AS (
  SELECT *, row_number() OVER (ORDER BY {key} ASC NULLS FIRST, _seq) - 1 AS _idx FROM {src}),
paged AS (SELECT *, _idx // {page_size} AS _page FROM numbered {cut}),
sizes AS (SELECT _page, COUNT(*) AS n FROM paged GROUP BY _page),
stop AS (SELECT min(_page) AS s FROM sizes WHERE n < {page_size})
SELECT {select or cols + f", '{_SOURCE[which]}' AS _source"} FROM paged
WHERE coalesce(_page <= (SELECT s FROM stop), true)"""


_stmt("land_pages", f"SELECT * FROM ({landed_sql('products')})", "raw_products")
_stmt("land_pages_short_page", f"SELECT * FROM ({landed_sql('products', short_page=(5, 40))})",
      "raw_products")
_stmt("landing_counts", "\nUNION ALL\n".join(
    f"SELECT * FROM ({landed_sql(w, select=repr(_SOURCE[w]) + ' AS _source, COUNT(*) AS records')})"
    for w in ("products", "enforcement", "adverse")), "raw_products", "raw_enforcement", "raw_adverse")


# --- change feed and sync --------------------------------------------------------------

_PRODUCT_ALL = ("product_ndc",) + _PRODUCT_REST
_ENF_ALL = ("recall_number",) + _ENF_REST
_SUMMARY_ALL = ("product_name", "reaction_name", "event_count", "serious_count", "earliest_report",
                "latest_report")


def _evolve(name: str, source: str, cols: tuple[str, ...], h: str, changed: tuple[str, str],
            nulled: str, new_key: tuple[str, str]) -> None:
    def sel(over: dict[str, str]) -> str:
        return ", ".join(f"{over.get(c, c)} AS {c}" for c in cols)
    body = f"""
SELECT {sel({changed[0]: f"CASE WHEN _h = 1 THEN {changed[1]} ELSE {changed[0]} END",
              nulled: f"CASE WHEN _h = 2 THEN NULL ELSE {nulled} END"})}
FROM (SELECT *, ({h}) % 10 AS _h FROM {source}) WHERE _h IS NULL OR _h <> 0
UNION ALL
SELECT {sel({new_key[0]: new_key[1]})}
FROM (SELECT *, ({h}) % 10 AS _h FROM {source}) WHERE _h = 3"""
    _cte(name, body, source)


def _digits(c: str) -> str:
    return f"TRY_CAST(regexp_replace({c}, '[^0-9]', '', 'g') AS BIGINT)"


# Snapshot evolution rules (fixed values, see sources.fixtures).
_evolve("next_products", "clean_products", _PRODUCT_ALL, _digits("product_ndc"),
        ("labeler_name", "labeler_name || ' (revised)'"), "brand_name",
        ("product_ndc", "product_ndc || '-R'"))
_evolve("next_enforcement", "clean_enforcement", _ENF_ALL, _digits("recall_number"),
        ("product_description", "product_description || ' (revised)'"), "city",
        ("recall_number", "recall_number || '-R'"))
_evolve("next_summary", "gold_summary", _SUMMARY_ALL,
        "coalesce(" + _digits("product_name || reaction_name") + ", 0) "
        "+ length(product_name) + length(reaction_name)",
        ("event_count", "event_count + 1"), "latest_report",
        ("reaction_name", "reaction_name || ' (NEW)'"))


def _diff(old: str, new: str, cols: tuple[str, ...], keys: tuple[str, ...]) -> str:
    on = " AND ".join(f"o.{k} = n.{k}" for k in keys)
    rest = [c for c in cols if c not in keys]
    same = " AND ".join(f"o.{c} IS NOT DISTINCT FROM n.{c}" for c in rest)
    oc = ", ".join(f"o.{c}" for c in cols)
    nc = ", ".join(f"n.{c}" for c in cols)
    return f"""
SELECT {nc}, 'insert' AS _change_type FROM {new} n WHERE NOT EXISTS (SELECT 1 FROM {old} o WHERE {on})
UNION ALL
SELECT {oc}, 'delete' FROM {old} o WHERE NOT EXISTS (SELECT 1 FROM {new} n WHERE {on})
UNION ALL
SELECT {oc}, 'update_preimage' FROM {old} o JOIN {new} n ON {on} WHERE NOT ({same})
UNION ALL
SELECT {nc}, 'update_postimage' FROM {old} o JOIN {new} n ON {on} WHERE NOT ({same})"""


_stmt("change_feed_products", _diff("clean_products", "next_products", _PRODUCT_ALL, ("product_ndc",)),
      "clean_products", "next_products")
_stmt("change_feed_enforcement", _diff("clean_enforcement", "next_enforcement", _ENF_ALL,
                                       ("recall_number",)), "clean_enforcement", "next_enforcement")
_stmt("change_feed_adverse", _diff("gold_summary", "next_summary", _SUMMARY_ALL,
                                   ("product_name", "reaction_name")), "gold_summary", "next_summary")
_stmt("sync_apply_products", "SELECT * FROM next_products", "next_products")
_stmt("sync_apply_enforcement", "SELECT * FROM next_enforcement", "next_enforcement")
_stmt("sync_apply_adverse", "SELECT * FROM next_summary", "next_summary")
_stmt("sync_stream_adverse", "SELECT * FROM next_summary", "next_summary")


# --- a second run of the pipeline over changed raw feeds ------------------------------------

_evolve("raw_products_2", "raw_products", ("product_ndc", "brand_name", "generic_name", "labeler_name", "product_type",
                                           "dosage_form", "marketing_category", "route", "active_ingredients"),
        _digits("product_ndc"), ("labeler_name", "labeler_name || '(revised)'"), "brand_name",
        ("product_ndc", "rtrim(product_ndc) || '-R'"))
_evolve("raw_enforcement_2", "raw_enforcement", ("recall_number", "classification", "status", "product_description",
                                                 "reason_for_recall", "recalling_firm", "city", "state", "country",
                                                 "distribution_pattern", "voluntary_mandated", "recall_initiation_date",
                                                 "report_date", "termination_date"),
        _digits("recall_number"), ("product_description", "product_description || ' (revised)'"), "city",
        ("recall_number", "recall_number || '-R'"))
_evolve("ae_reports_2", "ae_reports", ("o_orderkey", "safetyreportid", "serious", "receivedate", "patientsex", "patientonsetage"),
        _digits("safetyreportid"), ("serious", "'1'"), "receivedate", ("safetyreportid", "safetyreportid || '9'"))


def _second(*chain: str) -> None:
    """The named steps once more, each reading the second version of what it reads where there is one."""
    for name in chain:
        deps, body = CTES[name]
        for d in deps:
            if f"{d}_2" in CTES:
                body = re.sub(rf"\b{d}\b", f"{d}_2", body)
        _cte(f"{name}_2", body, *[f"{d}_2" if f"{d}_2" in CTES else d for d in deps])


_second("stage_products", "clean_products", "stage_enforcement", "clean_enforcement",
        "stage_adverse", "clean_adverse", "gold_summary")

for _key, _name, _cols, _keys in (
        ("products", "clean_products", _PRODUCT_ALL, ("product_ndc",)),
        ("enforcement", "clean_enforcement", _ENF_ALL, ("recall_number",)),
        ("adverse", "gold_summary", _SUMMARY_ALL, ("product_name", "reaction_name"))):
    _stmt(f"pipeline_change_feed_{_key}",
          f"SELECT *, CAST(2 AS BIGINT) AS _commit_version FROM ({_diff(_name, f'{_name}_2', _cols, _keys)})", _name, f"{_name}_2")
    _stmt(f"pipeline_gold_{_key}", f"SELECT * FROM {_name}_2", f"{_name}_2")
    _stmt(f"pipeline_sync_{_key}", f"SELECT * FROM {_name}_2", f"{_name}_2")
_stmt("incremental_adverse_summary", "SELECT * FROM gold_summary_2", "gold_summary_2")


# --- whole records, drift, arrays, quarantine, index, daily partials ---------------------------------

for _w, (_words, _src) in {"products": ("labeler_name", "raw_products"), "enforcement": ("recalling_firm", "raw_enforcement"),
                           "adverse": ("receivedate", "raw_adverse")}.items():
    _k = _RAW[_w][1]
    _if = f"CASE WHEN {_k} IS NOT NULL THEN "
    _stmt(f"bronze_undeclared_{_w}", f"SELECT {_k}, {_if}upper({_words}) END AS maker, "
          f"{_if}CAST(length({_words}) AS INTEGER) END AS words, {_if}{_k} END AS tag FROM {_src}", _src)
    _stmt(f"bronze_arrays_{_w}", f"SELECT {_RAW[_w][2]}, '{_SOURCE[_w]}' AS _source FROM {_src}", _src)

# What the drifted deliveries differ in (fixed values, see sources.fixtures).
STATEMENTS["schema_drift"] = """
SELECT * FROM (VALUES
  ('openFDA /drug/ndc.json', 'openfda', NULL, 'struct', 'new'),
  ('openFDA /drug/ndc.json', 'dosage_form', 'string', 'bigint', 'retyped'),
  ('openFDA /drug/ndc.json', 'marketing_category', 'string', NULL, 'missing'),
  ('openFDA /food/enforcement.json', 'openfda', NULL, 'struct', 'new'),
  ('openFDA /food/enforcement.json', 'country', 'string', 'array', 'retyped'),
  ('openFDA /food/enforcement.json', 'country[]', NULL, 'string', 'new'),
  ('openFDA /food/enforcement.json', 'voluntary_mandated', 'string', NULL, 'missing'),
  ('openFDA /drug/event.json', 'openfda', NULL, 'struct', 'new'),
  ('openFDA /drug/event.json', 'serious', 'string', 'boolean', 'retyped'),
  ('openFDA /drug/event.json', 'patient.weight', NULL, 'decimal(2,1)', 'new'),
  ('openFDA /drug/event.json', 'patient.patientsex', 'string', NULL, 'missing')
) AS t(source, path, declared, found, change)"""

_cte("stage_reports", f"""
SELECT safetyreportid AS report_id, {_int('serious')} AS is_serious, {_date('receivedate')} AS receive_date,
  {_int('patientsex')} AS patient_sex, {_int('patientonsetage')} AS patient_age,
  serious AS _src_serious, receivedate AS _src_receivedate, patientonsetage AS _src_age
FROM ae_reports""", "ae_reports")

# Rule names and predicates (fixed values), the drop rule first.
_RULES = {
    "products": ("stage_products", _PRODUCT_ALL, [
        ("has_ndc", "product_ndc IS NOT NULL"), ("has_brand", "brand_name IS NOT NULL"), ("ndc_not_blank", "product_ndc <> ''")]),
    "enforcement": ("stage_enforcement", _ENF_ALL, [
        ("has_recall_number", "recall_number IS NOT NULL"),
        ("valid_classification", "classification IN ('Class I', 'Class II', 'Class III')"),
        ("recall_number_not_blank", "recall_number <> ''"),
        ("recall_date_parsed", "_src_recall_date IS NULL OR recall_date IS NOT NULL"),
        ("report_date_parsed", "_src_report_date IS NULL OR report_date IS NOT NULL"),
        ("termination_date_parsed", "_src_termination_date IS NULL OR termination_date IS NOT NULL")]),
    "adverse": ("stage_reports", ("is_serious", "receive_date", "patient_sex", "patient_age"), [
        ("has_report_id", "report_id IS NOT NULL"),
        ("serious_parsed", "_src_serious IS NULL OR is_serious IS NOT NULL"),
        ("receive_date_parsed", "_src_receivedate IS NULL OR receive_date IS NOT NULL"),
        ("patient_age_parsed", "_src_age IS NULL OR patient_age IS NOT NULL")]),
}
_counts = []
for _w, (_src, _cols2, _rules) in _RULES.items():
    _failed = ", ".join(f"CASE WHEN ({p}) IS NOT TRUE THEN '{n}' END" for n, p in _rules)
    _drop = f"({_rules[0][1]}) IS NOT TRUE"
    _stmt(f"quarantine_{_w}", f"SELECT {', '.join(_cols2)}, concat_ws(',', {_failed}) AS failed_rules FROM {_src} WHERE {_drop}", _src)
    _counts += [f"SELECT '{_w}' AS dataset, {n} AS rule, CAST(count_if(NOT {_drop}) AS BIGINT) AS accepted, "
                f"CAST(count_if({_drop}) AS BIGINT) AS rejected FROM {_src}{f' WHERE ({p}) IS NOT TRUE' if p else ''}"
                for n, p in [("NULL", None)] + [(f"'{n}'", p) for n, p in _rules]]
_stmt("quarantine_counts", "SELECT * FROM (" + "\nUNION ALL\n".join(_counts) + ") WHERE accepted + rejected > 0",
      "stage_products", "stage_enforcement", "stage_reports")

for _key in ("search_recalls", "search_recalls_like", "search_products", "search_products_like"):
    STATEMENTS[f"{_key}_indexed"] = STATEMENTS[_key]
STATEMENTS["kpi_adverse_daily"] = STATEMENTS["kpi_adverse"]
STATEMENTS["top_products_daily"] = STATEMENTS["top_products"]

for _w, (_src, _, _) in _RAW.items():
    _stmt(f"land_pages_streamed_{_w}", f"SELECT * FROM ({landed_sql(_w)})", _src)
    if _w != "products":
        _stmt(f"land_pages_{_w}", f"SELECT * FROM ({landed_sql(_w)})", _src)
