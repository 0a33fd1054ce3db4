"""Dashboard responses built from the gold tables.

Each function returns the JSON-ready shape a dashboard consumes: a record of
KPIs, or ``{"results": [...], "count": n}`` where ``count`` is the number of
rows returned after the limit (``total_matches`` gives the full count of a
search). Only bounded results reach the driver: a one-row KPI record or a
top-k of at most 200 rows.
"""

from __future__ import annotations

import datetime as dt
from typing import Any

from pyspark.sql import DataFrame

from safetylake.operators import queries


def _value(v: Any) -> Any:
    return v.isoformat() if isinstance(v, (dt.date, dt.datetime)) else v


def _rows(df: DataFrame) -> list[dict[str, Any]]:
    return [{k: _value(v) for k, v in r.asDict().items()} for r in df.collect()]


def stats(products: DataFrame, recalls: DataFrame, summary: DataFrame) -> dict[str, int]:
    (row,) = queries.kpi_stats(products, recalls, summary).collect()
    return {k: int(v) for k, v in row.asDict().items()}


def enforcement(recalls: DataFrame, search: str = "", limit: int = queries.RECALL_LIMIT[0],
                mode: str = "literal") -> dict[str, Any]:
    rows = _rows(queries.search_recalls(recalls, search, limit, mode))
    return {"results": rows, "count": len(rows)}


def adverse_events(summary: DataFrame, limit: int = queries.PAIR_LIMIT[0]) -> dict[str, Any]:
    rows = _rows(queries.top_pairs(summary, limit))
    return {"results": rows, "count": len(rows)}


def adverse_events_by_product(summary: DataFrame) -> dict[str, Any]:
    return {"results": _rows(queries.top_products(summary))}


def products(catalog: DataFrame, search: str = "", limit: int = queries.PRODUCT_LIMIT[0],
             mode: str = "literal") -> dict[str, Any]:
    rows = _rows(queries.search_products(catalog, search, limit, mode))
    return {"results": rows, "count": len(rows)}
