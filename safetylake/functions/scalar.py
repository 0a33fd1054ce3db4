"""Scalar column functions used by the cleaning and query stages.

All of them compile to JVM expressions inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_FORMAT = "yyyyMMdd"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def upper_trim(c: str | Column) -> Column:
    """``upper(trim(c))``; trim removes spaces only, tabs stay."""
    return F.upper(F.trim(_col(c)))


def parse_date(c: str | Column, strict: bool = False) -> Column:
    """Parse a ``yyyyMMdd`` string to DATE.

    Tolerant by default: blank or impossible dates become NULL instead of
    failing the whole dataset. ``strict=True`` raises on bad input (ANSI).
    """
    return F.to_date(_col(c), DATE_FORMAT) if strict else F.try_to_date(_col(c), DATE_FORMAT)


def parse_int(c: str | Column, strict: bool = False) -> Column:
    """Cast a string to INT; ``'1.5'``, ``'abc'`` and ``''`` become NULL unless strict."""
    return _col(c).cast("int") if strict else _col(c).try_cast("int")


def size0(c: str | Column) -> Column:
    """Array length with NULL counted as 0, whatever the session's ANSI or
    legacy ``sizeOfNull`` settings (which would otherwise give NULL or -1)."""
    c = _col(c)
    return F.coalesce(F.when(c.isNotNull(), F.size(c)), F.lit(0))


def first_element(c: str | Column) -> Column:
    """Element 0 of an array; NULL for both a NULL and an empty array."""
    return F.get(_col(c), 0)


def literal_contains(columns: list[str], term: str) -> Column:
    """Case-insensitive literal substring match, OR-ed over ``columns``.

    ``%``, ``_``, quotes and backslashes in ``term`` are ordinary characters.
    A NULL column value simply does not match.
    """
    needle = F.lower(F.lit(term))       # lowered by the engine, as the columns are
    cond = None
    for name in columns:
        hit = F.coalesce(F.lower(F.col(name)).contains(needle), F.lit(False))
        cond = hit if cond is None else (cond | hit)
    return cond


def like_pattern(term: str) -> str:
    """``%term%`` for ``Column.like`` keeping ``%`` and ``_`` as wildcards.

    Backslash is LIKE's escape character, so it is doubled to stay literal.
    """
    return "%" + term.lower().replace("\\", "\\\\") + "%"
