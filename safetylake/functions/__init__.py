"""Column-level helpers; all return built-in Spark expressions (no UDFs)."""

from safetylake.functions.scalar import (  # noqa: F401
    first_element,
    literal_contains,
    like_pattern,
    parse_date,
    parse_int,
    size0,
    upper_trim,
)
