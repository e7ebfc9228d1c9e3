"""Column expressions (all built-in, JVM-side)."""

from policypanel.functions.columns import (
    as_col,
    clean_int,
    date_from_parts,
    era,
    event_date,
    flag,
    is_missing_token,
    is_present,
    month_key,
    normalise_key,
    null_if_equal,
    null_outside,
    pct_change,
    per_scale,
    safe_ratio,
)

__all__ = [
    "as_col", "clean_int", "date_from_parts", "era", "event_date", "flag",
    "is_missing_token", "is_present", "month_key", "normalise_key", "null_if_equal",
    "null_outside", "pct_change", "per_scale", "safe_ratio",
]
