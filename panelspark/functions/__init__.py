from panelspark.functions.columns import (  # noqa: F401
    conditional,
    duration_minutes,
    per_unit,
    recode,
    row_sum,
    safe_pct,
    strict_sum,
    strip_slashes,
    strip_suffix,
    sum_or_zero,
)
