"""DataFrame -> DataFrame operators (cleaning, profiling, pre/post, DiD)."""

from policypanel.operators.aggregate import collapse_by_era, collapse_by_key, unpivot_periods, years_from_masks
from policypanel.operators.clean import (
    clean_events,
    clean_events_wide,
    clean_panel,
    clean_panel_observed,
    drop_blank,
    drop_missing,
    null_ranges,
    null_sentinels,
    prepare_events,
    snake_case_columns,
    zero_fill,
)
from policypanel.operators.did import (
    did_estimate,
    did_flags,
    did_summary,
    label_units,
    unit_era,
    unit_filter,
    unit_panel,
)
from policypanel.operators.joins import join_small
from policypanel.operators.prepost import (
    annualise,
    missing_share,
    period_summary,
    pre_post_change,
    pre_post_summary,
    segment_pre_post,
    tag_era,
    topk_shift,
    window_rate,
    years_per_era,
)
from policypanel.operators.profiling import (
    describe_numeric,
    distinct_counts,
    distinct_values,
    frequent_modes,
    frequent_values,
    key_counts_lexical,
    length_stats,
    modes,
    null_counts,
    profile,
    range_stats,
    row_audit,
    summary_stats,
    value_counts,
)
from policypanel.operators.ranks import exact_quantiles
from policypanel.operators.sketches import (
    distinct_sets,
    distinct_sketches,
    quantile_sketches,
    window_quantiles,
)

__all__ = [
    "annualise", "clean_events", "clean_events_wide", "clean_panel", "clean_panel_observed",
    "collapse_by_era", "collapse_by_key", "describe_numeric", "did_estimate", "did_flags",
    "did_summary", "distinct_counts", "distinct_sets", "distinct_sketches", "distinct_values",
    "drop_blank", "drop_missing", "exact_quantiles", "frequent_modes", "frequent_values",
    "join_small", "key_counts_lexical", "label_units", "length_stats", "missing_share", "modes",
    "null_counts", "null_ranges", "null_sentinels", "period_summary", "pre_post_change",
    "pre_post_summary", "prepare_events", "profile", "quantile_sketches", "range_stats",
    "row_audit", "segment_pre_post", "snake_case_columns", "summary_stats", "tag_era",
    "topk_shift", "unit_era", "unit_filter", "unit_panel", "unpivot_periods", "value_counts",
    "window_quantiles", "window_rate", "years_from_masks", "years_per_era", "zero_fill",
]
