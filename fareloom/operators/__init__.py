from fareloom.operators.aggregates import (
    aggregate_by_time,
    aggregate_by_zone,
    borough_rollup,
    distance_efficiency,
    feed_distribution,
    fleet_kpis,
    hourly_pattern,
    join_pickup_zone,
    monthly_trend,
    payment_analysis,
    popular_pairs,
    revenue_by_feed,
    revenue_per_trip,
    revenue_share,
    top_k,
    top_zones,
    trips_per_hour,
    weekend_pattern,
)
from fareloom.operators.cleaning import (
    clean_trips,
    cleaning_audit,
    drop_duplicates,
    rejected_trips,
    rule_failures,
)
from fareloom.operators.features import add_derived_features
from fareloom.operators.feeds import (
    add_metadata_columns,
    column_overlap,
    combine_feeds,
    standardize_column_names,
)
from fareloom.operators.outliers import bounds_table, fit_bounds, outlier_audit, remove_outliers
from fareloom.operators.quality import (
    duplicate_profile,
    invalid_values,
    layer_reduction,
    null_profile,
    null_summary,
    quality_report,
    row_counts,
)
from fareloom.operators.quantiles import exact_quantiles
from fareloom.operators.ratios import hit_rate, inside_circle
from fareloom.operators.statistics import (
    busiest,
    date_range,
    describe_numeric,
    summary_statistics,
    summary_totals,
    table_shape,
)
from fareloom.operators.text import top_words, word_count, word_totals, words

__all__ = [
    "add_derived_features",
    "add_metadata_columns",
    "aggregate_by_time",
    "aggregate_by_zone",
    "borough_rollup",
    "bounds_table",
    "busiest",
    "clean_trips",
    "cleaning_audit",
    "column_overlap",
    "combine_feeds",
    "date_range",
    "describe_numeric",
    "distance_efficiency",
    "drop_duplicates",
    "duplicate_profile",
    "exact_quantiles",
    "feed_distribution",
    "fit_bounds",
    "fleet_kpis",
    "hit_rate",
    "hourly_pattern",
    "inside_circle",
    "invalid_values",
    "join_pickup_zone",
    "layer_reduction",
    "monthly_trend",
    "null_profile",
    "null_summary",
    "outlier_audit",
    "payment_analysis",
    "popular_pairs",
    "quality_report",
    "rejected_trips",
    "remove_outliers",
    "revenue_by_feed",
    "revenue_per_trip",
    "revenue_share",
    "row_counts",
    "rule_failures",
    "standardize_column_names",
    "summary_statistics",
    "summary_totals",
    "table_shape",
    "top_k",
    "top_words",
    "top_zones",
    "trips_per_hour",
    "weekend_pattern",
    "word_count",
    "word_totals",
    "words",
]
