"""``DataFrame → DataFrame`` operators: filters, joins, aggregates, profiles, checks."""

from starmart.operators.aggregates import (
    category_percent,
    count_distinct,
    count_distinct_pair,
    count_where,
    distinct_expression,
    distinct_rows_count,
    group_avg,
    group_by_expression,
    group_count,
    group_count_drop_null,
    group_count_multi,
    group_count_ordered,
    group_count_where,
    min_max,
    row_count,
    select_distinct,
)
from starmart.operators.duplicates import duplicate_key_counts, duplicate_rows, first_rows
from starmart.operators.filters import (
    count_marker,
    filter_and,
    filter_column_compare,
    filter_contains,
    filter_date_after,
    filter_in,
    filter_is_null,
    filter_length_eq,
    filter_not_in,
    filter_not_in_keep_null,
    filter_not_null,
    filter_number_eq,
    filter_range_ge,
    filter_text_eq,
)
from starmart.operators.joins import (
    bounded_broadcast,
    distinct_pair_join,
    fits_broadcast,
    fits_broadcast_all,
    in_subquery,
    lookup_join,
    salted_join,
)
from starmart.operators.profile import null_percent, null_profile, schema_report, table_stats
from starmart.operators.projections import (
    add_column,
    add_columns,
    insert_columns,
    limit_rows,
    order_by,
    preview,
    project_rename,
    qualified_star,
)
from starmart.operators.quality import (
    check_age_consistency,
    check_all,
    check_date_order,
    check_key_coverage,
    check_nulls,
    check_row_count,
    check_table_verdict,
    check_unique_key,
    date_order_violations,
)
from starmart.operators.windows import window_avg_distinct, with_group_avg
