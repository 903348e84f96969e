"""Column expressions, predicates and fixed values."""

from starmart.functions.columns import (
    age_at_year,
    cast_int,
    decode,
    epoch_day_to_date,
    epoch_day_to_date_or_marker,
    fill_missing,
    parse_date,
    split_after_first,
    split_coordinates,
    strip_upper,
    strip_whitespace,
    text_length,
    upper_trim,
)
from starmart.functions.predicates import (
    contains_upper,
    date_after,
    is_in,
    is_missing,
    length_eq,
    not_in,
    not_in_keep_null,
)

__all__ = [
    "age_at_year", "cast_int", "decode", "epoch_day_to_date", "epoch_day_to_date_or_marker",
    "fill_missing", "parse_date", "split_after_first", "split_coordinates", "strip_upper",
    "strip_whitespace", "text_length", "upper_trim",
    "contains_upper", "date_after", "is_in", "is_missing", "length_eq", "not_in", "not_in_keep_null",
]
