"""Column expressions (no jobs, no UDFs)."""

from ecospark.functions.dates import block_week, parse_dmy
from ecospark.functions.nulls import any_missing, distinct_with_null, fold_missing, is_in, is_missing, missing_count, not_in
from ecospark.functions.numeric import count_cell, european_double, lenient_double
from ecospark.functions.rules import (as_level, first_match, level_index, override, recode,
                                      regex_category, threshold_fill)
from ecospark.functions.strings import (detect, extract_first, nth_piece, remove_first, replace_all,
                                        replace_first, rtrim_unicode)

__all__ = [
    "block_week", "parse_dmy", "any_missing", "distinct_with_null", "is_in", "missing_count", "not_in", "is_missing", "fold_missing",
    "count_cell",
    "european_double", "lenient_double", "as_level", "first_match", "level_index", "override", "recode",
    "regex_category", "threshold_fill", "detect", "extract_first", "nth_piece", "remove_first", "replace_all",
    "replace_first", "rtrim_unicode",
]
