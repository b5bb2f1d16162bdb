"""DataFrame -> DataFrame operators."""

from ecospark.operators.aggregates import (frequency_table, missing_by_group, missing_patterns,
                                           missing_share, with_missing_count)
from ecospark.operators.columns import (cast_by_type, cast_matching, clean_columns, clean_name, clean_names,
                                        drop_matching, matching, null_column, ordinal_names, rename_ordinal,
                                        reorder_first, select_matching, select_ordinal, select_renamed)
from ecospark.operators.distinct import distinct_counts
from ecospark.operators.filters import (drop_na, drop_na_except, filter_in, filter_not_in, keep_any_missing,
                                        keep_flag)
from ecospark.operators.joins import (common_keys, full_join, join, join_stored, left_join, mark_join, natural_join,
                                      null_key_report, null_safe_key, patch, patch_chain, unique_by)
from ecospark.operators.reshape import explode_wide, pivot_fixed, separate, unpivot_columns
from ecospark.operators.setops import bind_rows
from ecospark.operators.windows import fill, fill_window, first_per_group, with_group_extremes

__all__ = [name for name in dir() if not name.startswith("_")]
