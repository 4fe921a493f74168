"""DataFrame-in, DataFrame-out operators."""

from martkit.operators.aggregates import (
    group_ordered_text, group_ordered_texts, ordered_text_agg, sum_nonzero,
)
from martkit.operators.joins import (
    allow_list_flag, best_row_per_key, count_per_key, left_join_distinct, left_lookup,
    listed_flag, require_unique, semi_by_keys, tiered_lookup,
)
from martkit.operators.shape import (
    as_view, clean_column_names, clean_name, flatten_structs, stamp_load_date,
    strict_select, unpivot_columns, with_literals,
)
from martkit.operators.upsert import upsert, write_merged

__all__ = [
    "group_ordered_text", "group_ordered_texts", "ordered_text_agg", "sum_nonzero", "allow_list_flag",
    "best_row_per_key", "count_per_key", "left_join_distinct", "left_lookup",
    "listed_flag", "require_unique", "semi_by_keys", "tiered_lookup",
    "as_view", "clean_column_names", "clean_name", "flatten_structs",
    "stamp_load_date", "strict_select", "unpivot_columns", "with_literals",
    "upsert", "write_merged",
]
