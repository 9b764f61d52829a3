from lakestrata.operators.aggregates import distinct_values, ordered_concat, pivot_count, segment_tallies
from lakestrata.operators.arrays import array_columns, explode_array, split_arrays
from lakestrata.operators.columns import (
    all_null_columns,
    drop_all_null,
    drop_by_pattern,
    null_profile,
    useless_columns,
)
from lakestrata.operators.contract import conform, contract_of, load_contracts, save_contracts, widen
from lakestrata.operators.flatten import flatten_all, flatten_once, has_struct, struct_children

__all__ = [
    "all_null_columns",
    "array_columns",
    "conform",
    "contract_of",
    "distinct_values",
    "drop_all_null",
    "drop_by_pattern",
    "explode_array",
    "flatten_all",
    "flatten_once",
    "has_struct",
    "load_contracts",
    "null_profile",
    "ordered_concat",
    "pivot_count",
    "save_contracts",
    "segment_tallies",
    "split_arrays",
    "struct_children",
    "useless_columns",
    "widen",
]
