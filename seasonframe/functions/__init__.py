from seasonframe.functions.exprs import (
    SortKey,
    as_names,
    decimal_places,
    exact_ratio,
    guarded_corr,
    integer_ratio,
    join_on_same,
    left_join_many,
    require_columns,
    row_differs,
    sort_keys,
)

__all__ = [
    "SortKey",
    "as_names",
    "decimal_places",
    "exact_ratio",
    "guarded_corr",
    "integer_ratio",
    "join_on_same",
    "left_join_many",
    "require_columns",
    "row_differs",
    "sort_keys",
]
