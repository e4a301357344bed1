"""Column-level functions: projections, scalar formatting, predicates."""

from lodestone.functions.columns import (
    drop_cols, drop_strict, identity, conform, split_xy, scale,
    class_probability, strip_ws, format_metric, format_name, decode_label,
)
from lodestone.functions.predicates import (
    cells_contain, notebook_contains, cells_contain_grouped, search, succeeded,
    not_downloaded, pandas_unknown, pending_run, PANDAS_TERMS,
)
