from pulse.operators.access import (
    first_where, flag_owner, keep_members, member_counts, pivot_values, split_counts, sum_where,
)
from pulse.operators.classify import class_ladder
from pulse.operators.compare import (
    compare_columns, read_any, row_diff, schema_diff, schema_rows, shape,
)
from pulse.operators.enrich import attach_many, cover, lookup, require, require_chain
from pulse.operators.labels import translate_labels
from pulse.operators.latest import first_per_key
from pulse.operators.links import link_state, link_status, open_links
from pulse.operators.profile import (
    column_profile, column_values, observed, profile_rows, require_rows, sample_per_key,
    sample_rows, value_counts,
)
from pulse.operators.recency import recency_flag, recent, recent_distinct
from pulse.operators.rollups import (
    attach_metrics, conditional_counts, distinct_by, distinct_split,
)

__all__ = [
    "attach_many", "attach_metrics", "class_ladder", "column_profile", "column_values",
    "compare_columns", "conditional_counts", "cover", "distinct_by", "distinct_split",
    "first_per_key", "first_where", "flag_owner", "keep_members", "link_state", "link_status",
    "lookup", "member_counts", "observed", "open_links", "pivot_values", "profile_rows",
    "read_any", "recency_flag", "recent", "recent_distinct", "require", "require_chain",
    "require_rows", "row_diff", "sample_per_key", "sample_rows", "schema_diff", "schema_rows",
    "shape", "split_counts", "sum_where", "translate_labels", "value_counts",
]
