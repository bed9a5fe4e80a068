"""DataFrame-in, DataFrame-out operators; keys and columns are arguments."""

from daybook.operators.conform import SchemaMismatch, conform
from daybook.operators.filters import (
    exclude_flagged,
    filter_between,
    keep_positive,
    require_not_null,
)
from daybook.operators.joins import (
    attach_rollup,
    enrich_left,
    enrich_left_spread,
    lookup_groups,
    usable_lookup,
)
from daybook.operators.ranking import keep_latest, rank_latest
from daybook.operators.rollups import (
    daily_activity,
    event_rollup,
    most_common_values,
    purchase_rollup,
)

__all__ = [
    "SchemaMismatch",
    "attach_rollup",
    "conform",
    "daily_activity",
    "enrich_left",
    "enrich_left_spread",
    "event_rollup",
    "exclude_flagged",
    "filter_between",
    "keep_latest",
    "keep_positive",
    "lookup_groups",
    "most_common_values",
    "purchase_rollup",
    "rank_latest",
    "require_not_null",
    "usable_lookup",
]
