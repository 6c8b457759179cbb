"""DataFrame operators; they take column names, so they run on any table."""

from cuebreaks.operators.fill import (
    attach_fallback,
    fill_from_fallback,
    group_fallback,
    group_fallback_fill,
)
from cuebreaks.operators.intervals import (
    add_terminal_rows,
    break_interval,
    interval_since,
    numbered_in_order,
    previous_in_order,
    previous_in_pieces,
    previous_value,
)
from cuebreaks.operators.lookups import (
    group_max,
    group_max_join_back,
    label_override,
    metadata_join,
    next_position_lookup,
    series_semi_join,
    terminal_position_lookup,
    terminal_quotients,
    title_lookup,
)
from cuebreaks.operators.ordering import presentation_order
from cuebreaks.operators.skew import HotKeys, find_hot, hot_keys, join_on, spread
from cuebreaks.operators.versions import (
    current_versions,
    dedup_full_row,
    distinct_rows,
    latest_snapshot,
    open_records,
    prune_then_dedup,
)

__all__ = [
    "HotKeys",
    "add_terminal_rows",
    "attach_fallback",
    "break_interval",
    "current_versions",
    "dedup_full_row",
    "distinct_rows",
    "fill_from_fallback",
    "find_hot",
    "group_fallback",
    "group_fallback_fill",
    "group_max",
    "group_max_join_back",
    "hot_keys",
    "interval_since",
    "join_on",
    "label_override",
    "latest_snapshot",
    "metadata_join",
    "next_position_lookup",
    "numbered_in_order",
    "open_records",
    "presentation_order",
    "previous_in_order",
    "previous_in_pieces",
    "previous_value",
    "prune_then_dedup",
    "series_semi_join",
    "spread",
    "terminal_position_lookup",
    "terminal_quotients",
    "title_lookup",
]
