"""Column-level rules: every function takes Columns (or names) and returns a Column."""

from cuebreaks.functions.dates import run_date_stamp
from cuebreaks.functions.grading import (
    ad_grade,
    ad_spec,
    content_type,
    cue_label,
    duration_band,
)
from cuebreaks.functions.measures import (
    break_fraction,
    break_minutes,
    content_segments,
    content_segments_fraction,
    decimal_quotient,
    duration_minutes,
    one_more_multiplier,
    spec_multiplier,
    whole_number,
    zero_fill,
)
from cuebreaks.functions.text import (
    contains_in_order,
    normalize_asset_id,
    series_name,
    usable_name,
)

__all__ = [
    "ad_grade",
    "ad_spec",
    "break_fraction",
    "break_minutes",
    "contains_in_order",
    "content_segments",
    "content_segments_fraction",
    "content_type",
    "cue_label",
    "decimal_quotient",
    "duration_band",
    "duration_minutes",
    "normalize_asset_id",
    "one_more_multiplier",
    "run_date_stamp",
    "series_name",
    "spec_multiplier",
    "usable_name",
    "whole_number",
    "zero_fill",
]
