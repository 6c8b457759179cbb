"""Name and identifier rules."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Format suffixes of an asset id, removed one after the other in this order.
FORMAT_SUFFIXES = ("_UHDDV", "_HDSDR", "_UHDSDR", "_UHDHDR")

# A name holding these words in this order marks an asset that must not be used.
RETIRED_NAME_WORDS = ("do", "not", "use")


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def series_name(series: Column | str, asset: Column | str) -> Column:
    """Lower-cased series title, or the lower-cased asset name where there is no series."""
    return F.coalesce(F.lower(as_column(series)), F.lower(as_column(asset)))


def normalize_asset_id(asset_id: Column | str) -> Column:
    """Asset id without its format suffixes (matched case-sensitively, anywhere), lower-cased."""
    stripped = reduce(
        lambda column, suffix: F.replace(column, F.lit(suffix), F.lit("")),
        FORMAT_SUFFIXES,
        as_column(asset_id),
    )
    return F.lower(stripped)


def contains_in_order(text: Column | str, words: tuple[str, ...]) -> Column:
    """True where ``words`` occur one after the other, with anything in between.

    Same answer as ``LIKE '%a%b%c%'``. The atomic groups pin each word to its first
    possible place, so a long text without a match costs one pass instead of the
    backtracking over every pair of places that the LIKE pattern would need.
    """
    pattern = r"(?s)\A" + "".join(f"(?>.*?{re.escape(word)})" for word in words)
    return as_column(text).rlike(pattern)


def usable_name(name: Column | str) -> Column:
    """False for names that say "do not use" in any case or spacing; NULL for a NULL name.

    As a filter, both drop the row.
    """
    return ~contains_in_order(F.lower(as_column(name)), RETIRED_NAME_WORDS)
