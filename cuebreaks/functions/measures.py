"""Numeric rules: zero fill, safe casts, break positions and multipliers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cuebreaks.functions.text import as_column


def zero_fill(value: Column | str) -> Column:
    return F.coalesce(as_column(value), F.lit(0))


def whole_number(value: Column | str) -> Column:
    """Nearest whole number (halves away from zero); NULL where it does not fit a bigint.

    Spark's own cast would cut the fraction off.
    """
    return F.round(as_column(value)).try_cast("bigint")


def duration_minutes(seconds: Column | str) -> Column:
    return F.round(as_column(seconds).try_cast("double") / 60, 2)


def break_minutes(time: Column | str) -> Column:
    """Position of a break in minutes, 0 when unknown."""
    return zero_fill(as_column(time).try_cast("double") / 60)


def break_fraction(time: Column | str, duration: Column | str) -> Column:
    """Position of a break as a share of the duration, 0 when unknown or the duration is 0."""
    return zero_fill(
        F.try_divide(as_column(time).try_cast("double"), as_column(duration).try_cast("double"))
    )


def content_segments(
    length: Column | str, time: Column | str, duration: Column | str
) -> Column:
    """Content left after a break, in minutes.

    Without a cue count (NULL ``length``) it is the whole duration, in *seconds*: the
    mixed unit is part of the defined result and feeds the same maximum.
    """
    total = as_column(duration).try_cast("double")
    left = total - as_column(time).try_cast("double")
    return F.when(as_column(length).isNull(), total).otherwise(left / 60)


def content_segments_fraction(
    length: Column | str, time: Column | str, duration: Column | str
) -> Column:
    """Content left after a break as a share of the duration; seconds for a NULL ``length``."""
    total = as_column(duration).try_cast("double")
    left = total - as_column(time).try_cast("double")
    return F.when(as_column(length).isNull(), total).otherwise(F.try_divide(left, total))


def decimal_quotient(numerator: Column | str, denominator: Column | str) -> Column:
    """Exact quotient of two whole numbers with nine decimals, NULL for a zero denominator.

    The operands are decimal(20,0), which holds any bigint and leaves the quotient 18
    decimals; dividing decimal(38,9) by decimal(38,9) would leave only six.
    """
    quotient = F.try_divide(
        as_column(numerator).cast("decimal(20,0)"), as_column(denominator).cast("decimal(20,0)")
    )
    return quotient.cast("decimal(38,9)")


def spec_multiplier(spec: Column | str, length: Column | str) -> Column:
    return decimal_quotient(spec, length)


def one_more_multiplier(length: Column | str) -> Column:
    return decimal_quotient(as_column(length) + 1, length)
