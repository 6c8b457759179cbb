"""Backfill of missing attributes from other rows of the same group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuebreaks.operators.skew import HOT_ROWS, HotKeys, find_hot, join_on

FALLBACK_PREFIX = "_fallback_"


def group_fallback(
    df: DataFrame, group: str, columns: Sequence[str], eligible: Column
) -> DataFrame:
    """One donor row per group in need: the smallest value of each column on its own.

    A group is in need if an eligible row lacks all the columns; donors are rows that
    have them all. Both are first reduced to their distinct values, so only those are
    sorted and shuffled, not the rows.
    """
    lacks_all = reduce(Column.__and__, [F.col(c).isNull() for c in columns])
    has_all = reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])
    needs = lacks_all & F.coalesce(eligible, F.lit(False))
    facts = df.filter(F.col(group).isNotNull() & (needs | has_all))
    return (
        facts.select(group, *columns, needs.alias("_needs"))
        .distinct()
        .groupBy(group)
        .agg(
            F.max("_needs").alias("_needs"),
            *[F.min(c).alias(f"{FALLBACK_PREFIX}{c}") for c in columns],
        )
        .filter(F.col("_needs") & F.col(f"{FALLBACK_PREFIX}{columns[0]}").isNotNull())
        .drop("_needs")
    )


def fill_from_fallback(df: DataFrame, columns: Sequence[str], eligible: Column) -> DataFrame:
    """Fill each missing column on its own from its fallback column, on eligible rows only."""
    filled = {
        c: F.when(F.col(c).isNull() & eligible, F.col(f"{FALLBACK_PREFIX}{c}")).otherwise(F.col(c))
        for c in columns
    }
    return df.withColumns(filled).drop(*[f"{FALLBACK_PREFIX}{c}" for c in columns])


def attach_fallback(
    df: DataFrame,
    group: str,
    columns: Sequence[str],
    eligible: Column,
    hot: HotKeys | None = None,
) -> DataFrame:
    """``df`` with its group's fallback columns; the number of rows does not change."""
    fallback = group_fallback(df, group, columns, eligible)
    return join_on(df, fallback, [(group, group)], hot=hot)


def group_fallback_fill(
    df: DataFrame,
    group: str,
    columns: Sequence[str],
    eligible: Column,
    hot: HotKeys | int | None = HOT_ROWS,
) -> DataFrame:
    """Backfill ``columns`` of eligible rows from their group."""
    attached = attach_fallback(df, group, columns, eligible, find_hot(df, [group], hot))
    return fill_from_fallback(attached, columns, eligible)
