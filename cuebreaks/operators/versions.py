"""Current versions, duplicates and the latest snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuebreaks.operators.skew import join_on

# Fixed value: versions that are still open end in this year.
OPEN_FROM = "9999-01-01 00:00:00"


def open_records(df: DataFrame, valid_to: str) -> DataFrame:
    """Rows whose validity is open-ended.

    A plain comparison instead of ``year(...) = 9999``, so that it reaches the file scan.
    """
    kind = dict(df.dtypes)[valid_to]
    return df.filter(F.col(valid_to) >= F.lit(OPEN_FROM).cast(kind))


def dedup_full_row(df: DataFrame) -> DataFrame:
    """One row of each group of identical rows; copies are combined before the shuffle."""
    return df.distinct()


def distinct_rows(df: DataFrame) -> DataFrame:
    """One row of each group of identical rows, dealt by the whole row.

    For the result of a join: a plain ``distinct()`` keeps to the join's partitioning by its key, so one task
    would get all rows of a hot key, and adaptive execution could not split the join. Whole rows need an exchange
    of their own; copies are combined before it.
    """
    whole = df.select(F.struct(*df.columns).alias("_row")).distinct()
    return whole.select([F.col(f"_row.{c}").alias(c) for c in df.columns])


def prune_then_dedup(df: DataFrame, drop: Sequence[str]) -> DataFrame:
    """Drop columns, then remove the rows that no longer differ."""
    return df.drop(*drop).distinct()


def current_versions(df: DataFrame, valid_to: str, keep: Sequence[str] | None = None) -> DataFrame:
    """Distinct open records; ``keep`` projects first, so the scan reads those columns only."""
    current = open_records(df, valid_to)
    return (current.select(*keep) if keep else current).distinct()


def latest_snapshot(df: DataFrame, keys: Sequence[str], snapshot: str) -> DataFrame:
    """All rows tied at the newest ``snapshot`` of their key; NULL keys form a key of their own.

    A snapshot of NULL is older than any other. The newest snapshot of each key is a maximum, merged before it
    moves; the rows that have it are then found by a semi join, in which adaptive execution splits a hot
    key as it does any join's. Nothing is ranked in one task and nothing about keys passes the driver unless
    Spark finds the maxima small enough to broadcast.
    """
    newest = df.groupBy(*keys).agg(F.max(snapshot).alias("_newest"))
    on = [*[(k, k) for k in keys], (snapshot, "_newest")]
    return join_on(df, newest, on, "left_semi", null_safe=True)
