"""Ordered groups: terminal rows, the previous value, break intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuebreaks.operators.skew import HOT_BYTES, HOT_ROWS, HotKeys, find_hot
from cuebreaks.sources.staging import Stage

PIECE = "_piece"


def add_terminal_rows(
    df: DataFrame, replace: dict[str, Column], blank: Sequence[str] = ()
) -> DataFrame:
    """Every row, and a copy of it with ``replace`` applied and the ``blank`` columns NULL.

    One pass over the input instead of a union that reads it twice; the other columns
    pass through untouched, so an existing partitioning by them is kept. Follow it with
    ``distinct()`` to keep one terminal row per asset.
    """
    doubled = df.withColumn("_terminal", F.explode(F.array(F.lit(False), F.lit(True))))
    terminal = F.col("_terminal")
    changed = {c: F.when(terminal, new).otherwise(F.col(c)) for c, new in replace.items()}
    blanked = {c: F.when(~terminal, F.col(c)) for c in blank}
    return doubled.withColumns({**changed, **blanked}).drop("_terminal")


def _window(partition: Sequence[str], order: Sequence[str]):
    # Spark's ascending order puts NULL first.
    return Window.partitionBy(*partition).orderBy(*order)


def _in_pieces(
    df: DataFrame, partition: Sequence[str], order: Sequence[str], pieces: int, stage: Stage
) -> DataFrame:
    """Range-partition by group and order, and number the ranges in ``_piece``.

    Written out, because the piece numbers must not change when a task is repeated.
    Ranges cut through groups, and through rows equal in ``order`` by the input partition
    they came from, so no group is ever held by one task.
    """
    ranged = df.withColumn("_part", F.spark_partition_id()).repartitionByRange(
        max(2, pieces), *partition, *order, "_part"
    )
    return stage.write(ranged.drop("_part").withColumn(PIECE, F.spark_partition_id()), "pieces")


def _join_carry(
    df: DataFrame, carry: DataFrame, partition: Sequence[str], stage: Stage
) -> DataFrame:
    """Attach per-piece values; there are at most as many as pieces plus hot groups.

    They are written, so that Spark broadcasts them by their measured size or else joins by piece.
    """
    keys = [*partition, PIECE]
    carry = stage.write(carry, "carry").withColumnsRenamed({c: f"_carry_{c}" for c in keys})
    same = F.col(PIECE) == F.col(f"_carry_{PIECE}")
    for c in partition:
        same = same & F.col(c).eqNullSafe(F.col(f"_carry_{c}"))
    return df.join(carry, same, "left").drop(*[f"_carry_{c}" for c in keys])


def previous_in_order(
    df: DataFrame, value: str, partition: Sequence[str], order: Sequence[str], out: str
) -> DataFrame:
    """``value`` of the previous row of the group, by one window."""
    return df.withColumn(out, F.lag(value).over(_window(partition, order)))


def previous_in_pieces(
    df: DataFrame,
    value: str,
    partition: Sequence[str],
    order: Sequence[str],
    out: str,
    pieces: int,
    stage: Stage | None = None,
) -> DataFrame:
    """Same result for groups too large for one task.

    Each piece of a group takes its lag on its own; the first row of a piece gets the
    last value of the piece before it.
    """
    stage = stage or Stage(df.sparkSession)
    split = _in_pieces(df, partition, order, pieces, stage)
    last = split.groupBy(*partition, PIECE).agg(
        F.max_by(value, F.struct(*order)).alias("_last")
    )
    before = F.lag("_last").over(Window.partitionBy(*partition).orderBy(PIECE))
    carry = last.withColumn("_carry", before).drop("_last")
    local = _window([*partition, PIECE], order)
    ranked = split.withColumn(out, F.lag(value).over(local)).withColumn(
        "_first", F.row_number().over(local) == 1
    )
    joined = _join_carry(ranked, carry, partition, stage)
    return joined.withColumn(
        out, F.when(F.col("_first"), F.col("_carry")).otherwise(F.col(out))
    ).drop(PIECE, "_first", "_carry")


def previous_value(
    df: DataFrame,
    value: str,
    partition: Sequence[str],
    order: Sequence[str],
    out: str,
    hot: HotKeys | int | None = HOT_ROWS,
    stage: Stage | None = None,
    hot_bytes: int = HOT_BYTES,
) -> DataFrame:
    """``value`` of the previous row in ``order`` (ascending, NULL first) within ``partition``.

    ``order`` must rank the rows of a group without ties for a repeatable result. Groups of ``hot`` rows or
    ``hot_bytes`` bytes, whichever is reached first, are ordered in pieces; others need one shuffle.
    """
    hot = find_hot(df, partition, hot, hot_bytes, stage)
    if hot is None:
        return previous_in_order(df, value, partition, order, out)
    ordinary, busy = hot.split(df)
    return previous_in_order(ordinary, value, partition, order, out).unionByName(
        previous_in_pieces(busy, value, partition, order, out, hot.total_pieces, stage)
    )


def interval_since(time: str, previous: str) -> Column:
    """Gap to the previous break, from 0 for the first one, in seconds with two decimals."""
    return F.round(F.col(time) - F.coalesce(F.col(previous), F.lit(0)), 2)


def break_interval(
    df: DataFrame,
    time: str,
    partition: Sequence[str],
    order: Sequence[str],
    previous: str = "Last_contentTimePosition",
    out: str = "Ad_Breaks_Interval",
    hot: HotKeys | int | None = HOT_ROWS,
    stage: Stage | None = None,
    hot_bytes: int = HOT_BYTES,
) -> DataFrame:
    """Attach the previous break's time and the gap since then."""
    lagged = previous_value(df, time, partition, order, previous, hot, stage, hot_bytes)
    return lagged.withColumn(out, interval_since(time, previous))


def numbered_in_order(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[str],
    position: str,
    length: str,
    hot: HotKeys | int | None = HOT_ROWS,
    stage: Stage | None = None,
    hot_bytes: int = HOT_BYTES,
) -> DataFrame:
    """Position 1..n of each row in its group, and the group's size n, both bigint."""
    hot = find_hot(df, partition, hot, hot_bytes, stage)
    ordinary, busy = (df, None) if hot is None else hot.split(df)
    numbered = ordinary.withColumns(
        {
            position: F.row_number().over(_window(partition, order)).cast("bigint"),
            length: F.count(F.lit(1)).over(Window.partitionBy(*partition)),
        }
    )
    if busy is None:
        return numbered
    stage = stage or Stage(df.sparkSession)
    split = _in_pieces(busy, partition, order, hot.total_pieces, stage)
    whole = Window.partitionBy(*partition)
    so_far = whole.orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        split.groupBy(*partition, PIECE)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_carry", F.coalesce(F.sum("_n").over(so_far), F.lit(0)))
        .withColumn(length, F.sum("_n").over(whole))
        .drop("_n")
    )
    local = F.row_number().over(_window([*partition, PIECE], order)).cast("bigint")
    joined = _join_carry(split.withColumn(position, local), carry, partition, stage)
    renumbered = joined.withColumn(position, F.col(position) + F.col("_carry"))
    return numbered.unionByName(renumbered.drop(PIECE, "_carry"))
