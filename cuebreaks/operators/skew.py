"""Hot keys: find them with one pre-aggregated count, then spread their rows.

A key is hot when it holds at least ``hot_rows`` rows or, where groups are ordered, ``hot_bytes`` bytes. No key
above that is left out. Up to ``LISTED`` keys are brought to the driver and broadcast; a longer list, as it may grow
with the data, is written to the shared folder and joined as Spark sees fit.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuebreaks.sources.staging import Stage

HOT_ROWS = 2_000_000
HOT_BYTES = 256 << 20
LISTED = 50_000

# What one task is given of rows that it groups and sorts, and the least that is worth a task of its own.
PART_BYTES = 128 << 20
LEAST_PART_BYTES = 8 << 20

PIECES = "_pieces"
SALT = "_salt"


@dataclass(frozen=True)
class HotKeys:
    """The heaviest keys of a relation and into how many pieces each is to be split."""

    columns: tuple[str, ...]
    keys: DataFrame
    total_pieces: int
    listed: bool = True

    def mark(self, df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
        """``df`` plus ``_pieces`` (and any extra hot-key column), NULL on rows of other keys."""
        columns = list(columns or self.columns)
        renamed = self.keys.withColumnsRenamed({c: f"_hot_{c}" for c in self.columns})
        same = [F.col(c).eqNullSafe(F.col(f"_hot_{h}")) for c, h in zip(columns, self.columns)]
        renamed = F.broadcast(renamed) if self.listed else renamed  # LISTED rows at most
        marked = df.join(renamed, reduce(Column.__and__, same), "left")
        return marked.drop(*[f"_hot_{c}" for c in self.columns])

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows of ordinary keys, rows of hot keys."""
        marked = self.mark(df)
        return (
            marked.filter(F.col(PIECES).isNull()).drop(PIECES),
            marked.filter(F.col(PIECES).isNotNull()).drop(PIECES),
        )


def row_bytes(df: DataFrame) -> Column:
    """About the bytes that a row takes in a shuffle: eight per column and the lengths of what varies."""

    def varying(name: str, kind: str) -> Column:
        value = F.col(name) if kind in ("string", "binary") else F.col(name).cast("string")
        return F.coalesce(F.octet_length(value), F.lit(0)).cast("long")

    wide = ("string", "binary", "array", "map", "struct", "variant")
    lengths = [varying(c, kind) for c, kind in df.dtypes if kind.startswith(wide)]
    return reduce(add, lengths, F.lit(8 * len(df.columns)).cast("long"))


def parts_of(df: DataFrame, copies: int = 1) -> int:
    """Into how many partitions to deal ``df``, each row ``copies`` times, for tasks that hold a part in memory.

    Adaptive execution sizes partitions by what they take compressed, which may be a thirtieth of what they take in
    a task. Bytes are measured row by row instead, by one job. Inputs below ``PART_BYTES`` times the session's shuffle
    partitions are cut finer, down to ``LEAST_PART_BYTES``, to keep all cores busy.
    """
    total = (df.agg(F.sum(row_bytes(df))).first()[0] or 0) * copies
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-total // PART_BYTES), min(usual, -(-total // LEAST_PART_BYTES)))


def hot_keys(
    df: DataFrame,
    columns: Sequence[str],
    hot_rows: int = HOT_ROWS,
    weight: str | None = None,
    hot_bytes: int | None = None,
    stage: Stage | None = None,
) -> HotKeys | None:
    """Keys with at least ``hot_rows`` rows (or summed ``weight``) or ``hot_bytes`` bytes; None when there are none.

    A key gets as many pieces as keep each below both. Runs one job that counts with map-side partial
    aggregation; bytes are measured row by row.
    """
    copies = F.col(weight) if weight else F.lit(1)
    pieces = [F.sum(copies) / hot_rows]
    if hot_bytes:
        pieces.append(F.sum(row_bytes(df) * copies) / hot_bytes)
    heaviest = (
        df.groupBy(*columns)
        .agg(reduce(F.greatest, pieces).alias("_shares"))
        .filter("_shares >= 1")
        .select(*columns, F.ceil("_shares").cast("int").alias(PIECES))
    )
    found = heaviest.limit(LISTED + 1).toArrow()
    if not found.num_rows:
        return None
    if found.num_rows > LISTED:
        keys = (stage or Stage(df.sparkSession)).write(heaviest, "hot-keys")
        return HotKeys(tuple(columns), keys, keys.agg(F.sum(PIECES)).first()[0], listed=False)
    keys = df.sparkSession.createDataFrame(found, heaviest.schema)
    return HotKeys(tuple(columns), keys, sum(found.column(PIECES).to_pylist()))


def find_hot(
    df: DataFrame,
    columns: Sequence[str],
    hot: HotKeys | int | None,
    hot_bytes: int | None = None,
    stage: Stage | None = None,
) -> HotKeys | None:
    """``hot`` as the operators take it: a row threshold to search with, keys found before, or None."""
    return hot_keys(df, columns, hot, None, hot_bytes, stage) if isinstance(hot, int) else hot


def spread(marked: DataFrame) -> DataFrame:
    """Replace ``_pieces`` by ``_salt``: 0 for ordinary rows, 0.._pieces-1 for hot ones.

    The input partition takes part in the hash, so even a group of identical rows spreads.
    """
    columns = [c for c in marked.columns if c != PIECES]
    drawn = F.pmod(F.xxhash64(F.spark_partition_id(), *columns), F.col(PIECES)).cast("int")
    return marked.withColumn(SALT, F.coalesce(drawn, F.lit(0))).drop(PIECES)


def join_on(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    how: str = "left",
    hot: HotKeys | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Equi-join on (left column, right column) pairs; the right key columns are dropped.

    Whether the right side is broadcast is Spark's choice, from measured sizes. If it is
    shuffled instead, rows of the ``hot`` left keys are salted and the matching right
    rows repeated once per piece. Count ``hot`` on ``left`` by the join's own columns: then
    the repeated rows are few against the rows the join returns.
    """
    pairs = dict(on)
    right = right.withColumnsRenamed({r: f"_on_{r}" for r in pairs.values()})
    if hot is not None:
        left = spread(hot.mark(left))
        copies = F.sequence(F.lit(0), F.coalesce(F.col(PIECES), F.lit(1)) - 1)
        right = (
            hot.mark(right, [f"_on_{pairs[c]}" for c in hot.columns])
            .withColumn("_on_salt", F.explode(copies))
            .drop(PIECES)
        )
    test = Column.eqNullSafe if null_safe else Column.__eq__
    tests = [test(F.col(a), F.col(f"_on_{b}")) for a, b in on]
    if hot is not None:
        tests.append(F.col(SALT) == F.col("_on_salt"))
    joined = left.join(right, reduce(Column.__and__, tests), how)
    return joined.drop(SALT, "_on_salt", *[f"_on_{b}" for b in pairs.values()])
