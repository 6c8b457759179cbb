"""Presentation order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def presentation_order(
    df: DataFrame, order: Sequence[str], numeric: Sequence[str] = ()
) -> DataFrame:
    """Rows sorted for reading; ``numeric`` columns compare as exact numbers.

    The last sort keys, a hash of the whole row and its input partition, only decide
    between rows that are equal in ``order`` or in everything, so that a large group of
    them is still spread over the tasks.
    """
    keys = [
        (F.col(c).cast("decimal(38,9)") if c in numeric else F.col(c)).asc_nulls_first()
        for c in order
    ]
    placed = df.withColumn("_part", F.spark_partition_id())
    return placed.orderBy(*keys, F.xxhash64(*df.columns), "_part").drop("_part")
