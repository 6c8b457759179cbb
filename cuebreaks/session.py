"""Session settings the jobs are meant to run with."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The summary compiles more than the default 100 classes; keep them for the next run.
    "spark.sql.codegen.cache.maxEntries": "2000",
    "spark.ui.enabled": "false",
}


# What a reducer is given to begin with; adaptive execution joins partitions that turn out small.
REDUCER_BYTES = 256 << 20


def shuffle_partitions(input_bytes: int, reducer_bytes: int = REDUCER_BYTES) -> int:
    """Partitions of a shuffle that moves as much as the input: 100 TB make 381,470 of 256 MB.

    Adaptive execution can merge partitions but not cut them, except in joins, so the number must come
    from the largest shuffle, not from Spark's default of 200.
    """
    return max(200, -(-input_bytes // reducer_bytes))


def build_session(
    name: str = "cuebreaks",
    master: str | None = None,
    input_bytes: int | None = None,
    **settings: str,
) -> SparkSession:
    """A session; ``settings`` are further Spark settings, with ``__`` for the dots.

    ``input_bytes``, the size of the largest input in memory, sets the width of shuffles.
    """
    if input_bytes is not None:
        settings = {"spark__sql__shuffle__partitions": str(shuffle_partitions(input_bytes)), **settings}
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    given = {key.replace("__", "."): value for key, value in settings.items()}
    for key, value in {**SETTINGS, **given}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
