"""Small inputs and comparisons shared by the tests."""

from __future__ import annotations

import datetime as dt
from collections import Counter

from cuebreaks.sources.schemas import CORRECTIONS, CUES, METADATA

SMALL = "/root/testdata/sf0.001"
OPEN = dt.datetime(9999, 12, 31, 23, 59, 59)
NEW = dt.datetime(2024, 1, 1)
OLD = dt.datetime(2023, 1, 1)


def bag(df, columns=None):
    """Rows as a multiset, with exact values, independent of row and column order."""
    columns = sorted(columns or df.columns)
    return Counter(tuple(repr(v) for v in row) for row in df.select(*columns).collect())


def cue(**values):
    row = dict.fromkeys(CUES.names)
    row.update(effectiveTo=OPEN, SDPSnapshotUpdateTimestamp=NEW)
    row.update(values)
    return tuple(row[name] for name in CUES.names)


def cue_rows(spark, rows):
    return spark.createDataFrame(rows, CUES)


def correction_rows(spark, rows):
    return spark.createDataFrame(rows, CORRECTIONS)


def metadata_rows(spark, rows):
    return spark.createDataFrame(rows, METADATA)
