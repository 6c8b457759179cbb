"""Shape of the physical plans."""

import contextlib
import datetime as dt
import importlib
import io
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cuebreaks import cue_summary
from cuebreaks import operators as ops
from cuebreaks.catalog import QUERIES
from cuebreaks.operators import skew
from cuebreaks.plans.cue_summary import current_cues
from cuebreaks.sources import Stage
from cuebreaks.sources.derived import CueInputs, cue_inputs
from helpers import SMALL, bag


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def tree(df):
    return plan(df).split("\n\n")[0]


@pytest.fixture(scope="module")
def inputs(spark):
    return cue_inputs(spark, SMALL)


def test_scan_reads_needed_columns_and_gets_the_filter(inputs):
    text = plan(current_cues(inputs.cues, inputs.corrections))
    assert "GreaterThanOrEqual(effectiveTo,9999-01-01T00:00)" in text
    assert "createdAt" not in text and "agingDate" not in text


def test_newest_snapshots_are_merged_before_they_move(inputs):
    text = tree(current_cues(inputs.cues, inputs.corrections))
    # No group is ranked: one exchange of partial maxima, one of rows to remove duplicates.
    assert "Window" not in text
    assert text.count("Exchange") - text.count("BroadcastExchange") == 2


def test_newest_snapshot_of_a_hot_episode_is_split(spark, shuffled_joins):
    n = F.col("id")
    cues = spark.range(0, 200_000, 1, 8).select(
        F.when(n % 2 == 0, F.lit(None)).otherwise(n % 5000).alias("k"), F.lit(1).alias("at"), n.cast("string").alias("v")
    )
    found = ops.latest_snapshot(cues, ["k"], "at")
    assert len(found.collect()) == 200_000
    assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()


def test_summary_ends_with_one_shuffle(inputs):
    text = tree(cue_summary(*inputs, "exact", dt.date(2024, 1, 2)))
    assert text.count("Scan parquet") == 1
    assert text.count("Exchange") - text.count("BroadcastExchange") == 1
    assert text.count("Window") == 1 and text.count("Generate") == 1


def test_without_broadcast_no_relation_has_a_nested_loop(spark, inputs):
    texts = []

    class Recorder(Stage):
        def write(self, df, name):
            texts.append(tree(df))
            return super().write(df, name)

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        date = dt.date(2024, 1, 2)
        texts.append(tree(cue_summary(*inputs, "exact", date, Recorder(spark), hot_rows=30)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    whole = "".join(texts)
    assert "SortMergeJoin" in whole and len(texts) >= 7
    assert "NestedLoop" not in whole and "CartesianProduct" not in whole


def test_terminal_rows_need_one_scan(inputs):
    doubled = ops.add_terminal_rows(inputs.cues, {}, ["createdAt"])
    assert tree(doubled).count("Scan parquet") == 1


@pytest.mark.parametrize("name", QUERIES)
def test_no_python_and_no_cross_join(spark, name):
    text = tree(QUERIES[name](spark, SMALL))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


@pytest.fixture
def shuffled_joins(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


def test_search_for_terminal_rows_splits_a_hot_asset(spark, shuffled_joins, monkeypatch):
    plan_of = importlib.import_module("cuebreaks.plans.cue_summary")
    n = F.col("id")
    cues = spark.range(0, 200_000, 1, 8).select(
        F.when(n % 2 == 0, "hot").otherwise(n.cast("string")).alias(plan_of.ASSET),
        F.when(n % 2 == 0, 0).otherwise(n % 7).alias("cuePointPosition"),
        F.lit(0).cast("long").alias("_length"),
        n.cast("double").alias("assetDuration"),
    )
    asked = cues.select(plan_of.ASSET, "_length").distinct()
    finals = {}

    class Recorder(Stage):
        def write(self, df, name):
            df.collect()
            finals[name] = df._jdf.queryExecution().executedPlan().toString()
            return super().write(df, name)

    metadata = spark.createDataFrame([("hot", "Drama")], "ContentID string, Primary_Genre string")
    plan_of._terminals(cues, asked, metadata, "exact", Recorder(spark))
    assert "skew=true" in finals["terminal-cues"]


@pytest.mark.parametrize("name", ["ad_spec", "ad_grade", "terminal_position_lookup", "group_fallback_fill"])
def test_duplicate_removal_after_the_metadata_join_splits_a_hot_asset(spark, shuffled_joins, monkeypatch, name):
    n = F.col("id")
    cues = spark.range(0, 120_000, 1, 8).select(
        F.lit("Show").alias("seriesTitle"),
        F.when(n % 2 == 0, "AST_HDSDR").otherwise(F.concat(F.lit("x"), n)).alias("assetExternalID"),
        F.concat(F.lit("Title "), n).alias("assetName"),
        n.cast("double").alias("assetDuration"),
        (n % 9).alias("cuePointLength"),
        n.alias("cuePointPosition"),
        n.cast("double").alias("contentTimePosition"),
        (n % 1000).alias("seasonNumber"),
        n.alias("episodeNumber"),
        F.lit("9999-12-31 23:59:59").cast("timestamp_ntz").alias("effectiveTo"),
    )
    titles = spark.range(0, 4000).select(
        F.when(F.col("id") == 0, "ast").otherwise(F.concat(F.lit("x"), "id")).alias("ContentID"),
        *[F.lit("Drama").alias(c) for c in ("Primary_Genre", "Secondary_Genre", "ProductType")],
    )
    catalog = importlib.import_module("cuebreaks.catalog")
    monkeypatch.setattr(catalog, "cue_inputs", lambda spark, sf_dir: CueInputs(cues, None, titles))
    finals = []

    def recorded(df):
        df.collect()
        finals.append(df._jdf.queryExecution().executedPlan().toString())

    monkeypatch.setattr(catalog, "_staged", lambda df, name: recorded(df) or Stage(spark).write(df, name))
    result = catalog.QUERIES[name](spark, "")
    recorded(result)
    assert "skew=true" in finals[0]


def test_whole_rows_are_told_apart(spark):
    rows = [(1, None, "a"), (1, None, "a"), (None, None, None), (None, None, None), (1, 2.0, "a"), (1, None, "b")]
    frame = spark.createDataFrame(rows, "k long, `odd name` double, s string")
    found = ops.distinct_rows(frame)
    assert found.schema == frame.schema and sorted(map(repr, found.collect())) == sorted(map(repr, frame.distinct().collect()))


def scans(spark, build, raw):
    """How many of the written relations, and the result, read each staged relation but the raw input."""
    read = Counter()

    def count(df):
        read.update({m[1] for f in {*df.inputFiles()} - raw if (m := re.search(r"/\d+-([a-z-]+)/part", f))})

    class Recorder(Stage):
        def write(self, df, name):
            count(df)
            return super().write(df, name)

    count(build(Recorder(spark)))
    return read


def test_staged_cues_are_scanned_three_times(spark, inputs):
    raw = {f for table in inputs for f in table.inputFiles()}
    read = scans(spark, lambda stage: cue_summary(*inputs, "exact", dt.date(2024, 1, 2), stage), raw)
    assert read["cues"] == 3 and read["profile"] <= 2 and read["described"] == 1


def test_lookups_scan_their_raw_input_once(spark, inputs):
    for name in ("metadata_join_exact", "metadata_join_normalized", "ad_spec", "ad_grade"):
        assert tree(QUERIES[name](spark, SMALL)).count("Scan parquet") == 2  # cues and metadata


def test_breaks_are_ordered_in_parts_sized_by_their_bytes_in_memory(spark, inputs, monkeypatch):
    # Rows that compress well: adaptive execution alone would give them all to one task.
    n = F.col("id")
    frame = spark.range(0, 20_000, 1, 4).select(n, F.repeat(F.lit("x"), 1000).alias("s"))
    size = 20_000 * (2 * 8 + 1000)
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert skew.parts_of(frame) == math.ceil(size / skew.LEAST_PART_BYTES) < usual
    assert skew.parts_of(frame.limit(0)) == 1
    monkeypatch.setattr(skew, "PART_BYTES", 1 << 20)
    assert skew.parts_of(frame) == math.ceil(size / (1 << 20)) > usual
    assert skew.parts_of(frame, 2) == math.ceil(2 * size / (1 << 20))

    monkeypatch.setattr(skew, "PART_BYTES", 20_000)
    result = cue_summary(*inputs, "exact", dt.date(2024, 1, 2))
    filled = result.groupBy(F.spark_partition_id()).count().collect()
    assert len(filled) > usual  # one shuffle of the session's width would fill no more
    monkeypatch.undo()
    assert bag(result) == bag(cue_summary(*inputs, "exact", dt.date(2024, 1, 2)))


def test_newest_cues_are_found_before_copies_are_removed(spark, shuffled_joins, monkeypatch):
    catalog = importlib.import_module("cuebreaks.catalog")
    n = F.col("id")
    old = n % 10 == 0
    cues = spark.range(0, 60_000, 1, 8).select(
        F.when(n % 2 == 0, F.lit(None)).otherwise((n % 5000).cast("string")).alias("seriesTitle"),
        n.cast("string").alias("assetExternalID"),
        F.lit(1).cast("long").alias("seasonNumber"),
        F.lit(None).cast("long").alias("episodeNumber"),
        n.alias("cuePointPosition"),
        F.when(n % 3 != 0, "9999-12-31 23:59:59").otherwise("2024-01-01 00:00:00").cast("timestamp_ntz").alias("effectiveTo"),
        F.when(n % 3 == 0, "2024-01-03").when(old, "2024-01-01").otherwise("2024-01-02").cast("timestamp_ntz")
        .alias("SDPSnapshotUpdateTimestamp"),
    )
    monkeypatch.setattr(catalog, "_staged", lambda *_: pytest.fail("all open cues are written"))
    found = catalog.latest_snapshot_cues(cues.unionByName(cues))
    # Series of every tenth number have old snapshots only, and these are even: all of them lack a series.
    rows = [r.cuePointPosition for r in found.collect()]
    assert sorted(rows) == [k for k in range(60_000) if k % 3 and k % 10]
    final = found._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in final  # the duplicate removal has an exchange of its own


def test_a_query_on_cues_does_not_wait_for_the_other_inputs(spark, monkeypatch):
    derived = importlib.import_module("cuebreaks.sources.derived")

    class Unwritten:
        def __init__(self, *_, **__):
            pass

        def write(self, df, name):
            assert name == "cues"
            return df

    monkeypatch.setattr(derived, "_STAGED", {})
    monkeypatch.setattr(derived, "Stage", Unwritten)
    assert not QUERIES["latest_snapshot_cues"](spark, SMALL).isEmpty()
