"""What must hold of any result."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cuebreaks import cue_summary
from cuebreaks import functions as R
from cuebreaks import operators as ops
from cuebreaks.sources.derived import cue_inputs
from cuebreaks.sources.schemas import SUMMARY
from helpers import SMALL, bag

EPISODE = ["Video_Series_Name", "SeasonNumber", "EpisodeNumber"]
DATE = dt.date(2024, 1, 2)


@pytest.fixture(scope="module")
def inputs(spark):
    return cue_inputs(spark, SMALL)


@pytest.fixture(scope="module")
def summary(inputs):
    return cue_summary(*inputs, "exact", DATE).cache()


def test_columns_and_types(summary):
    assert summary.dtypes == [(f.name, f.dataType.simpleString()) for f in SUMMARY]


def test_no_duplicate_rows(summary):
    assert summary.distinct().count() == summary.count()


def test_retired_names_are_gone(summary):
    assert summary.filter(F.lower("assetName").like("%do%not%use%")).isEmpty()
    assert summary.filter("assetName IS NULL").isEmpty()


def test_end_rows_are_unique_and_blank(summary):
    ends = summary.filter("ad_cue IS NULL")
    blank = [
        "Asset_Duration_minutes", "Content_Breaks", "Content_Breaks_percent", "Content_Segments",
        "Content_Segments_percent", "Distributor", "Mutiplier", "Multiplier_just_one_more",
        "Content_Segments_MAX", "Content_Segments_MAX_split",
    ]
    assert ends.count() == 1081
    for column in blank:
        assert ends.filter(F.col(column).isNotNull()).isEmpty(), column
    assert ends.filter("Interval_Segments <> cuePointLength + 1").isEmpty()


def test_intervals_add_up_to_the_duration(summary):
    last = Window.partitionBy(*EPISODE).orderBy(F.col("Interval_Segments").desc())
    episodes = (
        summary.withColumn("end_last", F.first("ad_cue").over(last).isNull())
        .groupBy(*EPISODE)
        .agg(
            F.countDistinct("assetExternalID").alias("assets"),
            F.countDistinct("cuePointLength").alias("lengths"),
            F.countDistinct("assetDuration").alias("durations"),
            F.countDistinct("Interval_Segments").alias("steps"),
            F.count("*").alias("rows"),
            F.count("assetDuration").alias("timed"),
            F.sum("Ad_Breaks_Interval").alias("total"),
            F.max("assetDuration").alias("duration"),
            F.min("end_last").alias("end_last"),
        )
        .filter(
            "assets = 1 AND lengths = 1 AND durations = 1 AND steps = rows AND timed = rows"
            " AND end_last"
        )
    )
    assert episodes.count() > 500
    assert episodes.filter(F.abs(F.col("total") - F.col("duration")) > 0.01 * F.col("rows")).isEmpty()


def test_dedup_is_idempotent(inputs):
    once = ops.dedup_full_row(inputs.cues)
    assert bag(ops.dedup_full_row(once)) == bag(once)
    pruned = ops.prune_then_dedup(inputs.cues, ["createdAt", "agingDate"])
    assert pruned.count() < once.count()


def test_only_open_records_of_the_newest_snapshot(inputs):
    keys, at = ["seriesTitle", "seasonNumber", "episodeNumber"], "SDPSnapshotUpdateTimestamp"
    current = ops.open_records(inputs.cues, "effectiveTo")
    assert current.filter(F.year("effectiveTo") != 9999).isEmpty()
    latest = ops.latest_snapshot(current, keys, at)
    assert latest.groupBy(*keys).agg(F.countDistinct(at).alias("n")).filter("n > 1").isEmpty()


def test_fill_changes_missing_values_only(inputs):
    genres = ["Primary_Genre", "Secondary_Genre", "ProductType"]
    cues = inputs.cues.select(
        R.series_name("seriesTitle", "assetName").alias("series"),
        R.normalize_asset_id("assetExternalID").alias("asset"),
        F.monotonically_increasing_id().alias("row"),
        "seasonNumber",
    )
    before = ops.metadata_join(cues, inputs.metadata, "asset", "ContentID", genres).cache()
    after = ops.group_fallback_fill(before, "series", genres, F.col("seasonNumber") != 0)
    assert after.count() == before.count()
    renamed = before.withColumnsRenamed({g: f"old_{g}" for g in genres}).drop(
        "series", "asset", "seasonNumber"
    )
    both = after.join(renamed, "row")
    for genre in genres:
        assert both.filter(f"old_{genre} IS NOT NULL AND NOT {genre} <=> old_{genre}").isEmpty()
        assert both.filter(f"seasonNumber = 0 AND NOT {genre} <=> old_{genre}").isEmpty()
        assert not both.filter(f"old_{genre} IS NULL AND {genre} IS NOT NULL").isEmpty()


def test_variants_agree_without_suffixes_in_metadata(inputs):
    plain_ids = inputs.metadata.filter(~F.col("ContentID").contains("_HDSDR"))
    exact = cue_summary(inputs.cues, inputs.corrections, plain_ids, "exact", DATE)
    normalized = cue_summary(inputs.cues, inputs.corrections, plain_ids, "normalized", DATE)
    assert bag(exact) == bag(normalized)


def test_several_corrections_fan_out(spark):
    cues = spark.createDataFrame([("S", "a", 1, 1)], "s string, n string, se long, ep long")
    fixes = spark.createDataFrame(
        [("s", "A", 2, None), ("S", "a", 3, 4)], "fs string, fn string, fse long, fep long"
    )
    result = ops.label_override(cues, fixes, [("s", "fs"), ("n", "fn")], [("se", "fse"), ("ep", "fep")])
    assert {(r.se, r.ep) for r in result.collect()} == {(2, 1), (3, 4)}


def test_presentation_order(inputs):
    result = ops.presentation_order(
        inputs.cues.select("seriesTitle", "seasonNumber", "cuePointPosition"),
        ["seriesTitle", "seasonNumber", "cuePointPosition"],
        ["seasonNumber", "cuePointPosition"],
    ).collect()
    first = lambda v: (v is not None, v if v is not None else 0)
    keys = [tuple(map(first, row)) for row in result]
    assert keys == sorted(keys) and len(keys) == inputs.cues.count()


def test_unknown_match_and_bad_schema_are_refused(inputs):
    with pytest.raises(ValueError, match="exact"):
        cue_summary(*inputs, "fuzzy", DATE)
    with pytest.raises(ValueError, match="assetDuration"):
        cue_summary(inputs.cues.drop("assetDuration"), inputs.corrections, inputs.metadata)
