"""Hand-worked titles, cell by cell."""

import datetime as dt
from decimal import Decimal

import pytest

from cuebreaks import cue_summary
from helpers import OLD, correction_rows, cue, cue_rows, metadata_rows

SHOW = dict(seriesTitle="Show A", seasonNumber=1, episodeNumber=2, assetName="Show A 2")
G1 = dict(SHOW, assetExternalID="A1_UHDDV", assetDuration=1800.0, cuePointLength=3)
G3 = dict(
    seriesTitle="Short S",
    seasonNumber=1,
    episodeNumber=1,
    assetName="Short S 1",
    assetExternalID="S1",
    assetDuration=540.0,
)
G4 = dict(G1, assetExternalID="A2", episodeNumber=3, assetName="Show A 3")
G6 = dict(
    seriesTitle="Zero", seasonNumber=1, episodeNumber=1, assetName="Zero 1", assetExternalID="Z1"
)


def breaks(title, times):
    return [
        cue(**title, cuePointPosition=position, contentTimePosition=float(time))
        for position, time in enumerate(times, 1)
    ]


MOVIE = dict(assetName="Film M", assetExternalID="M1", assetDuration=6000.0, cuePointLength=4)
CUES = [
    *breaks(G1, [300, 900, 1500]),
    breaks(G1, [300])[0],
    cue(**G1, cuePointPosition=1, contentTimePosition=999.0, SDPSnapshotUpdateTimestamp=OLD),
    cue(
        **G1,
        cuePointPosition=1,
        contentTimePosition=777.0,
        SDPSnapshotUpdateTimestamp=dt.datetime(2024, 6, 1),
        effectiveTo=dt.datetime(2024, 7, 1),
    ),
    *breaks(MOVIE, [1200, 2400, 3600, 4800]),
    cue(**G3),
    *breaks(G4, [300, 900, 1500]),
    cue(**dict(SHOW, assetName="Do Not  Use me"), assetExternalID="X1", assetDuration=60.0),
    cue(**dict(SHOW, assetName=None), assetExternalID="X2", assetDuration=60.0),
    cue(
        seriesTitle="Misl",
        assetName="Wrong",
        seasonNumber=4,
        episodeNumber=4,
        assetExternalID="W1",
        contentTimePosition=100.0,
        cuePointPosition=1,
        cuePointLength=1,
    ),
]
CORRECTIONS = [("MISL", "wrong", 7, None)]
METADATA = [
    ("a1", "Drama", "Crime", "Series", "D2C Drama", "Dist"),
    ("m1", "Movies", "Action", "Movie", "Acquired", "Dist"),
    ("s1", "Kids", "Fun", "Series", "Acquired", "Dist"),
    ("w1", "Drama", "Legal", "Series", "Acquired", "Dist"),
]


@pytest.fixture(scope="module", params=["exact", "normalized"])
def summary(spark, request):
    result = cue_summary(
        cue_rows(spark, CUES),
        correction_rows(spark, CORRECTIONS),
        metadata_rows(spark, METADATA),
        request.param,
        dt.date(2024, 3, 1),
    )
    return result.collect()


def title(summary, asset):
    rows = [row for row in summary if row.assetExternalID == asset]
    return sorted(rows, key=lambda row: row.Interval_Segments)


def column(rows, name):
    return [row[name] for row in rows]


def test_row_count_and_run_date(summary):
    assert len(summary) == 17
    assert {row.updated_date for row in summary} == {dt.date(2024, 2, 29)}


def test_plain_episode(summary):
    rows = title(summary, "a1")
    cues, end = rows[:3], rows[3]
    assert {(r.Video_Series_Name, r.SeasonNumber, r.EpisodeNumber) for r in rows} == {
        ("show a", 1, 2)
    }
    assert {(r.duration, r.ad_spec, r.ad_grade, r.TypeOfContent) for r in rows} == {
        ("20-39", 3, "At Spec", "Peacock Original")
    }
    assert column(rows, "contentTimePosition") == [300, 900, 1500, 1800]
    assert column(rows, "Ad_Breaks_Interval") == [300, 600, 600, 300]
    assert column(cues, "Content_Segments") == [25, 15, 5]
    assert {(r.Content_Segments_MAX, r.Content_Segments_MAX_split) for r in cues} == {(25, 12.5)}
    assert {(r.Mutiplier, r.Multiplier_just_one_more) for r in cues} == {
        (Decimal("1.000000000"), Decimal("1.333333333"))
    }
    assert column(cues, "Content_Breaks") == [5, 15, 25]
    assert column(cues, "Content_Breaks_percent") == [300 / 1800, 900 / 1800, 1500 / 1800]
    assert {r.Asset_Duration_minutes for r in cues} == {30.0}
    assert (end.cuePointPosition, end.ad_cue, end.Distributor) == (4, None, None)
    assert end.Content_Segments is end.Content_Segments_percent is end.Mutiplier is None
    assert end.Asset_Duration_minutes is end.Content_Breaks is end.Content_Segments_MAX is None


def test_movie_without_series(summary):
    rows = title(summary, "m1")
    assert {(r.Video_Series_Name, r.SeasonNumber, r.EpisodeNumber) for r in rows} == {
        ("film m", 0, 0)
    }
    assert {(r.duration, r.ad_spec, r.ad_grade) for r in rows} == {("90-119", 8, "Below Spec")}
    assert column(rows, "Ad_Breaks_Interval") == [1200] * 5
    cues = rows[:4]
    assert column(cues, "Content_Segments") == [80, 60, 40, 20]
    assert {(r.Content_Segments_MAX, r.Content_Segments_MAX_split) for r in cues} == {(80, 40)}
    assert {(r.Mutiplier, r.Multiplier_just_one_more) for r in cues} == {
        (Decimal("2.000000000"), Decimal("1.250000000"))
    }


def test_title_without_cues(summary):
    start, end = title(summary, "s1")
    assert (start.cuePointLength, start.cuePointPosition, start.contentTimePosition) == (0, 0, 0)
    assert start.ad_cue == "NULL"
    assert (start.Content_Segments, start.Content_Segments_percent) == (540, 540)
    assert (start.Content_Segments_MAX, start.Content_Segments_MAX_split) == (540, 270)
    assert (start.ad_spec, start.ad_grade) == (0, "At Spec")
    assert start.Mutiplier is start.Multiplier_just_one_more is None
    assert (start.Ad_Breaks_Interval, end.Ad_Breaks_Interval) == (0, 540)
    assert end.cuePointPosition == 1


def test_backfilled_episode(summary):
    rows = title(summary, "a2")
    assert {(r.Primary_Genre, r.Secondary_Genre, r.ProductType, r.TypeOfContent) for r in rows} == {
        ("Drama", "Crime", "Series", "Others")
    }
    assert {(r.ad_spec, r.ad_grade) for r in rows} == {(3, "At Spec")}
    assert {(r.Mutiplier, r.Multiplier_just_one_more) for r in rows[:3]} == {
        (Decimal("4.333333333"), Decimal("1.333333333"))
    }


def test_excluded_and_corrected_rows(summary):
    assert not title(summary, "x1") and not title(summary, "x2")
    cue_row, end = title(summary, "w1")
    assert (cue_row.SeasonNumber, cue_row.EpisodeNumber) == (7, 4)
    assert (cue_row.duration, cue_row.ad_spec, cue_row.ad_grade) == (None, 0, "Above Spec")
    assert cue_row.Content_Segments is None
    assert (cue_row.Mutiplier, cue_row.Multiplier_just_one_more) == (
        Decimal("0.000000000"),
        Decimal("2.000000000"),
    )
    assert cue_row.Ad_Breaks_Interval == 100
    assert end.contentTimePosition is None and end.Ad_Breaks_Interval is None


def test_zero_duration_gives_no_error(spark):
    zero = cue(
        **G6, assetDuration=0.0, cuePointLength=1, cuePointPosition=1, contentTimePosition=0.0
    )
    result = cue_summary(
        cue_rows(spark, [zero]), correction_rows(spark, []), metadata_rows(spark, [])
    )
    (row,) = result.filter("ad_cue = 'END'").collect()
    assert row.Content_Breaks_percent == 0 and row.Content_Segments_percent is None


def test_snapshot_ties_stay_and_null_season_is_a_group(spark):
    titled = dict(seriesTitle="T", assetName="t", assetExternalID="T1", assetDuration=100.0)
    rows = [
        cue(**titled, cuePointPosition=1, contentTimePosition=10.0, cuePointLength=2),
        cue(**titled, cuePointPosition=2, contentTimePosition=20.0, cuePointLength=2),
        cue(
            **titled,
            cuePointPosition=2,
            contentTimePosition=99.0,
            cuePointLength=2,
            SDPSnapshotUpdateTimestamp=OLD,
        ),
    ]
    result = cue_summary(
        cue_rows(spark, rows), correction_rows(spark, []), metadata_rows(spark, [])
    )
    times = sorted(row.contentTimePosition for row in result.collect())
    assert times == [10, 20, 100]
