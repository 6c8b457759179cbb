"""The cue-point summary: one row per break and per end of video, graded and with its interval.

The wide relation of cue points is shuffled five times at most: to meet the newest snapshots (not if Spark broadcasts
these), to remove duplicates, to find the terminal rows, to receive the title attributes (neither if Spark
broadcasts the titles), and to order the breaks of an episode. Everything else that the summary needs from joins and groups (metadata, backfill,
multipliers, longest content) is worked out on relations of titles, which have one row where the cues
have many.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuebreaks import functions as R
from cuebreaks.functions.grading import CUE_WITHOUT_LENGTH
from cuebreaks.operators import (
    add_terminal_rows,
    attach_fallback,
    distinct_rows,
    fill_from_fallback,
    group_max,
    hot_keys,
    interval_since,
    join_on,
    label_override,
    latest_snapshot,
    metadata_join,
    open_records,
    previous_in_order,
    previous_in_pieces,
    terminal_quotients,
)
from cuebreaks.operators.skew import HOT_BYTES, HOT_ROWS, parts_of
from cuebreaks.sources.schemas import CORRECTIONS, CUES, METADATA, SUMMARY, check_schema
from cuebreaks.sources.staging import Stage
from cuebreaks.sources.tables import check_target, read_table, replace_table

SERIES, ASSET = "Video_Series_Name", "assetExternalID"
EPISODE = (SERIES, "SeasonNumber", "EpisodeNumber")
TITLE = (SERIES, ASSET, "_length")
GENRES = ("Primary_Genre", "Secondary_Genre", "ProductType")

RAW_EPISODE = ("seriesTitle", "seasonNumber", "episodeNumber")
SNAPSHOT = "SDPSnapshotUpdateTimestamp"

# The columns that tell two summary rows apart; all others follow from these and are added
# after the last shuffle. A row without ``ad_cue`` is an end of video.
CORE = (
    SERIES,
    ASSET,
    "assetName",
    "assetDuration",
    "cuePointLength",
    "cuePointPosition",
    "contentTimePosition",
    "ad_cue",
    "Content_Segments",
    *GENRES,
    "SeasonNumber",
    "EpisodeNumber",
    "TypeOfContent",
    "Distributor",
    "Mutiplier",
    "Multiplier_just_one_more",
    "Content_Segments_MAX",
)

# Breaks of an episode follow their position. The other columns settle the order of rows
# that share one, so that every run gives the same intervals.
_FIRST = ("cuePointPosition", ASSET, "assetName", "contentTimePosition")
BREAK_ORDER = (*_FIRST, *[c for c in CORE if c not in _FIRST and c not in EPISODE])

TERMINAL_BLANK = (
    "ad_cue",
    "Content_Segments",
    "Distributor",
    "Mutiplier",
    "Multiplier_just_one_more",
    "Content_Segments_MAX",
)


def is_episode() -> Column:
    """Season or episode 0 stands for "not an episode"; such rows are never backfilled."""
    return (F.col("SeasonNumber") != 0) & (F.col("EpisodeNumber") != 0)


def current_cues(cues: DataFrame, corrections: DataFrame) -> DataFrame:
    """Distinct cue points of the newest snapshot of each episode, with corrected labels.

    Looks for it by the labels as delivered and corrects them afterwards. Duplicates are removed by whole
    rows, so the join before may be split.
    """
    cues = open_records(check_schema(cues, CUES, "cues"), "effectiveTo").drop("effectiveTo")
    newest = distinct_rows(latest_snapshot(cues, RAW_EPISODE, SNAPSHOT).drop(SNAPSHOT))
    corrected = label_override(
        newest,
        check_schema(corrections, CORRECTIONS, "corrections"),
        on=[("seriesTitle", SERIES), ("assetName", "Asset_Name")],
        values=[("seasonNumber", "Season"), ("episodeNumber", "Episode")],
    )
    return corrected.select(
        R.series_name("seriesTitle", "assetName").alias(SERIES),
        R.normalize_asset_id(ASSET).alias(ASSET),
        "assetName",
        "assetDuration",
        "contentTimePosition",
        "cuePointPosition",
        "cuePointLength",
        R.zero_fill("seasonNumber").alias("SeasonNumber"),
        R.zero_fill("episodeNumber").alias("EpisodeNumber"),
        R.zero_fill("cuePointLength").alias("_length"),
        F.coalesce(R.usable_name("assetName"), F.lit(False)).alias("_usable"),
    )


def _profile(cues: DataFrame, stage: Stage) -> DataFrame:
    """One row per title and episode, with the longest content among its cues."""
    segments = R.content_segments("cuePointLength", "contentTimePosition", "assetDuration")
    counted = cues.groupBy(*TITLE, "SeasonNumber", "EpisodeNumber", "_usable").agg(
        F.max(segments).alias("_longest")
    )
    return stage.write(counted, "profile")


def _terminals(
    cues: DataFrame, asked: DataFrame, metadata: DataFrame, match: str, stage: Stage
) -> DataFrame:
    """Multipliers by (asset, position), for the positions that some title asks for.

    Built on the expected count *before* the backfill, and on all assets, also those whose
    name excludes them from the result.
    """
    positions = cues.filter(F.col(ASSET).isNotNull()).select(
        ASSET,
        R.zero_fill("cuePointPosition").alias("_position"),
        "_length",
        "assetDuration",
    )
    # Most cues are not at an asked position, so they are sifted before anything else. The matches are
    # written as they are: with nothing grouped on top, adaptive execution may split a hot asset.
    wanted = asked.select(ASSET, "_length")
    on = [(ASSET, ASSET), ("_position", "_length")]
    matches = stage.write(join_on(positions, wanted, on, how="left_semi"), "terminal-cues")
    described = metadata_join(
        matches.distinct(), metadata, ASSET, "ContentID", ["Primary_Genre"], match
    )
    graded = described.withColumn("_seconds", R.whole_number("assetDuration")).withColumn(
        "_spec", R.ad_spec("assetDuration", "Primary_Genre", "_seconds")
    )
    return terminal_quotients(graded, ASSET, "_position", "_length", "_spec")


def title_attributes(
    cues: DataFrame, profile: DataFrame, metadata: DataFrame, match: str, stage: Stage
) -> DataFrame:
    """Everything joined to a cue, by series, asset and cue count.

    Metadata, the series' fallback for it, the multipliers of the terminal row, and the
    asset's longest content. All joins are of titles, and each is followed by a shuffle or a write, so
    adaptive execution splits what is hot.
    """
    asked = (
        profile.filter("_usable").groupBy(*TITLE).agg(F.max(is_episode()).alias("_is_episode"))
    )
    columns = [*GENRES, "TypeOfContent", "Distributor"]
    described = stage.write(
        metadata_join(asked, metadata, ASSET, "ContentID", columns, match), "titles"
    )
    with_fallback = attach_fallback(
        described, SERIES, GENRES, F.col("_is_episode")
    ).drop("_is_episode")
    longest = group_max(profile, ASSET, "_longest", "Content_Segments_MAX")
    with_longest = join_on(with_fallback, longest, [(ASSET, ASSET)])
    return join_on(
        with_longest,
        _terminals(cues, described, metadata, match, stage),
        [(ASSET, ASSET), ("_length", "_position")],
    )


def _describe(cues: DataFrame) -> DataFrame:
    """The core columns of real cue points, from staged cues with title attributes."""
    duration, time, length = "assetDuration", "contentTimePosition", "cuePointLength"
    derived = {
        length: F.col("_length"),
        "cuePointPosition": R.zero_fill("cuePointPosition"),
        time: R.zero_fill(time),
        "ad_cue": R.cue_label(length),
        "Content_Segments": R.content_segments(length, time, duration),
        "TypeOfContent": R.content_type("TypeOfContent"),
    }
    filled = fill_from_fallback(cues, GENRES, is_episode())
    return filled.select(*[derived[c].alias(c) if c in derived else c for c in CORE])


def _with_ends(cues: DataFrame) -> DataFrame:
    """Cue points and one end-of-video row per asset, without duplicates."""
    return add_terminal_rows(
        cues,
        replace={
            "cuePointPosition": F.col("cuePointLength") + 1,
            "contentTimePosition": F.col("assetDuration"),
        },
        blank=TERMINAL_BLANK,
    )


def _with_previous(
    cues: DataFrame, attributes: DataFrame, hot_rows: int, stage: Stage
) -> DataFrame:
    """The breaks in their episode's order, each with the time of the one before.

    Episodes are counted on the very rows that are ordered: after metadata has multiplied them, and
    twice, for their end-of-video rows.
    """
    time, previous = "contentTimePosition", "Last_contentTimePosition"
    on = [(c, c) for c in TITLE]
    joined = _describe(join_on(cues, attributes, on, "inner", None, True))
    # Written with nothing grouped on top, so adaptive execution may split a hot title.
    described = stage.write(joined, "described")
    twice = described.withColumn("_rows", F.lit(2))
    hot = hot_keys(twice, EPISODE, hot_rows, "_rows", HOT_BYTES, stage)
    parts = parts_of(described, 2)

    def in_order(part: DataFrame) -> DataFrame:
        # One shuffle serves the terminal rows, the duplicate removal and the window. Its tasks hold twice the rows they
        # read, so the number of partitions comes from bytes in memory, not from what the shuffle compresses them to.
        ends = _with_ends(part.repartition(parts, *EPISODE)).distinct()
        return previous_in_order(ends, time, EPISODE, BREAK_ORDER, previous)

    if hot is None:
        return in_order(described)
    ordinary, busy = hot.split(described)
    # Copies, such as the many equal end-of-video rows of one asset, are merged before they move.
    ends = _with_ends(busy).distinct()
    in_pieces = previous_in_pieces(
        ends, time, EPISODE, BREAK_ORDER, previous, hot.total_pieces, stage
    )
    return in_order(ordinary).unionByName(in_pieces)


def _complete(breaks: DataFrame, run_date: dt.date | None) -> DataFrame:
    """The summary columns that follow from the core columns, row by row."""
    duration, time, length = "assetDuration", "contentTimePosition", "cuePointLength"
    is_cue = F.col("ad_cue").isNotNull()
    raw_length = F.when(F.col("ad_cue") != CUE_WITHOUT_LENGTH, F.col(length))
    raw_time = F.when(F.col("Content_Segments").isNotNull(), F.col(time))
    derived = {
        "Asset_Duration_minutes": F.when(is_cue, R.duration_minutes(duration)),
        "Content_Breaks": F.when(is_cue, R.break_minutes(time)),
        "Content_Breaks_percent": F.when(is_cue, R.break_fraction(time, duration)),
        "Content_Segments_percent": F.when(
            is_cue, R.content_segments_fraction(raw_length, raw_time, duration)
        ),
        "duration": R.duration_band(duration, "_seconds"),
        "ad_grade": R.ad_grade(length, "ad_spec"),
        "Content_Segments_MAX_split": F.col("Content_Segments_MAX") / 2,
        "Interval_Segments": F.col("cuePointPosition"),
        "updated_date": R.run_date_stamp(run_date),
        "Ad_Breaks_Interval": interval_since(time, "Last_contentTimePosition"),
    }
    graded = breaks.withColumn("_seconds", R.whole_number(duration)).withColumn(
        "ad_spec", R.ad_spec(duration, "Primary_Genre", "_seconds")
    )
    return graded.select(*[derived[c].alias(c) if c in derived else c for c in SUMMARY.names])


def cue_summary(
    cues: DataFrame,
    corrections: DataFrame,
    metadata: DataFrame,
    metadata_match: str = "exact",
    run_date: dt.date | None = None,
    stage: Stage | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The 31-column summary.

    ``metadata_match`` is ``exact`` or ``normalized`` (see ``metadata_join``). Relations that
    several steps read are written to ``stage`` while the plan is built; release it (or, without one,
    call ``release_staged``) after the result has been written. Keys with ``hot_rows`` rows or more are processed in pieces.
    """
    stage = stage or Stage(cues.sparkSession)
    metadata = check_schema(metadata, METADATA, "metadata")
    current = stage.write(current_cues(cues, corrections), "cues")
    profile = _profile(current, stage)
    attributes = stage.write(
        title_attributes(current, profile, metadata, metadata_match, stage), "attributes"
    )
    breaks = _with_previous(current.filter("_usable").drop("_usable"), attributes, hot_rows, stage)
    return _complete(breaks, run_date)


def build_summary_table(
    spark,
    cues: str,
    corrections: str,
    metadata: str,
    target: str,
    metadata_match: str = "exact",
    run_date: dt.date | None = None,
    partition_by: tuple[str, ...] = (),
    atomic: bool = False,
) -> None:
    """Read the three input tables, replace ``target`` by the summary, free the staged data."""
    sources = (cues, corrections, metadata)
    check_target(spark, target, sources)
    stage = Stage(spark)
    inputs = [read_table(spark, name) for name in sources]
    try:
        summary = cue_summary(*inputs, metadata_match, run_date, stage)
        replace_table(summary, target, sources, partition_by, atomic)
    finally:
        stage.release()
