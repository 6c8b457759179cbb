"""The registered queries: each runs one operator, or the whole job, over the test tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cuebreaks import functions as R
from cuebreaks import operators as ops
from cuebreaks import oracle
from cuebreaks.plans import cue_summary
from cuebreaks.sources.derived import LINE_ORDER, CueInputs, cue_input, cue_inputs
from cuebreaks.sources.staging import Stage, shared_dir
from cuebreaks.sources.tables import read_table, replace_table

RUN_DATE = dt.date(2024, 1, 2)

Query = Callable[[SparkSession, str], DataFrame]

GENRES = ("Primary_Genre", "Secondary_Genre", "ProductType")
EPISODE = ("Video_Series_Name", "SeasonNumber", "EpisodeNumber")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _on_table(name: str, query: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(_table(spark, sf_dir, name))


def _on_inputs(query: Callable[[CueInputs], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(cue_inputs(spark, sf_dir))


def _on_cues(query: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(cue_input(spark, sf_dir, "cues"))


def _staged(df: DataFrame, name: str) -> DataFrame:
    """Written out: operators read their input twice, to count keys and to work on it."""
    return Stage(df.sparkSession).write(df, name)


def _open(cues: DataFrame, *columns: str) -> DataFrame:
    """Distinct open cues, cut to ``columns``."""
    return ops.current_versions(cues, "effectiveTo", columns or None)


def scan_open_records(cues: DataFrame) -> DataFrame:
    current = ops.current_versions(cues, "effectiveTo")
    return current.withColumn("valid_to_year", F.year("effectiveTo").cast("bigint")).drop(
        "effectiveTo"
    )


def dedup_full_row(lineitem: DataFrame) -> DataFrame:
    returned = lineitem.filter(F.col("l_returnflag") == "R")
    return ops.dedup_full_row(lineitem.unionByName(returned))


def prune_then_dedup(lineitem: DataFrame) -> DataFrame:
    kept = {"l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"}
    return ops.prune_then_dedup(lineitem, [c for c in lineitem.columns if c not in kept])


def latest_snapshot_cues(cues: DataFrame) -> DataFrame:
    keys, snapshot = ["seriesTitle", "seasonNumber", "episodeNumber"], "SDPSnapshotUpdateTimestamp"
    # Copies do not change a maximum, so they are removed from the newest rows only.
    latest = ops.latest_snapshot(ops.open_records(cues, "effectiveTo"), keys, snapshot)
    return ops.current_versions(latest, "effectiveTo").select(*keys, "assetExternalID", "cuePointPosition", snapshot)


def label_override(inputs: CueInputs) -> DataFrame:
    overridden = ops.label_override(
        ops.current_versions(inputs.cues, "effectiveTo"),
        inputs.corrections,
        on=[("seriesTitle", "Video_Series_Name"), ("assetName", "Asset_Name")],
        values=[("seasonNumber", "Season"), ("episodeNumber", "Episode")],
    )
    return overridden.select(
        "seriesTitle",
        "assetName",
        "assetExternalID",
        "cuePointPosition",
        "seasonNumber",
        "episodeNumber",
    )


def _metadata_join(match: str) -> Query:
    def query(inputs: CueInputs) -> DataFrame:
        cues = _normalized(_open(inputs.cues, "assetExternalID", "cuePointPosition")).distinct()
        columns = [*GENRES, "TypeOfContent", "Distributor"]
        return ops.metadata_join(
            cues, inputs.metadata, "assetExternalID", "ContentID", columns, match
        )

    return _on_inputs(query)


def _normalized(cues: DataFrame) -> DataFrame:
    return cues.withColumn("assetExternalID", R.normalize_asset_id("assetExternalID"))


def next_position_lookup(lineitem: DataFrame) -> DataFrame:
    lines = lineitem.select("l_orderkey", *LINE_ORDER)
    placed = ops.numbered_in_order(lines, ["l_orderkey"], LINE_ORDER, "pos", "len")
    placed = _staged(placed.select("l_orderkey", "l_extendedprice", "pos"), "placed")
    return ops.next_position_lookup(placed, "l_orderkey", "pos", "l_extendedprice", "next_price")


def next_position_lookup_cues(cues: DataFrame) -> DataFrame:
    positions = _open(cues, "assetExternalID", "cuePointPosition", "contentTimePosition")
    return ops.next_position_lookup(
        _staged(positions, "positions"),
        "assetExternalID",
        "cuePointPosition",
        "contentTimePosition",
        "next_break",
        lookup_key=R.normalize_asset_id("assetExternalID"),
    )


def _specified(inputs: CueInputs) -> DataFrame:
    """Distinct cue points with the expected cue count of their title."""
    cues = _normalized(
        _open(
            inputs.cues, "assetExternalID", "assetDuration", "cuePointLength", "cuePointPosition"
        )
    ).withColumns({c: R.zero_fill(c) for c in ("cuePointLength", "cuePointPosition")})
    matched = ops.metadata_join(
        cues,
        inputs.metadata,
        "assetExternalID",
        "ContentID",
        ["Primary_Genre"],
        "normalized",
    )
    return ops.distinct_rows(
        matched.withColumn("_seconds", R.whole_number("assetDuration"))
        .withColumn("ad_spec", R.ad_spec("assetDuration", "Primary_Genre", "_seconds"))
        .drop("_seconds")
    )


def terminal_position_lookup(inputs: CueInputs) -> DataFrame:
    specified = _staged(_specified(inputs), "specified")
    return ops.terminal_position_lookup(
        specified, "assetExternalID", "cuePointPosition", "cuePointLength", "ad_spec"
    )


def group_max_join_back(lineitem: DataFrame) -> DataFrame:
    lines = lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    with_max = ops.group_max_join_back(lines, "l_orderkey", "l_extendedprice", "max_price")
    return with_max.withColumn("max_price_split", F.col("max_price") / 2)


def group_max_cues(cues: DataFrame) -> DataFrame:
    segments = _normalized(ops.current_versions(cues, "effectiveTo")).select(
        "assetExternalID",
        "cuePointPosition",
        R.content_segments("cuePointLength", "contentTimePosition", "assetDuration").alias(
            "Content_Segments"
        ),
    )
    return ops.group_max_join_back(
        _staged(segments, "segments"), "assetExternalID", "Content_Segments", "Content_Segments_MAX"
    )


def series_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    indebted = _table(spark, sf_dir, "customer").filter("c_acctbal < 0")
    orders = _table(spark, sf_dir, "orders")
    return ops.series_semi_join(orders, indebted, "o_custkey", "c_custkey")


def _placed(cues: DataFrame) -> DataFrame:
    """Distinct open cues by series, season and episode, without missing numbers."""
    numbers = ("cuePointLength", "cuePointPosition", "contentTimePosition")
    return (
        _normalized(ops.open_records(cues, "effectiveTo"))
        .withColumns({c: R.zero_fill(c) for c in numbers})
        .select(
            R.series_name("seriesTitle", "assetName").alias("Video_Series_Name"),
            "assetExternalID",
            "assetName",
            "assetDuration",
            *numbers,
            F.col("seasonNumber").alias("SeasonNumber"),
            F.col("episodeNumber").alias("EpisodeNumber"),
        )
        .distinct()
    )


def group_fallback_fill(inputs: CueInputs) -> DataFrame:
    cues = _placed(inputs.cues).select(*EPISODE, "assetExternalID")
    genred = ops.distinct_rows(
        ops.metadata_join(cues, inputs.metadata, "assetExternalID", "ContentID", GENRES, "exact")
    )
    eligible = (F.col("SeasonNumber") != 0) & (F.col("EpisodeNumber") != 0)
    genred = _staged(genred, "genred")
    return ops.group_fallback_fill(genred, "Video_Series_Name", GENRES, eligible)


def terminal_row_union(cues: DataFrame) -> DataFrame:
    after_last = F.col("cuePointLength") + 1
    placed = _placed(cues).withColumn("Interval_Segments", F.col("cuePointPosition"))
    return ops.add_terminal_rows(
        placed,
        replace={
            "cuePointPosition": after_last,
            "contentTimePosition": F.col("assetDuration"),
            "Interval_Segments": after_last,
        },
    ).distinct()


def break_interval(cues: DataFrame) -> DataFrame:
    order = [
        "Interval_Segments",
        "assetExternalID",
        "assetName",
        "contentTimePosition",
        "assetDuration",
        "cuePointLength",
        "cuePointPosition",
    ]
    with_ends = _staged(terminal_row_union(cues), "with-ends")
    return ops.break_interval(with_ends, "contentTimePosition", EPISODE, order)


def _micros(time: str) -> Column:
    """Micro-seconds since 1970 of a zone-less time, in any session time zone."""
    since = F.col(time) - F.lit("1970-01-01").cast("timestamp_ntz")

    def part(unit: str) -> Column:
        return F.extract(F.lit(unit), since)

    minutes = ((part("DAY") * 24 + part("HOUR")) * 60 + part("MINUTE")).cast("bigint")
    return minutes * 60_000_000 + (part("SECOND") * 1_000_000).cast("bigint")


def event_gaps(events: DataFrame) -> DataFrame:
    timed = events.select("event_id", "user_id", _micros("ts").alias("micros"))
    return ops.break_interval(
        timed, "micros", ["user_id"], ["micros", "event_id"], "previous_micros", "gap_micros"
    )


def run_date_instants(events: DataFrame) -> DataFrame:
    """The stamp for each event's time, taken as UTC."""
    instant = F.timestamp_micros(_micros("ts"))
    return events.select("event_id", R.run_date_stamp(instant=instant).alias("updated_date"))


def exclude_name_documents(documents: DataFrame) -> DataFrame:
    """Names that are whole texts, into some of which the words are put that retire a name."""
    words = F.element_at(
        F.array(*[F.lit(w) for w in (" DO NOT USE ", " do-not-use ", " DoNotUse", " use not do ")]),
        (F.col("doc_id") % 4 + 1).cast("int"),
    )
    half = (F.length("text") / 2).cast("int")
    marked = F.concat(F.substring("text", F.lit(1), half), words, F.substring("text", half + 1, F.length("text")))
    text = F.when(F.col("doc_id") % 5 == 0, marked).otherwise(F.col("text"))
    return documents.withColumn("text", text).filter(R.usable_name("text"))


def replace_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = ops.current_versions(cue_input(spark, sf_dir, "cues"), "effectiveTo")
    target = f"{shared_dir(spark)}/cuebreaks-target/{uuid.uuid4().hex}"
    replace_table(current.drop("effectiveTo"), target)
    return read_table(spark, target)


def _summary(match: str) -> Query:
    return _on_inputs(lambda inputs: cue_summary(*inputs, metadata_match=match, run_date=RUN_DATE))


QUERIES: dict[str, Query] = {
    "scan_open_records": _on_cues(scan_open_records),
    "dedup_full_row": _on_table("lineitem", dedup_full_row),
    "prune_then_dedup": _on_table("lineitem", prune_then_dedup),
    "latest_snapshot": _on_table(
        "orders", lambda orders: ops.latest_snapshot(orders, ["o_custkey"], "o_orderdate")
    ),
    "latest_snapshot_cues": _on_cues(latest_snapshot_cues),
    "label_override": _on_inputs(label_override),
    "series_name_fallback": _on_cues(
        lambda cues: cues.select(
            "seriesTitle",
            "assetName",
            R.series_name("seriesTitle", "assetName").alias("Video_Series_Name"),
        )
    ),
    "normalize_asset_id": _on_cues(
        lambda cues: cues.select(
            F.col("assetExternalID").alias("raw_id"),
            R.normalize_asset_id("assetExternalID").alias("assetExternalID"),
        )
    ),
    "zero_fill": _on_cues(
        lambda cues: cues.select(
            "assetExternalID",
            *[
                R.zero_fill(c).alias(c)
                for c in ("cuePointLength", "cuePointPosition", "contentTimePosition")
            ],
        )
    ),
    "duration_minutes": _on_cues(
        lambda cues: cues.select(
            "assetDuration", R.duration_minutes("assetDuration").alias("Asset_Duration_minutes")
        )
    ),
    "break_position": _on_cues(
        lambda cues: cues.select(
            "assetExternalID",
            "cuePointPosition",
            R.break_minutes("contentTimePosition").alias("Content_Breaks"),
            R.break_fraction("contentTimePosition", "assetDuration").alias(
                "Content_Breaks_percent"
            ),
        )
    ),
    "cue_label": _on_cues(
        lambda cues: cues.select(
            "assetExternalID", "cuePointLength", R.cue_label("cuePointLength").alias("ad_cue")
        )
    ),
    "content_segments": _on_cues(
        lambda cues: cues.select(
            "assetExternalID",
            "cuePointPosition",
            R.content_segments("cuePointLength", "contentTimePosition", "assetDuration").alias(
                "Content_Segments"
            ),
            R.content_segments_fraction(
                "cuePointLength", "contentTimePosition", "assetDuration"
            ).alias("Content_Segments_percent"),
        )
    ),
    "duration_band": _on_cues(
        lambda cues: cues.withColumn("_seconds", R.whole_number("assetDuration")).select(
            "assetExternalID",
            "assetDuration",
            R.duration_band("assetDuration", "_seconds").alias("duration"),
        )
    ),
    "content_type": _on_inputs(
        lambda inputs: inputs.metadata.select(
            "ContentID", R.content_type("TypeOfContent").alias("TypeOfContent")
        )
    ),
    "exclude_name_pattern": _on_cues(
        lambda cues: cues.filter(R.usable_name("assetName")).select(
            "assetExternalID", "assetName", "cuePointPosition"
        )
    ),
    "exclude_name_documents": _on_table("documents", exclude_name_documents),
    "metadata_join_exact": _metadata_join("exact"),
    "metadata_join_normalized": _metadata_join("normalized"),
    "next_position_lookup": _on_table("lineitem", next_position_lookup),
    "next_position_lookup_cues": _on_cues(next_position_lookup_cues),
    "terminal_position_lookup": _on_inputs(terminal_position_lookup),
    "group_max_join_back": _on_table("lineitem", group_max_join_back),
    "group_max_cues": _on_cues(group_max_cues),
    "series_semi_join": series_semi_join,
    "group_fallback_fill": _on_inputs(group_fallback_fill),
    "ad_spec": _on_inputs(_specified),
    "ad_grade": _on_inputs(
        lambda inputs: _specified(inputs).withColumn(
            "ad_grade", R.ad_grade("cuePointLength", "ad_spec")
        )
    ),
    "terminal_row_union": _on_cues(terminal_row_union),
    "break_interval": _on_cues(break_interval),
    "event_gaps": _on_table("events", event_gaps),
    "run_date_stamp": _on_cues(
        lambda cues: cues.select(
            "assetExternalID", R.run_date_stamp(RUN_DATE).alias("updated_date")
        )
    ),
    "run_date_instants": _on_table("events", run_date_instants),
    "presentation_order": _on_table(
        "orders",
        lambda orders: ops.presentation_order(
            orders, ["o_custkey", "o_orderdate", "o_orderkey"], numeric=["o_custkey", "o_orderkey"]
        ),
    ),
    "replace_table_roundtrip": replace_table_roundtrip,
    "cue_summary_exact": _summary("exact"),
    "cue_summary_normalized": _summary("normalized"),
}

ORACLE_SQL: dict[str, str] = oracle.twins(RUN_DATE.isoformat())
