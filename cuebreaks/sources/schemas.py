"""Column names and types of the inputs and of the summary table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_NTZ = T.TimestampNTZType()


def _schema(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


# The names and their order in all lists of this file.
# Times are in seconds; an open version ends in the year 9999, hence no time zone.
CUES = _schema(
    ("seriesTitle", T.StringType()),
    ("assetExternalID", T.StringType()),
    ("assetName", T.StringType()),
    ("assetDuration", T.DoubleType()),
    ("contentTimePosition", T.DoubleType()),
    ("cuePointPosition", T.LongType()),
    ("cuePointLength", T.LongType()),
    ("seasonNumber", T.LongType()),
    ("episodeNumber", T.LongType()),
    ("effectiveTo", _NTZ),
    ("SDPSnapshotUpdateTimestamp", _NTZ),
)

CORRECTIONS = _schema(
    ("Video_Series_Name", T.StringType()),
    ("Asset_Name", T.StringType()),
    ("Season", T.LongType()),
    ("Episode", T.LongType()),
)

METADATA = _schema(
    ("ContentID", T.StringType()),
    ("Primary_Genre", T.StringType()),
    ("Secondary_Genre", T.StringType()),
    ("ProductType", T.StringType()),
    ("TypeOfContent", T.StringType()),
    ("Distributor", T.StringType()),
)

# Metadata columns that the summary does not keep.
METADATA_UNUSED = (
    "CoppaCompliance",
    "adRequirementsOnAVOD",
    "adRequirementsOnPremiumTier",
    "adRequirementsOnPremiumPlusTier",
    "Rev_Share",
)

SUMMARY = _schema(
    ("Video_Series_Name", T.StringType()),
    ("assetExternalID", T.StringType()),
    ("assetName", T.StringType()),
    ("assetDuration", T.DoubleType()),
    ("Asset_Duration_minutes", T.DoubleType()),
    ("cuePointLength", T.LongType()),
    ("cuePointPosition", T.LongType()),
    ("contentTimePosition", T.DoubleType()),
    ("Content_Breaks", T.DoubleType()),
    ("Content_Breaks_percent", T.DoubleType()),
    ("ad_cue", T.StringType()),
    ("Content_Segments", T.DoubleType()),
    ("Content_Segments_percent", T.DoubleType()),
    ("duration", T.StringType()),
    ("Primary_Genre", T.StringType()),
    ("Secondary_Genre", T.StringType()),
    ("ProductType", T.StringType()),
    ("SeasonNumber", T.LongType()),
    ("EpisodeNumber", T.LongType()),
    ("TypeOfContent", T.StringType()),
    ("Distributor", T.StringType()),
    ("ad_spec", T.LongType()),
    ("ad_grade", T.StringType()),
    ("Mutiplier", T.DecimalType(38, 9)),
    ("Multiplier_just_one_more", T.DecimalType(38, 9)),
    ("Content_Segments_MAX", T.DoubleType()),
    ("Content_Segments_MAX_split", T.DoubleType()),
    ("Interval_Segments", T.LongType()),
    ("Last_contentTimePosition", T.DoubleType()),
    ("updated_date", T.DateType()),
    ("Ad_Breaks_Interval", T.DoubleType()),
)


def check_schema(df: DataFrame, required: T.StructType, name: str) -> DataFrame:
    """``df`` cut to the required columns; raises if one is missing or of another type."""
    found = {field.name: field.dataType for field in df.schema}
    problems = [
        f"{field.name}: needs {field.dataType.simpleString()}, has "
        + (found[field.name].simpleString() if field.name in found else "no such column")
        for field in required
        if found.get(field.name) != field.dataType
    ]
    if problems:
        raise ValueError(f"{name} does not fit: " + "; ".join(problems))
    return df.select(*required.names)
