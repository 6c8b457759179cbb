"""Duration bands, expected cue counts and grades."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cuebreaks.functions.measures import whole_number
from cuebreaks.functions.text import as_column

# Label of a duration below the given minutes, and the label above them all.
BAND_LABELS = (
    (10, "< 10"),
    (20, "10-19"),
    (40, "20-39"),
    (60, "40-59"),
    (90, "60-89"),
    (120, "90-119"),
    (150, "120-149"),
)
BAND_LABEL_ABOVE = "150+"

# Expected cue points of a title shorter than the given minutes, for a movie and
# for anything else, and of longer titles.
MOVIE_GENRE = "Movies"
SPECS = (
    (10, 0, 0),
    (20, 2, 2),
    (40, 3, 3),
    (60, 5, 5),
    (90, 8, 6),
    (120, 8, 8),
    (150, 10, 10),
    (180, 13, 13),
)
SPEC_ABOVE = (15, 13)
SPEC_WITHOUT_DURATION = 0
SPEC_WITHOUT_GENRE = 13

# Output labels.
ABOVE_SPEC, AT_SPEC, BELOW_SPEC = "Above Spec", "At Spec", "Below Spec"
ORIGINAL_CONTENT, OTHER_CONTENT = "Peacock Original", "Others"
ORIGINAL_CONTENT_MARK = "d2c"
CUE_WITHOUT_LENGTH, CUE_WITH_LENGTH = "NULL", "END"


def _by_minutes(seconds: Column, steps, above) -> Column:
    """Value of the first step whose minutes exceed ``seconds``; compares whole seconds."""
    chain = F
    for minutes, value in steps:
        chain = chain.when(seconds < minutes * 60, value)
    return chain.otherwise(above)


def duration_band(duration: Column | str, seconds: Column | str | None = None) -> Column:
    """Duration label; NULL for no duration, the top label for one that is not a number.

    ``seconds`` is the whole number of ``duration`` where a column already holds it; the
    steps then compare that column instead of rounding the duration once per step.
    """
    seconds = whole_number(duration) if seconds is None else as_column(seconds)
    return F.when(
        as_column(duration).isNotNull(), _by_minutes(seconds, BAND_LABELS, BAND_LABEL_ABOVE)
    )


def ad_spec(
    duration: Column | str, genre: Column | str, seconds: Column | str | None = None
) -> Column:
    """Number of cue points a title of this duration and genre should have, as bigint.

    ``seconds`` as in ``duration_band``.
    """
    seconds = whole_number(duration) if seconds is None else as_column(seconds)
    genre = as_column(genre)
    is_movie = genre == MOVIE_GENRE

    def by_genre(movie: int, other: int):
        return movie if movie == other else F.when(is_movie, movie).otherwise(other)

    steps = [(minutes, by_genre(movie, other)) for minutes, movie, other in SPECS]
    spec = (
        F.when(as_column(duration).isNull(), SPEC_WITHOUT_DURATION)
        .when(genre.isNull() | seconds.isNull(), SPEC_WITHOUT_GENRE)
        .otherwise(_by_minutes(seconds, steps, by_genre(*SPEC_ABOVE)))
    )
    return spec.cast("bigint")


def ad_grade(length: Column | str, spec: Column | str) -> Column:
    """Cue count against the expected count; NULL if either is unknown."""
    length, spec = as_column(length), as_column(spec)
    return (
        F.when(length > spec, ABOVE_SPEC)
        .when(length == spec, AT_SPEC)
        .when(length < spec, BELOW_SPEC)
    )


def content_type(raw_type: Column | str) -> Column:
    is_original = F.lower(as_column(raw_type)).contains(ORIGINAL_CONTENT_MARK)
    return F.when(is_original, ORIGINAL_CONTENT).otherwise(OTHER_CONTENT)


def cue_label(length: Column | str) -> Column:
    """Label of a cue point; the text "NULL" (not a null) where the cue count is unknown."""
    return F.when(as_column(length).isNull(), CUE_WITHOUT_LENGTH).otherwise(CUE_WITH_LENGTH)
