"""Column rules against plain restatements of them."""

import datetime as dt
import random
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from cuebreaks import functions as R

# minutes from, minutes below, label, spec of a movie, spec of anything else
RULES = [
    (float("-inf"), 10, "< 10", 0, 0),
    (10, 20, "10-19", 2, 2),
    (20, 40, "20-39", 3, 3),
    (40, 60, "40-59", 5, 5),
    (60, 90, "60-89", 8, 6),
    (90, 120, "90-119", 8, 8),
    (120, 150, "120-149", 10, 10),
    (150, 180, "150+", 13, 13),
    (180, float("inf"), "150+", 15, 13),
]


def test_bands_and_specs(spark):
    edges = [600, 1200, 2400, 3600, 5400, 7200, 9000, 10800]
    seconds = [-60.0, 0.0, *[e + d for e in edges for d in (-1.0, -0.5, -0.4, 0.0, 1.0)], 1e6]
    rows = [(s, genre) for s in seconds for genre in ("Movies", "movies", "Drama", None)]
    result = spark.createDataFrame(rows, "d double, genre string").select(
        "d", "genre", R.duration_band("d").alias("band"), R.ad_spec("d", "genre").alias("spec")
    )
    for row in result.collect():
        # Python rounds halves to even, the rule away from zero.
        minutes = int(row.d + 0.5 if row.d >= 0 else row.d - 0.5) / 60
        _, _, label, movie, other = next(r for r in RULES if r[0] <= minutes < r[1])
        spec = 13 if row.genre is None else movie if row.genre == "Movies" else other
        assert (row.band, row.spec) == (label, spec), row


def test_duration_that_is_missing_or_not_a_number(spark):
    rows = [(None, "Movies"), (float("nan"), "Movies"), (1e300, "Drama")]
    result = spark.createDataFrame(rows, "d double, genre string").select(
        R.duration_band("d").alias("band"), R.ad_spec("d", "genre").alias("spec")
    )
    assert [tuple(row) for row in result.collect()] == [(None, 0), ("150+", 13), ("150+", 13)]


def test_given_seconds_change_nothing(spark):
    frame = spark.range(0, 12000, 7).select(F.col("id").cast("double").alias("d"))
    frame = frame.withColumn("s", R.whole_number("d")).withColumn("g", F.lit("Movies"))
    same = frame.filter(
        (R.ad_spec("d", "g") == R.ad_spec("d", "g", "s"))
        & (R.duration_band("d") == R.duration_band("d", "s"))
    )
    assert same.count() == frame.count()


def test_grades(spark):
    frame = spark.createDataFrame([(4, 3), (3, 3), (2, 3), (None, 3), (2, None)], "n long, s long")
    grades = [row[0] for row in frame.select(R.ad_grade("n", "s")).collect()]
    assert grades == ["Above Spec", "At Spec", "Below Spec", None, None]


def test_asset_ids(spark):
    ids = {
        "AST1_UHDDV": "ast1",
        "AST1_HDSDR": "ast1",
        "AST1_UHDSDR": "ast1",
        "AST1_UHDHDR": "ast1",
        "AST1_uhddv": "ast1_uhddv",
        "A_HDSDRB_HDSDR": "ab",
        # The suffixes go one after the other: what a later removal leaves is not looked at again.
        "X_UH_HDSDRDDV": "x_uhddv",
        "X_UHD_HDSDRSDR": "x",
        None: None,
    }
    frame = spark.createDataFrame([(k,) for k in ids], "id string")
    got = {r.id: r.n for r in frame.select("id", R.normalize_asset_id("id").alias("n")).collect()}
    assert got == ids


def test_names_match_like_and_stay_fast_on_long_text(spark):
    rng = random.Random(7)
    texts = [
        "".join(rng.choice(["do", "not", "use", "x", " ", "\n", "NO", "T", "%"]) for _ in range(n))
        for n in range(1, 60)
        for _ in range(5)
    ]
    frame = spark.createDataFrame([(t,) for t in [*texts, "", None]], "t string")
    differ = frame.filter(
        ~R.usable_name("t").eqNullSafe(~F.lower("t").like("%do%not%use%"))
    )
    assert differ.count() == 0
    # Thousands of "do" and "not" without a "use" behind them.
    long = spark.createDataFrame([("do not " * 40_000,)], "t string")
    assert long.filter(R.usable_name("t")).count() == 1


def test_series_name(spark):
    rows = [("The Show", "Part 1"), (None, "FILM"), (None, None)]
    frame = spark.createDataFrame(rows, "s string, a string").select(R.series_name("s", "a"))
    assert [row[0] for row in frame.collect()] == ["the show", "film", None]


def test_quotients(spark):
    rows = [(13, 3), (5, 3), (1, 0), (7, None), (2**62, 1)]
    frame = spark.createDataFrame(rows, "a long, b long")
    shown = [row[0] for row in frame.select(R.decimal_quotient("a", "b").cast("string")).collect()]
    assert shown == ["4.333333333", "1.666666667", None, None, f"{2**62}.000000000"]


def test_whole_numbers_round_away_from_zero(spark):
    values = {2.5: 3, 3.5: 4, -2.5: -3, 2.4: 2, float("nan"): None, 1e300: None}
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in frame.select(R.whole_number("v")).collect()] == list(values.values())


def test_minutes_round_by_decimal_value(spark):
    frame = spark.createDataFrame([(60.3,), (90.0,), (None,)], "s double")
    assert [r[0] for r in frame.select(R.duration_minutes("s")).collect()] == [1.01, 1.5, None]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/Los_Angeles"])
def test_run_date_follows_new_york_in_any_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    begun = dt.datetime.now(ZoneInfo("America/New_York")).date()
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        stamp = spark.range(1).select(R.run_date_stamp()).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    after = dt.datetime.now(ZoneInfo("America/New_York")).date()
    assert stamp + dt.timedelta(days=1) in {begun, after}


# Fixed moments: around midnight in New York, in winter and summer and at both clock changes.
@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York", "Europe/London"])
@pytest.mark.parametrize(
    "utc, stamp",
    [
        ("2024-01-02 03:00:00", "2023-12-31"), ("2024-01-02 04:30:00", "2023-12-31"),
        ("2024-01-02 05:00:00", "2024-01-01"), ("2024-07-02 03:59:59.999999", "2024-06-30"),
        ("2024-07-02 04:00:00", "2024-07-01"), ("2024-03-10 04:59:59", "2024-03-08"),
        ("2024-03-10 05:00:00", "2024-03-09"), ("2024-03-11 03:59:59", "2024-03-09"),
        ("2024-03-11 04:00:00", "2024-03-10"), ("2024-11-03 03:59:59", "2024-11-01"),
        ("2024-11-03 04:00:00", "2024-11-02"), ("2024-11-04 04:59:59", "2024-11-02"),
        ("2024-11-04 05:00:00", "2024-11-03"),
    ],
)
def test_run_date_at_fixed_moments(spark, zone, utc, stamp):
    moment = dt.datetime.fromisoformat(utc).replace(tzinfo=dt.timezone.utc)
    micros = (moment - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        instant = F.timestamp_micros(F.col("id") * 0 + micros)
        found = spark.range(1).select(R.run_date_stamp(instant=instant)).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found == dt.date.fromisoformat(stamp)

