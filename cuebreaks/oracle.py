"""SQL twins of the registered queries, for a second engine to check the results with."""

from __future__ import annotations

INPUTS = """
titles AS (
  SELECT o_orderkey AS k, o_orderdate, o_orderpriority, o_orderstatus, c_name, c_mktsegment
  FROM orders JOIN customer ON c_custkey = o_custkey
),
lines AS (
  SELECT t.k, t.c_name, t.o_orderdate, l_shipdate,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_partkey, l_suppkey,
                            l_extendedprice, l_quantity) AS pos,
         count(*) OVER (PARTITION BY l_orderkey) AS len,
         (t.k * 37) % 12000 + 60 AS d
  FROM lineitem JOIN titles t ON t.k = l_orderkey
),
once AS (
  SELECT k,
         CASE WHEN k % 17 <> 0 THEN c_name END AS "seriesTitle",
         CASE WHEN k % 7 = 3 THEN 'ast' || k
              ELSE 'AST' || k || ['', '_UHDDV', '_HDSDR', '_UHDSDR', '_UHDHDR'][k % 5 + 1]
         END AS "assetExternalID",
         CASE WHEN k % 50 = 1 THEN 'DO NOT USE ' || k
              WHEN k % 97 <> 0 THEN 'Title ' || k END AS "assetName",
         CASE WHEN k % 29 <> 0 THEN d::DOUBLE END AS "assetDuration",
         CASE WHEN k % 31 <> 0 THEN floor(pos * d / (len + 1))::DOUBLE END AS "contentTimePosition",
         CASE WHEN k % 31 <> 0 THEN pos END AS "cuePointPosition",
         CASE WHEN k % 31 <> 0 THEN len END AS "cuePointLength",
         k % 4 AS "seasonNumber",
         k % 7 AS "episodeNumber",
         CASE WHEN k % 13 = 0 THEN l_shipdate
              ELSE TIMESTAMP '9999-12-31 23:59:59' END AS "effectiveTo",
         o_orderdate AS "SDPSnapshotUpdateTimestamp",
         l_shipdate AS "createdAt",
         l_shipdate AS "agingDate"
  FROM lines
),
cues AS (
  SELECT * EXCLUDE (k) FROM once
  UNION ALL
  SELECT * EXCLUDE (k) FROM once WHERE k % 10 = 0
  UNION ALL
  SELECT * EXCLUDE (k) REPLACE ("createdAt" + INTERVAL 1 DAY AS "createdAt")
  FROM once WHERE "seasonNumber" = 2 AND "episodeNumber" = 1
),
corrections AS (
  SELECT upper(c_name) AS fix_series, 'TITLE ' || k AS fix_asset, 9::BIGINT AS fix_season,
         CASE WHEN k % 2 = 0 THEN 9::BIGINT END AS fix_episode
  FROM titles WHERE k % 23 = 0
),
metadata AS (
  SELECT 'ast' || k || CASE WHEN k % 3 = 0 THEN '_HDSDR' ELSE '' END AS "ContentID",
         CASE WHEN k % 6 = 0 THEN NULL WHEN k % 5 = 0 THEN 'Movies' ELSE c_mktsegment
         END AS "Primary_Genre",
         CASE WHEN k % 6 <> 0 THEN o_orderpriority END AS "Secondary_Genre",
         CASE WHEN k % 6 <> 0 THEN o_orderstatus END AS "ProductType",
         CASE WHEN k % 4 = 0 THEN 'D2C Original' ELSE 'Acquired' END AS "TypeOfContent",
         c_mktsegment AS "Distributor"
  FROM titles WHERE k % 19 <> 0
),
-- Fixed values: bounds, labels and specs of the duration bands.
bands (lo, hi, label, movie_spec, other_spec) AS (
  VALUES (-9e15::BIGINT, 600, '< 10', 0, 0), (600, 1200, '10-19', 2, 2),
         (1200, 2400, '20-39', 3, 3), (2400, 3600, '40-59', 5, 5), (3600, 5400, '60-89', 8, 6),
         (5400, 7200, '90-119', 8, 8), (7200, 9000, '120-149', 10, 10),
         (9000, 10800, '150+', 13, 13), (10800, 9e15::BIGINT, '150+', 15, 13)
),
open_cues AS (
  SELECT DISTINCT * FROM cues WHERE year("effectiveTo") = 9999
)"""


def norm(column: str) -> str:
    stripped = column
    # Format suffixes.
    for suffix in ("_UHDDV", "_HDSDR", "_UHDSDR", "_UHDHDR"):
        stripped = f"replace({stripped}, '{suffix}', '')"
    return f"lower({stripped})"


def whole(column: str) -> str:
    return f"try_cast(round({column}) AS BIGINT)"


def two_decimals(expression: str) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(18, 6)), 2) AS DOUBLE)"


def quotient(numerator: str, denominator: str) -> str:
    return f"CAST({numerator}::DOUBLE / nullif({denominator}, 0) AS DECIMAL(38, 9))"


def spec(duration: str, genre: str, band: str) -> str:
    """Expected cue count, given the joined row of ``bands``."""
    return f"""CAST(CASE WHEN {duration} IS NULL THEN 0
        WHEN {genre} IS NULL OR {band}.label IS NULL THEN 13
        WHEN {genre} = 'Movies' THEN {band}.movie_spec ELSE {band}.other_spec END AS BIGINT)"""


def grade(length: str, expected: str) -> str:
    return f"""CASE sign({length} - {expected})
        WHEN 1 THEN 'Above Spec' WHEN 0 THEN 'At Spec' WHEN -1 THEN 'Below Spec' END"""


def in_band(duration: str, band: str) -> str:
    return f"LEFT JOIN bands {band} ON {whole(duration)} >= {band}.lo AND {whole(duration)} < {band}.hi"


SEGMENTS = """CASE WHEN "cuePointLength" IS NULL THEN "assetDuration"
    ELSE ("assetDuration" - "contentTimePosition") / 60 END"""
SEGMENTS_FRACTION = """CASE WHEN "cuePointLength" IS NULL THEN "assetDuration"
    ELSE ("assetDuration" - "contentTimePosition") / nullif("assetDuration", 0) END"""
# The labels of long titles and of origins.
BAND_LABEL = """CASE WHEN "assetDuration" IS NOT NULL THEN coalesce(band.label, '150+') END"""
ORIGIN = """CASE WHEN lower("TypeOfContent") LIKE '%d2c%' THEN 'Peacock Original'
    ELSE 'Others' END"""


def summary(match: str, run_date: str) -> str:
    title_key = 'lower(t."ContentID")' if match == "exact" else norm('t."ContentID"')
    return f"""WITH {INPUTS},
ranked AS (
  SELECT *, dense_rank() OVER (PARTITION BY "seriesTitle", "seasonNumber", "episodeNumber"
                               ORDER BY "SDPSnapshotUpdateTimestamp" DESC NULLS LAST) AS age
  FROM open_cues
),
placed AS (
  SELECT coalesce(lower("seriesTitle"), lower("assetName")) AS series,
         {norm('"assetExternalID"')} AS asset,
         "assetName", "assetDuration", "contentTimePosition", "cuePointLength",
         coalesce("cuePointPosition", 0) AS pos, coalesce("cuePointLength", 0) AS len,
         coalesce(fix_season, "seasonNumber", 0) AS season,
         coalesce(fix_episode, "episodeNumber", 0) AS episode
  FROM ranked LEFT JOIN corrections
    ON lower(fix_series) = lower("seriesTitle") AND lower(fix_asset) = lower("assetName")
  WHERE age = 1
),
described AS (
  SELECT p.*, {SEGMENTS} AS segments, band.label,
         "Primary_Genre", "Secondary_Genre", "ProductType", {ORIGIN} AS origin, "Distributor",
         {spec('"assetDuration"', '"Primary_Genre"', 'band')} AS first_spec
  FROM placed p LEFT JOIN metadata t ON {title_key} = p.asset
  {in_band('p."assetDuration"', 'band')}
),
ends AS (
  SELECT DISTINCT asset, pos, {quotient('first_spec', 'len')} AS mult,
         {quotient('(len + 1)', 'len')} AS one_more
  FROM described
),
longest AS (SELECT asset, max(segments) AS most FROM described GROUP BY asset),
rolled AS (
  SELECT DISTINCT d.*, e.mult, e.one_more, g.most
  FROM described d
  LEFT JOIN ends e ON e.asset = d.asset AND e.pos = d.len
  LEFT JOIN longest g ON g.asset = d.asset
  WHERE lower(d."assetName") NOT LIKE '%do%not%use%'
),
wanting AS (
  SELECT DISTINCT series FROM rolled
  WHERE "Primary_Genre" IS NULL AND "Secondary_Genre" IS NULL AND "ProductType" IS NULL
    AND season <> 0 AND episode <> 0
),
donors AS (
  SELECT series, min("Primary_Genre") AS p, min("Secondary_Genre") AS s, min("ProductType") AS t
  FROM rolled
  WHERE series IN (SELECT series FROM wanting) AND "Primary_Genre" IS NOT NULL
    AND "Secondary_Genre" IS NOT NULL AND "ProductType" IS NOT NULL
  GROUP BY series
),
filled AS (
  SELECT r.* REPLACE (
           CASE WHEN season * episode <> 0 THEN coalesce("Primary_Genre", p)
                ELSE "Primary_Genre" END AS "Primary_Genre",
           CASE WHEN season * episode <> 0 THEN coalesce("Secondary_Genre", s)
                ELSE "Secondary_Genre" END AS "Secondary_Genre",
           CASE WHEN season * episode <> 0 THEN coalesce("ProductType", t)
                ELSE "ProductType" END AS "ProductType")
  FROM rolled r LEFT JOIN donors USING (series)
),
regraded AS (
  SELECT f.*, {spec('"assetDuration"', '"Primary_Genre"', 'band')} AS final_spec, {BAND_LABEL} AS duration
  FROM filled f {in_band('f."assetDuration"', 'band')}
),
breaks AS (
  SELECT series AS "Video_Series_Name", asset AS "assetExternalID", "assetName", "assetDuration",
         {two_decimals('"assetDuration" / 60')} AS "Asset_Duration_minutes",
         len AS "cuePointLength", pos AS "cuePointPosition",
         coalesce("contentTimePosition", 0) AS "contentTimePosition",
         coalesce("contentTimePosition" / 60, 0) AS "Content_Breaks",
         coalesce("contentTimePosition" / nullif("assetDuration", 0), 0) AS "Content_Breaks_percent",
         CASE WHEN "cuePointLength" IS NULL THEN 'NULL' ELSE 'END' END AS ad_cue,
         segments AS "Content_Segments", {SEGMENTS_FRACTION} AS "Content_Segments_percent",
         duration, "Primary_Genre", "Secondary_Genre", "ProductType",
         season AS "SeasonNumber", episode AS "EpisodeNumber", origin AS "TypeOfContent",
         "Distributor", final_spec AS ad_spec, {grade('len', 'final_spec')} AS ad_grade,
         mult AS "Mutiplier", one_more AS "Multiplier_just_one_more",
         most AS "Content_Segments_MAX", most / 2 AS "Content_Segments_MAX_split",
         pos AS "Interval_Segments"
  FROM regraded
  UNION BY NAME
  SELECT series AS "Video_Series_Name", asset AS "assetExternalID", "assetName", "assetDuration",
         len AS "cuePointLength", len + 1 AS "cuePointPosition",
         "assetDuration" AS "contentTimePosition",
         duration, "Primary_Genre", "Secondary_Genre", "ProductType",
         season AS "SeasonNumber", episode AS "EpisodeNumber", origin AS "TypeOfContent",
         final_spec AS ad_spec, {grade('len', 'final_spec')} AS ad_grade,
         len + 1 AS "Interval_Segments"
  FROM regraded
),
followed AS (
  SELECT *, lag("contentTimePosition") OVER (
      PARTITION BY "Video_Series_Name", "SeasonNumber", "EpisodeNumber"
      ORDER BY "cuePointPosition" NULLS FIRST, "assetExternalID" NULLS FIRST,
        "assetName" NULLS FIRST, "contentTimePosition" NULLS FIRST, "assetDuration" NULLS FIRST,
        "cuePointLength" NULLS FIRST, ad_cue NULLS FIRST, "Content_Segments" NULLS FIRST,
        "Primary_Genre" NULLS FIRST, "Secondary_Genre" NULLS FIRST, "ProductType" NULLS FIRST,
        "TypeOfContent" NULLS FIRST, "Distributor" NULLS FIRST, "Mutiplier" NULLS FIRST,
        "Multiplier_just_one_more" NULLS FIRST, "Content_Segments_MAX" NULLS FIRST
    ) AS "Last_contentTimePosition"
  FROM breaks
)
SELECT *, DATE '{run_date}' - 1 AS updated_date,
       {two_decimals('"contentTimePosition" - coalesce("Last_contentTimePosition", 0)')}
         AS "Ad_Breaks_Interval"
FROM followed"""


def _derived(body: str) -> str:
    """SQL over the derived inputs; a body that begins with a comma adds relations of its own."""
    return f"WITH {INPUTS}{body if body.startswith(',') else chr(10) + body}"


# Season, episode and series of every open cue, as several twins below start from.
PLACED = f"""SELECT DISTINCT coalesce(lower("seriesTitle"), lower("assetName")) AS "Video_Series_Name",
    {norm('"assetExternalID"')} AS "assetExternalID", "assetName", "assetDuration",
    coalesce("cuePointLength", 0) AS "cuePointLength",
    coalesce("cuePointPosition", 0) AS "cuePointPosition",
    coalesce("contentTimePosition", 0) AS "contentTimePosition",
    "seasonNumber" AS "SeasonNumber", "episodeNumber" AS "EpisodeNumber"
  FROM open_cues"""

WITH_ENDS = f"""placed AS ({PLACED}),
with_ends AS (
  SELECT *, "cuePointPosition" AS "Interval_Segments" FROM placed
  UNION
  SELECT * REPLACE ("cuePointLength" + 1 AS "cuePointPosition",
                    "assetDuration" AS "contentTimePosition"),
         "cuePointLength" + 1 AS "Interval_Segments"
  FROM placed
)"""

GENRED = f"""placed AS ({PLACED}),
genred AS (
  SELECT DISTINCT p."Video_Series_Name", p."assetExternalID", "SeasonNumber", "EpisodeNumber",
         "Primary_Genre", "Secondary_Genre", "ProductType"
  FROM placed p LEFT JOIN metadata ON lower("ContentID") = p."assetExternalID"
)"""

SPECIFIED = f"""specified AS (
  SELECT DISTINCT c.asset AS "assetExternalID", "assetDuration",
         coalesce("cuePointLength", 0) AS "cuePointLength",
         coalesce("cuePointPosition", 0) AS "cuePointPosition",
         "Primary_Genre", {spec('"assetDuration"', '"Primary_Genre"', 'band')} AS ad_spec
  FROM (SELECT *, {norm('"assetExternalID"')} AS asset FROM open_cues) c
  LEFT JOIN metadata t ON {norm('"ContentID"')} = c.asset
  {in_band('"assetDuration"', 'band')}
)"""


def _metadata_join(key: str) -> str:
    return _derived(f"""SELECT c.*, t.* EXCLUDE ("ContentID")
FROM (SELECT DISTINCT {norm('"assetExternalID"')} AS "assetExternalID", "cuePointPosition"
      FROM open_cues) c
LEFT JOIN (SELECT DISTINCT * REPLACE ({key} AS "ContentID") FROM metadata) t
  ON t."ContentID" = c."assetExternalID" """)


def twins(run_date: str) -> dict[str, str]:
    """SQL by query name."""
    return {
        "scan_open_records": _derived(
            """SELECT * EXCLUDE ("effectiveTo"), year("effectiveTo")::BIGINT AS valid_to_year
FROM open_cues"""
        ),
        "dedup_full_row": "SELECT DISTINCT * FROM lineitem",
        "prune_then_dedup": """SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, l_linestatus
FROM lineitem""",
        "latest_snapshot": """SELECT * FROM orders o WHERE o_orderdate =
  (SELECT max(n.o_orderdate) FROM orders n WHERE n.o_custkey = o.o_custkey)""",
        "latest_snapshot_cues": _derived(
            """SELECT "seriesTitle", "seasonNumber", "episodeNumber", "assetExternalID",
  "cuePointPosition", "SDPSnapshotUpdateTimestamp"
FROM open_cues
QUALIFY "SDPSnapshotUpdateTimestamp" = max("SDPSnapshotUpdateTimestamp")
  OVER (PARTITION BY "seriesTitle", "seasonNumber", "episodeNumber")"""
        ),
        "label_override": _derived(
            """SELECT "seriesTitle", "assetName", "assetExternalID", "cuePointPosition",
  coalesce(fix_season, "seasonNumber") AS "seasonNumber",
  coalesce(fix_episode, "episodeNumber") AS "episodeNumber"
FROM open_cues LEFT JOIN corrections
  ON lower(fix_series) = lower("seriesTitle") AND lower(fix_asset) = lower("assetName")"""
        ),
        "series_name_fallback": _derived(
            """SELECT "seriesTitle", "assetName",
  CASE WHEN "seriesTitle" IS NULL THEN lower("assetName") ELSE lower("seriesTitle")
  END AS "Video_Series_Name" FROM cues"""
        ),
        "normalize_asset_id": _derived(
            f"""SELECT "assetExternalID" AS raw_id, {norm('"assetExternalID"')}
  AS "assetExternalID" FROM cues"""
        ),
        "zero_fill": _derived(
            """SELECT "assetExternalID", ifnull("cuePointLength", 0) AS "cuePointLength",
  ifnull("cuePointPosition", 0) AS "cuePointPosition",
  ifnull("contentTimePosition", 0) AS "contentTimePosition" FROM cues"""
        ),
        "duration_minutes": _derived(
            f"""SELECT "assetDuration", {two_decimals('"assetDuration" / 60')}
  AS "Asset_Duration_minutes" FROM cues"""
        ),
        "break_position": _derived(
            """SELECT "assetExternalID", "cuePointPosition",
  ifnull("contentTimePosition" / 60, 0) AS "Content_Breaks",
  ifnull("contentTimePosition" / nullif("assetDuration", 0), 0) AS "Content_Breaks_percent"
FROM cues"""
        ),
        "cue_label": _derived(
            """SELECT "assetExternalID", "cuePointLength",
  if("cuePointLength" IS NULL, 'NULL', 'END') AS ad_cue FROM cues"""
        ),
        "content_segments": _derived(
            f"""SELECT "assetExternalID", "cuePointPosition", {SEGMENTS} AS "Content_Segments",
  {SEGMENTS_FRACTION} AS "Content_Segments_percent" FROM cues"""
        ),
        "duration_band": _derived(
            f"""SELECT "assetExternalID", "assetDuration", {BAND_LABEL} AS duration
FROM cues {in_band('"assetDuration"', 'band')}"""
        ),
        "content_type": _derived(
            f"""SELECT "ContentID", {ORIGIN} AS "TypeOfContent" FROM metadata"""
        ),
        "exclude_name_pattern": _derived(
            """SELECT "assetExternalID", "assetName", "cuePointPosition" FROM cues
WHERE lower("assetName") NOT LIKE '%do%not%use%'"""
        ),
        "exclude_name_documents": """SELECT * FROM (SELECT * REPLACE (
    CASE WHEN doc_id % 5 = 0 THEN concat(text[1 : length(text) // 2],
      [' DO NOT USE ', ' do-not-use ', ' DoNotUse', ' use not do '][doc_id % 4 + 1],
      text[length(text) // 2 + 1 :]) ELSE text END AS text) FROM documents)
WHERE lower(text) NOT LIKE '%do%not%use%'""",
        "metadata_join_exact": _metadata_join('lower("ContentID")'),
        "metadata_join_normalized": _metadata_join(norm('"ContentID"')),
        "next_position_lookup": """WITH placed AS (
  SELECT l_orderkey, l_extendedprice, row_number() OVER (
    PARTITION BY l_orderkey ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity
  ) AS pos FROM lineitem)
SELECT a.*, b.l_extendedprice AS next_price
FROM placed a LEFT JOIN placed b ON b.l_orderkey = a.l_orderkey AND b.pos - 1 = a.pos""",
        "next_position_lookup_cues": _derived(
            f"""SELECT a."assetExternalID", a."cuePointPosition", a."contentTimePosition", c.next_break
FROM (SELECT DISTINCT "assetExternalID", "cuePointPosition", "contentTimePosition"
      FROM open_cues) a
LEFT JOIN (SELECT DISTINCT {norm('"assetExternalID"')} AS asset, "cuePointPosition" AS pos,
             "contentTimePosition" AS next_break FROM open_cues) c
  ON c.asset = a."assetExternalID" AND c.pos - 1 = a."cuePointPosition" """
        ),
        "terminal_position_lookup": _derived(
            f""", {SPECIFIED}, quotients AS (
  SELECT DISTINCT "assetExternalID" AS asset, "cuePointPosition" AS pos,
         {quotient('ad_spec', '"cuePointLength"')} AS "Mutiplier",
         {quotient('("cuePointLength" + 1)', '"cuePointLength"')} AS "Multiplier_just_one_more"
  FROM specified)
SELECT s.*, q."Mutiplier", q."Multiplier_just_one_more"
FROM specified s LEFT JOIN quotients q
  ON q.asset = s."assetExternalID" AND q.pos = s."cuePointLength" """
        ),
        "group_max_join_back": """SELECT l_orderkey, l_linenumber, l_extendedprice, g.top
    AS max_price, g.top / 2 AS max_price_split
FROM lineitem LEFT JOIN
  (SELECT l_orderkey AS k, max(l_extendedprice) AS top FROM lineitem GROUP BY 1) g
  ON g.k = l_orderkey""",
        "group_max_cues": _derived(
            f"""SELECT c.*, g.most AS "Content_Segments_MAX"
FROM (SELECT {norm('"assetExternalID"')} AS "assetExternalID", "cuePointPosition",
        {SEGMENTS} AS "Content_Segments" FROM open_cues) c
LEFT JOIN (SELECT {norm('"assetExternalID"')} AS asset, max({SEGMENTS}) AS most
           FROM open_cues GROUP BY 1) g ON g.asset = c."assetExternalID" """
        ),
        "series_semi_join": """SELECT * FROM orders WHERE o_custkey IN
  (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
        "group_fallback_fill": _derived(
            f""", {GENRED},
wanting AS (
  SELECT DISTINCT "Video_Series_Name" FROM genred
  WHERE coalesce("Primary_Genre", "Secondary_Genre", "ProductType") IS NULL
    AND "SeasonNumber" <> 0 AND "EpisodeNumber" <> 0
),
donors AS (
  SELECT "Video_Series_Name", min("Primary_Genre") AS p, min("Secondary_Genre") AS s,
         min("ProductType") AS t
  FROM genred SEMI JOIN wanting USING ("Video_Series_Name")
  WHERE "Primary_Genre" IS NOT NULL AND "Secondary_Genre" IS NOT NULL
    AND "ProductType" IS NOT NULL
  GROUP BY ALL
)
SELECT g.* REPLACE (
    CASE WHEN "SeasonNumber" * "EpisodeNumber" <> 0 THEN coalesce("Primary_Genre", p)
         ELSE "Primary_Genre" END AS "Primary_Genre",
    CASE WHEN "SeasonNumber" * "EpisodeNumber" <> 0 THEN coalesce("Secondary_Genre", s)
         ELSE "Secondary_Genre" END AS "Secondary_Genre",
    CASE WHEN "SeasonNumber" * "EpisodeNumber" <> 0 THEN coalesce("ProductType", t)
         ELSE "ProductType" END AS "ProductType")
FROM genred g LEFT JOIN donors USING ("Video_Series_Name")"""
        ),
        "ad_spec": _derived(f", {SPECIFIED}\nSELECT * FROM specified"),
        "ad_grade": _derived(
            f""", {SPECIFIED}
SELECT *, {grade('"cuePointLength"', 'ad_spec')} AS ad_grade FROM specified"""
        ),
        "terminal_row_union": _derived(f", {WITH_ENDS}\nSELECT * FROM with_ends"),
        "break_interval": _derived(
            f""", {WITH_ENDS},
followed AS (
  SELECT *, lag("contentTimePosition") OVER (
      PARTITION BY "Video_Series_Name", "SeasonNumber", "EpisodeNumber"
      ORDER BY "Interval_Segments" NULLS FIRST, "assetExternalID" NULLS FIRST,
        "assetName" NULLS FIRST, "contentTimePosition" NULLS FIRST, "assetDuration" NULLS FIRST,
        "cuePointLength" NULLS FIRST, "cuePointPosition" NULLS FIRST
    ) AS "Last_contentTimePosition"
  FROM with_ends)
SELECT *, {two_decimals('"contentTimePosition" - coalesce("Last_contentTimePosition", 0)')}
  AS "Ad_Breaks_Interval" FROM followed"""
        ),
        "event_gaps": """SELECT event_id, user_id, micros, before AS previous_micros,
  micros - coalesce(before, 0) AS gap_micros
FROM (SELECT *, lag(micros) OVER (PARTITION BY user_id ORDER BY micros, event_id) AS before
      FROM (SELECT event_id, user_id, epoch_us(ts) AS micros FROM events))""",
        "run_date_instants": """SELECT event_id,
  CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS DATE) - 1 AS updated_date FROM events""",
        "run_date_stamp": _derived(
            f"""SELECT "assetExternalID", DATE '{run_date}' - 1 AS updated_date FROM cues"""
        ),
        "presentation_order": "SELECT * FROM orders ORDER BY o_custkey, o_orderdate, o_orderkey",
        "replace_table_roundtrip": _derived(
            """SELECT * EXCLUDE ("effectiveTo") FROM open_cues"""
        ),
        "cue_summary_exact": summary("exact", run_date),
        "cue_summary_normalized": summary("normalized", run_date),
    }
