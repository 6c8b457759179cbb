"""Cue-point inputs derived from the star-schema test tables.

Every line item becomes a cue point of the title its order stands for. The expressions
bring in what real inputs have: closed versions, copies, missing values, format
suffixes, retired names, titles without metadata.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cuebreaks.operators.intervals import numbered_in_order
from cuebreaks.operators.skew import HOT_ROWS, hot_keys, join_on
from cuebreaks.sources.schemas import METADATA_UNUSED
from cuebreaks.sources.staging import Stage

LINE_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")


class CueInputs(NamedTuple):
    cues: DataFrame
    corrections: DataFrame
    metadata: DataFrame


# Test inputs only: kept for the life of the application, so that each query reads the same files.
_STAGED: dict[tuple[str, str, str], DataFrame] = {}


def _text(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), key.cast("string"))


def _titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).withColumn(
        "k", F.col("o_orderkey")
    )


def derive_cues(spark: SparkSession, sf_dir: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", *LINE_ORDER)
    hot = hot_keys(lines, ["l_orderkey"], hot_rows)
    titles = _titles(spark, sf_dir).select("k", "c_name", "o_orderdate")
    titled = join_on(lines, titles, [("l_orderkey", "k")], how="inner", hot=hot)
    base = numbered_in_order(titled, ["l_orderkey"], LINE_ORDER, "pos", "len", hot).withColumn(
        "k", F.col("l_orderkey")
    )

    k, pos, length = F.col("k"), F.col("pos"), F.col("len")
    seconds = (k * 37) % 12000 + 60
    suffix = (
        F.when(k % 5 == 0, "")
        .when(k % 5 == 1, "_UHDDV")
        .when(k % 5 == 2, "_HDSDR")
        .when(k % 5 == 3, "_UHDSDR")
        .otherwise("_UHDHDR")
    )
    has_cues = k % 31 != 0
    cues = base.select(
        F.when(k % 17 != 0, F.col("c_name")).alias("seriesTitle"),
        F.when(k % 7 == 3, _text("ast", k))
        .otherwise(F.concat(_text("AST", k), suffix))
        .alias("assetExternalID"),
        F.when(k % 50 == 1, _text("DO NOT USE ", k))
        .when(k % 97 == 0, F.lit(None).cast("string"))
        .otherwise(_text("Title ", k))
        .alias("assetName"),
        F.when(k % 29 != 0, seconds.cast("double")).alias("assetDuration"),
        F.when(has_cues, F.floor(pos * seconds / (length + 1)).cast("double")).alias(
            "contentTimePosition"
        ),
        F.when(has_cues, pos).alias("cuePointPosition"),
        F.when(has_cues, length).alias("cuePointLength"),
        (k % 4).alias("seasonNumber"),
        (k % 7).alias("episodeNumber"),
        F.when(k % 13 == 0, F.col("l_shipdate"))
        .otherwise(F.lit("9999-12-31 23:59:59").cast("timestamp_ntz"))
        .alias("effectiveTo"),
        F.col("o_orderdate").alias("SDPSnapshotUpdateTimestamp"),
        F.col("l_shipdate").alias("createdAt"),
        F.col("l_shipdate").alias("agingDate"),
        k.alias("_k"),
    )
    # Copies: every row once; again for each tenth title; and again, a day later, for S2E1.
    near_copy = (F.col("seasonNumber") == 2) & (F.col("episodeNumber") == 1)
    copies = F.array_compact(
        F.array(F.lit(0), F.when(F.col("_k") % 10 == 0, 1), F.when(near_copy, 2))
    )
    later = F.col("createdAt") + F.expr("interval 1 day")
    return (
        cues.withColumn("_copy", F.explode(copies))
        .withColumn("createdAt", F.when(F.col("_copy") == 2, later).otherwise(F.col("createdAt")))
        .drop("_k", "_copy")
    )


def derive_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    return (
        _titles(spark, sf_dir)
        .filter(k % 23 == 0)
        .select(
            F.upper("c_name").alias("Video_Series_Name"),
            _text("TITLE ", k).alias("Asset_Name"),
            F.lit(9).cast("bigint").alias("Season"),
            F.when(k % 2 == 0, F.lit(9).cast("bigint")).alias("Episode"),
        )
    )


def derive_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    described = k % 6 != 0
    return (
        _titles(spark, sf_dir)
        .filter(k % 19 != 0)
        .select(
            F.when(k % 3 == 0, F.concat(_text("ast", k), F.lit("_HDSDR")))
            .otherwise(_text("ast", k))
            .alias("ContentID"),
            F.when(described & (k % 5 == 0), "Movies")
            .when(described, F.col("c_mktsegment"))
            .alias("Primary_Genre"),
            F.when(described, F.col("o_orderpriority")).alias("Secondary_Genre"),
            F.when(described, F.col("o_orderstatus")).alias("ProductType"),
            F.when(k % 4 == 0, "D2C Original").otherwise("Acquired").alias("TypeOfContent"),
            F.col("c_mktsegment").alias("Distributor"),
            *[F.col("c_mktsegment").alias(c) for c in METADATA_UNUSED],
        )
    )


_DERIVE = {"cues": derive_cues, "corrections": derive_corrections, "metadata": derive_metadata}


def cue_input(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the inputs as a written table, derived once per application and scale."""
    key = (spark.conf.get("spark.app.id"), sf_dir, name)
    if key not in _STAGED:
        _STAGED[key] = Stage(spark, lasting=True).write(_DERIVE[name](spark, sf_dir), name)
    return _STAGED[key]


def cue_inputs(spark: SparkSession, sf_dir: str) -> CueInputs:
    """All three inputs; a query that reads cues only takes ``cue_input`` and does not wait for the others."""
    return CueInputs(*[cue_input(spark, sf_dir, name) for name in CueInputs._fields])
