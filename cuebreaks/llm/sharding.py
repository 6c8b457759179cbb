"""Contiguous shards of nearly equal bytes, cut by a distributed prefix sum.

Rows are put in ``doc_id`` order by a range shuffle of a few numbers per row, never of texts.
Each range partition gives one total; the running sum of the totals, one row per partition,
is the only relation that is handled in one place. Added to the running sum inside a partition it
gives the place of each row in the whole byte stream, which is cut at equal targets.

Defined cases: NULL text counts 16 bytes, NULL ``doc_id`` comes first, rows alike in every
column each get a slot of their own, and a document larger than a target leaves shards empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cuebreaks.llm.inputs import text_or_empty
from cuebreaks.sources.staging import Stage

ROW_OVERHEAD = 16


def shard_by_bytes(
    docs: DataFrame, shards: int = 40, overhead: int = ROW_OVERHEAD, stage: Stage | None = None
) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, shard, slot``.

    A document belongs to the shard in whose equal share of all bytes its middle byte lies, so
    sizes differ from the target by less than one document. ``slot`` counts from 0 in ``doc_id`` order.
    """
    stage = stage or Stage(docs.sparkSession)
    text = text_or_empty()
    sized = docs.select(
        "doc_id",
        (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"),
    )
    # The row number separates equal ids, so no id can fill a range partition by itself.
    ordered = stage.write(sized, "sizes").repartitionByRange("doc_id", "row")
    ordered = stage.write(ordered.withColumn("part", F.spark_partition_id()), "ordered")

    totals = ordered.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(whole).alias("all_bytes"),
    )
    inside = Window.partitionBy("part").orderBy("doc_id", "row")
    placed = (
        ordered.withColumn("end_inside", F.sum("size").over(inside))
        .withColumn("index_inside", F.row_number().over(inside) - 1)
        .join(F.broadcast(offsets), "part")  # one row per range partition
        .withColumn("middle", (F.col("bytes_before") + F.col("end_inside")) * 2 - F.col("size"))
        .withColumn("shard", F.expr(f"cast((middle * {shards}) div (2 * all_bytes) as int)"))
        .withColumn("index", F.col("rows_before") + F.col("index_inside"))
        .select("doc_id", "size", "text_crc32", "shard", "index")
    )
    placed = stage.write(placed, "placed")
    first = placed.groupBy("shard").agg(F.min("index").alias("first"))
    return placed.join(F.broadcast(first), "shard").select(  # one row per shard
        "doc_id", "size", "text_crc32", "shard", (F.col("index") - F.col("first")).alias("slot")
    )
