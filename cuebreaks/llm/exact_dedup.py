"""Exact duplicates by an extendible-hash index on shared files.

1. Every row gives an index entry: the 64-bit hash of its normalised text and the text's digest.
2. The directory of the index starts at the depth the number of keys asks for and doubles while a
   bucket holds more than ``bucket_keys`` keys. A bucket takes the least depth that keeps it from
   overflowing, so only overfull ones are split. The buckets are ranges of the hash's leading bits.
3. Texts are compared byte by byte: they are grouped by bucket, hash and the text itself, with copies
   merged before the shuffle, however many there are. Different texts of one hash form a chain.
4. The pages (one line per distinct text) are written to the shared folder, each task's sorted by bucket, and looked up by
   the entries by hash and digest.

The bucket is a function of the hash and only labels the pages: no task owns a bucket. Grouping and lookup are dealt by Spark's
own hashes, which do the owners' work.

Defined cases: NULL text is an empty text, a NULL ``doc_id`` counts as smaller than any other, and of
rows alike in ``doc_id`` and text one stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cuebreaks.llm.inputs import SPACE_RUN, fresh, same, text_or_empty
from cuebreaks.sources.staging import Stage

BUCKET_KEYS = 100_000
MAX_DEPTH = 62


def normalised(column: str = "text") -> Column:
    """The text with each run of white space replaced by one space; NULL is empty."""
    return F.regexp_replace(text_or_empty(column), SPACE_RUN, " ")


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _prefix(depth: int) -> Column:
    """The leading ``depth`` bits of a hash, as the number of a directory slot."""
    return F.shiftrightunsigned("hash", 64 - depth) if depth else F.lit(0).cast("long")


def directory_depth(keys: DataFrame, bucket_keys: int = BUCKET_KEYS) -> int:
    """Depth at which no slot holds more than ``bucket_keys`` keys; doubles step by step."""
    total = keys.count()
    depth = 0
    while depth < MAX_DEPTH and total >> depth > bucket_keys:
        depth += 1
    while 0 < depth < MAX_DEPTH:
        fullest = keys.groupBy(_prefix(depth).alias("slot")).count().agg(F.max("count")).first()[0]
        if fullest <= bucket_keys:
            break
        depth += 1
    return depth


def bucket_of(keys: DataFrame, depth: int, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """``slot, bucket``: the buckets behind the directory's slots, by least sufficient local depth."""
    slots = keys.groupBy(_prefix(depth).alias("slot")).agg(F.count("*").alias("n"))
    local = F.lit(depth)
    for shorter in reversed(range(depth)):
        shared = Window.partitionBy(F.shiftright("slot", depth - shorter))
        slots = slots.withColumn(f"n{shorter}", F.sum("n").over(shared))
        local = F.when(F.col(f"n{shorter}") <= bucket_keys, shorter).otherwise(local)
    bucket = F.expr(f"concat_ws(':', local, shiftright(slot, {depth} - local))")
    return slots.withColumn("local", local).select("slot", bucket.alias("bucket"))


def duplicate_groups(
    docs: DataFrame, bucket_keys: int = BUCKET_KEYS, stage: Stage | None = None
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``, ``bucket`` and ``copies``.

    ``copies`` counts the rows alike in id and text.
    """
    stage = stage or Stage(docs.sparkSession)
    text = docs.select("doc_id", normalised().alias("body"))
    keyed = text.withColumn("hash", F.xxhash64("body"))
    entries = stage.write(
        keyed.withColumn("digest", _digest(F.col("body")))
        .groupBy("doc_id", "hash", "digest")
        .agg(F.count("*").alias("copies")),
        "entries",
    )
    keys = entries.select("hash").distinct()
    depth = directory_depth(keys, bucket_keys)
    if depth:
        directory = stage.write(bucket_of(keys, depth, bucket_keys), "directory")
        slotted = keyed.withColumn("slot", _prefix(depth))
        keyed = slotted.join(directory, "slot").drop("slot")
    else:
        keyed = keyed.withColumn("bucket", F.lit("0:0"))

    group = keyed.groupBy("bucket", "hash", "body").agg(
        F.min("doc_id").alias("least"),
        F.max(F.col("doc_id").isNull()).alias("unknown"),
        F.count("*").alias("group_size"),
    )
    pages = group.select(
        "bucket",
        F.col("hash").alias("page_hash"),
        _digest(F.col("body")).alias("page_digest"),
        F.when(~F.col("unknown"), F.col("least")).alias("keep_id"),
        "group_size",
    )
    pages = stage.write(pages.sortWithinPartitions("bucket", "page_hash"), "pages")
    found = entries.join(
        pages, (F.col("hash") == F.col("page_hash")) & (F.col("digest") == F.col("page_digest"))
    )
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return found.select("*", copy.alias("copy")).select(
        "doc_id",
        "keep_id",
        "group_size",
        (same("doc_id", "keep_id") & (F.col("copy") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "bucket",
        "copies",
    )


def drop_duplicates(docs: DataFrame, bucket_keys: int = BUCKET_KEYS, stage: Stage | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    stage = stage or Stage(docs.sparkSession)
    groups = duplicate_groups(docs, bucket_keys, stage).filter("kept")
    taken = docs.columns
    key, digest = fresh(taken, "stays_id"), fresh(taken, "stays_digest")
    stays = groups.select(F.col("doc_id").alias(key), F.unhex("text_sha256").alias(digest), "copies")
    stays = stage.write(stays, "stays")
    own = fresh(taken, "own_digest")
    marked = docs.withColumn(own, _digest(normalised()))
    kept = marked.join(stays, same("doc_id", key) & (F.col(own) == F.col(digest)), "left_semi")
    if not stays.filter("copies > 1").isEmpty():  # rows alike in id and text all match
        kept = kept.dropDuplicates(["doc_id", own])
    return kept.drop(own)
