import hashlib
import re
from collections import defaultdict

from llm_helpers import docs, tuples
from pyspark.sql import functions as F

from cuebreaks.llm import exact_dedup

ROWS = [
    (5, "a b"), (3, "a  b"), (9, "a\tb"), (4, "a b "), (7, None), (6, ""), (8, "A b"), (None, "n"), (2, "n"),
    (10, " "), (11, "long " * 30000), (12, "long  " * 30000), (13, "a b"), (13, "a b"), (14, " "), (15, "\n\n"), (1, "twice"), (1, "twice"),
]


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[normal(text)].append(doc_id)
    found = []
    for body, ids in groups.items():
        ids.sort(key=lambda i: (i is not None, i or 0))
        digest = hashlib.sha256(body.encode()).hexdigest()
        found += [(i, ids[0], len(ids), k == 0, digest) for k, i in enumerate(ids)]
    return sorted(found, key=repr)


def plain(frame):
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def test_groups_of_odd_texts(spark):
    assert plain(exact_dedup.duplicate_groups(docs(spark, ROWS))) == expected(ROWS)


def test_small_buckets_double_the_directory(spark):
    rows = [(k, f"text {k % 300}") for k in range(900)]
    frame = exact_dedup.duplicate_groups(docs(spark, rows), bucket_keys=20)
    assert plain(frame) == expected(rows)
    buckets = frame.groupBy("bucket").agg(F.count_distinct("text_sha256").alias("n")).collect()
    assert len(buckets) >= 15 and max(b.n for b in buckets) <= 20


def test_only_overfull_buckets_split(spark):
    # Nine keys share the first bit 0, one has 1: the latter's bucket keeps depth 1.
    keys = spark.createDataFrame([(k << 59,) for k in range(9)] + [(-1,)], "hash long")
    depth = exact_dedup.directory_depth(keys, 4)
    slots = exact_dedup.bucket_of(keys, depth, 4)
    found = {r.slot: r.bucket for r in slots.collect()}
    assert depth >= 3
    assert [b for b in found.values() if b.startswith("1:")] == ["1:1"]


def test_colliding_hashes_are_told_apart_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: F.lit(7).cast("long"))
    assert plain(exact_dedup.duplicate_groups(docs(spark, ROWS), bucket_keys=2)) == expected(ROWS)


def test_filter_keeps_whole_rows(spark):
    frame = docs(spark, ROWS)
    kept = exact_dedup.drop_duplicates(frame)
    assert kept.schema == frame.schema
    want = [(r[0],) for r in expected(ROWS) if r[3]]
    assert tuples(kept, "doc_id") == sorted(want, key=lambda r: (r[0] is not None, r[0] or 0))
    assert kept.filter("hash != 'own hash'").count() == 0


def test_empty_table(spark):
    assert exact_dedup.duplicate_groups(docs(spark, [])).count() == 0
    assert exact_dedup.drop_duplicates(docs(spark, [])).count() == 0
