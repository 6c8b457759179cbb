import zlib

from llm_helpers import SF, docs, sample_texts

from cuebreaks.llm import sharding
from cuebreaks.llm.queries import QUERIES


def expected(rows, shards, overhead=16):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    sizes = [len((t or "").encode()) + overhead for _, t in ordered]
    total, at, slots, found = sum(sizes), 0, {}, []
    for (doc_id, text), size in zip(ordered, sizes):
        shard = (2 * at + size) * shards // (2 * total)
        slots[shard] = slots.get(shard, -1) + 1
        found.append((doc_id, size, zlib.crc32((text or "").encode()), shard, slots[shard]))
        at += size
    return found


def plain(frame):
    return sorted(tuple(r) for r in frame.select("doc_id", "size", "text_crc32", "shard", "slot").collect())


def test_query_cuts_the_byte_stream_in_equal_parts(spark):
    rows = sample_texts()
    result = QUERIES["op10_sharding"](spark, SF)
    assert plain(result) == sorted(expected(rows, 40))
    assert {tuple(r) for r in result.select("law", "grown_shard").collect()} == {("bytes", None)}


def test_nulls_empty_long_and_wide_characters(spark):
    rows = [(3, None), (1, ""), (2, "x" * 5000), (5, "é中\U0001f600"), (4, "y")]
    assert plain(sharding.shard_by_bytes(docs(spark, rows), shards=3)) == sorted(expected(rows, 3))


def test_repeated_rows_and_one_id_for_all(spark):
    frame = docs(spark, [(7, "same")] * 30 + [(None, "none")] * 3)
    found = sharding.shard_by_bytes(frame, shards=4).collect()
    places = {(r.shard, r.slot) for r in found}
    assert len(places) == 33
    for shard in range(4):
        slots = sorted(slot for s, slot in places if s == shard)
        assert slots == list(range(len(slots))) and 8 <= len(slots) <= 9


def test_empty_table(spark):
    assert sharding.shard_by_bytes(docs(spark, []), shards=4).count() == 0
