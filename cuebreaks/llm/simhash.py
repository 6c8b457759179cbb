"""Near duplicates by SimHash fingerprints and a Gray-order hierarchical index.

Fingerprints that differ in at most ``max_bits`` bits agree on at least ``shared`` of ``blocks`` bit blocks when
blocks = max_bits + shared. So every choice of ``shared`` blocks is one mask, and a link shows under some mask
as equal masked bits: the top pattern of the index, and what Spark partitions by. Below it, a task sorts the
fingerprints of each pattern by Gray rank, so neighbours share long bit patterns, and builds nodes upwards: a
node holds the bits that all below it share, less those already in its parent. A search goes down from the
pattern, adds up the differences at each node, and drops the whole group under a node once they exceed ``max_bits``.

Equal fingerprints are one entry. A pattern with more than ``cell`` fingerprints is split by hash, and every pair
of its parts is a cell of its own, so tasks stay bounded and no pair is lost. Cells return a star per linked group,
not all pairs; stars are joined to components by Spark jobs.

Defined cases: NULL text has no words, like an empty one: fingerprint zero. A NULL ``doc_id`` is never the
smallest unless it is alone. Rows alike share fingerprint and component.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuebreaks.llm.components import component_roots
from cuebreaks.llm.inputs import fresh, row_hash, same, ship_package
from cuebreaks.sources.staging import Stage

SHINGLE_WORDS = 3
MAX_BITS = 3
BLOCKS = 5
CELL = 8192
FANOUT = 16

_SLICE = 1 << 21  # candidate pairs that a search step holds, about


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Majority bits of the XXH64 of all word shingles, as an unsigned number."""
    from xxhash import xxh64_intdigest

    listed = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII blanks only
    if not listed:
        return 0
    runs = zip(*(listed[k:] for k in range(words))) if len(listed) >= words else [listed]
    hashes = np.fromiter((xxh64_intdigest(b" ".join(run), 42) for run in runs), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, text_hash, bits`` (signed 64 bits) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.fromiter((fingerprint(t.as_py(), words) for t in batch.column(2)), np.uint64, len(batch))
            columns = [batch.column(0), batch.column(1), pa.array(bits.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "bits"])

    ship_package(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long"), row_hash().alias("text_hash"), F.col("text").cast("string"))
    return source.mapInArrow(run, "doc_id long, text_hash long, bits long")


def masks(max_bits: int, blocks: int) -> list[int]:
    """One 64-bit mask for each choice of blocks that a link must leave equal."""
    borders = [64 * k // blocks for k in range(blocks + 1)]
    block = [(1 << b) - (1 << a) for a, b in zip(borders, borders[1:])]
    return [sum(chosen) for chosen in combinations(block, blocks - max_bits)]


def gray_rank(bits: np.ndarray) -> np.ndarray:
    """Place of each word in Gray order: the number whose Gray code it is."""
    rank = bits.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Search trees over groups of fingerprints; ``group`` numbers are sorted, Gray order inside."""

    def __init__(self, group: np.ndarray, bits: np.ndarray, fanout: int = FANOUT):
        everything = ~np.uint64(0)
        # From the leaves up: first child, bits, mask of the bits shared below, group.
        low, mask = bits, np.full(len(bits), everything)
        levels = [(np.arange(len(bits)), low, mask, group)]
        while True:
            _, low, mask, own = levels[-1]
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            if len(first) == len(own) and len(levels) > 1:
                break
            size = np.diff(np.r_[first, len(own)])
            within = np.arange(len(own)) - np.repeat(first, size)
            head = np.flatnonzero(within % fanout == 0)
            count = np.diff(np.r_[head, len(own)])
            apart = low ^ np.repeat(low[head], count)
            shared = np.bitwise_and.reduceat(mask & ~apart, head)
            levels.append((head, low[head], shared, own[head]))
        self.levels = levels
        # A node keeps only what its parent does not have.
        self.residual = []
        for k, (_, _, mask, _) in enumerate(levels):
            if k + 1 < len(levels):
                head, _, above, _ = levels[k + 1]
                mask = mask & ~np.repeat(above, np.diff(np.r_[head, len(mask)]))
            self.residual.append(mask)
        self.bits = bits
        self.root = np.repeat(np.arange(len(first)), np.diff(np.r_[self._spans()]))

    def _spans(self) -> np.ndarray:
        """First leaf of each root, and the number of leaves."""
        at = np.arange(len(self.levels[-1][0]))
        for head, *_ in reversed(self.levels[1:]):
            at = head[at]
        return np.r_[at, len(self.bits)]

    def links(self, queries: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, leaf) of one group at most ``max_bits`` apart, each found from its earlier leaf."""
        query, node = queries, self.root[queries]
        differ = np.zeros(len(query), np.uint8)
        for k in reversed(range(len(self.levels))):
            _, low, _, _ = self.levels[k]
            differ = differ + np.bitwise_count((self.bits[query] ^ low[node]) & self.residual[k][node])
            near = differ <= max_bits
            query, node, differ = query[near], node[near], differ[near]
            if k == 0:
                break
            head = self.levels[k][0]
            below = len(self.levels[k - 1][1])
            count = np.diff(np.r_[head, below])[node]
            start = np.repeat(head[node] - np.r_[0, np.cumsum(count)[:-1]], count) if len(node) else head[:0]
            query, differ = np.repeat(query, count), np.repeat(differ, count)
            node = start + np.arange(len(start))
        later = node > query
        return query[later], node[later]


def _hook(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the trees of each pair in ``parent``, which stays flat with the least leaf as root."""
    while len(a):
        x, y = parent[a], parent[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        apart = low != high
        a, b = a[apart], b[apart]
        np.minimum.at(parent, high[apart], low[apart])
        while True:
            above = parent[parent]
            if np.array_equal(above, parent):
                break
            parent[:] = above


def stars(group: np.ndarray, bits: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, least leaf of its linked group) for all groups at once."""
    order = np.lexsort((gray_rank(bits), group))
    group, bits = group[order], bits[order]
    first = np.r_[True, group[1:] != group[:-1]]
    alone = first & np.r_[first[1:], True]
    group, bits = group[~alone], bits[~alone]
    if not len(bits):
        return bits, bits
    index = GrayIndex(group, bits)
    parent = np.arange(len(bits))
    sizes = np.diff(index._spans())
    work = np.cumsum(np.repeat(sizes, sizes))  # at most so many leaves are compared
    for queries in np.split(np.arange(len(bits)), np.flatnonzero(np.diff(work // _SLICE)) + 1):
        _hook(parent, *index.links(queries, max_bits))
    linked = parent != np.arange(len(bits))
    return bits[linked], bits[parent[linked]]


def _cell_links(max_bits: int):
    """For rows ``cell, bits`` sorted by cell: whole cells at a time, in batches."""

    def emit(cells: np.ndarray, bits: np.ndarray) -> pa.RecordBatch:
        a, b = stars(cells, bits.view(np.uint64), max_bits)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, bits = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            cells = np.r_[cells, batch.column(0).to_numpy()]
            bits = np.r_[bits, batch.column(1).to_numpy()]
            if not len(cells):
                continue
            done = int(np.searchsorted(cells, cells[-1]))  # the last cell may go on
            if done:
                yield emit(cells[:done], bits[:done])
                cells, bits = cells[done:], bits[done:]
        if len(cells):
            yield emit(cells, bits)

    return run


def fingerprint_links(
    distinct: DataFrame, stage: Stage, max_bits: int = MAX_BITS, blocks: int = BLOCKS, cell: int = CELL
) -> DataFrame:
    """Links ``a, b`` that connect all of the distinct ``bits`` at most ``max_bits`` apart."""
    ship_package(distinct.sparkSession)
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    patterns = F.array(*[
        F.struct(F.lit(k).alias("mask"), F.col("bits").bitwiseAND(F.lit(signed(m))).alias("pattern"))
        for k, m in enumerate(masks(max_bits, blocks))
    ])
    spread = distinct.select("bits", F.explode(patterns).alias("p")).select("bits", "p.mask", "p.pattern")
    large = spread.groupBy("mask", "pattern").count().filter(F.col("count") > cell)
    parts = F.ceil(F.col("count") / cell).cast("int").alias("parts")
    large = stage.write(large.select("mask", "pattern", parts), "large")
    own = F.pmod(F.xxhash64("bits"), F.col("parts"))
    other = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("other")
    split = spread.join(large, ["mask", "pattern"], "left").select("*", other).withColumn("own", F.coalesce(own, F.lit(0)))
    # The cell's number is a hash: two cells of one number are searched as one, which loses nothing.
    number = F.xxhash64("mask", "pattern", F.least("own", "other"), F.greatest("own", "other"))
    cells = split.select(number.alias("cell"), "bits")
    dealt = cells.repartition("cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(_cell_links(max_bits), "a long, b long")


def near_duplicates(
    docs: DataFrame,
    words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    blocks: int = BLOCKS,
    cell: int = CELL,
    stage: Stage | None = None,
) -> DataFrame:
    """One row per document: ``doc_id, text_hash, bits, root, component_id``.

    ``root`` names the component by one of its fingerprints, ``component_id`` by its smallest document.
    """
    stage = stage or Stage(docs.sparkSession)
    marked = stage.write(fingerprints(docs, words), "fingerprints")
    distinct = stage.write(marked.groupBy("bits").agg(F.min("doc_id").alias("least")), "distinct")
    links = fingerprint_links(distinct, stage, max_bits, blocks, cell)
    roots = component_roots(links, stage).select(F.col("node").alias("bits"), "root")
    rooted = distinct.join(roots, "bits", "left").withColumn("root", F.coalesce("root", "bits"))
    rooted = stage.write(rooted, "rooted")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(smallest, "root").select("bits", "root", "component_id")
    return marked.join(classes, "bits").select("doc_id", "text_hash", "bits", "root", "component_id")


def drop_near_duplicates(docs: DataFrame, stage: Stage | None = None, **options) -> DataFrame:
    """The row of each component with the smallest ``doc_id``, with all its columns."""
    stage = stage or Stage(docs.sparkSession)
    found = stage.write(near_duplicates(docs, stage=stage, **options), "found")
    names = {n: fresh(docs.columns, n) for n in ("stays_id", "stays_hash", "own_hash")}
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash")
    stays = found.groupBy("root").agg(F.min(order).alias("first")).select(
        F.col("first.doc_id").alias(names["stays_id"]), F.col("first.text_hash").alias(names["stays_hash"])
    )
    own = names["own_hash"]
    on = same("doc_id", names["stays_id"]) & (F.col(own) == F.col(names["stays_hash"]))
    kept = docs.withColumn(own, row_hash()).join(stays, on, "left_semi")
    repeated = found.groupBy("doc_id", "text_hash").count().filter("count > 1")
    if not repeated.isEmpty():  # rows alike in id and text all match
        kept = kept.dropDuplicates(["doc_id", own])
    return kept.drop(own)
