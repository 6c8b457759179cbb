"""Removes byte strings of ``length`` bytes that occur earlier in the corpus, by sharded suffix arrays.

1. Every window of ``length`` bytes has an anchor: of its grams of ``GRAM`` bytes the one of least hash, the
   leftmost of equals. Equal windows have equal anchors, so they meet if windows are dealt by anchor. The windows
   next to each other that share an anchor occurrence make a segment; only its place and hashes are shuffled.
2. Segments whose anchor occurs once are done. Of segments equal in 128 bits of hash, all but the first are repeats
   from end to end, however many there are; those with an earlier copy in their own task are not even
   compared. Only first ones whose anchor has several different segments need their bytes compared.
3. Those segments are dealt by anchor. A task takes them in shards of whole anchors and sorts the suffixes of each shard by
   external induced sorting (``induced``). Neighbours that share ``length`` bytes or more hold equal windows:
   all but the earliest are repeats.
4. An anchor with more than ``shard_bytes`` of different segments, such as one at the edge of a passage that very
   many documents hold, would outgrow a task. Its segments are taken window by window: equal windows meet by anchor
   and digest, 128 bits of hash, merged to the earliest place before they move.
5. The spans of a document meet its text once more, overlapping ones are joined and cut out.

Defined cases: NULL text is empty; texts of less than ``length`` bytes lose nothing; a NULL ``doc_id`` comes before
all others; rows alike in id and text are one place in the corpus and lose the same bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cuebreaks.llm.induced import Shard
from cuebreaks.llm.inputs import row_hash, same, ship_package
from cuebreaks.sources.staging import Stage

LENGTH = 100
GRAM = 24
SHARD_BYTES = 1 << 22

_PLACE_BITS = 21
_PIECE = 1 << 20
_FREQUENT = 200_000  # segments a task remembers
_HELD_SEGMENTS = 5000  # whose windows' digests a task holds

_SEGMENT = "doc_id long, text_hash long, start long, size int, anchor long, digest long, copied boolean"


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every gram of ``GRAM`` bytes, by joining grams of half the length."""
    hashes, factor, size = data.astype(np.uint64) + np.uint64(1), 0x9E3779B97F4A7C15, 1
    single, one = hashes, factor
    for bit in bin(GRAM)[3:]:
        hashes = hashes[:-size] * np.uint64(factor) + hashes[size:]
        factor, size = factor * factor % 2**64, 2 * size
        if bit == "1":
            hashes = hashes[:-1] * np.uint64(one) + single[size : size + len(hashes) - 1]
            factor, size = factor * one % 2**64, size + 1
    return (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)


def segments(data: bytes, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, last window and anchor hash of each segment in texts laid end to end.

    ``ends`` are the ends of the texts in ``data`` (at most 2**21 bytes); no window reaches over one.
    """
    if len(data) < length:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    hashes = _gram_hashes(np.frombuffer(data, np.uint8))
    place = np.uint64((1 << _PLACE_BITS) - 1)
    least = (hashes & ~place) | np.arange(len(hashes), dtype=np.uint64)
    width, size = length - GRAM + 1, 1
    while 2 * size <= width:
        least, size = np.minimum(least[:-size], least[size:]), 2 * size
    if size < width:
        least = np.minimum(least[: len(least) - (width - size)], least[width - size :])
    anchor = (least & place).astype(np.int64)
    whole = np.zeros(len(anchor) + length, np.int8)
    np.add.at(whole, np.maximum(ends - length + 1, np.r_[0, ends[:-1]]), 1)  # cut off from here
    np.add.at(whole, ends, -1)
    inside = np.cumsum(whole, dtype=np.int64)[: len(anchor)] == 0
    change = anchor[1:] != anchor[:-1]
    first = np.flatnonzero(inside & np.r_[True, change | ~inside[:-1]])
    last = np.flatnonzero(inside & np.r_[change | ~inside[1:], True])
    return first, last, hashes[anchor[first]]


class _Copies:
    """Tells which segments of a task certainly have an earlier copy: one that the task has seen.

    Segments that repeat are remembered with their earliest place, up to a bound; what is not recognised
    here is found by the shuffle. So a very frequent segment sends a few rows per task, not all.
    """

    def __init__(self):
        self.earliest: dict[tuple[int, int], tuple] = {}
        self.anchors = np.empty(0, np.uint64)

    def __call__(self, places: np.ndarray, anchor: np.ndarray, digest: np.ndarray) -> np.ndarray:
        """Flags for segments; a column of ``places``: whether the id is known, id, text's hash, start."""
        copied = np.zeros(len(anchor), bool)
        order = np.argsort(anchor)
        equal = anchor[order][1:] == anchor[order][:-1]
        repeats = np.isin(anchor, self.anchors)
        repeats[order] |= np.r_[False, equal] | np.r_[equal, False] if len(order) else False
        own = np.flatnonzero(repeats)
        if len(own):
            copied[own] = self._copied(places[:, own], anchor[own], digest[own])
        return copied

    def _copied(self, places: np.ndarray, anchor: np.ndarray, digest: np.ndarray) -> np.ndarray:
        order = np.lexsort((*places[::-1], digest, anchor))
        a, d, place = anchor[order], digest[order], places[:, order]
        head = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (d[1:] != d[:-1])])
        size = np.diff(np.r_[head, len(order)])
        # Rows alike are one place: equal to the earliest, they are no copies.
        later = (place != place[:, np.repeat(head, size)]).any(axis=0)
        known = len(self.earliest)
        for pair, n, row in zip(zip(a[head].tolist(), d[head].tolist()), size.tolist(), head.tolist()):
            seen = self.earliest.get(pair)
            if seen is None and (n < 2 or len(self.earliest) >= _FREQUENT):
                continue
            here = tuple(place[:, row].tolist())
            if seen is None or here < seen:
                self.earliest[pair] = here
            elif here > seen:
                later[row : row + n] = True
        if len(self.earliest) > known:
            self.anchors = np.unique(np.fromiter((p[0] for p in self.earliest), np.uint64, len(self.earliest)))
        copied = np.empty(len(order), bool)
        copied[order] = later
        return copied


def _segment_rows(length: int):
    from xxhash import xxh3_64_intdigest

    def rows(held: list[tuple], copies: _Copies) -> pa.RecordBatch:
        """``held``: id, hash, place in the document, and bytes of pieces of documents."""
        data = b"".join(h[3] for h in held)
        ends = np.cumsum([len(h[3]) for h in held])
        first, last, anchors = segments(data, ends, length)
        piece = np.searchsorted(ends, first, "right")
        digest = np.fromiter(
            (xxh3_64_intdigest(data[a : b + length]) for a, b in zip(first.tolist(), last.tolist())),
            np.uint64,
            len(first),
        )
        shift = np.array([h[2] for h in held], np.int64) - np.r_[0, ends[:-1]]
        start = first + shift[piece]
        known = np.array([h[0] is not None for h in held])[piece]
        ids = np.array([h[0] or 0 for h in held], np.int64)[piece]
        hashes = np.array([h[1] for h in held], np.int64)[piece]
        copied = copies(np.stack((known.astype(np.int64), ids, hashes, start)), anchors, digest)
        columns = [
            pa.array(ids, mask=~known),
            pa.array(hashes),
            pa.array(start),
            pa.array((last - first + length).astype(np.int32)),
            pa.array(anchors.view(np.int64)),
            pa.array(digest.view(np.int64)),
            pa.array(copied),
        ]
        names = ["doc_id", "text_hash", "start", "size", "anchor", "digest", "copied"]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, copies = [], 0, _Copies()
        for batch in batches:
            ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc_id, text_hash, body in zip(ids, hashes, batch.column(2)):
                body = body.as_py() or b""
                # A window lies in one piece at least: pieces overlap by one byte less.
                for at in range(0, max(len(body) - length + 1, 0), _PIECE - length + 1):
                    held.append((doc_id, text_hash, at, body[at : at + _PIECE]))
                    size += len(held[-1][3])
                    if size >= _PIECE:
                        yield rows(held, copies)
                        held, size = [], 0
        if held:
            yield rows(held, copies)

    return run


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the listed segments."""
    for batch in batches:
        found: list[tuple] = []
        ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for doc_id, text_hash, body, listed in zip(ids, hashes, batch.column(2), batch.column(3).to_pylist()):
            body = body.as_py()
            found += [
                (s["anchor"], doc_id, text_hash, s["start"], body[s["start"] : s["start"] + s["size"]])
                for s in listed
            ]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        names = ["anchor", "doc_id", "text_hash", "start", "body"]
        columns = zip(*found) if found else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _window_digests(length: int):
    """The digests of all windows of the listed segments, one row per segment."""
    from xxhash import xxh3_64_intdigest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(found: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            names = ["anchor", "doc_id", "text_hash", "start", "digests"]
            columns = zip(*found) if found else [[]] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            found: list[tuple] = []
            ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc_id, text_hash, body, listed in zip(ids, hashes, batch.column(2), batch.column(3)):
                body = body.as_py()
                for s in listed.as_py():
                    places = range(s["start"], s["start"] + s["size"] - length + 1)
                    digests = np.fromiter((xxh3_64_intdigest(body[a : a + length]) for a in places), np.uint64)
                    found.append((s["anchor"], doc_id, text_hash, s["start"], digests.view(np.int64)))
                    if len(found) >= _HELD_SEGMENTS:
                        yield rows(found)
                        found = []
            yield rows(found)

    return run


def repeats_in_shard(document: np.ndarray, start: np.ndarray, bodies: list[bytes], length: int) -> tuple:
    """``segment, first, last``: runs of windows of each segment that repeat an earlier window of the shard.

    ``document`` numbers the documents in their order.
    """
    data = np.frombuffer(b"\0".join(bodies) + b"\0", np.uint8).astype(np.uint16) + 1
    sizes = np.array([len(b) + 1 for b in bodies])
    begin = np.cumsum(sizes) - sizes
    data[begin + sizes - 1] = 0
    # A document is shorter than 2**36 bytes here, or its windows could not be told apart.
    order = (document << 36) + start
    parts = []
    repeat = np.zeros(len(data), bool)

    def settle() -> None:
        """Marks all of a run of equal windows but the earliest."""
        at = np.concatenate(parts)
        segment = np.searchsorted(begin, at, "right") - 1
        place = order[segment] + at - begin[segment]
        repeat[at[place > place.min()]] = True

    for at, shared in Shard(data, length).runs():
        heads = np.flatnonzero(shared < length)
        if not len(heads):
            parts.append(at)
            continue
        parts.append(at[: heads[0]])
        settle() if sum(map(len, parts)) > 1 else None
        # Runs inside the block, all at once.
        inner = at[heads[0] : heads[-1]]
        if len(inner):
            cut = heads[:-1] - heads[0]
            segment = np.searchsorted(begin, inner, "right") - 1
            place = order[segment] + inner - begin[segment]
            least = np.minimum.reduceat(place, cut)
            repeat[inner[place > np.repeat(least, np.diff(np.r_[cut, len(inner)]))]] = True
        parts = [at[heads[-1] :]]
    if sum(map(len, parts)) > 1:
        settle()
    first = np.flatnonzero(repeat & ~np.r_[False, repeat[:-1]])
    last = np.flatnonzero(repeat & ~np.r_[repeat[1:], False])
    segment = np.searchsorted(begin, first, "right") - 1
    return segment, first - begin[segment], last - begin[segment]


def _shard_repeats(length: int, shard_bytes: int):
    def repeats(anchors, ids, hashes, starts, bodies) -> pa.RecordBatch:
        place = [(i is not None, i or 0, h) for i, h in zip(ids, hashes)]
        number = {p: k for k, p in enumerate(sorted(set(place)))}
        document = np.array([number[p] for p in place], np.int64)
        start = np.array(starts, np.int64)
        segment, first, last = repeats_in_shard(document, start, bodies, length)
        taken = pa.array(segment)
        columns = [
            pa.array(ids, pa.int64()).take(taken),
            pa.array(hashes, pa.int64()).take(taken),
            pa.array(start[segment] + first),
            pa.array(start[segment] + last + length),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "start", "stop"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], [], [], [], []]
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= shard_bytes and row[0] != held[0][-1]:
                    yield repeats(*held)
                    held, size = [[], [], [], [], []], 0
                for column, value in zip(held, row):
                    column.append(value)
                size += len(row[4])
        if held[0]:
            yield repeats(*held)

    return run


def _window_repeats(segments: DataFrame, length: int) -> DataFrame:
    """``doc_id, text_hash, start, stop`` of windows that repeat an earlier one; one row of ``segments`` has several."""
    window = segments.select("anchor", "doc_id", "text_hash", "start", F.posexplode("digests").alias("at", "digest"))
    place = F.struct("doc_id", "text_hash", (F.col("start") + F.col("at")).alias("start"))
    window = window.select("anchor", "digest", place.alias("place"))
    # Merged before the shuffle: windows inside a frequent passage are equal in all its documents.
    earliest = window.groupBy("anchor", "digest").agg(F.min("place").alias("earliest"), F.max("place").alias("latest"))
    several = earliest.filter(~F.col("earliest").eqNullSafe(F.col("latest"))).drop("latest")
    later = window.join(several, ["anchor", "digest"]).filter(~F.col("place").eqNullSafe(F.col("earliest")))
    return later.select("place.*", (F.col("place.start") + length).alias("stop"))


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins overlapping spans and cuts them out."""
    for batch in batches:
        spans_out, kept = [], []
        for body, spans in zip(batch.column(1), batch.column(2).to_pylist()):
            body = body.as_py()
            joined: list[list[int]] = []
            for s in sorted(spans or [], key=lambda s: s["start"]):
                if joined and s["start"] <= joined[-1][1]:
                    joined[-1][1] = max(joined[-1][1], s["stop"])
                else:
                    joined.append([s["start"], s["stop"]])
            at, parts = 0, []
            for a, b in joined:
                parts.append(body[at:a])
                at = b
            parts.append(body[at:])
            kept.append(b"".join(parts))
            spans_out.append([{"start": a, "stop": b} for a, b in joined])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        lengths = pa.array([len(b.as_py()) for b in batch.column(1)], pa.int64())
        columns = [batch.column(0), lengths, pa.array(spans_out, kind), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "spans", "kept"])


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES, stage: Stage | None = None
) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, spans`` (removed: ``start, stop``) and ``kept`` (bytes)."""
    ship_package(docs.sparkSession)
    stage = stage or Stage(docs.sparkSession)
    body = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    texts = docs.select(F.col("doc_id").cast("long"), row_hash().alias("text_hash"), body.alias("body"))
    key = ["doc_id", "text_hash"]

    rows = texts.mapInArrow(_segment_rows(length), _SEGMENT)
    # A row that is known to be a copy needs no partners: it is dealt by its place.
    alone = F.when(F.col("copied"), F.xxhash64(*key, "start")).otherwise(F.col("anchor"))
    rows = rows.withColumn("anchor", alone)
    equal = Window.partitionBy("anchor", "digest").orderBy(*key, "start")
    around = Window.partitionBy("anchor")
    ranked = (
        rows.withColumn("first", ~F.col("copied") & (F.rank().over(equal) == 1))
        .withColumn("n", F.count("*").over(around))
        .withColumn("mixed", F.min("digest").over(around) < F.max("digest").over(around))
        .withColumn("crowded", F.sum(F.when(F.col("first"), F.col("size"))).over(around) > shard_bytes)
    )
    found = ranked.filter(F.col("copied") | (F.col("n") > 1) & (~F.col("first") | F.col("mixed")))
    crowded = F.col("first") & F.col("crowded")
    found = found.select(*key, "start", "size", "anchor", "first", crowded.alias("crowded"))
    found = stage.write(found, "segments")

    def beside(listed: DataFrame, how: str) -> DataFrame:
        renamed = listed.withColumnsRenamed({"doc_id": "at_id", "text_hash": "at_hash"})
        on = same("doc_id", "at_id") & (F.col("text_hash") == F.col("at_hash"))
        return texts.join(renamed, on, how)

    def cut(listed: DataFrame) -> DataFrame:
        places = listed.groupBy(*key).agg(F.collect_list(F.struct("start", "size", "anchor")).alias("listed"))
        return beside(places, "inner").select(*key, "body", "listed")

    shards = cut(found.filter("first and not crowded")).mapInArrow(
        _cut_out, "anchor long, doc_id long, text_hash long, start long, body binary"
    )
    dealt = shards.repartition("anchor").sortWithinPartitions("anchor")
    compared = dealt.mapInArrow(
        _shard_repeats(length, shard_bytes), "doc_id long, text_hash long, start long, stop long"
    )
    if not found.filter("crowded").isEmpty():
        digests = cut(found.filter("crowded")).mapInArrow(
            _window_digests(length), "anchor long, doc_id long, text_hash long, start long, digests array<long>"
        )
        compared = compared.union(_window_repeats(stage.write(digests, "windows"), length))
    copied = found.filter("not first").select(*key, "start", (F.col("start") + F.col("size")).alias("stop"))
    spans = copied.union(compared).groupBy(*key).agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    listed = beside(spans, "left").select("doc_id", "body", "spans")
    return listed.mapInArrow(
        _removed, "doc_id long, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary"
    )
