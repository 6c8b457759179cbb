"""Packs documents into token windows by Karmarkar-Karp multiway differencing.

1. Tasks turn texts into ids. Pieces of text seen before are looked up in a table, only new ones go
   to the tokenizer. That gives the same ids, as its rules never reach over a piece's borders.
2. A document is cut: whole windows first, then what is left into pieces of at most ``max_piece`` ids. Only
   numbers move on: place, length and checksum of each piece.
3. Pieces are dealt by hash into blocks of about ``block_windows`` windows, so a task holds one block at
   a time. Within a block each piece starts as a partition of m windows, one filled. The two partitions
   with the widest spread are merged, fullest windows with emptiest, until one partition is left: m windows
   of nearly equal fill. If its fullest exceeds the capacity, m rises and the block is done anew.

Defined cases: NULL and empty texts hold the end id alone; rows alike are packed each; ties go by piece
order; an empty table gives no piece.
"""

from __future__ import annotations

import heapq
import re
import sys
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuebreaks.llm.inputs import ship_package
from cuebreaks.sources.staging import Stage

CAPACITY = 4096
MAX_PIECE = 1024
BLOCK_WINDOWS = 128
END_ID = 2
PIECES_KEPT = 500_000

PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED_SCHEMA = f"{PIECE_SCHEMA}, sequence_id long, offset long"


def _is_latin(text: str) -> bool:
    """No character beyond Latin-1, so none that combines with others or folds in an odd way."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def unsafe_letters() -> str:
    """Letters that composing and lower-casing turn into something that ends in no letter, as U+09DF or U+0130."""
    letters = (c for c in map(chr, range(0xC0, sys.maxunicode + 1)) if c.isalpha())
    return "".join(c for c in letters if not unicodedata.normalize("NFC", c).lower()[-1].isalpha())


class Tokens(dict):
    """Ids of pieces of text as little-endian 32-bit numbers, kept up to a bound; of a text when called.

    The vocabulary's rules split at white space and between letters and a lone mark, so these borders
    can be cut first, unless the rules make a combining mark of the letter's end. A piece of plain Latin letters is one word to them: it goes straight to the
    tokenizer's model, in the byte alphabet. All other pieces take the tokenizer's whole way.
    """

    _mark = re.compile(rf"[.,;:!?](?<=[^\W\d_{unsafe_letters()}].)(?=[ \n])")
    _letters = re.compile("[a-zà-öø-ÿ]+").fullmatch

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__({"": b""})
        self.tokenizer = Tokenizer.from_file(path)
        self.word = self.tokenizer.model.tokenize
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}  # bytes that stand for themselves
        hidden = (b for b in range(256) if b not in shown)
        self.alphabet = {b: 256 + k for k, b in enumerate(hidden)}

    def __call__(self, text: str) -> bytes:
        if len(self) > PIECES_KEPT:
            self.clear()
            self[""] = b""
        if "<|" not in text and _is_latin(text):
            text = text.lower()  # what the rules do to these characters; it must not forge a control string
        spaced = self._mark.sub(r" \g<0>", text).replace("\n", " ")
        return b"".join(map(self.__getitem__, spaced.split(" ")))

    def __missing__(self, piece: str) -> bytes:
        low = piece.lower()
        if self._letters(low):
            if not low.isascii():
                low = low.encode().decode("latin-1").translate(self.alphabet)
            ids = [t.id for t in self.word(low)]
        else:
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        found = self[piece] = array("I", ids).tobytes()
        return found


@cache
def tokens_of(path: str) -> Tokens:
    """One per Python worker, so its table outlives a task."""
    return Tokens(path)


def cuts(tokens: int, capacity: int, max_piece: int) -> list[int]:
    """Borders of a document's pieces: whole windows, then equal pieces of at most ``max_piece``."""
    whole = tokens - tokens % capacity
    left = tokens - whole
    parts = -(-left // max_piece)
    return [*range(0, whole, capacity), *(whole + left * k // parts for k in range(parts)), tokens]


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, max_piece: int = MAX_PIECE
) -> DataFrame:
    """The pieces of every document; the end id counts as its last one."""

    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(tokenizer)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = memoryview(tokens(text.as_py() or "") + end)
                borders = cuts(len(ids) // 4, capacity, max_piece)
                for a, b in zip(borders, borders[1:]):
                    rows.append((doc_id, a, b - a, zlib.crc32(ids[4 * a : 4 * b]), len(ids) // 4))
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            columns = [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 5)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, PIECE_SCHEMA
    )


def difference(lengths: list[int], windows: int) -> list[list[int]]:
    """Multiway differencing: which items go to which of ``windows`` windows, nearly equal sums.

    A partial partition keeps its sums in falling order. Items of a window hang together as a chain
    of links, so a merge costs one sort of ``windows`` numbers.
    """
    if windows == 1:
        return [list(range(len(lengths)))]
    links: list[tuple[int, int]] = []  # joined chains; a chain is an item or, beyond, a link
    items = len(lengths)
    # (minus spread, order) on the heap; sums and chains of the filled windows only
    heap: list[tuple[int, int, np.ndarray, np.ndarray]] = [
        (-n, k, np.array([n]), np.array([k])) for k, n in enumerate(lengths)
    ]
    heapq.heapify(heap)
    order = items
    while len(heap) > 1:
        _, _, a_sums, a_chains = heapq.heappop(heap)
        _, _, b_sums, b_chains = heapq.heappop(heap)
        overlap = len(a_sums) + len(b_sums) - windows
        if overlap <= 0:  # each fills windows that are empty in the other
            sums, chains = np.concatenate((a_sums, b_sums)), np.concatenate((a_chains, b_chains))
        else:
            free_a = len(a_sums) - overlap
            free_b = len(b_sums) - overlap
            tail_b = slice(free_b, None)
            joined = range(items + len(links), items + len(links) + overlap)
            links.extend(zip(a_chains[free_a:].tolist(), b_chains[tail_b][::-1].tolist()))
            sums = np.concatenate(
                (a_sums[:free_a], b_sums[:free_b], a_sums[free_a:] + b_sums[tail_b][::-1])
            )
            chains = np.concatenate((a_chains[:free_a], b_chains[:free_b], np.array(joined)))
        rank = np.argsort(-sums, kind="stable")
        sums, chains = sums[rank], chains[rank]
        least = int(sums[-1]) if len(sums) == windows else 0
        heapq.heappush(heap, (least - int(sums[0]), order, sums, chains))
        order += 1
    found = []
    for chain in heap[0][3].tolist():
        window, todo = [], [chain]
        while todo:
            at = todo.pop()
            if at < items:
                window.append(at)
            else:
                todo.extend(links[at - items])
        found.append(sorted(window))
    return found


def fill_windows(lengths: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most ``capacity``: full items alone, the rest by differencing."""
    full = [[k] for k, n in enumerate(lengths) if n == capacity]
    rest = [k for k, n in enumerate(lengths) if n < capacity]
    if not rest:
        return full
    sizes = [lengths[k] for k in rest]
    windows = -(-sum(sizes) // capacity)
    while True:
        found = difference(sizes, windows)
        if max(sum(sizes[k] for k in window) for window in found) <= capacity:
            return full + [[rest[k] for k in window] for window in found]
        windows += 1


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    max_piece: int = MAX_PIECE,
    block_windows: int = BLOCK_WINDOWS,
    stage: Stage | None = None,
) -> DataFrame:
    """One row per piece, with the window (``sequence_id``) it lies in and its ``offset`` there."""
    stage = stage or Stage(docs.sparkSession)
    pieces = stage.write(token_pieces(docs, tokenizer, capacity, max_piece), "pieces")
    total = pieces.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    blocks = max(1, -(-total // (capacity * block_windows)))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "start", "row"], kind="stable", ignore_index=True)
        lengths = frame["length"].to_numpy()
        sequence = np.zeros(len(frame), "int64")
        offset = np.zeros(len(frame), "int64")
        for k, window in enumerate(fill_windows(lengths.tolist(), capacity)):
            sequence[window] = k
            offset[window] = np.cumsum(lengths[window]) - lengths[window]
        # A block has far fewer windows than 2**32: one at most for each of its rows.
        frame["sequence_id"] = (int(frame["block"].iloc[0]) << 32) + sequence
        frame["offset"] = offset
        return frame.drop(columns=["row", "block"])

    row = F.monotonically_increasing_id().alias("row")
    dealt = pieces.select("*", row).withColumn(
        "block", F.pmod(F.xxhash64("doc_id", "start", "row"), F.lit(blocks))
    )
    return dealt.groupBy("block").applyInPandas(run, PACKED_SCHEMA)
