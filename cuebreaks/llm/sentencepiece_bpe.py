"""Exact SentencePiece encoding of merge-type (BPE) vocabularies by backtracking, and decoding.

Merging joins, again and again, the neighbours whose joint piece has the best score, the leftmost of equal ones. A row of
pieces is what merging would leave exactly if each neighbouring pair of it is: if merging the text of the two alone
leaves these two. So no merge queue over the text is needed:

1. An Aho-Corasick automaton over the vocabulary finds the longest piece that begins at each character.
2. From the left, the longest piece is taken that is compatible with the piece before it; if it is not, the next shorter piece
   that begins the same way is tried. Compatibility is settled by merging the two pieces' text anew, once per pair.
3. Where no piece fits, the position is marked in a bit field as failed, the last piece is taken back, and the search goes on
   with its next shorter one. No piece is taken that ends at a failed position, so each is left once at most.

Blanks are written as U+2581, one is put in front, and a character without a piece becomes its UTF-8 bytes' pieces. Where no
piece of the vocabulary has two characters side by side, a text can be cut between them: that is so before each run of
blanks, and between letters and most marks. Parts seen before are looked up in a table of bounded size.

Defined cases: NULL and empty texts hold the begin and end ids alone; rows alike give the same; an empty table gives none.
A model that is no BPE with byte pieces and plain normalisation is refused with an error.
"""

from __future__ import annotations

import codecs
import re
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuebreaks.llm.inputs import fresh, ship_package

BLANK = "▁"
PARTS_KEPT = 300_000
PART_CHARS = 64
PAIRS_KEPT = 300_000
SLICE_ROWS = 256

# Each byte that is no part of a character gives one replacement character.
codecs.register_error("cuebreaks-each-byte", lambda e: ("�" * (e.end - e.start), e.end))


class Vocabulary(dict):
    """Pieces, scores and searches of one model; as a dict, the ids of parts of text seen before."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        super().__init__()
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = range(model.get_piece_size())
        written = [model.id_to_piece(k) for k in size]
        special = {k for k in size if model.is_control(k) or model.is_unknown(k) or model.is_unused(k)}
        of_byte = [k for k in size if model.is_byte(k)]
        self.begin, self.end = model.bos_id(), model.eos_id()
        self.bytes_from = of_byte[0] if of_byte else -1
        self.pieces = {written[k]: k for k in size if k not in special and not model.is_byte(k)}
        self.written = written
        self.score = {piece: model.get_score(k) for piece, k in self.pieces.items()}
        self.single = frozenset(p for p in self.pieces if len(p) == 1)
        self._check(model, of_byte)

        self.automaton = ahocorasick.Automaton()
        for piece in self.pieces:
            if len(piece) > 1:
                self.automaton.add_word(piece, (len(piece) - 1, piece))
        self.automaton.make_automaton()
        self.parts = re.compile(self._part_pattern()).findall
        self.strange = re.compile(f"([^{re.escape(''.join(self.single))}])").split
        self.shorter: dict[str, str | None] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.shown = [p.replace(BLANK, " ") for p in written]
        for k in special:
            self.shown[k] = " ⁇ " if model.is_unknown(k) else ""
        self.raw = [s.encode() for s in self.shown]
        for byte, k in enumerate(of_byte):
            self.raw[k] = bytes([byte])
        self.hidden = np.array([model.is_control(k) for k in size])

    def _check(self, model, of_byte: list[int]) -> None:
        probe = "   ﬁ①ẛ̣ á  \t\n "
        usable = (
            len(of_byte) == 256
            and of_byte == list(range(of_byte[0], of_byte[0] + 256))
            and min(self.begin, self.end) >= 0
            and all(set(p) <= self.single for p in self.pieces)
            and not any(re.search(f"[^{BLANK}]{BLANK}", p) for p in self.pieces)
            and model.decode(model.encode(probe)) == probe
            and self.merged(BLANK + probe[:1].replace(" ", BLANK)) == model.encode(" ", out_type=str)
        )
        if not usable:
            raise ValueError("not a merge-type model with byte pieces, a blank in front and plain normalisation")

    def _part_pattern(self) -> str:
        """Parts of a text: a word before a mark that no piece has behind a letter, or all up to the next blank."""
        letters = sorted(c for c in self.single if c.isalpha() and c < "\u0250")
        behind = {b for p in self.pieces for a, b in zip(p, p[1:]) if a in letters}
        marks = sorted(c for c in self.single if not c.isalnum() and c not in behind and c != BLANK)
        word, apart = (re.escape("".join(group)) for group in (letters, marks))
        return f"{BLANK}*[{word}]+(?=[{BLANK}{apart}])|{BLANK}+[^{BLANK}]*|[^{BLANK}]+"

    def merged(self, text: str) -> list[str]:
        """What merging leaves of a short text."""
        found = list(text)
        score = self.score
        while len(found) > 1:
            best, at = None, -1
            for k in range(len(found) - 1):
                value = score.get(found[k] + found[k + 1])
                if value is not None and (best is None or value > best):
                    best, at = value, k
            if at < 0:
                break
            found[at : at + 2] = [found[at] + found[at + 1]]
        return found

    def compatible(self, before: str, piece: str) -> bool:
        """Whether merging leaves these two side by side; without one before, whether it leaves the piece whole."""
        key = (before, piece)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > PAIRS_KEPT:
                self.pairs.clear()
            known = self.pairs[key] = self.merged(before + piece) == ([before, piece] if before else [piece])
        return known

    def next_shorter(self, piece: str) -> str | None:
        """The longest other piece that ``piece`` begins with."""
        if piece not in self.shorter:
            n = len(piece) - 1
            while n and piece[:n] not in self.pieces:
                n -= 1
            self.shorter[piece] = piece[:n] or None
        return self.shorter[piece]

    def search(self, text: str) -> list[str]:
        """The pieces of a text whose characters all have one."""
        longest = list(text)
        for last, (before, piece) in self.automaton.iter(text):
            longest[last - before] = piece  # ends come in rising order
        size = len(longest)
        failed = bytearray(size // 8 + 1)
        taken: list[str] = []
        at, piece, before = 0, longest[0], ""
        known = self.pairs.get
        while True:
            stop = at + len(piece)
            if not failed[stop >> 3] >> (stop & 7) & 1:
                fits = known((before, piece))
                if self.compatible(before, piece) if fits is None else fits:
                    taken.append(piece)
                    if stop == size:
                        return taken
                    at, before, piece = stop, piece, longest[stop]
                    continue
            piece = self.next_shorter(piece)
            while piece is None:  # nothing fits here
                failed[at >> 3] |= 1 << (at & 7)
                back = taken.pop()
                at -= len(back)
                before = taken[-1] if taken else ""
                piece = self.next_shorter(back)

    def part(self, text: str) -> bytes:
        """The ids of a part as little-endian 32-bit numbers."""
        ids = array("I")
        for k, run in enumerate([text] if self.single.issuperset(text) else self.strange(text)):
            if k % 2:
                ids.extend(self.bytes_from + b for b in run.encode())
            elif run:
                ids.extend(map(self.pieces.__getitem__, self.search(run)))
        return ids.tobytes()

    def __missing__(self, text: str) -> bytes:
        found = self.part(text)
        if len(text) <= PART_CHARS:
            if len(self) > PARTS_KEPT:
                self.clear()
            self[text] = found
        return found

    def encode(self, text: str) -> bytes:
        """The ids of a whole text, between the begin and the end id."""
        marked = BLANK + text.replace(" ", BLANK) if text else ""
        ids = b"".join(map(self.__getitem__, self.parts(marked)))
        return b"".join((array("I", [self.begin]).tobytes(), ids, array("I", [self.end]).tobytes()))

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; of the blank in front nothing is left."""
        hidden = self.hidden[ids]
        text = ids[~hidden]
        if not len(text):
            return ""
        if ((text >= self.bytes_from) & (text < self.bytes_from + 256)).any():
            runs = np.split(ids, np.flatnonzero(hidden))  # bytes do not join over a control id
            raw = (b"".join(map(self.raw.__getitem__, run.tolist())) for run in runs)
            shown = "".join(r.decode("utf-8", "cuebreaks-each-byte") for r in raw)
        else:
            shown = "".join(map(self.shown.__getitem__, text.tolist()))
        return shown[1:] if self.written[text[0]].startswith(BLANK) else shown


@cache
def vocabulary(path: str) -> Vocabulary:
    """One per Python worker, so its tables outlive a task."""
    return Vocabulary(path)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Few rows at a time, so that no more is held than these give."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(start, SLICE_ROWS)


def encode(
    docs: DataFrame, model: str, keep: list[str] | None = None, name: str = "ids", back: str | None = None
) -> DataFrame:
    """The columns ``keep`` (all by default) of every row and the ids of its text: binary, little-endian, 32 bits each.

    With ``back``, a column of that name has the text that the ids decode to.
    """
    ship_package(docs.sparkSession)
    keep = docs.columns if keep is None else keep
    name = fresh(keep, name)
    added = [F.lit(b"").alias(name)]
    if back:
        added.append(F.lit("").alias(fresh([*keep, name], back)))
    schema = docs.select(*keep, *added).schema
    source = docs.select(*keep, F.col("text").cast("string").alias(fresh(keep, "body")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(model)
        for batch in _slices(batches):
            ids = [words.encode(t.as_py() or "") for t in batch.column(len(keep))]
            found = [pa.array(ids, pa.binary())]
            if back:
                found.append(pa.array([words.decode(np.frombuffer(i, "<u4")) for i in ids], pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *found], schema.names)

    return source.mapInArrow(run, schema)


def decode(encoded: DataFrame, model: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """All columns of every row and the text of its ``ids``; NULL ids are an empty text."""
    ship_package(encoded.sparkSession)
    at = encoded.columns.index(ids)
    schema = encoded.withColumn(fresh(encoded.columns, name), F.lit("")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(model)
        for batch in _slices(batches):
            texts = [words.decode(np.frombuffer(i.as_py() or b"", "<u4")) for i in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], schema.names)

    return encoded.mapInArrow(run, schema)
