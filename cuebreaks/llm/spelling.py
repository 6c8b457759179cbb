"""Groups spelling variants: words that differ by one letter hang on the far more frequent one.

1. Tasks cut texts into words, garble a fixed share of them as the contract of the query asks, and count
   them; counts are combined before and after the shuffle.
2. Two words one edit apart differ in the counts of two letters at most. The letters are dealt into ``PARTS`` parts, so
   the counts of all but two parts are equal. Each word is entered once for every choice of ``PARTS - 2`` parts
   under these counts: that cuts the vocabulary into small groups in which every near pair meets.
3. Within groups, blocks of words become matrices of letter counts. A NumPy product (Gram matrix) gives the squared
   distances of whole blocks: those of at most two between words of equal or adjacent length are candidates. A pair counts under the
   first choice of parts only that it shares, and its edit is verified letter by letter.
4. A word's form is its near word of largest count, if that is at least ``factor`` times its own. Forms are followed to the
   last by doubling steps, written to the shared folder each.

A group of more than ``GROUP_ROWS`` words is dealt into parts by hash and each pair of parts is compared in a task of its own;
no word or pair is dropped. Rows move by word, by group, and by word of a pair.

Defined cases: NULL texts have no words; a NULL ``doc_id`` counts as an empty number; rows alike count each; ties go to the
word of smaller code points; an empty table gives no word.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuebreaks.llm.inputs import ship_package
from cuebreaks.sources.staging import Stage

LEAST_LETTERS = 5
LEAST_COUNT = 3
FACTOR = 2
GARBLED = 97

PARTS = 5
GROUP_ROWS = 8192
TILE = 1024
SMALL = 96
SHOWN = 24
OCCURRENCES, DOCUMENTS = 1 << 20, 1 << 14
WORDS_KEPT = 500_000

ALPHABET = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
_RUNS = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
CHOICES = tuple(combinations(range(PARTS), PARTS - 2))


def _crc_table() -> np.ndarray:
    """The checksum's steps by one byte."""
    steps = np.arange(256, dtype="uint32")
    for _ in range(8):
        steps = np.where(steps & 1, (steps >> 1) ^ np.uint32(0xEDB88320), steps >> 1)
    return steps


class Words(dict):
    """Numbers of runs seen, with what a count of their occurrences needs; filled by looking runs up."""

    LONGEST = 64  # bytes; longer runs are summed one by one

    def __init__(self):
        super().__init__()
        self.runs: list[str] = []
        self.sums: list[int] = []
        self.sizes: list[int] = []

    def __missing__(self, run: str) -> int:
        low = run.lower() if run.isascii() else run.translate(_LOWER)
        number = self.get(low) if low != run else None
        if number is None:
            number = len(self.runs)
            body = low.encode()
            self.runs.append(low)
            self.sums.append(zlib.crc32(body))
            self.sizes.append(len(body))
        self[run] = self[low] = number
        return number


class Tally:
    """Counts words, garbled where the checksum of ``<doc_id>:<run>`` is a multiple of ``garbled``.

    The checksum of a joined text follows from those of both parts and the length of the second, so occurrences are
    judged as arrays.
    """

    _steps = _crc_table()

    def __init__(self, garbled: int):
        self.garbled = garbled
        self._begin()

    def _begin(self) -> None:
        self.words = Words()
        self.counts = np.zeros(0, "int64")
        self.changed: Counter[str] = Counter()
        self.prefixes: list[int] = []
        self.docs: list[int] = []
        self.seen: list[np.ndarray] = []
        self.pending = 0

    def add(self, doc_id: int | None, text: str) -> None:
        found = np.fromiter(map(self.words.__getitem__, _RUNS.findall(text)), "int32")
        self.prefixes.append(zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()))
        self.docs.append(len(found))
        self.seen.append(found)
        self.pending += len(found)
        if self.pending >= OCCURRENCES or len(self.docs) >= DOCUMENTS:
            self.settle()

    def settle(self) -> None:
        """Count what has been added."""
        if self.pending:
            seen = np.concatenate(self.seen)
            doc = np.repeat(np.arange(len(self.docs)), self.docs)
            sums, sizes = np.array(self.words.sums, "uint32"), np.array(self.words.sizes)
            longest = min(int(sizes.max()), Words.LONGEST)
            moved = np.zeros((longest + 1, len(self.docs)), "uint32")
            moved[0] = self.prefixes
            for n in range(longest):
                moved[n + 1] = self._steps[moved[n] & 255] ^ (moved[n] >> 8)
            size = sizes[seen]
            checks = moved[np.minimum(size, longest), doc] ^ sums[seen]
            for k in np.flatnonzero(size > longest):
                checks[k] = zlib.crc32(self.words.runs[seen[k]].encode(), self.prefixes[doc[k]])
            hit = checks % self.garbled == 0
            counts = np.bincount(seen[~hit], minlength=len(self.words.runs))
            counts[: len(self.counts)] += self.counts
            self.counts = counts
            for number, check in zip(seen[hit].tolist(), checks[hit].tolist()):
                run = self.words.runs[number]
                at = check % len(run)
                self.changed[run[:at] + run[at + 1 :]] += 1
        self.prefixes, self.docs, self.seen, self.pending = [], [], [], 0

    @property
    def full(self) -> bool:
        return len(self.words) + len(self.changed) > WORDS_KEPT

    def flush(self, least_letters: int) -> pa.RecordBatch:
        """The counts of words long enough, and a fresh start."""
        self.settle()
        total = Counter(dict(zip(self.words.runs, self.counts.tolist())))
        total.update(self.changed)
        kept = {w: n for w, n in total.items() if n and len(w) >= least_letters}
        self._begin()
        return pa.RecordBatch.from_arrays(
            [pa.array(list(kept), pa.string()), pa.array(list(kept.values()), pa.int64())], ["word", "n"]
        )


def vocabulary(
    docs: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, garbled: int = GARBLED
) -> DataFrame:
    """``word, n``: the words of ``docs`` that are long and frequent enough."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(garbled)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                tally.add(doc_id, text.as_py() or "")
                if tally.full:
                    yield tally.flush(least_letters)
        yield tally.flush(least_letters)

    counted = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "word string, n long"
    )
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def letter_parts(words: DataFrame) -> list[str]:
    """The alphabet dealt into parts of like frequency: by falling count, there and back."""
    letters = F.explode(F.split("word", "")).alias("letter")
    counts = dict(words.select(letters).groupBy("letter").count().collect())  # one line per letter
    ranked = sorted(ALPHABET, key=lambda c: (-counts.get(c, 0), c))
    turn = [*range(PARTS), *reversed(range(PARTS))]
    return ["".join(c for k, c in enumerate(ranked) if turn[k % len(turn)] == p) for p in range(PARTS)]


def _entries(words: DataFrame, parts: list[str]) -> DataFrame:
    """Each word once per choice of parts: ``choice, shared`` (its letters of those, in order), ``word, n``."""

    def shared(choice: tuple[int, ...]) -> Column:
        others = "".join(parts[p] for p in range(PARTS) if p not in choice)
        left = F.translate("word", others, "")
        return F.array_join(F.array_sort(F.split(left, "")), "")

    listed = [F.struct(F.lit(k).alias("choice"), shared(c).alias("shared")) for k, c in enumerate(CHOICES)]
    return words.select("word", "n", F.inline(F.array(*listed)))


def _dealt(entries: DataFrame, group_rows: int, stage: Stage) -> DataFrame:
    """The entries with ``pair`` and ``side``: groups of more than ``group_rows`` once per pair of parts."""
    big = entries.groupBy("choice", "shared").agg(F.count("*").alias("rows")).filter(F.col("rows") > group_rows)
    big = big.select("choice", "shared", F.ceil(F.col("rows") / group_rows).cast("int").alias("parts"))
    big = stage.write(big, "big-groups")
    whole = F.array(F.struct(F.lit("").alias("pair"), F.lit(0).alias("side")))
    if big.isEmpty():
        return entries.select("*", F.inline(whole))
    part = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda other: F.struct(
            F.concat_ws("-", F.least("part", other), F.greatest("part", other)).alias("pair"),
            F.when(other == F.col("part"), 0).when(F.col("part") < other, 1).otherwise(2).alias("side"),
        ),
    )
    marked = entries.join(big, ["choice", "shared"], "left").withColumn("part", part)
    listed = F.when(F.col("parts").isNull(), whole).otherwise(pairs)
    return marked.select("word", "n", "choice", "shared", F.inline(listed))


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one letter of ``a`` was replaced, or one put into it, to give ``b``."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    at = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return len(b) == len(a) + 1 and a[at:] == b[at + 1 :]


def _can_be_near(a: np.ndarray, b: np.ndarray, a_size: np.ndarray, b_size: np.ndarray) -> np.ndarray:
    """Whether the beginnings of words leave one edit possible; ``a`` has the shorter ones, a line each."""
    replaced = (a != b).sum(axis=1) <= 1
    place = np.arange(SHOWN - 1)
    first = np.argmin(np.c_[a == b, np.zeros(len(a), bool)], axis=1)[:, None]
    shifted = (a[:, :-1] == b[:, 1:]) | (place < first) | (place >= a_size[:, None])
    return np.where(a_size == b_size, replaced, shifted.all(axis=1))


class Blocks:
    """Near pairs within groups of words, by products of letter-count matrices."""

    def __init__(self, parts: list[str]):
        self.part = np.zeros((len(ALPHABET), PARTS))
        for p, letters in enumerate(parts):
            self.part[[ALPHABET.index(c) for c in letters], p] = 1
        self.place = np.full(256, -1)
        self.place[[ord(c) for c in ALPHABET]] = range(len(ALPHABET))
        # The first choice that avoids the parts in which a pair differs, by the bits of these.
        self.owner = np.array(
            [
                next((k for k, c in enumerate(CHOICES) if not any(bits >> p & 1 for p in c)), -1)
                for bits in range(1 << PARTS)
            ]
        )

    def counts(self, words: list[str]) -> np.ndarray:
        """A line of letter counts per word."""
        body = np.frombuffer("".join(words).encode("latin-1"), "uint8")
        line = np.repeat(np.arange(len(words)), [len(w) for w in words])
        wide = len(ALPHABET)
        flat = np.bincount(line * wide + self.place[body], minlength=len(words) * wide)
        return flat.reshape(len(words), wide).astype("float64")

    def pairs(
        self, words: list[str], group: np.ndarray, choice: np.ndarray, side: np.ndarray
    ) -> Iterator[tuple[int, int]]:
        """Places of near words, the shorter one first. Rows of one ``group`` are compared, sides 1 and 2 only with each other."""
        size = np.array([len(w) for w in words])
        order = np.lexsort((size, group)) if len(words) > TILE else np.arange(len(words))
        shown = np.array([w[:SHOWN].encode("latin-1") for w in words], f"S{SHOWN}").view("uint8").reshape(-1, SHOWN)
        for a in range(0, len(words), TILE):
            left = order[a : a + TILE]
            lines = self.counts([words[k] for k in left])
            square = (lines**2).sum(axis=1)
            for b in range(a, len(words), TILE):
                right = order[b : b + TILE]
                if group[right[0]] != group[left[-1]] and b > a or size[right].min() > size[left].max() + 1:
                    break
                others = lines if b == a else self.counts([words[k] for k in right])
                distance = square[:, None] + (others**2).sum(axis=1) - 2 * lines @ others.T
                i, j = np.nonzero(distance <= 2)
                x, y = left[i], right[j]
                kept = (group[x] == group[y]) & (np.abs(size[x] - size[y]) <= 1) & (distance[i, j] > 0)
                kept &= (side[x] == 0) & (side[y] == 0) | (side[x] + side[y] == 3)
                if b == a:
                    kept &= i < j
                i, j, x, y = i[kept], j[kept], x[kept], y[kept]
                swapped = size[x] > size[y]
                x, y = np.where(swapped, y, x), np.where(swapped, x, y)
                close = _can_be_near(shown[x], shown[y], size[x], size[y])
                i, j, x, y = i[close], j[close], x[close], y[close]
                differs = np.abs(lines[i] - others[j]) @ self.part > 0
                own = self.owner[differs @ (1 << np.arange(PARTS))] == choice[x]
                for p, q in zip(x[own].tolist(), y[own].tolist()):
                    if one_edit(words[p], words[q]):
                        yield p, q


def near_pairs(words: DataFrame, group_rows: int = GROUP_ROWS, stage: Stage | None = None) -> DataFrame:
    """``a, a_n, b, b_n``: the pairs of ``words`` (``word, n``; distinct, letters of ``ALPHABET``) one edit apart, each once."""
    ship_package(words.sparkSession)
    stage = stage or Stage(words.sparkSession)
    parts = letter_parts(words)
    dealt = _dealt(_entries(words, parts), group_rows, stage)
    key = ["choice", "shared", "pair"]
    placed = dealt.repartition(*key).sortWithinPartitions(*key)
    names = ["a", "a_n", "b", "b_n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = Blocks(parts)
        rows: list[tuple] = []  # whole groups, and the open one at the end
        group: list[int] = []
        last, closed = None, 0

        def compared(n: int) -> pa.RecordBatch:
            words, counts, choice, side = zip(*rows[:n]) if n else ((), (), (), ())
            found = list(blocks.pairs(list(words), np.array(group[:n]), np.array(choice), np.array(side)))
            columns = [
                pa.array([words[p] for p, _ in found], pa.string()),
                pa.array([counts[p] for p, _ in found], pa.int64()),
                pa.array([words[q] for _, q in found], pa.string()),
                pa.array([counts[q] for _, q in found], pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for word, n, choice, shared, pair, side in zip(*(c.to_pylist() for c in batch.columns)):
                if (choice, shared, pair) != last:
                    last = (choice, shared, pair)
                    if len(rows) - closed == 1:  # a word alone has no pair
                        del rows[closed:], group[closed:]
                    closed = len(rows)
                    if closed >= SMALL:
                        yield compared(closed)
                        rows, group, closed = [], [], 0
                rows.append((word, n, choice, side))
                group.append(closed)
        yield compared(len(rows))

    return placed.select("word", "n", *key, "side").mapInArrow(run, "a string, a_n long, b string, b_n long")


def _roots(forms: DataFrame, stage: Stage) -> DataFrame:
    """``word, root``: the last of each word's forms, by steps that double."""
    reached = stage.write(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = reached.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        reached = stage.write(moved, "roots")
        if reached.filter("moved").isEmpty():
            return reached.select("word", "root")


def spelling_groups(
    docs: DataFrame,
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    factor: int = FACTOR,
    garbled: int = GARBLED,
    group_rows: int = GROUP_ROWS,
    stage: Stage | None = None,
) -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``."""
    stage = stage or Stage(docs.sparkSession)
    words = stage.write(vocabulary(docs, least_letters, least_count, garbled), "words")
    pairs = near_pairs(words, group_rows, stage)
    ways = F.array(
        F.struct(F.col("a").alias("word"), F.struct((-F.col("b_n")).alias("n"), F.col("b").alias("near")).alias("best")),
        F.struct(F.col("b").alias("word"), F.struct((-F.col("a_n")).alias("n"), F.col("a").alias("near")).alias("best")),
    )
    near = (
        stage.write(pairs, "pairs")
        .select(F.inline(ways))
        .groupBy("word")
        .agg(F.count("*").alias("n_near"), F.min("best").alias("best"))
    )
    formed = -F.col("best.n") >= factor * F.col("n")
    judged = stage.write(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(formed, F.col("best.near")).alias("form"),
            F.when(formed, -F.col("best.n")).alias("form_n"),
        ),
        "judged",
    )
    roots = _roots(judged.filter(F.col("form").isNotNull()), stage)
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
