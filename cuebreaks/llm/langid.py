"""Language identification by rank-order n-gram profiles and out-of-place distance.

A profile lists a language's most frequent letter n-grams, most frequent first. A document's own list is
compared to each profile: every n-gram costs the number of places it is off, or the length of
a profile if it is missing there. The language with the least total wins.

Profiles come from all rows given for learning: tasks count n-grams, Spark adds the counts up and cuts
each language's list. The profiles alone (``profile_size`` rows per language) reach the driver.

Defined cases: NULL texts and texts without a letter are ``und`` with score 0, as is everything
when there is nothing to learn from; ties go to the n-gram of lower code points and to the
language first in order; rows alike are counted each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cuebreaks.llm.inputs import fresh, ship_package

PROFILE_SIZE = 400
UNKNOWN = "und"

_BITS = 18  # letters have code points below 2**18
_CHUNK = 1 << 20


@cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(1 << _BITS)])


def _pieces(text: str) -> Iterator[tuple[np.ndarray, int]]:
    """Code points of the lower-case letters, with one zero between and around words, in pieces.

    Each piece but the first begins with the last two points of the one before, so that no n-gram is lost or cut; the
    number of such points comes with it.
    """
    low = text.lower()
    carried = np.zeros(1, np.int64)
    for at in range(0, max(len(low), 1), _CHUNK):
        points = np.frombuffer(low[at : at + _CHUNK].encode("utf-32-le", "replace"), "<u4").astype(np.int64)
        points = np.where(points < (1 << _BITS), points, 0)
        points = np.where(_letters()[points], points, 0)
        end = [0] if at + _CHUNK >= len(low) else []
        points = np.concatenate((carried, points, end)).astype(np.int64)
        keep = points != 0
        keep[1:] |= points[:-1] != 0
        keep[: len(carried)] = True
        points = points[keep]
        yield points, len(carried)
        carried = points[-2:]


def _ngrams(points: np.ndarray, carried: int) -> np.ndarray:
    """Codes of the n-grams that end behind the carried points."""
    own = points[carried:]
    found = [own[own != 0] | (1 << 3 * _BITS)]
    pairs = (points[:-1] << _BITS) | points[1:]
    new = pairs[carried - 1 :]
    found.append(new[new != 0] | (2 << 3 * _BITS))
    triples = (pairs[:-1] << _BITS) | points[2:]
    # A blank inside would join two words.
    found.append(triples[points[1:-1] != 0] | (3 << 3 * _BITS))
    return np.concatenate(found)


def ngrams(text: str) -> np.ndarray:
    """Codes of the n-grams (one to three letters, blank-padded words) of a text, repeats included."""
    return np.concatenate([_ngrams(*piece) for piece in _pieces(text)])


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text and their counts; long texts are counted piece by piece."""
    return _merged([np.unique(_ngrams(*piece), return_counts=True) for piece in _pieces(text)])


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    grams = np.concatenate([p[0] for p in parts])
    counts = np.concatenate([p[1] for p in parts])
    distinct, place = np.unique(grams, return_inverse=True)
    return distinct, np.bincount(place, counts, len(distinct)).astype(np.int64)


def top(grams: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    return grams[np.argsort(-counts, kind="stable")[:size]]


@dataclass(frozen=True)
class Profiles:
    """All languages' rank lists as one table: sorted n-grams, and each language's rank of them."""

    langs: list[str]
    grams: np.ndarray
    ranks: np.ndarray
    size: int

    def nearest(self, text: str | None) -> tuple[str, float]:
        grams, counts = counted(text or "")
        if not len(grams) or not self.langs:
            return UNKNOWN, 0.0
        own = top(grams, counts, self.size)
        place = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        rank = np.where(self.grams[place] == own, self.ranks[:, place], self.size)
        off = np.where(rank < self.size, np.abs(rank - np.arange(len(own))), self.size).sum(axis=1)
        best = int(np.argmin(off))
        return self.langs[best], 1.0 - float(off[best]) / (self.size * len(own))


def learn(
    labelled: DataFrame, lang: str = "lang", text: str = "text", size: int = PROFILE_SIZE
) -> Profiles:
    """Profiles of the languages of ``labelled``; rows without a language or text teach nothing."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def flush(name: str) -> pa.RecordBatch:
            grams, counts = _merged(held.pop(name))
            langs = pa.array([name], pa.string()).take(pa.array(np.zeros(len(grams), np.int32)))
            return pa.RecordBatch.from_arrays([langs, pa.array(grams), pa.array(counts)], ["lang", "gram", "n"])

        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                parts = held.setdefault(name, [])
                parts.append(counted(body.as_py()))
                if len(parts) >= 500:
                    held[name] = [_merged(parts)]
        for name in list(held):
            yield flush(name)

    ship_package(labelled.sparkSession)
    usable = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).dropna()
    counts = usable.mapInArrow(count, "lang string, gram long, n long")
    total = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    lists = total.withColumn("rank", rank).filter(F.col("rank") <= size).select("lang", "gram", "rank")
    found = lists.toPandas()
    langs = sorted(found["lang"].unique())
    grams = np.unique(found["gram"].to_numpy(np.int64))
    ranks = np.full((len(langs), len(grams)), size, np.int64)
    at = np.searchsorted(grams, found["gram"].to_numpy(np.int64))
    ranks[np.searchsorted(langs, found["lang"]) if langs else [], at] = found["rank"].to_numpy(np.int64) - 1
    return Profiles(langs, grams, ranks, size)


def identify(docs: DataFrame, profiles: Profiles, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of every row, with ``lang_pred`` and ``score`` (1: same list as the profile)."""
    ship_package(docs.sparkSession)
    source = docs.select(*keep, F.col("text").alias(fresh(keep, "body")))
    schema = docs.select(*keep, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [profiles.nearest(t.as_py()) for t in batch.column(len(keep))]
            langs = pa.array([f[0] for f in found], pa.string())
            scores = pa.array([f[1] for f in found], pa.float64())
            columns = [batch.column(k) for k in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, langs, scores], schema.names)

    return source.mapInArrow(run, schema)
