"""Toxicity by a weighted finite-state pattern grammar over clauses.

A lexical transducer turns words into symbols: insult (with a weight), threat, target, negation, report, article, other.
A second one reads a clause's symbols from right to left and settles its threats by what follows: a target within
``AFTER`` words is the object ("kill you"), unless an article opens another one before it ("kill the process you
started"); "her" before another word owns that word ("her knee"). Without an object, a threat stays open only at the
clause's end ("you should kill") or as an infinitive of a language that puts the object first.
Four more read what it writes from left to right, and each puts a factor on insults and threats: one asks open threats for
a target up to ``BEFORE`` words earlier and takes a third person directly before a threat as an account ("they beat them"),
one strengthens insults aimed at a target, one weakens what is negated, one what is reported. These four are composed
into one machine. An insult counts without an aim, as toxic rows may have none. A clause counts its strongest match; a document's score adds up its clauses on
the scale of log-odds, from the share of toxic documents as start.

Insults are learned: words and word beginnings that are significantly more frequent in toxic documents. They are
fitted on at most ``fit_rows`` labelled documents per label, those of least id hash, one text of each (that of least
hash), of which near copies (by one min-hash of their sentences) count once. Scores read nothing but the text.
The start value is 0.5 at most, so that no text is rejected for what others are labelled.

Defined cases: NULL and empty texts have no clause and score the start value; without toxic labels nothing but
threats is known; rows alike score alike; several labels of one document each count.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuebreaks.llm.inputs import fresh, ship_package
from cuebreaks.sources.staging import Stage

FIT_ROWS = 4000
LEXICON_ROWS = 5000
LEAST_WEIGHT = 3.0
MOST_WEIGHT = 6.0
STEMS = (4, 5, 6)
THRESHOLD = 0.7

OTHER, INSULT, THREAT, INFINITIVE, TARGET, NEGATION, REPORT, THIRD, HER, ARTICLE, FACED = SYMBOLS = range(11)
AFTER, BEFORE = 3, 3

# Fixed function words of the grammar, in the languages of the corpus.
CLASSES = {
    THREAT: "kill hurt destroy beat shoot stab",
    INFINITIVE: "tuer frapper töten schlagen matar golpear",
    TARGET: "you your yours him them vous toi tu ihr dich du usted tú",
    THIRD: "he she they",
    HER: "her",
    NEGATION: "not never neither nor pas jamais nicht nie kein keine nunca jamás",
    REPORT: "said says told wrote reported quoted claimed dit disait sagte schrieb dijo escribió",
    ARTICLE: "the a an le la les un une der die das den einen eine el los las una",
}
THREAT_WEIGHT = 4.0

_WORDS = re.compile(r"[^\W\d_]+")
_LONG = 1 << 20
WORDS_KEPT = 300_000
_CLAUSES = re.compile(r"[.!?;:,\n]+")


@dataclass(frozen=True)
class Transducer:
    """Reads symbols from state 0; ``moves[state, symbol] = (state, factor)``. A move not listed stays, factor 1."""

    moves: dict[tuple[int, int], tuple[int, float]]

    def step(self, state: int, symbol: int) -> tuple[int, float]:
        return self.moves.get((state, symbol), (state, 1.0))


def compose(*parts: Transducer) -> Transducer:
    """One machine over the reachable tuples of states; factors multiply."""
    number = {tuple(0 for _ in parts): 0}
    todo, moves = list(number), {}
    while todo:
        states = todo.pop()
        for symbol in SYMBOLS:
            steps = [p.step(s, symbol) for p, s in zip(parts, states)]
            after = tuple(s for s, _ in steps)
            if after not in number:
                number[after] = len(number)
                todo.append(after)
            moves[number[states], symbol] = (number[after], math.prod(f for _, f in steps))
    return Transducer(moves)


def _scope(openers: tuple[int, ...], reach: int, factor: float, symbols: tuple[int, ...]) -> Transducer:
    """``factor`` on ``symbols`` within ``reach`` words after one of ``openers``; 0: up to the clause's end."""
    moves: dict[tuple[int, int], tuple[int, float]] = {}
    last = max(reach, 1)
    for state in range(last + 1):
        for symbol in SYMBOLS:
            after = last if symbol in openers else max(state - 1, 0) if reach else state
            weakened = state > 0 and symbol in symbols
            moves[state, symbol] = (after, factor if weakened else 1.0)
    return Transducer(moves)


NEGATED = _scope((NEGATION,), 3, 0.3, (INSULT, THREAT, FACED))
REPORTED = _scope((REPORT,), 0, 0.5, (INSULT, THREAT, FACED))
AIMED = _scope((TARGET, THIRD, HER), 4, 1.25, (INSULT,))


def _threatened() -> Transducer:
    """Threats count after a close target, faced ones always but directly after a third person.

    State: words a target still reaches, and whether the last word was a third person.
    """
    moves: dict[tuple[int, int], tuple[int, float]] = {}
    for left in range(BEFORE + 1):
        for third in (0, 1):
            for symbol in SYMBOLS:
                after = BEFORE if symbol == TARGET else max(left - 1, 0)
                void = symbol == THREAT and not left or symbol in (THREAT, FACED) and third
                moves[2 * left + third, symbol] = (2 * after + (symbol == THIRD), 0.0 if void else 1.0)
    return Transducer(moves)


THREATENED = _threatened()
GRAMMAR = compose(NEGATED, REPORTED, AIMED, THREATENED)


END, WORD, FUNCTION = range(3)


def _ahead() -> dict[tuple[int, int], tuple[int, int]]:
    """Reads a clause from its end and writes what its verbs are: faced, open, or nothing.

    State: words that the next object to the right still reaches, and what the symbol to the right is.
    """
    moves: dict[tuple[int, int], tuple[int, int]] = {}
    for reach in range(AFTER + 1):
        for right in (END, WORD, FUNCTION):
            for symbol in SYMBOLS:
                written = symbol
                if symbol in (THREAT, INFINITIVE):
                    is_open = symbol == INFINITIVE or right == END
                    written = FACED if reach else THREAT if is_open else OTHER
                is_object = symbol == TARGET or symbol == HER and right != WORD
                left = AFTER if is_object else 0 if symbol == ARTICLE else max(reach - 1, 0)
                kind = WORD if symbol in (OTHER, INSULT) else FUNCTION
                moves[3 * reach + right, symbol] = (3 * left + kind, written)
    return moves


AHEAD = _ahead()


def features(word: str) -> list[str]:
    """What a lexicon entry can match of a word: all of it, or a beginning (marked by a star)."""
    return [word, *(f"{word[:n]}*" for n in STEMS if len(word) > n)]


def _words(text: str) -> Iterable[str]:
    """Words of a text; of a long one, one after the other."""
    return _WORDS.findall(text) if len(text) < _LONG else (m.group() for m in _WORDS.finditer(text))


@dataclass
class Model:
    """The learned lexicon and the start value; runs anywhere, is small."""

    insults: dict[str, float]
    start: float
    known: dict[str, tuple[int, float]] = field(default_factory=dict, repr=False)

    def symbol(self, word: str) -> tuple[int, float]:
        """Symbol and weight of a lower-case word."""
        found = self.known.get(word)
        if found is None:
            if len(self.known) > WORDS_KEPT:
                self.known.clear()
            weight = max((self.insults.get(f, 0.0) for f in features(word)), default=0.0)
            fixed = next((c for c, listed in CLASSES.items() if word in listed.split()), OTHER)
            threat = THREAT_WEIGHT if fixed in (THREAT, INFINITIVE) else 0.0
            found = (INSULT, weight) if weight else (fixed, threat)
            self.known[word] = found
        return found

    def clause(self, words: Iterable[str]) -> float:
        """The weight of a clause's strongest match."""
        read = [self.symbol(w) for w in words]
        if not any(weight for _, weight in read):
            return 0.0
        ahead, written = 0, []
        for symbol, weight in reversed(read):
            ahead, symbol = AHEAD[ahead, symbol]
            written.append((symbol, weight if symbol != OTHER else 0.0))
        state, best = 0, 0.0
        for symbol, weight in reversed(written):
            state, factor = GRAMMAR.step(state, symbol)
            best = max(best, weight * factor)
        return best

    def score(self, text: str | None) -> float:
        low = (text or "").lower()
        total = self.start
        symbol = self.symbol
        if any(symbol(w)[1] for w in _words(low)):
            total += sum(self.clause(_words(c)) for c in _CLAUSES.split(low))
        return 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, total))))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    fit_rows: int = FIT_ROWS,
    lexicon_rows: int = LEXICON_ROWS,
    stage: Stage | None = None,
) -> Model:
    """The model of ``labels`` (``doc_id, toxic``) over the texts of ``docs``."""
    ship_package(docs.sparkSession)
    stage = stage or Stage(docs.sparkSession)
    usable = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "toxic")
    counts = dict(usable.groupBy("toxic").count().collect())
    order = F.xxhash64("doc_id")
    chosen = [usable.filter(F.col("toxic") == t).orderBy(order, "doc_id").limit(fit_rows) for t in (0, 1)]
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen[0].union(chosen[1])), "doc_id")  # bounded
    sample = sample.groupBy("toxic", "doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    sketch = F.array_min(F.transform(F.split("text", r"[.\n]+"), lambda w: F.xxhash64(w)))
    fitted = sample.select("toxic", "text", sketch.alias("sketch")).dropDuplicates(["toxic", "sketch"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = set(_WORDS.findall((text.as_py() or "").lower()))
                seen[toxic].update({f for w in words for f in features(w)})
                seen[toxic][""] += 1
        for toxic, counter in enumerate(seen):
            names = pa.array(list(counter), pa.string())
            numbers = pa.array(list(counter.values()), pa.int64())
            label = pa.array([toxic] * len(names), pa.int32())
            yield pa.RecordBatch.from_arrays([names, label, numbers], ["feature", "toxic", "n"])

    seen = fitted.select("toxic", "text").mapInArrow(count, "feature string, toxic int, n long")
    sums = [F.sum(F.when(F.col("toxic") == t, F.col("n")).otherwise(0)) for t in (0, 1)]
    table = seen.groupBy("feature").agg(sums[0].alias("clean"), sums[1].alias("bad"))
    table = stage.write(table, "features")
    whole = F.col("feature") == ""  # in every document
    bad, clean, candidates = table.agg(
        F.max(F.when(whole, F.col("bad"))), F.max(F.when(whole, F.col("clean"))), F.count("*")
    ).first()
    all_of = {"bad": bad or 0, "clean": clean or 0}
    both = (F.col("bad") + F.col("clean")) / max(1, sum(all_of.values()))

    def rate(n: str) -> Column:
        return (F.col(n) + 0.5) / (all_of[n] + 1)

    def part(n: str) -> Column:
        return F.when(F.col(n) > 0, F.col(n) * F.log(F.col(n) / (all_of[n] * both))).otherwise(0.0)

    lexicon = (
        table.filter(~whole)
        .withColumn("weight", F.log(rate("bad") / rate("clean")))
        .withColumn("ratio", 2 * (part("bad") + part("clean")))  # of likelihoods
        .filter(F.col("weight") >= LEAST_WEIGHT)
        .filter(F.col("ratio") >= 2 * math.log(max(candidates, 1)) + 4)  # allows for so many trials
        .orderBy(F.col("ratio").desc(), "feature")
        .limit(lexicon_rows)
    )
    found = lexicon.select("feature", "weight", "bad").collect()  # lexicon_rows at most
    seen_bad = {r["feature"]: r["bad"] for r in found}
    covered: dict[str, int] = {}  # most documents of an entry below each beginning
    for name, n in seen_bad.items():
        for longer in features(name.rstrip("*"))[1:]:
            if longer != name:
                covered[longer] = max(covered.get(longer, 0), n)
    # A beginning gives way to a longer entry that finds nearly all the same documents.
    insults = {
        r["feature"]: min(r["weight"], MOST_WEIGHT)
        for r in found
        if covered.get(r["feature"], 0) < 0.9 * r["bad"]
    }
    start = math.log((counts.get(1, 0) + 0.5) / (counts.get(0, 0) + 0.5))
    return Model(insults, min(start, 0.0))


def score(docs: DataFrame, model: Model, keep: list[str], name: str = "score") -> DataFrame:
    """The columns ``keep`` of every row and its score."""
    ship_package(docs.sparkSession)
    source = docs.select(*keep, F.col("text").cast("string").alias(fresh(keep, "body")))
    schema = docs.select(*keep, F.lit(0.0).alias(name)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array([model.score(t.as_py()) for t in batch.column(len(keep))], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], scores], schema.names)

    return source.mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    name = fresh(docs.columns, "score")
    return score(docs, model, docs.columns, name).filter(F.col(name) < threshold).drop(name)
