"""Benchmark passages in documents, by a distributed positional inverted index.

1. Each benchmark item gives its windows (``window`` consecutive words; a shorter item is one window). The terms of
   all windows are counted over all documents, and each window takes its rarest term for entry.
2. The index stores a posting for each occurrence of an entry term in a document: term, document,
   position, and the words around it that a window can reach. It is written to the shared folder.
3. A window's list is its entry term's postings. The other terms' offset-adjusted positions are intersected
   with it from the next rarest on: a posting stays while the word at the term's offset is that term. What is left
   are exact phrases. Postings that have all the terms close by, in any order, are proximity matches.

Texts are read once: their words are written in pieces of ``PIECE_WORDS``, each with the words that a window can reach
beyond it, and all later steps read the pieces. So a posting is cut out of a piece, whatever the length of its text.

Words are counted in the documents' own spelling and folded afterwards, so whole texts need no folding.
Lists of benchmark terms are counted; up to ``BROADCAST_TERMS`` words of ``BROADCAST_BYTES`` they are broadcast, so no word
of a document moves, beyond that documents' words are counted before they move, or move with their surroundings cut out.

Defined cases: NULL text and NULL items have no words; a NULL ``item_id`` is a value like others, left out of the
list of items; equal items each count; rows alike get equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuebreaks.llm.inputs import fresh, row_hash, same
from cuebreaks.sources.staging import Stage

WINDOW = 10
BROADCAST_TERMS = 500_000
BROADCAST_BYTES = 32 << 20
PIECE_WORDS = 1024

_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def fold(text: Column) -> Column:
    """A-Z in lower case; other letters stay."""
    return F.translate(text, _UPPER, _UPPER.lower())


def words(text: Column) -> Column:
    """The words of a text in its own spelling; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _BREAK, -1), "")


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item_id, terms``: the distinct windows of each item."""
    listed = benchmark.select("item_id", words(fold(F.col("text"))).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(1)))
    return listed.select(
        "item_id", F.explode(F.transform(starts, lambda s: F.slice("w", s, window))).alias("terms")
    ).distinct()


def _pieces(docs: DataFrame, reach: int) -> DataFrame:
    """The words of each text in pieces: ``doc_id, text_hash, n_words, begin, before, own, part``.

    ``own`` words from ``begin`` on are the piece's own; ``part`` has ``before`` more in front and up to ``reach`` behind. A
    text without words is one empty piece.
    """
    listed = docs.select("doc_id", row_hash().alias("text_hash"), words(F.col("text")).alias("w"))
    last = F.greatest(F.size("w") - 1, F.lit(0))
    begins = F.sequence(F.lit(0), last, F.lit(PIECE_WORDS))

    def piece(begin: Column) -> Column:
        before = F.least(begin, F.lit(reach))
        return F.struct(
            begin.alias("begin"),
            before.alias("before"),
            F.least(F.size("w") - begin, F.lit(PIECE_WORDS)).alias("own"),
            F.slice("w", begin - before + 1, before + PIECE_WORDS + reach).alias("part"),
        )

    cut = listed.select("doc_id", "text_hash", F.size("w").alias("n_words"), F.explode(F.transform(begins, piece)).alias("p"))
    return cut.select("doc_id", "text_hash", "n_words", "p.begin", "p.before", "p.own", "p.part")


def _own_words() -> Column:
    return F.slice("part", F.col("before") + 1, F.col("own"))


def _fits(terms: DataFrame, name: str) -> bool:
    """Whether a list of terms is proven small enough to be broadcast."""
    n, size = terms.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(name)), F.lit(0))).first()
    return n <= BROADCAST_TERMS and size <= BROADCAST_BYTES


def _spelled(pieces: DataFrame, terms: DataFrame) -> DataFrame:
    """``spelling, term, n``: how documents spell the given terms, and how often."""
    used = pieces.select(F.explode(_own_words()).alias("spelling"))
    # lower() folds at least what fold() does, so no spelling of a term is lost here.
    near = terms.select(F.lower("term").alias("low")).distinct()
    if _fits(terms, "term"):
        used = used.join(F.broadcast(near), F.lower("spelling") == F.col("low"), "left_semi")
    counts = used.groupBy("spelling").agg(F.count("*").alias("n")).withColumn("term", fold(F.col("spelling")))
    return counts.join(terms, "term", "left_semi")


def phrase_hits(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, stage: Stage | None = None
) -> DataFrame:
    """``doc_id, text_hash, start, length, item_id, exact``: matches of windows in documents.

    ``start`` counts words from 0. Rows that are not ``exact`` are proximity matches, at the entry term.
    """
    stage = stage or Stage(docs.sparkSession)
    return _hits(stage.write(_pieces(docs, window - 1), "pieces"), benchmark, window, stage)


def _hits(pieces: DataFrame, benchmark: DataFrame, window: int, stage: Stage) -> DataFrame:
    windows = stage.write(
        item_windows(benchmark, window).withColumn("window_id", F.monotonically_increasing_id()), "windows"
    )
    terms = stage.write(windows.select(F.explode("terms").alias("term")).distinct(), "terms")
    spelled = stage.write(_spelled(pieces, terms), "spelled")
    counts = spelled.groupBy("term").agg(F.sum("n").alias("n"))

    offsets = windows.select("window_id", F.posexplode("terms").alias("at", "term"))
    rarity = offsets.join(counts, "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    by_rarity = rarity.groupBy("window_id").agg(
        F.sort_array(F.collect_list(F.struct("n", "at", "term"))).alias("lists")
    )
    # A window with a term that no document has cannot match.
    usable = by_rarity.filter(F.col("lists")[0]["n"] > 0).join(windows, "window_id")
    entries = stage.write(
        usable.select(
            "item_id",
            "lists",
            F.col("lists")[0]["term"].alias("entry"),
            F.col("lists")[0]["at"].alias("entry_at"),
            F.array_distinct("terms").alias("bag"),
            F.size("terms").alias("length"),
        ),
        "entries",
    )
    spellings = stage.write(
        spelled.join(entries.select(F.col("entry").alias("term")).distinct(), "term", "left_semi").select(
            "spelling", "term"
        ),
        "spellings",
    )

    reach = window - 1
    placed = pieces.select(
        "doc_id", "text_hash", "begin", "before", "part", F.posexplode(_own_words()).alias("at", "spelling")
    )
    place = F.col("before") + F.col("at")  # in the part
    first = F.greatest(place - reach, F.lit(0))
    cut = {"pos": F.col("begin") + F.col("at"), "around": F.slice("part", first + 1, 2 * reach + 1)}
    if _fits(spellings, "spelling"):
        found = placed.join(F.broadcast(spellings), "spelling").withColumns(cut)
    else:
        found = placed.withColumns(cut).drop("part").join(spellings, "spelling")
    postings = found.select(
        "doc_id",
        "text_hash",
        "term",
        "pos",
        F.least("pos", F.lit(reach)).alias("before"),
        F.transform("around", fold).alias("around"),
    )
    index = stage.write(postings, "postings")

    lists = index.join(entries, F.col("term") == F.col("entry"))
    at = lambda t: F.get("around", F.col("before") - F.col("entry_at") + t["at"])
    inside = F.col("before") >= F.col("entry_at")
    exact = inside & F.forall("lists", lambda t: F.coalesce(at(t) == t["term"], F.lit(False)))
    near = F.size(F.array_except("bag", "around")) == 0
    return lists.withColumn("exact", exact).filter(F.col("exact") | near).select(
        "doc_id",
        "text_hash",
        F.when(F.col("exact"), F.col("pos") - F.col("entry_at")).otherwise(F.col("pos")).alias("start"),
        "length",
        "item_id",
        "exact",
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, stage: Stage | None = None
) -> DataFrame:
    """One row per document: ``doc_id, text_hash, n_words, n_hit, n_items, items, contaminated, n_near_items``."""
    stage = stage or Stage(docs.sparkSession)
    pieces = stage.write(_pieces(docs, window - 1), "pieces")
    hits = stage.write(_hits(pieces, benchmark, window, stage), "hits")
    key = ["doc_id", "text_hash"]
    exact = hits.filter("exact")
    last = F.col("start") + F.col("length") - 1
    covered = exact.select(*key, F.explode(F.sequence("start", last)).alias("pos")).distinct()
    items = hits.groupBy(*key).agg(
        F.array_sort(F.collect_set(F.when(F.col("exact"), F.col("item_id").cast("string")))).alias("items"),
        F.count_distinct(F.when(~F.col("exact"), F.col("item_id"))).alias("n_near_items"),
        F.count_distinct(F.when(F.col("exact"), F.struct("item_id"))).alias("n_items"),
    )
    per_doc = covered.groupBy(*key).agg(F.count("*").alias("n_hit"))
    renamed = {"doc_id": "hit_id", "text_hash": "hit_hash"}
    on = same("doc_id", "hit_id") & (F.col("text_hash") == F.col("hit_hash"))
    found = stage.write(
        items.join(
            per_doc.withColumnsRenamed(renamed), on, "left"
        ).drop("hit_id", "hit_hash").withColumnsRenamed(renamed),
        "found",
    )
    listed = pieces.filter("begin = 0").select("doc_id", "text_hash", "n_words")  # one per row of docs
    zero = F.lit(0).cast("long")
    return listed.join(found, on, "left").select(
        *key,
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", zero).alias("n_hit"),
        F.coalesce("n_items", zero).alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        (F.coalesce("n_hit", zero) > 0).alias("contaminated"),
        F.coalesce("n_near_items", zero).alias("n_near_items"),
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, stage: Stage | None = None
) -> DataFrame:
    """The rows of ``docs`` without any exact match, with all their columns."""
    stage = stage or Stage(docs.sparkSession)
    exact = phrase_hits(docs, benchmark, window, stage).filter("exact")
    hit_id, hit_hash, own = (fresh(docs.columns, n) for n in ("hit_id", "hit_hash", "own_hash"))
    hit = stage.write(
        exact.select(F.col("doc_id").alias(hit_id), F.col("text_hash").alias(hit_hash)).distinct(), "hit"
    )
    on = same("doc_id", hit_id) & (F.col(own) == F.col(hit_hash))
    return docs.withColumn(own, row_hash()).join(hit, on, "left_anti").drop(own)
