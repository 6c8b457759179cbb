"""Personal data: pattern spans, and terms that reveal a protected entity by co-occurrence.

An entity is one value found by a pattern. The unit of all counts is the passage: texts, with a blank at either
end, are cut into passages of ``passage_chars`` code points. Over the N passages of the corpus,

    IC(c) = log(N / n(c))                         information of entity c
    PMI(c; t) = log(N * n(c, t) / (n(c) * n(t)))  what term t tells of c

where n counts passages that hold c, t or both: an entity is in the passage in which it starts, a word of at least
three letters in the one that holds all of it, inside a pattern span or not (words cut by the edge of a passage are no
evidence). A term that tells at least ``threshold`` of an entity's information is disclosing. Each of its occurrences
in a document that holds the entity, however far off, is a span of kind ``term`` unless it touches a pattern span.
``sanitise`` removes those that tell all of it (``removal``) and generalises the others to a mark. Terms seen with an
entity in fewer than ``support`` passages give no estimate.

All counts are pre-aggregated. Passages bound the pairs of entities and terms: they grow with the text, not with its
square. Texts are shuffled only where rows repeat, to count each once, and if they hold an entity of ``support``
passages.

Defined cases: NULL text is empty; of documents alike in id and text each gets the same spans, and they count once
as evidence; a passage repeated within a text or by other documents counts each time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cuebreaks.llm.inputs import fresh, row_hash, same, text_or_empty
from cuebreaks.sources.staging import Stage

KINDS = ("email", "ip", "card", "phone")
PASSAGE_CHARS = 500
SUPPORT = 3
THRESHOLD = 0.8
REMOVAL = 0.999
BLOCK = 64

# The contract's patterns, with possessive loops and run starts so that no text takes quadratic time. A match
# can begin inside a run only where the last match ended (\G).
_EMAIL_CHARS = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{_EMAIL_CHARS})|\G){_EMAIL_CHARS}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){15,}+",  # shorter runs fail the check on digits anyway
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_WORD = r"\p{L}{3,}+"
_WHOLE_WORD = rf"(?<=\P{{L}}){_WORD}(?=\P{{L}})"  # touches no edge of its passage
_NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running_sums(sizes: Column, levels: int = 3) -> Column:
    """The sum of what stands before each number of an array.

    Blocks of ``BLOCK`` numbers are summed on their own and begin where the running sums of their totals say, so an
    array of n numbers takes about ``BLOCK * n`` steps; only the last level grows by appending.
    """

    def appended(numbers: Column, begin: Column) -> Column:
        sums = F.aggregate(
            numbers, F.array(begin), lambda done, n: F.concat(done, F.array(F.element_at(done, -1) + n))
        )
        return F.slice(sums, F.lit(1), F.size(numbers))

    if levels == 0:
        return appended(sizes, F.lit(0))

    def in_blocks(numbers: Column) -> Column:
        count = F.ceil(F.size(numbers) / BLOCK).cast("int")
        begins = F.slice(F.sequence(F.lit(0), count), F.lit(1), count)
        blocks = F.transform(begins, lambda k: F.slice(numbers, k * BLOCK + 1, BLOCK))

        def summed(cut: Column) -> Column:
            totals = F.transform(cut, lambda block: F.aggregate(block, F.lit(0), lambda a, n: a + n))
            return F.flatten(F.zip_with(cut, running_sums(totals, levels - 1), appended))

        return _bound(blocks, summed)

    return _bound(sizes, in_blocks)


def found_spans(text: Column, pattern: str) -> Column:
    """All matches with their places in code points: an array of ``start, end, value``; linear in their number."""
    value = F.regexp_extract_all(text, F.lit(pattern), 0)
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(value))
    pairs = F.zip_with(gaps, value, lambda g, v: F.struct(F.length(g).alias("gap"), v.alias("value")))

    def placed(found: Column) -> Column:
        before = running_sums(F.transform(found, lambda p: p["gap"] + F.length(p["value"])))

        def span(pair: Column, begin: Column) -> Column:
            start = begin + pair["gap"]
            end = start + F.length(pair["value"])
            return F.struct(start.alias("start"), end.alias("end"), pair["value"].alias("value"))

        return F.zip_with(found, before, span)

    return _bound(pairs, placed)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, place: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - place, F.lit(1)).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(place % 2 == 1, twice).otherwise(digit)

    places = F.sequence(F.lit(0), F.length(digits) - 1)
    return F.aggregate(places, F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(
            parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= F.lit("255")))
        )
    if kind == "card":
        return F.length(_digits(value)).between(16, 19) & _luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def pattern_spans(text: Column, kind: str) -> Column:
    """The valid matches of one kind."""
    spans = F.filter(found_spans(text, PATTERNS[kind]), lambda s: _valid(kind, s["value"]))
    needs = _NEEDS[kind]
    possible = F.contains(text, F.lit(needs)) if needs else text.rlike(PATTERNS[kind])
    nothing = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(possible, spans).otherwise(nothing)


def _passages(text: Column, chars: int) -> Column:
    """The distinct words of each passage: an array of arrays; linear in the text."""
    cut = F.regexp_extract_all(F.concat(F.lit(" "), text, F.lit(" ")), F.lit(f"(?s).{{1,{chars}}}"), 0)

    def words(passage: Column) -> Column:
        return F.array_distinct(F.transform(F.regexp_extract_all(passage, F.lit(_WHOLE_WORD), 0), F.lower))

    return F.transform(cut, words)


def _held(found: DataFrame, chars: int) -> DataFrame:
    """``doc_id, text_hash, passage, entity``: each entity once per passage that it starts in."""
    held = found.select("doc_id", "text_hash", F.explode("spans").alias("span"))
    return held.select(
        "doc_id",
        "text_hash",
        F.floor((F.col("span.start") + 1) / chars).cast("int").alias("passage"),
        F.concat_ws(":", "span.kind", "span.value").alias("entity"),
    ).distinct()


def _of_rows(frame: DataFrame) -> DataFrame:
    """``frame`` with its row identity renamed, to be joined on ``_row()``."""
    return frame.withColumnsRenamed({"doc_id": "at_id", "text_hash": "at_hash"})


def _row() -> Column:
    return same("doc_id", "at_id") & (F.col("text_hash") == F.col("at_hash"))


def disclosing_terms(
    texts: DataFrame, held: DataFrame, docs: DataFrame, passages: int, support: int, threshold: float, chars: int
) -> DataFrame:
    """``entity, term, told``: the part of an entity's information that a term tells, where it is disclosing.

    ``texts`` are the rows with entities, each once, ``held`` their entities by passage and ``docs`` all rows.
    """
    entity = held.groupBy("entity").agg(F.count("*").alias("n_c"))
    entity = entity.filter((F.col("n_c") >= support) & (F.col("n_c") < passages))
    counted = _of_rows(held.join(entity, "entity").withColumnRenamed("passage", "at_passage"))
    worded = texts.join(counted.select("at_id", "at_hash").distinct(), _row(), "left_semi")
    worded = worded.select("doc_id", "text_hash", F.posexplode(_passages(F.col("text"), chars)).alias("passage", "words"))
    met = worded.join(counted, _row() & (F.col("passage") == F.col("at_passage")))
    pair = met.select("entity", "n_c", F.explode("words").alias("term"))
    pair = pair.groupBy("entity", "n_c", "term").agg(F.count("*").alias("n_ct")).filter(F.col("n_ct") >= support)
    listed = F.explode(F.flatten(_passages(text_or_empty(), chars)))
    term = docs.select(listed.alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    everything = F.lit(float(max(passages, 1)))
    told = F.log(everything * F.col("n_ct") / (F.col("n_c") * F.col("n_t"))) / F.log(everything / F.col("n_c"))
    return (
        pair.join(term, "term")
        .withColumn("told", told)
        .filter(F.col("told") >= threshold)
        .select("entity", "term", "told")
    )


def _occurrences(texts: DataFrame, held: DataFrame, disclosing: DataFrame) -> DataFrame:
    """``doc_id, text_hash, start, end, told``: disclosing terms anywhere in the texts that hold their entity.

    Words meet their terms by joins, and pattern spans by their order in the text, so a long text with many of either
    takes no quadratic time.
    """
    key = ["doc_id", "text_hash"]
    holders = held.select(*key, "entity").distinct().join(disclosing.select("entity").distinct(), "entity")
    texts = texts.join(_of_rows(holders), _row(), "left_semi")
    said = texts.select(*key, F.explode(F.array_distinct(
        F.transform(F.regexp_extract_all("text", F.lit(_WORD), 0), F.lower))).alias("term"))
    said = said.join(disclosing, "term").withColumnRenamed("entity", "of")
    listed = said.join(_of_rows(holders), _row() & (F.col("of") == F.col("entity")))
    listed = listed.groupBy(*key, "term").agg(F.max("told").alias("told")).withColumnRenamed("term", "listed")
    marked = texts.select(*key, F.explode(found_spans(F.col("text"), _WORD)).alias("word"))
    marked = marked.join(_of_rows(listed), _row() & (F.lower("word.value") == F.col("listed")))
    marked = marked.select(*key, "word.start", "word.end", "told")
    spans = texts.select(*key, F.explode("spans").alias("span"))
    both = marked.unionByName(spans.select(*key, "span.start", "span.end", F.lit(None).cast("double").alias("told")))
    upward = Window.partitionBy(*key).orderBy("start", F.col("told").isNotNull())
    downward = Window.partitionBy(*key).orderBy(F.col("start").desc(), F.col("told").isNotNull())
    is_span = F.col("told").isNull()
    placed = both.withColumns({
        "reached": F.max(F.when(is_span, F.col("end"))).over(upward),
        "ahead": F.min(F.when(is_span, F.col("start"))).over(downward),
    })
    touched = F.coalesce(F.col("reached") > F.col("start"), F.lit(False)) | F.coalesce(
        F.col("ahead") < F.col("end"), F.lit(False)
    )
    return placed.filter(~is_span & ~touched).select(*key, "start", "end", "told")


def personal_data(
    docs: DataFrame,
    passage_chars: int = PASSAGE_CHARS,
    support: int = SUPPORT,
    threshold: float = THRESHOLD,
    stage: Stage | None = None,
) -> DataFrame:
    """One row per document: ``doc_id, text_hash, base, terms``.

    ``base`` are structs of ``kind, start, end`` by kind, then start; ``terms`` structs of ``start, end, told`` by start.
    """
    stage = stage or Stage(docs.sparkSession)
    text = docs.select("doc_id", row_hash().alias("text_hash"), text_or_empty().alias("text"))

    def of_kind(kind: str) -> Column:
        return F.transform(
            pattern_spans(F.col("text"), kind),
            lambda s: F.struct(
                F.lit(kind).alias("kind"),
                s["start"].alias("start"),
                s["end"].alias("end"),
                s["value"].alias("value"),
            ),
        )

    spanned = text.withColumn("spans", F.concat(*[of_kind(k) for k in KINDS]))
    passages = F.ceil((F.length("text") + 2) / passage_chars)
    edges = F.when(F.size("spans") > 0, F.col("text"))
    # texts with an entity only
    found = stage.write(spanned.withColumn("passages", passages).withColumn("text", edges), "spans")
    key = ["doc_id", "text_hash"]
    once = found.groupBy(*key).agg(F.count("*").alias("n"), F.max("passages").alias("passages"))
    rows, distinct, passages = once.agg(F.sum("n"), F.count("*"), F.sum("passages")).first()
    repeated = distinct < (rows or 0)
    evidence = text.dropDuplicates(key) if repeated else text  # texts move only where rows repeat
    texts = found.filter(F.size("spans") > 0)
    texts = texts.dropDuplicates(key) if repeated else texts
    held = stage.write(_held(found, passage_chars), "held")
    disclosing = disclosing_terms(texts, held, evidence, passages or 0, support, threshold, passage_chars)
    disclosing = stage.write(disclosing, "disclosing")
    nothing = F.array().cast("array<struct<start:int,end:int,told:double>>")
    terms = _occurrences(texts, held, disclosing).groupBy(*key)
    terms = terms.agg(F.sort_array(F.collect_list(F.struct("start", "end", "told"))).alias("terms"))
    base = F.transform("spans", lambda s: F.struct(s["kind"], s["start"], s["end"]))
    return found.join(_of_rows(terms), _row(), "left").select(
        *key, base.alias("base"), F.coalesce("terms", nothing).alias("terms")
    )


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced; ``spans``: structs of ``start, end, mark``. Of overlapping ones the first wins."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def step(state: Column, span: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        put = F.struct(
            span["end"].alias("at"), F.concat(state["done"], gap, span["mark"]).alias("done")
        )
        return F.when(span["start"] >= state["at"], put).otherwise(state)

    tail = lambda state: F.concat(
        state["done"], F.substring(text, state["at"] + 1, F.length(text))
    )
    return F.aggregate(F.sort_array(spans), start, step, tail)


def sanitise(docs: DataFrame, removal: float = REMOVAL, stage: Stage | None = None, **options) -> DataFrame:
    """``docs`` with personal data replaced by marks, and disclosing terms generalised or removed."""
    found = personal_data(docs, stage=stage, **options)

    def marks(spans: str, mark: Callable[[Column], Column]) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"], s["end"], mark(s).alias("mark")))

    marked = F.concat(
        marks("base", lambda s: F.concat(F.lit("<"), s["kind"], F.lit(">"))),
        marks("terms", lambda s: F.when(s["told"] >= removal, "").otherwise("<term>")),
    )
    names = {n: fresh(docs.columns, n) for n in ("span_id", "span_hash", "marks", "own_hash")}
    spans = found.select(
        F.col("doc_id").alias(names["span_id"]),
        F.col("text_hash").alias(names["span_hash"]),
        marked.alias(names["marks"]),
    ).filter(F.size(names["marks"]) > 0).dropDuplicates([names["span_id"], names["span_hash"]])
    own = names["own_hash"]
    on = same("doc_id", names["span_id"]) & (F.col(own) == F.col(names["span_hash"]))
    joined = docs.withColumn(own, row_hash()).join(spans, on, "left")
    clean = F.when(F.col(names["marks"]).isNull(), F.col("text")).otherwise(
        redacted(F.col("text"), F.col(names["marks"]))
    )
    return joined.withColumn("text", clean).select(*docs.columns)
