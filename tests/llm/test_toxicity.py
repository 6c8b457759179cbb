import random
import zlib

import duckdb
import pytest
from llm_helpers import docs

from cuebreaks.llm import toxicity as tox
from cuebreaks.llm.queries import QUERIES

BIG = "/root/testdata/sf0.1"
INSULTS = {"idiot": 5.0, "scumb*": 4.0}


@pytest.fixture
def model():
    return tox.Model(dict(INSULTS), start=-2.0)


def test_clauses_not_words_are_scored(model):
    plain = model.clause("what an idiot".split())
    assert plain == 5.0
    assert model.clause("you are an idiot".split()) == pytest.approx(5.0 * 1.25)
    assert model.clause("he is not an idiot".split()) == pytest.approx(5.0 * 1.25 * 0.3)
    assert model.clause("someone said idiot".split()) == pytest.approx(5.0 * 0.5)
    assert model.clause("not one of these many words idiot".split()) == 5.0  # out of the negation's reach
    assert model.clause("scumbags scumball scum".split()) == 4.0


def test_threats_need_a_target(model):
    assert model.clause("kill the process".split()) == 0.0
    assert model.clause("you should kill".split()) == tox.THREAT_WEIGHT


@pytest.mark.parametrize("text, weight", [
    ("i will kill you", 4.0),
    ("we are going to hurt them", 4.0),
    ("kill all of you", 4.0),
    ("kill anybody who ever looks at you", 0.0),  # out of reach
    ("i will not kill you", 4.0 * 0.3),
    ("she said i will kill you", 4.0 * 0.5),
    ("he will kill her", 4.0),
    ("ich werde dich töten", 4.0),
    ("je vais vous tuer demain", 4.0),
    ("they beat the record", 0.0),
    ("you beat the record", 0.0),
    ("she hurt her knee", 0.0),
    ("he beat them", 0.0),
    ("you know very well whom we all should kill", 0.0),
    ("kill the process you started", 0.0),
    ("destroy a record of yours", 0.0),
    ("i will kill you the next time", 4.0),
    ("he will kill her the next day", 4.0),
])
def test_threats_are_settled_by_a_close_target(model, text, weight):
    assert model.clause(text.split()) == pytest.approx(weight)
    assert (model.score(f"Hello. {text}!") > 0.7) == (weight == 4.0)


WORDS = "idiot scumbag kill hurt töten you them her he they not never said the an film ok blue".split()


def strongest(model, words):
    """The strongest match of a clause, by trying every word in turn on the words around it."""
    symbols = [model.symbol(w)[0] for w in words]
    n, best = len(words), 0.0

    def is_object(j):
        owns = j + 1 < n and symbols[j + 1] in (tox.OTHER, tox.INSULT)
        return symbols[j] == tox.TARGET or symbols[j] == tox.HER and not owns

    for i, symbol in enumerate(symbols):
        before = lambda reach: symbols[max(i - reach, 0):i]
        weight = model.symbol(words[i])[1]
        if symbol == tox.INSULT:
            weight *= 1.25 if {tox.TARGET, tox.THIRD, tox.HER} & set(before(4)) else 1.0
        elif weight:
            faced = any(is_object(j) and tox.ARTICLE not in symbols[i:j] for j in range(i + 1, min(i + tox.AFTER, n - 1) + 1))
            is_open = (symbol == tox.INFINITIVE or i == n - 1) and tox.TARGET in before(tox.BEFORE)
            weight *= (faced or is_open) and symbols[max(i - 1, 0)] != tox.THIRD
        weight *= 0.3 if tox.NEGATION in before(3) else 1.0
        weight *= 0.5 if tox.REPORT in symbols[:i] else 1.0
        best = max(best, weight)
    return best


def test_the_machines_find_what_a_search_word_by_word_finds(model):
    draw = random.Random(5)
    clauses = [draw.choices(WORDS, k=draw.randint(0, 9)) for _ in range(20_000)]
    for words in clauses:
        assert model.clause(words) == pytest.approx(strongest(model, words)), words
    # A sum of the known words would not do: it differs on most clauses that hold one.
    known = [c for c in clauses if any(model.symbol(w)[1] for w in c)]
    differ = sum(abs(model.clause(c) - max(model.symbol(w)[1] for w in c)) > 0.01 for c in known)
    assert differ > len(known) / 2


def test_one_text_of_a_labelled_id_is_learned_from(spark):
    rows = [(k, "plain words") for k in range(50)] + [(99, f"grumblix number{k}") for k in range(200)]
    labels = spark.createDataFrame([(k, 0) for k in range(50)] + [(99, 1)] * 30, "doc_id long, toxic int")
    model = tox.learn(docs(spark, rows), labels)
    assert model.insults == {}  # one document is no evidence, however often its rows repeat


def test_scores_add_up_clauses_and_are_probabilities(model):
    one, two = model.score("An idiot."), model.score("An idiot. What, idiot!")
    assert 0 < model.score(None) == model.score("") < 0.2 < 0.9 < one < two < 1
    assert model.score("not idiot") < 0.7
    assert model.score("idiot " * 100_000) == pytest.approx(one)


def test_composition_multiplies_the_parts():
    parts = (tox.NEGATED, tox.REPORTED, tox.AIMED, tox.THREATENED)
    symbols = [tox.REPORT, tox.TARGET, tox.NEGATION, tox.OTHER, tox.INSULT, tox.THREAT, tox.TARGET, tox.THREAT]
    state, states = 0, [0] * 4
    for symbol in symbols:
        state, factor = tox.GRAMMAR.step(state, symbol)
        steps = [p.step(s, symbol) for p, s in zip(parts, states)]
        states = [s for s, _ in steps]
        expected = 1.0
        for _, f in steps:
            expected *= f
        assert factor == pytest.approx(expected)


def tables(spark):
    rows, labels = [], []
    for k in range(400):
        bad = k % 4 == 0
        word = ("grumblix" if bad else "calm") + "abcdefg"[k % 7] * 3
        rows.append((k, f"some text number{k} with {word} here. and sentence{k * 7} more"))
        labels.append((k, int(bad)))
    labels += [(3, None), (None, 1), (9999, 1), (0, 1)]
    return docs(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_learns_words_and_stems(spark):
    frame, labels = tables(spark)
    model = tox.learn(frame, labels)
    assert any(f.startswith("grumb") for f in model.insults)
    assert not any(f.startswith(("calm", "some", "text", "numb", "sente")) for f in model.insults)
    assert model.score("a grumblixian") > 0.7 > model.score("a calm text")


def test_odd_documents_and_the_filter(spark):
    frame, labels = tables(spark)
    model = tox.learn(frame, labels)
    odd = docs(spark, [(1, None), (2, ""), (3, "grumblixaaa"), (3, "grumblixaaa"), (None, "fine"), (5, "fine " * 50000)])
    scored = {(r.doc_id, round(r.score, 3)) for r in tox.score(odd, model, ["doc_id"]).collect()}
    assert {i for i, s in scored if s >= 0.7} == {3}
    kept = tox.drop_toxic(odd, model)
    assert kept.schema == odd.schema
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 5]


def test_nothing_to_learn_from_and_empty_table(spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = tox.learn(docs(spark, [(1, "a")]), labels)
    assert model.insults == {} and 0 < model.score("a") < 0.7
    assert tox.drop_toxic(docs(spark, []), model).count() == 0


def test_held_out_accuracy(spark):
    """On sf0.1: recall and precision of held-out labels, and clean documents of each language left alone.

    Recall is not asked by language: with a dozen or two toxic rows of one to learn from, its insults are not told from chance.
    """
    tables = {name: f"read_parquet('{BIG}/{name}.parquet')" for name in ("labels", "documents")}
    truth = {i: (t, lang) for i, t, lang in duckdb.sql(
        f"SELECT doc_id, toxic, lang FROM {tables['labels']} AS l JOIN {tables['documents']} AS d USING (doc_id)"
    ).fetchall()}
    rows = QUERIES["op2_toxicity"](spark, BIG).filter("held_out").select("doc_id", "predicted", "score").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 and 0 <= r.score <= 1 for r in rows)
    by_lang = {}
    for r in rows:
        if r.doc_id in truth:
            toxic, lang = truth[r.doc_id]
            by_lang.setdefault(lang, []).append((toxic, r.predicted))
    judged = [pair for pairs in by_lang.values() for pair in pairs]
    hits = sum(t and p for t, p in judged)
    assert hits >= 0.8 * sum(t for t, _ in judged)
    assert hits >= 0.9 * sum(p for _, p in judged)
    wrong = lambda pairs: sum(p and not t for t, p in pairs) / sum(not t for t, _ in pairs)
    assert wrong(judged) <= 0.01
    for lang, pairs in by_lang.items():
        print(lang, sum(t and p for t, p in pairs), sum(t for t, _ in pairs), sum(p and not t for t, p in pairs), len(pairs))
        assert wrong(pairs) <= 0.03
