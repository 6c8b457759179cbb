from collections import Counter, defaultdict

import duckdb
import pytest
from llm_helpers import docs
from pyspark.sql import functions as F

from cuebreaks.llm import langid
from cuebreaks.llm.queries import QUERIES

BIG = "/root/testdata/sf0.01"


def plain_grams(text):
    counts = Counter()
    word = ""
    for c in (text or "").lower() + " ":
        if c.isalpha():
            word += c
            continue
        if word:
            padded = f" {word} "
            counts.update(word)
            counts.update(padded[k : k + 2] for k in range(len(padded) - 1))
            counts.update(padded[k : k + 3] for k in range(len(padded) - 2))
            word = ""
    return counts


def code(gram):
    points = [0 if c == " " else ord(c) for c in gram]
    return sum(p << 18 * k for k, p in enumerate(reversed(points))) | len(gram) << 54


def top(counts, size):
    return sorted(counts, key=lambda g: (-counts[g], code(g)))[:size]


def test_counts_of_grams():
    for text in ["A", "ab cd", " Été... œuvre 12x", "中文 字", "a-b c\U0001f600d", "  ", "x" * 5]:
        grams, counts = langid.counted(text)
        assert dict(zip(grams.tolist(), counts.tolist())) == {code(g): n for g, n in plain_grams(text).items()}


@pytest.mark.parametrize("chunk", [1, 2, 3, 7])
@pytest.mark.parametrize("text", ["", "  ", "aé", "語言識別沒有空格" * 9, "one\ntwo\tthree;;four\n\n" * 5, "a1b22cc  ddd" * 5 + "\n"])
def test_no_ngram_is_lost_between_pieces(monkeypatch, chunk, text):
    whole = [part.tolist() for part in langid.counted(text)]
    monkeypatch.setattr(langid, "_CHUNK", chunk)
    assert [part.tolist() for part in langid.counted(text)] == whole


def test_long_texts_are_counted_in_pieces(monkeypatch):
    monkeypatch.setattr(langid, "_CHUNK", 50)
    text = "some words of a text " * 40
    grams, counts = langid.counted(text)
    assert dict(zip(grams.tolist(), counts.tolist())) == {code(g): n for g, n in plain_grams(text).items()}


ROWS = [("en", "the cat and the dog"), ("en", "the cat and the dog"), ("de", "der hund und die katze"),
        ("fr", "le chat et le chien"), (None, "the the the"), ("xx", None), ("de", "")]


def test_predictions_against_the_definition(spark):
    frame = spark.createDataFrame(ROWS, "lang string, text string").withColumn("gram", F.lit(1))
    size = 30
    profiles = langid.learn(frame, size=size)
    sums = defaultdict(Counter)
    for lang, text in ROWS:
        if lang and text:
            sums[lang].update(plain_grams(text))
    ranks = {lang: top(c, size) for lang, c in sums.items()}
    for text in ["the hund", "le dog et", "und", "zzz", "CAT"]:
        own = top(plain_grams(text), size)
        cost = {
            lang: sum(abs(k - r.index(g)) if g in r else size for k, g in enumerate(own)) for lang, r in ranks.items()
        }
        best = min(sorted(cost), key=cost.get)
        assert profiles.nearest(text) == (best, 1 - cost[best] / (size * len(own)))


def test_odd_documents(spark):
    profiles = langid.learn(spark.createDataFrame(ROWS, "lang string, text string"))
    frame = docs(spark, [(1, None), (2, ""), (3, "12 -- \U0001f600"), (4, "the dog"), (4, "the dog"), (None, "le " * 90000)])
    found = langid.identify(frame, profiles, ["doc_id"]).collect()
    assert sorted((r.doc_id or 0, r.lang_pred) for r in found) == [(0, "fr"), (1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en")]
    assert all(0 <= r.score <= 1 for r in found)


def test_nothing_to_learn_from_and_empty_table(spark):
    profiles = langid.learn(spark.createDataFrame([], "lang string, text string"))
    assert [tuple(r) for r in langid.identify(docs(spark, [(1, "word")]), profiles, ["doc_id"]).collect()] == [(1, "und", 0.0)]
    assert langid.identify(docs(spark, []), profiles, ["doc_id"]).count() == 0


def test_held_out_accuracy(spark):
    truth = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{BIG}/documents.parquet' WHERE lang IS NOT NULL").fetchall())
    rows = [r for r in QUERIES["op8_language_id"](spark, BIG).collect() if r.held_out and r.doc_id in truth]
    right = sum(r.lang_pred == truth[r.doc_id] for r in rows)
    assert len(rows) > 150 and right >= 0.98 * len(rows)
