import random
import re
import zlib
from collections import Counter

import pytest
from llm_helpers import docs

from cuebreaks.llm import spelling


def plain_words(rows, garbled=97):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % garbled == 0 else run] += 1
    return counts


def cuts(word):
    return {word[:k] + word[k + 1 :] for k in range(len(word))}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return b in cuts(a) or a in cuts(b)


def plain(rows, least_letters=5, least_count=3, factor=2, garbled=97):
    known = {w: n for w, n in plain_words(rows, garbled).items() if len(w) >= least_letters and n >= least_count}
    near = {w: [v for v in known if abs(len(v) - len(w)) <= 1 and v != w and is_near(w, v)] for w in known}
    best = {w: min(vs, key=lambda v: (-known[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if known[v] >= factor * known[w]}
    found = []
    for w, n in known.items():
        root = w
        while root in form:
            root = form[root]
        found.append((w, form.get(w), root, n, len(near[w]), known[form[w]] if w in form else None))
    return sorted(found)


def told(frame):
    return sorted(tuple(r) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect())


def typo(rng, word):
    k = rng.randrange(len(word))
    letter = rng.choice("aeioustnré")
    return rng.choice([word[:k] + word[k + 1 :], word[:k] + letter + word[k:], word[:k] + letter + word[k + 1 :]])


def corpus(seed, n=150):
    rng = random.Random(seed)
    base = ["".join(rng.choice("aeioustnréÉ×") for _ in range(rng.randrange(4, 8))) for _ in range(60)]
    base += [typo(rng, w) for w in base for _ in range(2)]
    base += [typo(rng, w) for w in base]
    return [(k, " ".join(rng.choice(base).title() if rng.random() < 0.1 else rng.choice(base[: 1 + rng.randrange(len(base))]) for _ in range(80))) for k in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = corpus(seed)
    expected = plain(rows)
    assert sum(r[1] is not None for r in expected) > 50 and any(r[1] != r[2] for r in expected if r[1])
    assert told(spelling.spelling_groups(docs(spark, rows))) == expected


def test_big_groups_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(spelling, "TILE", 16)
    monkeypatch.setattr(spelling, "SMALL", 8)
    rows = corpus(3)
    expected = plain(rows, garbled=3)
    assert told(spelling.spelling_groups(docs(spark, rows), garbled=3, group_rows=5)) == expected
    assert told(spelling.spelling_groups(docs(spark, rows), garbled=3)) == expected


def test_odd_rows(spark):
    long_word = "z" * 3000
    rows = corpus(4, 60) + [(None, None), (None, "Hello hello HELLO helo0hello"), (1, ""), (2, "Étéville " * 5)]
    rows += [(7, f"{long_word} {long_word} {long_word} y{long_word} y{long_word} y{long_word}")] * 2
    rows += [(8, "a " * 200_000 + "abcdef " * 3)]
    assert told(spelling.spelling_groups(docs(spark, rows))) == plain(rows)


def test_chains_ties_and_one_letter_moved(spark):
    text = {"abcdef": 40, "abcdeg": 20, "abcdhg": 10, "abkdhg": 5, "abcfed": 9, "mmmmmx": 8, "mmmmmy": 8, "mmmmmm": 4, "nnnnn": 3}
    rows = [(k, w) for w, n in text.items() for k in range(n)]
    found = {r[0]: r for r in told(spelling.spelling_groups(docs(spark, rows), garbled=(1 << 32) - 5))}
    assert found["abkdhg"][1:3] == ("abcdhg", "abcdef")
    assert found["mmmmmm"][1:3] == ("mmmmmx", "mmmmmx") and found["mmmmmm"][4] == 2
    assert found["abcfed"] == ("abcfed", None, "abcfed", 9, 0, None)
    assert found["nnnnn"][4] == 0


def test_empty_table(spark):
    assert spelling.spelling_groups(docs(spark, [])).count() == 0
    assert spelling.spelling_groups(docs(spark, [(1, None), (2, "ab 12")])).count() == 0


def test_checksums_are_joined():
    rng = random.Random(6)
    tally = spelling.Tally(5)
    rows = [(k, " ".join("abcéX" [rng.randrange(5)] * rng.randrange(1, 90) for _ in range(20))) for k in range(50)]
    for doc_id, text in rows:
        tally.add(doc_id, text)
    batch = tally.flush(1)
    assert dict(zip(*(c.to_pylist() for c in batch.columns))) == {w: n for w, n in plain_words(rows, 5).items() if w}


def test_table_of_words_stays_bounded(spark, monkeypatch):
    monkeypatch.setattr(spelling, "OCCURRENCES", 7)
    tally = spelling.Tally(97)
    for doc_id, text in corpus(7, 5):
        tally.add(doc_id, text)
        assert tally.pending < 7
    tally.flush(5)
    assert not tally.words and not tally.changed


def test_one_edit():
    assert spelling.one_edit("abc", "abd") and spelling.one_edit("abc", "abcd") and spelling.one_edit("abc", "xabc")
    assert not spelling.one_edit("abc", "acb") and not spelling.one_edit("abc", "abc") and not spelling.one_edit("abc", "acbd")


def test_every_letter_has_one_part(spark):
    words = spark.createDataFrame([("abcde",), ("ééééé",)], "word string")
    parts = spelling.letter_parts(words)
    assert sorted("".join(parts)) == sorted(spelling.ALPHABET)
