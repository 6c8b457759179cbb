import hashlib
import random

import numpy as np
import pytest
from llm_helpers import SF, docs, sample_texts

from cuebreaks.llm import sentencepiece_bpe as sp
from cuebreaks.llm.queries import QUERIES, piece_model, word_tokenizer


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=piece_model())


@pytest.fixture(scope="module")
def words():
    return sp.Vocabulary(piece_model())


def ids_of(raw):
    return np.frombuffer(raw, "<u4").tolist()


def same(words, library, text):
    expected = library.encode(text, add_bos=True, add_eos=True)
    assert ids_of(words.encode(text)) == expected, text
    assert words.decode(np.array(expected, "uint32")) == library.decode(expected), text


ODD = [
    "", " ", "  ", "▁", "a▁ b", "<s></s><unk>", "<0x41>", "\x00", "é́ ﬁ ①", "中文 日本語 한국어", "\U0001f600x\U0001f600",
    "word,word.\nword\t;x", "0001110101010", "aaaaaaaaaaaaaaaaaaaaaaaa", " " * 15, " " * 30 + "hello", "a" + " " * 47 + "b", "\n\n\n  \n",
    "''\"\"..,,}},},", "http://a.b/c?d=e&f", "x" * 5000, "क़য় אשׁ", "the the  the   the",
]


def test_odd_texts(words, library):
    for text in ODD:
        same(words, library, text)


def test_sample_texts(words, library):
    for _, text in sample_texts():
        same(words, library, text)


def test_random_texts(words, library):
    rng, pieces = random.Random(11), list(words.pieces)
    makers = [
        lambda: "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 12))),
        lambda: "".join(rng.choice(pieces)[: rng.randrange(1, 9)] for _ in range(rng.randrange(1, 12))).replace("▁", " "),
        lambda: "".join(rng.choice("aeiourstln  ") for _ in range(rng.randrange(1, 40))),
        lambda: "".join(rng.choice(" \t\nab.") for _ in range(rng.randrange(1, 60))),
        lambda: "".join(chr(rng.randrange(1, 0x3000)) for _ in range(rng.randrange(1, 30))),
        lambda: "".join(rng.choice("ab01<>x,'") for _ in range(rng.randrange(1, 80))),
    ]
    for k in range(12_000):
        same(words, library, makers[k % len(makers)]())


def test_decoding_any_ids(words, library):
    rng = random.Random(12)
    for _ in range(5000):
        ids = [rng.choice([rng.randrange(300), rng.randrange(32000)]) for _ in range(rng.randrange(12))]
        assert words.decode(np.array(ids, "uint32")) == library.decode(ids), ids


def test_rows_of_pieces_are_those_that_merging_leaves(words):
    """The search against merging over the whole text, pair by pair, without any part of the search."""
    rng = random.Random(13)
    for _ in range(1500):
        text = "".join(rng.choice("abcdeinrst▁.,'0") for _ in range(rng.randrange(1, 25)))
        assert words.search(text) == words.merged(text)


def test_search_goes_back(words, monkeypatch):
    back = []
    plain = words.next_shorter
    monkeypatch.setattr(words, "next_shorter", lambda piece: back.append(piece) or plain(piece))
    rng = random.Random(14)
    for _ in range(300):
        words.search("".join(rng.choice("aeinrst") for _ in range(30)))
    assert back


def test_tables_stay_bounded(library, monkeypatch):
    monkeypatch.setattr(sp, "PARTS_KEPT", 10)
    monkeypatch.setattr(sp, "PAIRS_KEPT", 10)
    small = sp.Vocabulary(piece_model())
    for _, text in sample_texts()[:10]:
        same(small, library, text)
    assert len(small) <= 11 and len(small.pairs) <= 11


def test_query_over_whole_table(spark, library):
    found = {r.doc_id: r for r in QUERIES["op13_sentencepiece"](spark, SF).collect()}
    texts = dict(sample_texts())
    assert found.keys() == texts.keys()
    for doc_id, text in texts.items():
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        r = found[doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_rows_and_columns(spark, library):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(None, "a b"), (1, None), (1, " "), (1, " "), (5, "word " * 50000)]
    frame = docs(spark, rows).selectExpr("*", "'own' AS ids", "'own' AS decoded")
    encoded = sp.encode(frame, piece_model())
    assert encoded.columns == [*frame.columns, "_ids"]
    found = sp.decode(encoded, piece_model(), "_ids")
    assert found.columns == [*encoded.columns, "_decoded"]
    got = sorted(((r.doc_id, ids_of(r._ids), r._decoded) for r in found.collect()), key=repr)
    plain = [(i, library.encode(t or "", add_bos=True, add_eos=True)) for i, t in rows]
    assert got == sorted(((i, ids, library.decode(ids)) for i, ids in plain), key=repr)


def test_empty_table_and_null_ids(spark):
    assert sp.decode(sp.encode(docs(spark, []), piece_model()), piece_model()).count() == 0
    nothing = spark.createDataFrame([(None,)], "ids binary")
    assert [r.decoded for r in sp.decode(nothing, piece_model()).collect()] == [""]


def test_other_models_are_refused():
    with pytest.raises(Exception):
        sp.Vocabulary(word_tokenizer())
