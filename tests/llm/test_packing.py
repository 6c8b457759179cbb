import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from llm_helpers import SF, docs, sample_texts

from cuebreaks.llm import packing
from cuebreaks.llm.queries import QUERIES, word_tokenizer


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(word_tokenizer())


ODD = [
    "", " ", "a", "<|ENDOFTEXT|> <|EndOfText|>x", "J\u030c H\u0331x E\u0301 I\u0307", "Œuvre ÀÉÎ µ",
    "it's  'S. x's", "<|endoftext|>a <|startoftext|>", "été İzmir ΟΣ Σ.",
    "q\x1c\x1dw  x y", "don't...  stop!? ok,", "K ẞ ß", "中文 \U0001f600\n\n\tz", "Êté, œuvre; ñ: a1b2",
    "\u09df, \u0958. \ufb2a, İ, a",
]


def test_ids_are_the_tokenizers(tokenizer):
    tokens = packing.Tokens(word_tokenizer())
    for text in ODD + [t for _, t in sample_texts()[:60]]:
        expected = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(tokens(text), "<u4").tolist() == expected, text


def test_ids_of_scripts_that_decompose(tokenizer):
    """Letters that composing or lower-casing takes apart, between marks and blanks."""
    rng, tokens = random.Random(21), packing.Tokens(word_tokenizer())
    ranges = [(0x958, 0x960), (0x9DC, 0x9E0), (0xFB1D, 0xFB4F), (0xA33, 0xA37), (0xF43, 0xF70), (0x1E96, 0x1E9C), (0x1F80, 0x1FB5)]
    odd = [chr(c) for a, b in ranges for c in range(a, b)] + list("İΣςßŉǰΐµſ") + ["\u0307", "\u0301", "\u09bc", "\u05b7", "\u093c"]
    seen = sorted({chr(rng.randrange(0xC0, 0x30000)) for _ in range(9000)} | {chr(rng.randrange(0xC0, 0x3000)) for _ in range(6000)})
    marks = list(".,;:!?") + [". ", ", ", "! ", ": ", " ", "\n", ".\n", "-"]
    texts = []
    for _ in range(50_000):
        letter = lambda: rng.choice(odd if rng.random() < 0.6 else seen if rng.random() < 0.5 else "aeioxÉé")
        texts.append("".join(letter() if rng.random() < 0.6 else rng.choice(marks) for _ in range(rng.randrange(1, 9))))
    texts = [t for t in texts if not any("\ud800" <= c <= "\udfff" for c in t)]
    for text, own in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(tokens(text), "<u4").tolist() == own.ids, ascii(text)


def test_table_of_pieces_stays_bounded(monkeypatch, tokenizer):
    monkeypatch.setattr(packing, "PIECES_KEPT", 20)
    tokens = packing.Tokens(word_tokenizer())
    for text in [t for _, t in sample_texts()[:20]] * 2:
        assert np.frombuffer(tokens(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def check_pieces(rows, texts, tokenizer, capacity):
    """Every id lies in one piece, pieces in windows without gaps or overlaps."""
    by_doc, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        windows[r.sequence_id].append((r.offset, r.length))
    assert by_doc.keys() == texts.keys()
    for doc_id, pieces in by_doc.items():
        ids = np.array([*tokenizer.encode(texts[doc_id] or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for spans in windows.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return windows


def test_query_covers_all_ids_with_little_padding(spark, tokenizer):
    rows = QUERIES["op1_packing"](spark, SF).collect()
    windows = check_pieces(rows, dict(sample_texts()), tokenizer, 4096)
    total = sum(r.length for r in rows)
    assert len(windows) <= -(-total // 4096) + max(2, total // 4096 // 20)


def test_odd_rows(spark, tokenizer):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(90, None), (91, "word " * 5000)]
    packed = packing.pack(docs(spark, rows), word_tokenizer(), capacity=64, max_piece=16, block_windows=4)
    check_pieces(packed.collect(), dict(rows), tokenizer, 64)


def test_repeated_rows_and_null_ids(spark):
    frame = docs(spark, [(1, "a b c"), (1, "a b c"), (None, "d"), (None, None)])
    rows = packing.pack(frame, word_tokenizer()).collect()
    assert sorted(r.length for r in rows) == [1, 2, 4, 4]
    assert len({(r.sequence_id, r.offset) for r in rows}) == 4


def test_empty_table(spark):
    assert packing.pack(docs(spark, []), word_tokenizer()).count() == 0


def test_differencing_is_near_equal():
    rng = random.Random(5)
    lengths = [rng.randrange(1, 1000) for _ in range(600)]
    found = packing.difference(lengths, 40)
    assert sorted(k for w in found for k in w) == list(range(600))
    sums = [sum(lengths[k] for k in w) for w in found]
    assert max(sums) - min(sums) <= 5


@pytest.mark.parametrize("lengths", [[], [4], [4, 4, 4], [3, 3, 3], [1, 1, 1, 1, 1], [2, 3, 2, 3, 2]])
def test_windows_never_overflow(lengths):
    found = packing.fill_windows(lengths, 4)
    assert sorted(k for w in found for k in w) == list(range(len(lengths)))
    assert all(sum(lengths[k] for k in w) <= 4 for w in found)


def test_count_rises_when_capacity_is_exceeded():
    # 12 fills three windows of four by sum, but three threes and a three do not fit that way.
    assert len(packing.fill_windows([3, 3, 3, 3], 4)) == 4


def test_cuts_cover_the_document():
    for n in (1, 15, 16, 17, 64, 65, 200):
        borders = packing.cuts(n, 64, 16)
        assert borders[0] == 0 and borders[-1] == n
        assert all(0 < b - a <= 64 for a, b in zip(borders, borders[1:]))
