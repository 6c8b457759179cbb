import hashlib
import random

import numpy as np
import pytest
from llm_helpers import SF, docs, sample_texts

from cuebreaks.llm import induced, suffix_dedup
from cuebreaks.llm.queries import QUERIES


def plain(rows, length=100):
    """Bytes, removed bytes, spans and digest of the rest, by trying every window."""
    seen, found = {}, []
    for place, (doc_id, text) in enumerate(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))):
        body = (text or "").encode()
        gone = np.zeros(len(body) + 1, bool)
        for at in range(len(body) - length + 1):
            if seen.setdefault(body[at : at + length], (place, at)) != (place, at):
                gone[at : at + length] = True
        kept = bytes(b for b, g in zip(body, gone) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + (gone[0] if len(body) else 0))
        found.append((doc_id, len(body), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=repr)


def of(frame):
    rows = frame.collect()
    return sorted(
        (
            (r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), hashlib.sha256(r.kept).hexdigest())
            for r in rows
        ),
        key=repr,
    )


def test_query_against_every_window(spark):
    result = QUERIES["op5_suffix_dedup"](spark, SF)
    assert sorted((tuple(r) for r in result.collect()), key=repr) == plain(sample_texts())


def messy(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 9)))
    passages = [" ".join(word() for _ in range(rng.randrange(20, 80))) for _ in range(6)]
    rows = [(None, None), (1, ""), (2, "x" * 700), (3, "ab" * 300), (4, "x" * 99), (5, "x" * 100)]
    for k in range(6, 60):
        parts = [rng.choice(passages)[rng.randrange(30) :] if rng.random() < 0.5 else " ".join(word() for _ in range(30)) for _ in range(4)]
        rows.append((k, " ".join(parts)))
    rows += [(k + 100, t) for k, t in rows[20:40]]  # whole copies
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_messy_texts(spark, seed):
    rows = messy(seed)
    assert of(suffix_dedup.remove_repeats(docs(spark, rows), shard_bytes=3000)) == plain(rows)


@pytest.mark.parametrize("length", [256, 300])
def test_windows_longer_than_a_byte_counts(spark, length):
    rng = random.Random(length)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    passage = word(500)
    rows = [(k, word(90) + passage + word(90)) for k in range(5)] + [(9, passage[: length - 1]), (10, passage[-length:])]
    found = of(suffix_dedup.remove_repeats(docs(spark, rows), length=length))
    assert found == plain(rows, length) and sum(r[2] for r in found) >= 4 * 500 + length


def test_an_anchor_with_very_many_versions(spark, monkeypatch):
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    passage = word(300)
    rows = [(k, word(120) + passage + word(rng.randrange(0, 120))) for k in range(150)] + [(None, "x" + passage)]

    def bounded(document, start, bodies, length, real=suffix_dedup.repeats_in_shard):
        assert sum(map(len, bodies)) <= 2 * 4000, "a task holds all versions of an anchor"
        return real(document, start, bodies, length)

    monkeypatch.setattr(suffix_dedup, "repeats_in_shard", bounded)  # goes to the workers by value
    found = of(suffix_dedup.remove_repeats(docs(spark, rows + rows[:9]), shard_bytes=4000))
    assert found == sorted([r for r in plain(rows) for _ in range(1 + (r[0] in range(9)))], key=repr)


def test_pieces_of_long_texts(spark, monkeypatch):
    rows = messy(9)
    monkeypatch.setattr(suffix_dedup, "_PIECE", 300)
    kept = suffix_dedup._segment_rows(100)  # built under the small piece size, run here
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array(range(len(rows)), pa.int64()), pa.array([(r[1] or "").encode() for r in rows])],
        ["doc_id", "text_hash", "body"],
    )
    starts = {}
    for out in kept(iter([batch])):
        for r in out.to_pylist():
            starts.setdefault(r["text_hash"], set()).update(range(r["start"], r["start"] + r["size"] - 99))
    for k, (_, text) in enumerate(rows):
        assert starts.get(k, set()) == set(range(max(0, len((text or "").encode()) - 99)))


def test_rows_alike_are_one_place(spark):
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefgh ") for _ in range(400))
    found = suffix_dedup.remove_repeats(docs(spark, [(1, text), (1, text), (2, text)])).collect()
    assert sorted((r.doc_id, len(r.kept)) for r in found) == [(1, 400), (1, 400), (2, 0)]


def test_empty_table(spark):
    assert suffix_dedup.remove_repeats(docs(spark, [])).count() == 0


def sorted_suffixes(parts):
    text = [s for p in parts for s in [*((b + 1, 0) for b in p), (0, None)]]
    text = [(s, k if s == 0 else 0) for k, (s, _) in enumerate(text)]
    order = sorted((k for k, s in enumerate(text) if s[0]), key=lambda k: text[k : k + 400])

    def shared(a, b):
        k = 0
        while text[a + k] == text[b + k]:
            k += 1
        return k if k else 0

    lcp = [shared(a, b) for a, b in zip(order, order[1:])]
    return text, order, [0, *lcp]


@pytest.mark.parametrize("seed", range(40))
def test_induced_sorting(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(induced, "BLOCK", rng.choice([2, 5, 1 << 16]))
    monkeypatch.setattr(induced.Queues.__init__, "__defaults__", (rng.choice([3, 40, 1 << 22]),))  # tuples spill
    letters = rng.choice([1, 2, 3, 26])
    parts = [bytes(rng.randrange(97, 97 + letters) for _ in range(rng.randrange(1, 40))) for _ in range(8)]
    parts += [p[rng.randrange(len(p)) :] for p in parts] + [b"\xff" * 4, b"\x00" * 3]
    text, order, lcp = sorted_suffixes(parts)
    blocks = list(induced.Shard(np.array([s[0] for s in text], np.uint16)).runs())
    assert np.concatenate([b[0] for b in blocks]).tolist() == order
    assert np.concatenate([b[1] for b in blocks]).tolist() == lcp
