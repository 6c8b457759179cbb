import os
import re
import subprocess
import sys

import pytest
from llm_helpers import docs, tuples
from pyspark.sql import functions as F

from cuebreaks.llm import decontam

ALPHA = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
BENCH = [(1, ALPHA), (2, "Short Item"), (3, None), (4, "..."), (5, "short item"), (None, "no number here"), (10, "the the the")]
DOCS = [
    (1, f"x y {ALPHA.upper()} z"),
    (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa"),
    (3, "alpha beta gamma delta epsilon zeta eta theta iota"),
    (4, "a short, ITEM! short-item shorter item"),
    (5, None),
    (6, ""),
    (7, "the the the the"),
    (None, "no number here"),
    (8, "no number here"),
    (8, "no number here"),
    (9, "é ALPHA Été " + ALPHA + " " + "w " * 40000 + ALPHA),
    (10, "kappa iota theta eta zeta epsilon delta gamma beta alpha"),
]


def words(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(rows, bench, window=10):
    found = []
    windows = {}
    for item, text in bench:
        w = words(text)
        for k in range(max(len(w) - window, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + window]), set()).add(item)
    for doc_id, text in rows:
        w = words(text)
        hit, items = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if of := windows.get(tuple(w[k : k + n])):
                    hit.update(range(k, k + n))
                    items |= of
        listed = sorted(str(i) for i in items if i is not None)
        found.append((doc_id, len(w), len(hit), len(items), listed, bool(hit)))
    return sorted(found, key=repr)


def of(frame):
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items", "contaminated"]
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def benchmark(spark, rows=BENCH):
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("terms", F.lit("own"))


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_odd_documents(spark, monkeypatch, broadcast):
    monkeypatch.setattr(decontam, "BROADCAST_TERMS", broadcast)
    assert of(decontam.contamination(docs(spark, DOCS), benchmark(spark))) == plain(DOCS, BENCH)


def test_long_lists_of_terms_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", 10)
    assert of(decontam.contamination(docs(spark, DOCS), benchmark(spark))) == plain(DOCS, BENCH)


@pytest.mark.parametrize("piece, window", [(1, 10), (4, 2), (12, 1)])
def test_pieces_lose_no_window(spark, monkeypatch, piece, window):
    monkeypatch.setattr(decontam, "PIECE_WORDS", piece)
    rows = [r for r in DOCS if r[0] != 9] + [(11, "q " * 5 + ALPHA + " " + ALPHA + " the the"), (12, " ".join("ab" * 30))]
    bench = BENCH + [(20, "a b a b a b a b a b a")]
    assert of(decontam.contamination(docs(spark, rows), benchmark(spark, bench), window)) == plain(rows, bench, window)


LONG = """
import resource, time
from pyspark.sql import SparkSession, functions as F
from cuebreaks.llm import decontam
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.driver.memory", "1g")
    .config("spark.sql.shuffle.partitions", "2").getOrCreate())
bench = spark.createDataFrame([(1, "zeta b")], "item_id long, text string")
def seconds(n):
    docs = spark.range(1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("zeta a a zeta b a a zeta a a "), n // 10).alias("text"))
    begin = time.time()
    found = [(r.n_words, r.n_hit, r.n_items) for r in decontam.contamination(docs, bench).collect()]
    assert found == [(n, n // 5, 1)], found
    return time.time() - begin
seconds(1000)
short, long = seconds(250_000), seconds(1_000_000)
print("took", short, long, "linear", long < 8 * short + 5)
"""


def test_a_million_words_in_a_small_heap(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {**os.environ, "PYTHONPATH": root}
    done = subprocess.run([sys.executable, "-c", LONG], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=400)
    assert "linear True" in done.stdout, done.stderr[-2000:]


def test_other_window_lengths(spark):
    assert of(decontam.contamination(docs(spark, DOCS), benchmark(spark), window=3)) == plain(DOCS, BENCH, 3)


def test_proximity_matches_are_told_apart(spark):
    hits = decontam.phrase_hits(docs(spark, [(10, DOCS[-1][1]), (2, DOCS[1][1])]), benchmark(spark))
    assert tuples(hits.filter("not exact").select("doc_id", "item_id").distinct(), "doc_id") == [(10,)]
    assert tuples(hits.filter("exact"), "doc_id", "start", "length", "item_id") == [(2, 0, 10, 1)]


def test_filter_keeps_clean_rows_whole(spark):
    frame = docs(spark, DOCS)
    kept = decontam.drop_contaminated(frame, benchmark(spark))
    assert kept.schema == frame.schema
    want = [(r[0],) for r in plain(DOCS, BENCH) if not r[5]]
    assert tuples(kept, "doc_id") == sorted(want)


def test_empty_tables(spark):
    assert decontam.contamination(docs(spark, []), benchmark(spark)).count() == 0
    clean = decontam.contamination(docs(spark, DOCS), benchmark(spark, [])).collect()
    assert len(clean) == len(DOCS) and not any(r.contaminated for r in clean)
    assert decontam.drop_contaminated(docs(spark, DOCS), benchmark(spark, [])).count() == len(DOCS)
