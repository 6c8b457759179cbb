import random
import re

import numpy as np
import pytest
import xxhash
from llm_helpers import SF, docs, sample_texts

from cuebreaks.llm import simhash
from cuebreaks.llm.components import component_roots
from cuebreaks.llm.queries import QUERIES
from cuebreaks.sources.staging import Stage


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, max_bits=3):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    bits = np.array(values, np.uint64)
    for i in range(len(bits)):
        for j in np.flatnonzero(np.bitwise_count(bits[i] ^ bits[i + 1 :]) <= max_bits):
            a, b = find(i), find(i + 1 + int(j))
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


@pytest.mark.parametrize("text", [None, "", " \n", "One", "ONE two", "a b c", "Été  x A\x0bB\x1cC d", "z " * 50000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_query_against_all_pairs(spark):
    rows = sample_texts()
    values = [plain_fingerprint(t) for _, t in rows]
    roots = plain_components(values)
    want = sorted((d, f"{v:016x}", rows[r][0]) for (d, _), v, r in zip(rows, values, roots))
    result = QUERIES["op4_simhash"](spark, SF)
    assert sorted(tuple(r) for r in result.collect()) == want


def clustered(rng, n, dense=0):
    """Fingerprints around a few centres, some of them chains."""
    found = {rng.getrandbits(64) for _ in range(n // 3)}
    while len(found) < n:
        value = rng.choice(list(found)[:20])
        for _ in range(rng.randrange(1, 6)):
            value ^= 1 << rng.randrange(64)
        found.add(value)
    centre = rng.getrandbits(64)
    return [*found, *{centre ^ (1 << a) ^ (1 << b) for a in range(dense) for b in range(a)}]


def partition(pairs):
    groups = {}
    for node, root in pairs:
        groups.setdefault(root, set()).add(node)
    return {frozenset(g) for g in groups.values() if len(g) > 1}


@pytest.mark.parametrize("seed", range(4))
def test_index_finds_the_links_of_every_group(seed):
    rng = random.Random(seed)
    values = np.array(clustered(rng, 150, dense=20), np.uint64)
    group = np.array([rng.randrange(4) if seed % 2 else 0 for _ in values], np.int64)
    a, b = simhash.stars(group, values, 3)
    want = set()
    for g in set(group.tolist()):
        own = values[group == g]
        roots = plain_components(own)
        want |= {(g, c) for c in partition(zip(own.tolist(), roots))}
    assert len(a) == sum(len(c) - 1 for _, c in want)
    of = {int(v): int(g) for v, g in zip(values, group)}
    links = {}
    for x, y in zip(a.tolist(), b.tolist()):
        links.setdefault((of[y], y), {y}).add(x)
    assert {(g, frozenset(c)) for (g, _), c in links.items()} == want


@pytest.mark.parametrize("cell", [8192, 7])
def test_links_connect_what_all_pairs_connect(spark, cell):
    values = clustered(random.Random(11), 300, dense=24)
    frame = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "bits long")
    stage = Stage(spark)
    roots = component_roots(simhash.fingerprint_links(frame, stage, cell=cell), stage).collect()
    found = partition([(r.node % (1 << 64), r.root) for r in roots])
    assert found == partition(zip(values, plain_components(values)))


def test_components_of_chains_stars_and_loops(spark):
    links = [(k, k + 1) for k in range(100, 140)] + [(500, k) for k in range(501, 560)] + [(7, 7), (9, 8), (8, 9)]
    roots = component_roots(spark.createDataFrame(links, "a long, b long"), Stage(spark))
    want = {**{k: 100 for k in range(100, 141)}, **{k: 500 for k in range(500, 560)}, 8: 8, 9: 8}
    assert {r.node: r.root for r in roots.collect()} == want


def test_gray_rank_orders_by_single_steps():
    ranked = sorted(range(64), key=lambda v: int(simhash.gray_rank(np.array([v], np.uint64))[0]))
    assert all(bin(a ^ b).count("1") == 1 for a, b in zip(ranked, ranked[1:]))


ROWS = [(4, "one two three four"), (2, "One two THREE four"), (2, "One two THREE four"), (None, "one two three four"),
        (9, None), (8, ""), (7, "something else entirely different here"), (None, "alone in this world of words")]


def test_odd_rows(spark):
    found = simhash.near_duplicates(docs(spark, ROWS)).collect()
    same = {r.component_id for r in found if r.text_hash is not None and r.doc_id in (2, 4)}
    assert same == {2} and len(found) == len(ROWS)
    assert {r.component_id for r in found if r.doc_id in (8, 9)} == {8}
    assert [r.component_id for r in found if r.doc_id is None].count(None) == 1


def test_filter_keeps_one_row_of_each_group(spark):
    frame = docs(spark, ROWS)
    kept = simhash.drop_near_duplicates(frame)
    assert kept.schema == frame.schema
    assert sorted((r.doc_id or -1 for r in kept.collect())) == [-1, 2, 7, 8]


def test_empty_table(spark):
    assert simhash.near_duplicates(docs(spark, [])).count() == 0
    assert simhash.drop_near_duplicates(docs(spark, [])).count() == 0
