from __future__ import annotations

import random
import re
from collections import Counter
from itertools import combinations

import pytest
import xxhash

from allotment.llm.components import connected_components
from allotment.llm.simhash import covering_triples, fingerprint, near_duplicates, near_pairs, one_of_each

from . import frames


def brute_fingerprint(text: str | None) -> int:
    words = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    grams = [b" ".join(words[k : k + 4]) for k in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, edges):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_triples_cover_all_fours():
    triples = covering_triples()
    assert len(triples) == 20
    assert all(any(set(t) <= set(four) for t in triples) for four in combinations(range(8), 4))


def test_fingerprint_agrees_with_brute_force():
    random.seed(3)
    for count in (0, 1, 3, 4, 5, 300, 70000):
        text = " ".join(random.choices(["a", "B", "cé", "dD", "e\x1cf"], k=count))
        assert fingerprint(text.encode()) == brute_fingerprint(text)


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("block", [16384, 7])
def test_pairs_connect_what_links_connect(spark, block):
    random.seed(block)
    marks = {random.getrandbits(64) for _ in range(40)} | {0, (1 << 64) - 1}
    for base in list(marks)[:8]:
        for _ in range(12):
            near = base
            for bit in random.sample(range(64), random.randint(1, 6)):
                near ^= 1 << bit
            marks.add(near)
    frame = spark.createDataFrame([(signed(m),) for m in marks], "fp long")
    found = [(r.a, r.b) for r in near_pairs(frame, block=block).collect()]
    links = [(signed(a), signed(b)) for a, b in combinations(marks, 2) if (a ^ b).bit_count() <= 4]
    nodes = [signed(m) for m in marks]
    assert components(nodes, found) == components(nodes, links)


def test_edges_and_repeats(spark):
    rows = near_duplicates(frames.docs(spark, frames.EDGES)).collect()
    assert len(rows) == len(frames.EDGES)
    texts = dict((i, t) for i, t, _, _ in frames.EDGES)
    assert all(r.fingerprint == f"{brute_fingerprint(texts[r.doc_id]):016x}" for r in rows)
    of = {r.doc_id: r.component_id for r in rows}
    assert (of[1], of[2], of[8], of[3], of[4], of[7], of[None]) == (1, 1, 1, 3, 3, 3, None)


def test_empty_table(spark):
    out = near_duplicates(frames.docs(spark, []))
    assert out.columns == ["doc_id", "fingerprint", "component_id"] and out.count() == 0


def test_components_of_chains_stars_and_loops(spark):
    chain = [(k, k + 1) for k in range(60)]
    star = [(1000, k) for k in range(1001, 1080)] + [(2000, k) for k in (1500, 1400, 1079)]
    loops = [(5000, 5000), (7, None), (None, None), (3, 2)]
    frame = spark.createDataFrame(chain + star + loops, "a long, b long")
    found = {r.node: r.component for r in connected_components(frame).collect()}
    nodes = {n for e in chain + star for n in e}
    assert found == components(nodes, chain + star)
    assert connected_components(frame.limit(0)).count() == 0


def test_one_of_each_keeps_unlike_texts_under_one_id(spark):
    words = lambda seed, n=60: " ".join(random.Random(seed).choices([f"w{k}" for k in range(500)], k=n))
    a, b, c = words(1), words(2), words(3)
    kept = lambda rows: sorted((r.doc_id, r.text) for r in one_of_each(frames.docs(spark, rows)).collect())
    row = lambda i, t, lang="en": (i, t, lang, "s")
    assert kept([row(1, a), row(1, b), row(2, c)]) == sorted([(1, a), (1, b), (2, c)])
    assert kept([row(1, a), row(5, a), row(5, b)]) == sorted([(1, a), (5, b)])
    assert kept([row(5, a), row(5, a, "de"), row(7, a)]) == [(5, a)]
    out = [(r.doc_id, r.text) for r in one_of_each(frames.docs(spark, [row(None, a), row(None, b), row(3, b)])).collect()]
    assert Counter(out) == Counter([(None, a), (3, b)])


@pytest.mark.parametrize("clash", ["fp", "times", "row", "best", "component", "_id"])
def test_one_of_each_with_clashing_columns(spark, clash):
    frame = spark.createDataFrame([(1, "x y z", 7), (2, "x y z", 8), (2, "p q r", 9)], f"doc_id long, text string, `{clash}` int")
    out = one_of_each(frame)
    assert out.schema == frame.schema and sorted(map(tuple, out.collect())) == [(1, "x y z", 7), (2, "p q r", 9)]
    assert one_of_each(frame.limit(0)).count() == 0
