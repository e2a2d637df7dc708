from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from allotment.llm import divergence
from allotment.llm.divergence import Tree, apart, divergences, terms

from . import frames


def brute(rows: list[tuple], least: int = 30, smooth: int = 5, top: int = 50) -> list[tuple]:
    """The report by its definition, over dense counts."""
    times, langs, documents, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        lang, source = lang or "", source or ""
        sources[lang].add(source)
        times[lang, source].update(words)
        langs[lang].update(words)
        documents[lang].update(set(words))
    out = []
    for lang in sources:
        kept = [t for t, n in documents[lang].items() if n >= least]

        def shares(counts, kept=kept):
            total = sum(counts[t] for t in kept) + smooth * len(kept)
            return {t: 1 + 10**9 * (counts[t] + smooth) // total for t in kept}

        of, whole = {s: shares(times[lang, s]) for s in sources[lang]}, shares(langs[lang])
        for s in sources[lang]:
            pairs = [(sum(abs(of[s][t] - of[o][t]) for t in kept), o) for o in sources[lang] if o != s]
            words = [(of[s][t] - whole[t], t) for t in kept if times[lang, s][t] and of[s][t] > whole[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", words, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, rank + 1) for rank, (value, item) in enumerate(found[:most])]
    return sorted(out)


def told(frame) -> list[tuple]:
    assert frame.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, frame.collect()))


def corpus(groups: int, documents: int, words: int) -> list[tuple]:
    random.seed(groups)
    pool = [f"{random.choice(['a', 'Zé', 'ß', '日本', 'qX'])}{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}" for k in range(words)]
    rows = []
    for i in range(documents):
        s = random.randrange(groups)
        text = " ".join(random.choices(pool[s % 7 :: 3], k=random.randint(0, 40)))
        rows.append((i, text, random.choice(["en", "en", "de", None]), f"s{s}"))
    return rows


def test_terms():
    assert terms("Don't STOP_it ÄÖ9é a1b\x00c\x7fd 日本".encode()) == ["don", "t", "stop", "it", "ÄÖ", "é", "a", "b", "c", "d", "日本"].__class__(
        w.encode() for w in ["don", "t", "stop", "it", "ÄÖ", "é", "a", "b", "c", "d", "日本"]
    )


@pytest.mark.parametrize("groups, least", [(3, 5), (40, 8)])
def test_against_brute_force(spark, groups, least):
    rows = corpus(groups, 400, 700)
    assert told(divergences(frames.docs(spark, rows), least=least)) == brute(rows, least)


def test_many_blocks_and_strips(spark, monkeypatch):
    """Small trees, so that the same corpus needs several blocks of groups and strips of terms."""
    for name, value in (("LEAF", 2), ("TREE", 8), ("TREES", 3)):
        monkeypatch.setattr(divergence, name, value)
    monkeypatch.setattr(Tree, "DEPTH", 2)
    rows = corpus(20, 300, 200)
    assert told(divergences(frames.docs(spark, rows), least=4)) == brute(rows, 4)


def test_edges(spark):
    rows = frames.EDGES * 6 + [(9, "one two", "en", "other"), (10, None, "fr", None), (11, "x", "solo", "s")]
    assert told(divergences(frames.docs(spark, rows), least=6)) == brute(rows, 6)
    alone = told(divergences(frames.docs(spark, rows)))  # no language keeps a term
    assert alone == brute(rows) and all(r[4] == 0 and r[2] == "pair" for r in alone if r[0] != "en")
    assert told(divergences(frames.docs(spark, []))) == []


def test_trees_are_exact():
    rng = np.random.default_rng(1)
    for fill in (0.0, 0.001, 0.2):
        counts = rng.integers(1, 50, (2, 256, 256)) * (rng.random((2, 256, 256)) < fill)
        totals = rng.integers(2000, 10**13, (2, 256))
        trees = []
        for k in range(2):
            r, c = np.nonzero(counts[k])
            tree = Tree.of(r, c, counts[k][r, c])
            trees.append(Tree.unpacked(*tree.packed()))
            assert len(tree.leaves) == sum(counts[k].reshape(32, 8, 32, 8).any(axis=(1, 3)).ravel())
        price = lambda k: [[1 + 10**9 * (int(n) + 5) // int(t) for n in row] for row, t in zip(counts[k][:, :201], totals[k])]
        a, b = np.array(price(0)), np.array(price(1))
        found = apart(*trees, 201, *totals, 5)
        for g, h in ((0, 0), (3, 200), (255, 17)):
            assert found[g, h] == np.abs(a[g] - b[h]).sum()
