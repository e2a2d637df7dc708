from __future__ import annotations

import math
import random
from collections import Counter
from dataclasses import replace
from zlib import crc32

import numpy as np
import pytest

from allotment.llm.brown import Sizes, context_weights, exchange, score, score_held_out, train, words_of

from . import frames

SMALL = Sizes(own=20, frequent=40, classes=4, rounds=6, held=50)


def corpus(n: int = 400):
    random.seed(4)
    left, right = [[f"{c}{k}" for k in range(30)] for c in "xy"]
    rows = []
    for k in range(n):
        a, b = (left, right) if k % 2 else (right, left)
        words = [random.choice(a if j % 4 < 3 else b) for j in range(random.randint(0, 40))]
        rows.append((k, " ".join([*words, *([f"once{k}"] if k % 3 == 0 else [])]), "en", "a"))
    return rows


def held_out(i) -> bool:
    return crc32(("" if i is None else str(i)).encode()) % 7 == 2


@pytest.mark.parametrize("sizes", [SMALL, Sizes()])
def test_counts_and_base_score(spark, sizes):
    rows = corpus(120) + frames.EDGES
    out = score_held_out(frames.docs(spark, rows), sizes=sizes).collect()
    counts = Counter()
    for i, t, *_ in rows:
        if not held_out(i):
            counts.update([*words_of((t or "").encode()), b""])
    total, kinds = sum(counts.values()), len(counts)
    want = Counter()
    for i, t, *_ in rows:
        words = [*words_of((t or "").encode()), b""]
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in words)
        want[(i, held_out(i), len(words), sum(counts[w] > 0 for w in words), total, round(base, 5))] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in out) == want


def test_classes_beat_single_words_on_held_out_texts(spark):
    out = [r for r in score_held_out(frames.docs(spark, corpus()), sizes=SMALL).collect() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_probabilities_add_up(spark):
    """All known words, an unseen one and the end as the next token of an empty text, with the unused places for unseen words."""
    frame = frames.docs(spark, corpus(60))
    model = train(frame, sizes=SMALL)
    assert np.allclose((10**model.transitions).sum(axis=1), 1)
    of = classes_of(model)
    words = list(of)
    probe = frames.docs(spark, [(k, w.decode(), None, None) for k, w in enumerate(words)] + [(-1, "never", None, None)])
    rows = {r.doc_id: r.score for r in score(probe, model).collect()}
    end, to_end = SMALL.end, model.transitions[:, SMALL.end]
    put = int(model.unseen[end])
    places = 10 ** (model.transitions[end, : SMALL.classes] + model.unseen_logs - model.emission_base)
    assert places.argmax() == put
    total = sum(10 ** (rows[k] - to_end[of[w]]) for k, w in enumerate(words)) + 10 ** (rows[-1] - to_end[put])
    assert total + 10 ** model.transitions[end, end] + places.sum() - places[put] == pytest.approx(1, abs=1e-9)


def classes_of(model):
    of = dict(zip(model.known.frequent, model.known.member.tolist()))
    return of | {bytes(r.word): r["class"] for r in model.others.collect()}


def test_every_word_has_a_class_of_its_own_contexts(spark):
    """Words that are not frequent: the class of the highest summed weight, by a plain recount; and no word is without one."""
    rows = corpus(200)
    model = train(frames.docs(spark, rows), sizes=replace(SMALL, passes=1))
    of, counts = classes_of(model), Counter(w for r in rows for w in words_of(r[1].encode()))
    assert set(of) == set(counts) and max(of.values()) < SMALL.classes
    frequent = dict(zip(model.known.frequent, model.known.member.tolist()))
    before, after = context_weights(model.known.pairs, SMALL)
    sums = {}
    for r in rows:
        line = words_of(r[1].encode())
        near = [SMALL.end, *(frequent.get(w, SMALL.open) for w in line), SMALL.end]
        for k, w in enumerate(line):
            if w not in frequent:
                sums[w] = sums.get(w, 0) + before[near[k]] + after[near[k + 2]]
    others = {bytes(r.word): (r.n, r["class"]) for r in model.others.collect()}
    assert set(sums) == set(others)
    for w, (n, c) in others.items():
        assert n == counts[w] and sums[w][c] == pytest.approx(sums[w].max())


def test_passes_count_what_the_last_one_placed(spark):
    """The bigrams after a pass, by a plain recount, and the second pass by them."""
    rows = corpus(200)
    once, twice = (train(frames.docs(spark, rows), sizes=replace(SMALL, passes=k)) for k in (1, 2))
    frequent = dict(zip(once.known.frequent, once.known.member.tolist()))
    first = {bytes(r.word): r["class"] for r in once.others.collect()}
    lines = [[SMALL.end, *(frequent.get(w, w) for w in words_of(r[1].encode())), SMALL.end] for r in rows]
    pairs = once.known.pairs.copy()
    for line in lines:
        for a, b in zip(line, line[1:]):
            if isinstance(a, bytes) != isinstance(b, bytes):
                pairs[first.get(a, a), first.get(b, b)] += 1
    before, after = context_weights(pairs, SMALL)
    sums = {}
    for line in lines:
        for a, w, b in zip(line, line[1:], line[2:]):
            if isinstance(w, bytes):
                sums[w] = sums.get(w, 0) + sum(t[c] for t, c in ((before, a), (after, b)) if not isinstance(c, bytes))
    for r in twice.others.collect():
        told = sums[bytes(r.word)]
        assert (np.isscalar(told) or told[r["class"]] == pytest.approx(told.max()))


def test_scores_against_a_plain_model(spark):
    """Class bigrams counted anew in plain Python from the classes; every text's score."""
    rows = [r for r in corpus(150) + frames.EDGES]
    out = score_held_out(frames.docs(spark, rows), sizes=SMALL).collect()
    model = train(frames.docs(spark, [r for r in rows if not held_out(r[0])]), sizes=SMALL)
    of, size = classes_of(model), SMALL.classes + 1
    counts, pairs = Counter(), np.zeros((size, size))
    for i, t, *_ in rows:
        if not held_out(i):
            counts.update(words_of((t or "").encode()))
            line = [SMALL.end, *(of[w] for w in words_of((t or "").encode())), SMALL.end]
            for a, b in zip(line, line[1:]):
                pairs[a, b] += 1
    mass, new = np.ones(SMALL.classes), np.ones(SMALL.classes)
    for w, n in counts.items():
        mass[of[w]] += n + 1 + (n == 1)
        new[of[w]] += n == 1
    share = (pairs.sum(axis=0) + 1) / (pairs.sum() + size)
    p = (pairs + SMALL.inertia * share) / (pairs.sum(axis=1, keepdims=True) + SMALL.inertia)
    want = Counter()
    for i, t, *_ in rows:
        told, before = 0.0, SMALL.end
        for w in words_of((t or "").encode()):
            c = of[w] if w in of else max(range(SMALL.classes), key=lambda k: (p[before, k] * new[k] / mass[k], -k))
            told += math.log10(p[before, c]) + math.log10((counts[w] + 1 if w in of else new[c]) / mass[c])
            before = c
        want[(i, round(told + math.log10(p[before, SMALL.end]), 5))] += 1
    assert Counter((r.doc_id, round(r.score, 5)) for r in out) == want


def likelihood(bigrams, member):
    joined = np.zeros((len(bigrams), member.max() + 1))
    joined[np.arange(len(bigrams)), member] = 1
    pairs = joined.T @ bigrams @ joined
    f = lambda x: (x * np.log(np.maximum(x, 1))).sum()
    return f(pairs) - f(pairs.sum(axis=0)) - f(pairs.sum(axis=1))


def test_exchange_ends_where_no_single_move_helps():
    chance = np.random.default_rng(0)
    bigrams = chance.integers(0, 30, (21, 21)).astype(float)
    bigrams[:10, 10:20] *= 9
    member = exchange(bigrams, 4, 50)
    best = likelihood(bigrams, member)
    assert best >= likelihood(bigrams, exchange(bigrams, 4, 0)) and member[20] == 4 and member[:20].max() < 4
    for s in range(20):
        for c in range(4):
            moved = member.copy()
            moved[s] = c
            assert likelihood(bigrams, moved) <= best + 1e-6


def test_empty_and_untrained(spark):
    assert score_held_out(frames.docs(spark, []), sizes=SMALL).count() == 0
    only = [(k, "a b", "en", "a") for k in range(40) if held_out(k)]
    out = score_held_out(frames.docs(spark, only), sizes=SMALL).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in out) and len(out) == len(only)
