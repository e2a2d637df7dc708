from __future__ import annotations

import numpy as np
import pytest

from allotment.llm.caps import CapFilters, near_vectors

from .test_simhash import components


def brute(rows, least):
    units = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            units[i] = np.array(v, dtype=np.float32).astype(float)
            units[i] /= np.linalg.norm(units[i])
    ids = sorted(units)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if units[a] @ units[b] >= least]
    root = components([i for i, _ in rows if i is not None], links)
    degree = {i: sum(i in e for e in links) for i, _ in rows}
    return degree, root


def made(seed: int):
    chance = np.random.default_rng(seed)
    rows = [(int(k), chance.standard_normal(16).tolist()) for k in range(300)]
    for k in range(60):
        base = np.array(rows[k % 4][1])
        rows.append((1000 + k, (base + 0.04 * chance.standard_normal(16)).tolist()))
    rows += [(2000 + k, rows[5][1]) for k in range(50)]
    rows += [(3000, None), (3001, [0.0] * 16), (3002, [None] + [1.0] * 15), (3003, [float("nan")] * 16), (3004, []), (None, rows[5][1])]
    return rows


@pytest.mark.parametrize("block", [4096, 9])
def test_agrees_with_brute_force(spark, block):
    rows = made(block)
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, n_links int")
    out = near_vectors(frame, block=block).collect()
    degree, root = brute(rows, 0.95)
    assert len(out) == len(rows)
    got = {r.vec_id: r for r in out if r.vec_id is not None}
    assert all(got[i].n_links <= degree[i] for i in got)
    assert sum(r.n_links for r in got.values()) >= 0.99 * sum(degree[i] for i in got)
    assert sum(got[i].component_id == root[i] for i in got) >= 0.99 * len(got)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert next((r.n_links, r.component_id, r.kept) for r in out if r.vec_id is None) == (0, None, False)


def test_empty_table(spark):
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.parametrize("rows", [500, 50_000, 5_000_000])
def test_recall_at_the_limit(rows):
    chance = np.random.default_rng(rows)
    filters = CapFilters(64, rows)
    a = chance.standard_normal((2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    aside = chance.standard_normal(a.shape)
    aside -= (aside * a).sum(axis=1, keepdims=True) * a
    b = 0.95 * a + np.sqrt(1 - 0.95**2) * aside / np.linalg.norm(aside, axis=1, keepdims=True)
    total = 3 * filters.codes**2
    keys = [r * total + f for r, f in (filters.passed(a), filters.passed(b))]
    assert len(np.unique(np.intersect1d(*keys) // total)) >= 0.95 * len(a)


def test_list_decoding_finds_all_that_pass():
    chance = np.random.default_rng(1)
    filters = CapFilters(8, 2000, parts=2, rounds=1)
    units = chance.standard_normal((50, 8))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    turned = units @ filters.turns[0]
    gains = [turned[:, cut] @ book.T / np.sqrt(2) for cut, book in zip(filters.cuts, filters.books[0])]
    sums = (gains[0][:, :, None] + gains[1][:, None, :]).reshape(50, -1)
    sums[np.arange(50), sums.argmax(axis=1)] = 9
    row, filter = np.nonzero(sums >= filters.height)
    assert np.array_equal(filters.passed(units), (row, filter))
