from __future__ import annotations

import random
from collections import Counter

import pandas as pd
import pytest

from allotment.llm.mixing import close, mix, mixed_rows, pivot, source_targets

from . import frames


def brute_targets(sizes: dict, weights=(5, 2, 1), most=3) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(most * sizes[s] for s in capped)
        target = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if target[s] > most * sizes[s]}
        if not over:
            return target | {s: float(most * sizes[s]) for s in capped}
        capped |= over


def test_targets(spark):
    sizes = {"a": 10, "b": 1000, "c": 3, "é": 500, "Z": 0, None: 40, "zz": 7}
    frame = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    found = {r.source: r.target for r in source_targets(frame).collect()}
    assert found == pytest.approx(brute_targets(sizes))


def test_pivot_keeps_mass_and_expectation():
    random.seed(1)
    rows = pd.DataFrame({"doc_id": range(500), "size": [random.randint(1, 400) for _ in range(500)]})
    rows["mass"] = rows["size"] * 0.3
    out = pivot(rows)
    still = out["extra"].isna().sum()
    taken = (out["size"] * out["extra"].fillna(0)).sum() + out.loc[out["extra"].isna(), "mass"].sum()
    assert still <= 1 and taken == pytest.approx(rows["mass"].sum())
    shares = []
    for shift in range(200):
        out = pivot(rows.head(40).assign(doc_id=lambda d, s=shift: d["doc_id"] + 1000 * s))
        shares.append((out["extra"].astype(float).fillna(out["mass"] / out["size"])).mean())
    assert sum(shares) / len(shares) == pytest.approx(0.3, abs=0.03)


@pytest.mark.parametrize(("leaf", "fan"), [(2048, 1024), (10, 3)])
def test_sources_come_near_their_targets(spark, leaf, fan):
    random.seed(leaf)
    rows = [(k, " ".join(["w"] * random.randint(0, 60)), "en", "hot" if k % 3 else f"s{k % 5}") for k in range(900)]
    out = mix(frames.docs(spark, rows), leaf=leaf, fan=fan).collect()
    again = mix(frames.docs(spark, rows[::-1]).repartition(3), leaf=leaf, fan=fan).collect()
    assert {(r.doc_id, r.taken) for r in out} == {(r.doc_id, r.taken) for r in again}
    taken, target = Counter(), {}
    for r in out:
        source = rows[r.doc_id][3]
        taken[source] += r.taken
        target[source] = r.target
        assert r.size == len(rows[r.doc_id][1].split()) and r.taken == r.copies * r.size and 0 <= r.copies <= 3
    assert all(abs(taken[s] - target[s]) <= 3 for s in target)


def test_close_comes_nearest():
    random.seed(2)
    for n in (1, 2, 5, 12, 30):
        sizes = [random.randint(1, 1 << (k % 14 + 1)) for k in range(n)]
        rows = pd.DataFrame({"doc_id": range(n), "size": sizes})
        rows["mass"] = rows["size"] * 0.37
        out = close(rows)
        miss = abs((out["size"] * out["extra"].astype(int)).sum() - rows["mass"].sum())
        if n <= 12:
            assert miss == pytest.approx(min(
                abs(sum(s for k, s in enumerate(sizes) if choice >> k & 1) - rows["mass"].sum()) for choice in range(1 << n)
            ))
        assert miss <= max(sizes) / 2


def test_edges(spark):
    frame = frames.docs(spark, frames.EDGES)
    out = mix(frame)
    assert out.count() == len(frames.EDGES) and mix(frame.limit(0)).count() == 0
    assert all(r["size"] == 0 for r in mix(frame.where("text is null or trim(text) = ''")).collect())
    copies = {(r.doc_id, r.row): r.copies for r in out.collect()}
    rows = mixed_rows(frame)
    assert rows.columns == frame.columns
    seen = Counter(r.doc_id for r in rows.collect())
    for id in {i for i, *_ in frames.EDGES}:
        assert seen[id] == sum(n for (i, _), n in copies.items() if i == id)
