from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from allotment.llm import topk
from allotment.llm.topk import exact_top_k, quantised

from ..plans import physical


def brute(rows, is_query, k):
    rows = sorted({(i, tuple(v)) for i, v in rows if i is not None})
    out = {}
    for i, v in rows:
        if is_query(i):
            scores = [(-sum(a * b for a, b in zip(v, w)), j) for j, w in rows if j != i]
            out[i] = [(j, -s) for s, j in sorted(scores)[:k]]
    return out


@pytest.mark.parametrize(("slices", "row_block", "query_block", "k"), [(4, 16384, 1024, 20), (3, 30, 4, 7), (1, 50, 1024, 1)])
def test_agrees_with_brute_force(spark, slices, row_block, query_block, k):
    random.seed(k)
    rows = [(n, [random.randint(-20, 20) for _ in range(10)]) for n in range(200)]
    rows += [(300 + n, rows[n][1]) for n in range(40)] + rows[:5] + [(None, [1] * 10), (500, [7, 7]), (520, [])]
    frame = spark.createDataFrame(rows, "vec_id long, v array<long>").repartition(5)
    out = exact_top_k(frame, F.col("vec_id") % 20 == 0, k, slices=slices, row_block=row_block, query_block=query_block).collect()
    found = {}
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(found[r.query_id])
    assert found == brute(rows, lambda i: i % 20 == 0, k)


def test_large_numbers_stay_exact(spark):
    rows = [(k, [10**8 + k, -(10**8)]) for k in range(0, 100, 4)]
    out = exact_top_k(spark.createDataFrame(rows, "vec_id long, v array<long>"), F.col("vec_id") == 0, 3).collect()
    assert [(r.vec_id, r.score) for r in sorted(out, key=lambda r: r.rank)] == brute(rows, lambda i: i == 0, 3)[0]


def test_unusable_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.51]), (20, None), (40, [None, 1.0]), (60, [nan, 1.0]), (80, [inf, 1.0]), (100, [1.0, 1.0])]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, rank string")
    assert {r.vec_id: r.v for r in quantised(frame).collect()} == {0: [32, -33], 100: [64, 64]}
    out = exact_top_k(quantised(frame), F.col("vec_id") % 20 == 0).collect()
    assert {(r.query_id, r.rank, r.vec_id, r.score) for r in out} == {(0, 1, 100, -64), (100, 1, 0, -64)}
    assert exact_top_k(quantised(frame.limit(0)), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize(("row_groups", "tasks"), [(1, 1), (2, 4), (1000, 1000)])
def test_any_grouping_of_blocks_agrees(spark, monkeypatch, row_groups, tasks):
    """Blocks that meet in one task or in many, with numbers of one to eight bytes in different blocks."""
    monkeypatch.setattr(topk, "ROW_GROUPS", row_groups)
    monkeypatch.setattr(topk, "TASKS", tasks)
    random.seed(row_groups)
    rows = [(n, [random.randint(-128, 128) for _ in range(6)]) for n in range(150)]
    rows += [(200 + n, [random.randint(-most, most) for _ in range(6)]) for n, most in enumerate([300, 70000, 2**31, 2**28] * 3)]
    frame = spark.createDataFrame(rows, "vec_id long, v array<long>").repartition(3)
    out = exact_top_k(frame, F.col("vec_id") % 10 == 0, 6, row_block=20, query_block=3).collect()
    found = {}
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert found == brute(rows, lambda i: i % 10 == 0, 6)


def test_copied_blocks_do_not_go_through_the_driver(spark):
    """Query blocks are copied for every group of rows, so the table of them is no measure of what a broadcast would hold."""
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").rstrip("b")) > 0
    rows = spark.createDataFrame([(n, [n % 7, n % 5]) for n in range(60)], "vec_id long, v array<long>")
    plan = physical(exact_top_k(rows, F.col("vec_id") % 20 == 0, 3, row_block=4, query_block=1))
    assert "Broadcast" not in plan
