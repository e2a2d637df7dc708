from __future__ import annotations

import random
import zlib
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from allotment.llm import queries
from allotment.llm.toxicity import BEGINNINGS, BUCKETS, Machine, fit, hashed, learnt, scored

from . import frames

DATA = "/root/testdata/sf0.1"


def test_terms_of_whole_texts():
    one = lambda t: zlib.crc32(t.encode()) % BUCKETS
    assert hashed(None).tolist() == hashed(b" 12 \n").tolist() == []
    assert hashed("Ab, ab überrascht".encode()).tolist() == sorted({one("ab"), one("überrascht"), *(one("überrascht"[:n] + "*") for n in BEGINNINGS)})
    assert one("lastword") in hashed((frames.LONG + " lastword").encode())


def test_score_by_its_definition():
    rng = np.random.default_rng(0)
    buckets = np.array([3, 10, 99, 1000])
    weights, values, factors = rng.normal(size=4), rng.random(4), rng.normal(size=(4, 3))
    machine = Machine(-0.5, buckets, weights, values, factors)
    total = -0.5 + sum(weights[k] * values[k] for k in (0, 2, 3))
    total += sum(factors[i] @ factors[j] * values[i] * values[j] for i, j in combinations((0, 2, 3), 2))
    assert machine.score(np.array([3, 99, 500, 1000])) == pytest.approx(1 / (1 + np.exp(-total)), abs=1e-12)
    assert machine.score(np.zeros(0, dtype=np.int64)) == pytest.approx(1 / (1 + np.exp(0.5)))


def paired(n: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Toxic if one of four insults meets a group that it is meant for: each word alone tells nothing."""
    random.seed(3)
    texts, labels = [], []
    letter = lambda k: chr(97 + random.randrange(k))
    for _ in range(n):
        insult, group = letter(4), letter(4)
        filler = " ".join(f"w{letter(26)}{letter(26)}" for _ in range(12))
        texts.append(hashed(f"in{insult} {filler} gr{group}".encode()))
        labels.append(float((ord(insult) + ord(group)) % 2))
    return texts, np.array(labels)


def test_pairs_that_a_linear_model_misses():
    texts, labels = paired(1600)
    accuracy = []
    for rank in (0, 4):
        machine = Machine(*fit(texts[:1200], labels[:1200], rank=rank, rounds=40, bend=0.3))
        told = np.array([machine.score(t) for t in texts[1200:]]) >= 0.5
        accuracy.append((told == labels[1200:]).mean())
    assert accuracy[0] < 0.65 and accuracy[1] > 0.95


def test_held_out_documents(spark):
    out = {r.doc_id: r for r in queries.op13_toxicity(spark, DATA).collect()}
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    assert len(out) == spark.read.parquet(f"{DATA}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for i, r in out.items())
    told = [(toxic[i], r.predicted) for i, r in out.items() if r.held_out and i in toxic]
    caught = [p for y, p in told if y]
    assert np.mean(caught) >= 0.9 and sum(p for y, p in told if not y) <= 2


def test_held_out_labels_and_other_columns_do_not_count(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) != 2
    one = learnt(docs, labels, fold)
    other = labels.withColumn("toxic", F.when(fold, F.col("toxic")).otherwise(1 - F.col("toxic")))
    two = learnt(docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit("y")), other, fold)
    assert one.bias == two.bias and (one.weights == two.weights).all() and (one.factors == two.factors).all()


@pytest.mark.parametrize("sample", [3, 20_000])
def test_edges(spark, sample):
    docs = frames.docs(spark, frames.EDGES)
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, None), (None, 1), (5, 0), (77, 1)], "doc_id long, toxic int")
    rows = scored(docs, learnt(docs, labels, sample=sample)).collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in rows if r.doc_id) == sorted((False, i) for i, *_ in frames.EDGES if i)
    assert len(rows) == len(frames.EDGES) and all(0 <= r.score <= 1 for r in rows)
    of = {r.doc_id: r.score for r in rows}
    assert of[3] == of[4] == of[7]


def test_no_labels_no_documents_one_label(spark):
    docs = frames.docs(spark, frames.EDGES)
    labels = lambda rows: spark.createDataFrame(rows, "doc_id long, toxic int")
    assert all(r.score < 1e-9 for r in scored(docs, learnt(docs, labels([]))).collect())
    assert all(r.score < 1e-9 for r in scored(docs, learnt(docs, labels([(1, 0), (5, 0)]))).collect())
    none = frames.docs(spark, [])
    assert scored(none, learnt(none, labels([(1, 1)]))).count() == 0
