from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from allotment.llm.quality import BINS, FEATURES, judged, shares

from . import frames


def corpus(seed: int = 1, n: int = 300):
    random.seed(seed)
    words = ["the", "sun", "rises", "over", "hills", "and", "rivers", "run", "down", "slowly", "to", "sea", "birds", "sing"]
    rows, labels = [], []
    for k in range(n):
        bad = random.random() < (0.7 if k % 3 == 0 else 0.1)
        text = " ".join(random.choices(words, k=random.randint(20, 80))) + "."
        if bad:
            text = random.choice([text.upper().replace(" ", "!! "), " ".join(w for w in text.split() for _ in range(9)), text.replace(" ", "%%% ")])
        rows.append((k, text, random.choice(["en", "fr"]), "bad host" if k % 3 == 0 else None if k % 3 == 1 else "good"))
        labels.append((k, int(not bad), 0))
    return rows, labels


def brute(rows, labels, threshold=0.5):
    """The same model in plain Python."""
    marks = {}
    for i, good, _ in labels:
        if i is not None and good is not None:
            marks[i] = min(good, marks.get(i, 1))
    bins = [[min(int(x * BINS), BINS - 1) for x in shares(t)] for _, t, *_ in rows]
    table = np.ones((2, len(FEATURES), BINS))
    for (i, *_), b in zip(rows, bins):
        if i in marks:
            for f, x in enumerate(b):
                table[0 if marks[i] else 1, f, x] += 1
    weight = np.round(np.log(table[0] / table[0].sum(axis=1, keepdims=True)) - np.log(table[1] / table[1].sum(axis=1, keepdims=True)), 6)
    n_good, n_bad = table[0][0].sum() - BINS, table[1][0].sum() - BINS
    overall = (n_good + 1) / (n_good + n_bad + 2)
    logit = lambda p: math.log(p / (1 - p))
    evidence = [sum(weight[f, x] for f, x in enumerate(b)) for b in bins]
    expected = [1 / (1 + math.exp(-(e + logit(overall)))) for e in evidence]
    hosts, paths = {}, {}
    for (_, _, path, host), m in zip(rows, expected):
        for d, key in ((hosts, host), (paths, (host, path))):
            a, n = d.get(key, (0.0, 0))
            d[key] = (a + m, n + 1)

    def spread(groups, base):
        n = sum(g[1] for g in groups.values())
        noise = {k: base(k) * (1 - base(k)) for k in groups}
        between = sum(c * (m / c - base(k)) ** 2 for k, (m, c) in groups.items()) / n - sum(noise.values()) / n
        inner = sum(c * noise[k] for k, (_, c) in groups.items()) / n
        return min(max(inner / max(between, 1e-9) - 1, 1), 1e6)

    k_host = spread(hosts, lambda _: overall)
    rate = {h: (m + k_host * overall) / (n + k_host) for h, (m, n) in hosts.items()}
    k_path = spread(paths, lambda k: rate[k[0]])
    out = []
    for k, ((i, _, path, host), e) in enumerate(zip(rows, evidence)):
        # The path summed anew without the document.
        others = [x for j, ((_, _, p, h), x) in enumerate(zip(rows, expected)) if j != k and (h, p) == (host, path)]
        prior = (sum(others) + k_path * rate[host]) / (len(others) + k_path)
        p = 1 / (1 + math.exp(-(e + logit(min(max(prior, 1e-9), 1 - 1e-9)))))
        out.append((i, round(p, 6), p >= threshold))
    return out


@pytest.mark.parametrize("edges", [False, True])
def test_agrees_with_plain_python(spark, edges):
    rows, labels = corpus()
    if edges:
        rows, labels = rows + frames.EDGES, labels + [(1, None, 1), (None, 0, 0), (2, 1, 0), (2, 0, 0)]
    marked = spark.createDataFrame(labels[::2], "doc_id long, quality int, toxic int")
    out = judged(frames.docs(spark, rows), marked)
    assert out.columns == frames.docs(spark, []).columns
    got = sorted(((r.doc_id, round(r.verdict.p_good, 6), r.verdict.kept) for r in out.select("doc_id", "verdict").collect()), key=repr)
    want = sorted(brute(rows, labels[::2]), key=repr)
    assert [(i, k) for i, _, k in got] == [(i, k) for i, _, k in want]
    assert [p for _, p, _ in got] == pytest.approx([p for _, p, _ in want], abs=2e-6)


def test_own_label_leaves_own_prior_alone(spark):
    """Two documents of the same text, one of them labelled this or that way, among many labelled ones."""
    rows, labels = corpus()
    text = "the sun rises over hills and rivers run down slowly to sea."
    rows += [(1000, text, "xx", "small"), (1001, text, "xx", "small")]
    priors = []
    for own in ([], [(1000, 1, 0), (1001, 0, 0)]):
        marked = spark.createDataFrame(labels + own, "doc_id long, quality int, toxic int")
        told = judged(frames.docs(spark, rows), marked).where("doc_id >= 1000").select("doc_id", "verdict").collect()
        priors.append({r.doc_id: r.verdict.prior for r in told})
    assert priors[0][1000] == priors[0][1001] and priors[1][1000] == priors[1][1001]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    told = judged(docs, labels.where("doc_id % 3 <> 0")).join(labels.where("doc_id % 3 = 0"), "doc_id")
    right, count = told.agg(F.sum((F.col("verdict.kept") == (F.col("quality") == 1)).cast("int")), F.count("*")).first()
    clean, kept = told.where("quality = 1").agg(F.count("*"), F.sum(F.col("verdict.kept").cast("int"))).first()
    assert right >= 0.95 * count and kept >= 0.97 * clean


def test_without_labels_and_rows(spark):
    rows, labels = corpus(n=20)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert judged(frames.docs(spark, rows), none).count() == 20
    assert judged(frames.docs(spark, []), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).count() == 0
    one_kind = spark.createDataFrame([(k, 1) for k in range(20)], "doc_id long, quality int")
    assert all(r.verdict.kept for r in judged(frames.docs(spark, corpus(5, 20)[0]), one_kind).select("verdict").collect() if r)
