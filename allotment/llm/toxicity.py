"""Toxic documents by a factorization machine over hashed terms."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .divergence import terms
from .tables import Scratch

#: Buckets that terms are hashed to, and lengths of the word beginnings that are terms as well.
BUCKETS, BEGINNINGS = 1 << 20, (4, 5, 6, 7, 8)
#: Labelled documents that the machine learns from, at most.
SAMPLE = 20_000


@lru_cache(maxsize=1 << 18)
def _buckets(word: bytes) -> tuple[int, ...]:
    """Buckets of a word and of its proper beginnings."""
    letters = word.decode("utf-8", "replace")
    parts = [word, *(letters[:n].encode() + b"*" for n in BEGINNINGS if len(letters) > n)]
    return tuple(zlib.crc32(p) % BUCKETS for p in parts)


def hashed(text: bytes | None) -> np.ndarray:
    """The buckets that the terms of the whole text fall into, each once and in order.

    Terms are the words (runs of letters, A-Z lower-cased) and their beginnings.
    """
    found = set(chain.from_iterable(map(_buckets, set(terms(text or b"")))))
    return np.sort(np.fromiter(found, dtype=np.int64, count=len(found)))


class Machine:
    """A factorization machine: bias, and a weight, a value and factors for some buckets.

    A text's score is sigmoid(bias + sum of w[i] x[i] + sum over i < j of <v[i], v[j]> x[i] x[j]),
    where i and j go over the buckets that the text has and x is a bucket's value. Buckets
    that the machine does not hold count nothing.
    """

    def __init__(self, bias: float, buckets: np.ndarray, weights: np.ndarray, values: np.ndarray, factors: np.ndarray):
        self.bias, self.weights, self.values, self.factors = bias, weights, values, factors
        self.place = np.full(BUCKETS, -1, dtype=np.int32)
        self.place[buckets] = np.arange(len(buckets), dtype=np.int32)

    def score(self, buckets: np.ndarray) -> float:
        at = self.place[buckets]
        at = at[at >= 0]
        x = self.values[at]
        parts = self.factors[at] * x[:, None]
        pairs = ((parts.sum(axis=0) ** 2).sum() - (parts**2).sum()) / 2
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.weights[at] @ x + pairs, -30, 30))))


def fit(
    texts: list[np.ndarray], labels: np.ndarray, *, rank: int = 4, rounds: int = 10, least: int = 5, often: float = 0.1, bend: float = 0.1,
    step: float = 2.0, sparse: float = 4.0, ridge: float = 0.1, seed: int = 1,
) -> tuple[float, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The arguments of ``Machine``, learnt from texts (buckets of each) and their labels, 0 or 1.

    Logistic loss in batches. Only buckets of ``least`` or more texts take part; a bucket's
    value falls with the share of the texts that have it. Weights follow the regularised leader,
    so a bucket must gather more gradient than ``sparse`` before it counts at all, which keeps
    the machine from learning single texts by heart. Factors are learnt for buckets that have a
    weight and for those that a share of ``often`` texts have, by steps of ``bend`` that shrink
    with the squared gradients. The same input gives the same machine; without both labels the score is their share.
    """
    count, none = len(texts), np.zeros(0)
    positive = float(labels.sum())
    if count == 0 or positive in (0.0, float(count)):
        return (30.0 if count and positive else -30.0), none.astype(np.int64), none, none, np.zeros((0, rank))
    bias = float(np.log((positive + 0.5) / (count - positive + 0.5)))
    having = np.bincount(np.concatenate(texts), minlength=BUCKETS)
    held = np.flatnonzero(having >= least)
    place = np.full(BUCKETS, -1, dtype=np.int64)
    place[held] = np.arange(len(held))
    share = having[held] / count
    values = np.log(1 / share) / np.log(count)
    texts = [at[at >= 0] for at in (place[t] for t in texts)]
    random = np.random.default_rng(seed)
    weights, lead, squares = (np.zeros(len(held)) for _ in range(3))
    factors, moved = random.normal(0, 0.05, (len(held), rank)), np.full((len(held), rank), 1e-2)
    bias_moved, frequent = 1e-2, share >= often
    for _ in range(rounds):
        order = random.permutation(count)
        for start in range(0, count, 64):
            batch = order[start : start + 64]
            size = len(batch)
            at = np.concatenate([texts[k] for k in batch])
            text = np.repeat(np.arange(size), [len(texts[k]) for k in batch])
            x = values[at]
            paired = (weights[at] != 0) | frequent[at]
            p_at, p_text, p_x = at[paired], text[paired], x[paired]
            parts = factors[p_at] * p_x[:, None]
            sums = _summed(p_text, parts, size)
            pairs = ((sums**2).sum(axis=1) - np.bincount(p_text, (parts**2).sum(axis=1), minlength=size)) / 2
            total = bias + np.bincount(text, weights[at] * x, minlength=size) + pairs
            off = 1 / (1 + np.exp(-np.clip(total, -30, 30))) - labels[batch]

            met, where = np.unique(at, return_inverse=True)
            slope = np.bincount(where, off[text] * x, minlength=len(met))
            grown = np.sqrt(squares[met] + slope**2)
            lead[met] += slope - (grown - np.sqrt(squares[met])) / step * weights[met]
            squares[met] += slope**2
            beyond = np.sign(lead[met]) * np.maximum(np.abs(lead[met]) - sparse, 0)
            weights[met] = -beyond / ((1 + grown) / step + ridge)

            met, where = np.unique(p_at, return_inverse=True)
            bent = off[p_text][:, None] * p_x[:, None] * (sums[p_text] - parts)
            slope = _summed(where, bent, len(met)) + 1e-3 * factors[met]
            moved[met] += slope**2
            factors[met] -= bend * slope / np.sqrt(moved[met])
            bias_moved += off.sum() ** 2
            bias -= 0.05 * off.sum() / np.sqrt(bias_moved)
    used = (weights != 0) | frequent
    return float(bias), held[used], weights[used], values[used], factors[used]


def _summed(group: np.ndarray, values: np.ndarray, groups: int) -> np.ndarray:
    """Column sums of the rows of each group."""
    out = np.empty((groups, values.shape[1]))
    for f in range(values.shape[1]):
        out[:, f] = np.bincount(group, values[:, f], minlength=groups)
    return out


_MODEL = "bucket long, weight double, value double, factors array<double>"


def _fitted(options: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One task learns from the sample; the bias is the row of bucket -1."""
        given = [(b["mark"][k].as_py(), b["buckets"][k].values.to_numpy(), b["label"][k].as_py()) for b in batches for k in range(b.num_rows)]
        given.sort(key=lambda r: r[0])
        bias, buckets, weights, values, factors = fit([r[1] for r in given], np.array([r[2] for r in given], dtype=np.float64), **options)
        columns = [np.r_[-1, buckets].astype(np.int64), np.r_[bias, weights], np.r_[0.0, values], [[], *factors.tolist()]]
        kinds = (pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["bucket", "weight", "value", "factors"])

    return run


def learnt(
    docs: DataFrame, labels: DataFrame, learn: Column | None = None, id: str = "doc_id", text: str = "text", label: str = "toxic",
    *, sample: int = SAMPLE, **options,
) -> Machine:
    """The machine for the labels of some documents.

    ``learn`` is a condition on the rows of ``labels``. Rows without an id or a label are left
    out. Of ids labelled twice the higher label holds, of documents with one id the text with
    the smallest hash. Of more than ``sample`` ids those with the smallest hash are
    taken, so the sample, the one task that learns and the machine (at most ``BUCKETS``
    rows) have a size that does not grow with the data. Without labels all scores are 0.
    """
    scratch = Scratch(docs.sparkSession)
    known = labels if learn is None else labels.where(learn)
    known = known.select(F.col(id).cast("long").alias("doc_id"), F.col(label).cast("long").alias("label"))
    known = known.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    given = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    known = known.withColumn("mark", F.xxhash64("doc_id"))
    # Only ids of documents are candidates; the semi join's own side has ids alone.
    known = known.join(given.select("doc_id"), "doc_id", "left_semi").orderBy("mark", "doc_id").limit(sample)
    known = scratch.write(known, "sample")
    chosen = given.join(F.broadcast(known), "doc_id").groupBy("doc_id", "mark", "label")
    chosen = chosen.agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def hash_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([hashed(t.as_py()) for t in batch["text"]], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch["mark"], batch["label"], found], ["mark", "label", "buckets"])

    rows = scratch.write(chosen.select("mark", "label", "text").mapInArrow(hash_terms, "mark long, label long, buckets array<long>"), "hashed")
    model = scratch.write(rows.repartition(1).mapInArrow(_fitted(options), _MODEL), "machine").toArrow()
    bucket, weight, value = (model[c].to_numpy() for c in ("bucket", "weight", "value"))
    if not len(bucket):  # without rows the task that learns sees no batch at all on some paths
        return Machine(*fit([], np.zeros(0), **options))
    told = bucket >= 0
    factors = np.array([f for b, f in zip(bucket, model["factors"].to_pylist()) if b >= 0], dtype=float).reshape(told.sum(), -1 if told.any() else 0)
    return Machine(float(weight[~told][0]), bucket[told], weight[told], value[told], factors)


def scored(docs: DataFrame, machine: Machine, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1) of every row of ``docs``, from its whole text alone.

    A NULL or empty text has no terms and gets the bias' score. Rows keep their id, also NULL
    or repeated; other columns are not read. An empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [shared.value.score(hashed(t.as_py())) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores, pa.float64())], ["doc_id", "score"])

    slim = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return slim.mapInArrow(run, "doc_id long, score double")
