"""Quality of documents: evidence of the text, shrunken rates of its path and host."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import Scratch

_UPPER, _LOWER, _DIGITS = (bytes(range(a, b)) for a, b in ((65, 91), (97, 123), (48, 58)))
_SIGNS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:'\"()-?!")
FEATURES = ("capitals", "signs", "digits", "exclaims", "repeats", "variety", "bare", "long", "lines")
BINS = 16


def shares(text: str | None) -> list[float]:
    """The text's features, each between 0 and 1, over the whole text.

    Share of capitals among ASCII letters, of signs, digits and exclamation marks among
    bytes, of words that repeat the word before, of distinct words (against what a text
    of that length has), of words that are one sign, words over 30 bytes, and of
    repeated lines.
    """
    data = (text or "").encode("utf-8", "replace")
    size, words, lines = max(len(data), 1), data.split(), data.split(b"\n")
    count = max(len(words), 1)
    among = lambda letters: len(data) - len(data.translate(None, letters))
    upper = among(_UPPER)
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    single = sum(len(w) == 1 and not w.isalnum() and w < b"\x80" for w in words)
    variety = (len(set(words)) / count) ** (4 / max(np.log2(count), 4))
    return [
        upper / max(upper + among(_LOWER), 1), 4 * among(_SIGNS) / size, 4 * among(_DIGITS) / size, 4 * data.count(b"!") / size,
        repeats / count, variety, single / count, sum(len(w) > 30 for w in words) / count, 1 - len(set(lines)) / len(lines),
    ]


def binned(text: Column) -> Column:
    """The features' bins as an array; equal steps from 0 to 1."""

    @F.pandas_udf("array<int>")
    def bins(texts: pd.Series) -> pd.Series:
        return pd.Series([[min(int(x * BINS), BINS - 1) for x in shares(t)] for t in texts], dtype=object)

    return bins(text)


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _spread(groups: DataFrame, good: str, count: str, expected: Column) -> Column:
    """Pseudo-counts of a group's prior by moments: how little groups differ beyond what chance explains.

    One aggregate, at most a million, at least one.
    """
    rate = F.col(good) / F.col(count)
    noise = expected * (1 - expected)
    between = F.sum(F.col(count) * F.pow(rate - expected, 2)) / F.sum(count) - F.sum(noise) / F.sum(count)
    inner = F.sum(F.col(count) * noise) / F.sum(count)
    found = groups.where(F.col(count) > 0).agg(F.coalesce(F.least(F.greatest(inner / F.greatest(between, F.lit(1e-9)) - 1, F.lit(1.0)), F.lit(1e6)), F.lit(1.0)).alias("k"))
    return F.lit(found.first()[0])


def judged(
    docs: DataFrame,
    labels: DataFrame,
    verdict: str = "verdict",
    *,
    id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    path: str = "lang",
    label: str = "quality",
    threshold: float = 0.5,
) -> DataFrame:
    """The rows and columns of ``docs`` with a struct ``verdict``: ``evidence``, ``prior``, ``p_good``, ``kept``.

    * Document evidence: a naive Bayes log-likelihood ratio over the binned features,
      trained on all labelled documents by grouped counts (``label`` is 1 for good; of
      several labels of a document the lowest counts).
    * A document's expected goodness under the global rate is summed over all documents
      by host and by path within the host. Labels count through the evidence alone, so what
      a document adds to its path is known from its text and can be taken out again.
    * A host's rate is shrunk towards the global rate, a path's towards its host's, with
      pseudo-counts found by moments; the document itself is left out of its path.
    * The path's rate and the document's evidence give the posterior; ``kept`` is
      whether it reaches ``threshold``.

    NULL hosts and paths are groups of their own, a NULL text counts as empty, a
    NULL id has no label. Without labels, or with one kind only, the evidence is 0 or
    goes by that kind's smoothed counts and the rate is near one half or that kind. A
    column named like ``verdict`` is replaced; all others stay. What reaches the driver
    is the table of counts, of fixed size, and a few sums.
    """
    scratch = Scratch(docs.sparkSession)
    marks = labels.where(F.col(id).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(id).cast("long").alias("id")).agg(
        F.min(F.col(label).cast("int")).alias("good")
    )
    keys = [F.col(host).cast("string").alias("host"), F.col(path).cast("string").alias("path")]
    seen = docs.select(F.col(id).cast("long").alias("id"), *keys, binned(F.col(text).cast("string")).alias("bins"))
    seen = scratch.write(seen.join(marks, "id", "left"), "features")

    counts = seen.where("good is not null").select("good", F.posexplode("bins").alias("feature", "bin")).groupBy("feature", "bin").agg(
        F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad")
    ).collect()
    table = np.ones((2, len(FEATURES), BINS))
    for row in counts:
        table[:, row.feature, row.bin] += (row.good, row.bad)
    good, bad = (part.sum(axis=1, keepdims=True) for part in table)
    weights = F.lit(np.round(np.log(table[0] / good) - np.log(table[1] / bad), 6).ravel())
    n_good, n_bad = float(good[0, 0] - BINS), float(bad[0, 0] - BINS)
    overall = F.lit((n_good + 1) / (n_good + n_bad + 2))

    def evidence(bins: Column) -> Column:
        gains = F.transform(bins, lambda bin, k: F.get(weights, k * BINS + bin))
        return F.aggregate(gains, F.lit(0.0), lambda a, b: a + b)

    def expected(bins: Column) -> Column:
        return 1 / (1 + F.exp(-(evidence(bins) + _logit(overall))))

    mass = expected(F.col("bins"))
    paths = scratch.write(seen.groupBy("host", "path").agg(F.sum(mass).alias("mass"), F.count("*").alias("n")), "paths")
    hosts = scratch.write(paths.groupBy("host").agg(F.sum("mass").alias("host_mass"), F.sum("n").alias("host_n")), "hosts")
    k_host = _spread(hosts, "host_mass", "host_n", overall)
    host_rate = (F.col("host_mass") + k_host * overall) / (F.col("host_n") + k_host)
    named = hosts.select(F.col("host").alias("_host"), host_rate.alias("host_rate"))
    paths = paths.join(named, F.col("host").eqNullSafe(F.col("_host"))).drop("_host")
    k_path = _spread(paths, "mass", "n", F.col("host_rate"))
    rates = paths.select(
        F.col("host").alias("_host"), F.col("path").alias("_path"), F.col("mass").alias("_mass"), F.col("n").alias("_n"),
        F.col("host_rate").alias("_rate"), k_path.alias("_k"),
    )
    # As written, the rates' true size tells the planner whether the texts have to move for the join.
    rates = scratch.write(rates, "rates")
    rows = docs.select(
        F.struct("*").alias("row"), F.col(host).cast("string").alias("host"), F.col(path).cast("string").alias("path"),
        binned(F.col(text).cast("string")).alias("bins"),
    ).join(rates, F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path")))
    others = F.least(F.greatest(F.col("_mass") - expected(F.col("bins")), F.lit(0.0)), F.col("_n") - 1)
    prior = (others + F.col("_k") * F.col("_rate")) / (F.col("_n") - 1 + F.col("_k"))
    rows = rows.withColumns({"evidence": evidence(F.col("bins")), "prior": F.greatest(F.least(prior, F.lit(1 - 1e-9)), F.lit(1e-9))})
    rows = rows.withColumn("p", 1 / (1 + F.exp(-(F.col("evidence") + _logit(F.col("prior"))))))
    told = F.struct("evidence", "prior", F.col("p").alias("p_good"), (F.col("p") >= threshold).alias("kept"))
    return rows.select(*[F.col("row")[c].alias(c) for c in docs.columns if c != verdict], told.alias(verdict))
