from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

import __spark_entry__
import corpus_pipeline as pipeline
from allotment.llm import queries
from allotment.llm.mixing import mix
from allotment.llm.quality import judged
from allotment.llm.secrets import find_secrets
from allotment.llm.simhash import near_duplicates

from . import frames

SMALL = "/root/testdata/sf0.001"


def test_every_operator_has_a_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(queries.ORACLES) <= set(queries.QUERIES)


def test_stages_one_by_one_and_whole_run(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    steps = {}
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        steps[name] = (docs, out)
        if name != pipeline.STAGES[-1][0]:
            assert out.schema.names == docs.schema.names and out.dtypes == docs.dtypes
            docs = spark.createDataFrame(out.collect(), out.schema)
    ids = lambda frame: Counter(r.doc_id for r in frame.collect())
    given, good = steps["quality classifier"]
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    assert ids(good) == Counter(r.doc_id for r in judged(given, labels).where("verdict.kept").collect())
    given, kept = steps["simhash near-dedup"]
    assert ids(kept) == Counter({r.component_id: 1 for r in near_duplicates(given).collect()})
    given, clean = steps["secret scan"]
    spans = {r.doc_id: r for r in find_secrets(given).collect()}
    for r in clean.collect():
        text, at, parts = spans[r.doc_id].text, 0, []
        for s in sorted((s.start, s.end) for s in spans[r.doc_id].spans):
            if s[0] >= at:
                parts += [text[at : s[0]], "[SECRET]"]
            at = max(at, s[1])
        assert r.text == "".join(parts) + text[at:] and r.n_chars == len(r.text)
    given, mixed = steps["source mixing"]
    assert ids(mixed) == Counter({r.doc_id: r.copies for r in mix(given).collect() if r.copies})
    given, coded = steps["bpe encoding"]
    texts = Counter((r.doc_id, r.text) for r in given.collect())
    rows = coded.collect()
    assert Counter((r.doc_id, r.decoded) for r in rows) == texts and all(len(r.ids) == 4 * r.n_tokens for r in rows)
    digest = lambda rs: Counter((r.doc_id, hashlib.sha256(bytes(r.ids)).hexdigest()) for r in rs)
    assert digest(pipeline.run(spark, SMALL).collect()) == digest(rows)


@pytest.mark.parametrize("rows", [frames.EDGES, []])
def test_stages_take_any_rows(spark, rows):
    for name, stage in pipeline.STAGES:
        docs = frames.docs(spark, rows)
        out = stage(spark, docs, SMALL)
        if name != "bpe encoding":
            assert out.columns == docs.columns
        assert (out.count() == 0) == (not rows)


def test_one_of_each_group_with_repeated_ids(spark):
    out = pipeline.keep_one_of_each(spark, frames.docs(spark, frames.EDGES), SMALL)
    assert Counter(r.doc_id for r in out.collect()) == Counter([1, 3, None, 5, 6])


def test_queries_carry_whole_tables(spark):
    count = lambda table: spark.read.parquet(f"{SMALL}/{table}.parquet").count()
    tables = {1: "documents", 3: "pages", 4: "documents", 5: "documents", 7: "embeddings", 8: "documents", 9: "documents", 10: "documents", 12: "documents", 13: "documents"}
    for name, query in queries.QUERIES.items():
        number = int(name[2:].split("_")[0])
        if number in tables:
            assert query(spark, SMALL).count() == count(tables[number])


def test_token_digests(spark):
    random.seed(0)
    rows = {r.doc_id: r for r in queries.op9_bpe_round_trip(spark, SMALL).collect()}
    for r in random.sample(spark.read.parquet(f"{SMALL}/documents.parquet").collect(), 20):
        assert rows[r.doc_id].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()
        assert rows[r.doc_id].n_tokens > 0 and np.isfinite(rows[r.doc_id].n_tokens)
