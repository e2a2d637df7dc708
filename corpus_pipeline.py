"""A corpus pipeline over ``documents``: judge, deduplicate, redact, mix, encode.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written and read again as the next one's ``docs``. All but the
last return the columns of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allotment.llm import bpe, mixing, quality, secrets, simhash
from allotment.llm.tables import Scratch, read

#: Path of the byte-level BPE vocabulary of the last stage.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps.

    Rows are judged one by one: repeated rows and rows without an id, text, source or language
    are judged as ``quality.judged`` says, and stay or go as they are.
    """
    told = quality.judged(docs.select(F.struct("*").alias("_document"), "doc_id", "text", "source", "lang"), read(spark, sf_dir, "labels"))
    return told.where("verdict.kept").select("_document.*")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: four-word shingles, at most four differing bits.

    Rows are told apart by id and fingerprint; which row of a group stays, also with NULL and
    repeated ids, is said in ``simhash.one_of_each``. NULL and empty texts are one group.
    """
    return simhash.one_of_each(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every found secret replaced by a mark and ``n_chars`` counted anew.

    A NULL text stays NULL and keeps its ``n_chars``. Overlapping spans are replaced by one mark.
    Repeated rows and NULL ids stay as they are.
    """
    found = secrets.find_secrets(docs, carry=True)
    text = F.when(F.size("spans") > 0, secrets.redacted(F.col("text"), F.col("spans"))).otherwise(F.col("row.text"))
    found = found.select("row", text.alias("text"))
    new = {"text": F.col("text"), "n_chars": F.coalesce(F.length("text"), F.col("row.n_chars")).cast(dict(docs.dtypes)["n_chars"])}
    return found.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them.

    Each row is taken by itself, also where ids repeat or are NULL. Documents without words
    have size 0 and are taken as often as the whole part of their source's rate says.
    """
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (packed little-endian 32-bit) and ``decoded``, the text of the ids.

    One row per row; a NULL text counts as empty and has no ids.
    """
    return bpe.encode_decode(docs, VOCABULARY)


STAGES = [
    ("quality classifier", keep_good),
    ("simhash near-dedup", keep_one_of_each),
    ("secret scan", redact_secrets),
    ("source mixing", mix_sources),
    ("bpe encoding", encode),
]

#: Fingerprints, trained counts, dependent rounding and BPE have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written to shared scratch and read again."""
    scratch, docs, last = Scratch(spark), read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        label = name.replace(" ", "_")
        docs = scratch.write(stage(spark, docs, sf_dir), label)
        scratch.drop(*([last] if last else []))
        last = label
    return docs
