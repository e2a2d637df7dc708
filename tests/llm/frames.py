"""Small frames for the operators' edge cases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, spans string, size string, row string, verdict string"


def docs(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of (doc_id, text, lang, source) with columns that clash with the operators' own."""
    filled = [(i, t, l, s, None if t is None else len(t), "f", "s", "z", "r", "v") for i, t, l, s in rows]
    return spark.createDataFrame(filled, DOCS)


LONG = " ".join(f"word{k}" for k in range(30000))
EDGES = [
    (1, "one two three four five six", "en", "a"), (2, "one two three four five six", "en", "a"), (2, "one two three four five six", "en", "a"),
    (3, None, None, None), (4, "", "en", None), (None, "no id here at all", "en", "a"), (5, LONG, "de", "b"),
    (6, "Überß 日本 🙂 <|endoftext|> \x1c x", None, "b"), (7, " \t\n ", "fr", "c"), (8, "ONE two Three four FIVE six", "en", "a"),
]
