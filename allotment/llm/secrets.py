"""Secrets in texts: fixed patterns, and character Markov models of random strings and ordinary words."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns in the order of their kinds, the group whose length
# counts, and its least length.
BASE = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
)
#: Kind of the spans that the models add.
MODEL = "markov"
#: Strings that the models judge: runs of these characters of the least length and more.
ALPHABET, LEAST = "A-Za-z0-9+/_=-", 16
#: Log-likelihood ratios are kept as whole thousandths of a nat; a string is a secret
#: from this total and this mean per character on.
UNIT, TOTAL, MEAN = 1000, 15_000, 600
#: Bounds of the labelled samples: documents for ordinary words, digests for random strings.
SAMPLE_DOCUMENTS, SAMPLE_DIGESTS = 2000, 2000
REDACTED = "[SECRET]"
#: The table covers the characters from this code on, so many in a row: "+" to "z".
_FIRST, _CODES = 43, 80

SPAN = "array<struct<start:int,kind_no:int,kind:string,end:int>>"


def _matches(text: Column, pattern: str, group: int, least: int, number: int, kind: str) -> Column:
    """Spans of the leftmost non-overlapping matches whose ``group`` has ``least`` characters, in code points."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    counted = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(whole))
    lengths = F.zip_with(gaps, F.zip_with(whole, counted, lambda w, c: F.struct(F.length(w).alias("w"), F.length(c).alias("c"))),
                         lambda g, x: F.struct(F.length(g).alias("gap"), x["w"].alias("whole"), x["c"].alias("counted")))
    none = F.array().cast(SPAN)

    def step(seen: Column, x: Column) -> Column:
        start = seen["at"] + x["gap"]
        span = F.struct(start.alias("start"), F.lit(number).alias("kind_no"), F.lit(kind).alias("kind"), (start + x["whole"]).alias("end"))
        kept = F.when(x["counted"] >= least, F.concat(seen["spans"], F.array(span))).otherwise(seen["spans"])
        return F.struct((start + x["whole"]).alias("at"), kept.alias("spans"))

    start = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    spans = F.aggregate(lengths, start, step, lambda seen: seen["spans"])
    return F.when(text.rlike(pattern), spans).otherwise(none)


def base_spans(text: Column) -> Column:
    """Spans of all base kinds, by start, then kind."""
    found = [_matches(text, pattern, group, least, k, kind) for k, (kind, pattern, group, least) in enumerate(BASE)]
    return F.array_sort(F.concat(*found))


def labelled_samples(docs: DataFrame, id: str = "doc_id", text: str = "text", *, documents: int = SAMPLE_DOCUMENTS,
                     digests: int = SAMPLE_DIGESTS) -> DataFrame:
    """``text`` and ``is_random``: ordinary words from a bounded sample of documents, random strings from digests.

    The documents are the first by MD5 of their id (ties by the text), so the sample does
    not depend on the layout; a bound on the MD5, from the number of rows, leaves all but
    some of the others where they are, unless too few rows pass it. Matches of the base patterns are taken out of them. Random strings are
    SHA-256 digests in hexadecimal, in Base64, and as capitals and digits.
    """
    key = F.md5(F.coalesce(F.col(id).cast("string"), F.lit("")))
    plain = F.coalesce(F.col(text).cast("string"), F.lit(""))
    keyed = docs.select(key.alias("key"), plain.alias("text"))
    count = docs.count()
    if count > 2 * documents:  # about twice as many as wanted are sorted, not all
        bounded = keyed.where(F.col("key") < f"{2 * documents * 16**12 // count:012x}")
        if bounded.select("key").limit(documents).count() == documents:  # not so with few different ids
            keyed = bounded
    chosen = keyed.orderBy("key", "text").limit(documents)
    cleaned = F.col("text")
    for _, pattern, _, _ in BASE[:2]:
        cleaned = F.regexp_replace(cleaned, pattern, " ")
    cleaned = F.regexp_replace(cleaned, r"[0-9a-f]{16,}", " ")
    words = chosen.select(F.explode(F.regexp_extract_all(cleaned, F.lit(f"[{ALPHABET}]{{4,}}"), F.lit(0))).alias("text"))
    digest = F.sha2(F.col("id").cast("string"), 256)
    coded = F.base64(F.unhex(digest))
    capitals = F.upper(F.regexp_replace(coded, "[^A-Za-z0-9]", ""))
    random = docs.sparkSession.range(digests).select(F.explode(F.array(digest, coded, capitals)).alias("text"))
    return words.withColumn("is_random", F.lit(False)).unionByName(random.withColumn("is_random", F.lit(True)))


def ratio_table(samples: DataFrame, alphabet: str = ALPHABET) -> DataFrame:
    """One row, ``ratios``: 80 x 80 whole numbers, the log-likelihood ratio of every step between two characters.

    For each label a first-order Markov chain over the characters of the alphabet, add-one
    smoothed; the ratio is random against ordinary, in thousandths of a nat. Steps
    outside of the alphabet count 0. The table's size is fixed.
    """
    codes = F.split(F.regexp_replace(F.col("text"), f"[^{alphabet}]", ""), "")
    steps = samples.select("is_random", codes.alias("c")).where(F.size("c") > 1).select(
        "is_random", F.explode(F.zip_with(
            F.slice("c", F.lit(1), F.size("c") - 1), F.slice("c", F.lit(2), F.size("c") - 1),
            lambda a, b: F.struct(F.ascii(a).alias("a"), F.ascii(b).alias("b")),
        )).alias("s"),
    )
    counts = steps.groupBy("s.a", "s.b").agg(
        F.count(F.when(F.col("is_random"), 1)).alias("random"), F.count(F.when(~F.col("is_random"), 1)).alias("ordinary")
    )
    totals = counts.groupBy("a").agg(F.sum("random").alias("all_random"), F.sum("ordinary").alias("all_ordinary"))
    spark = samples.sparkSession
    known = spark.range(_FIRST, _FIRST + _CODES).select(F.col("id").cast("int").alias("a"), F.char("id").alias("letter")).where(
        F.col("letter").rlike(f"^[{alphabet}]$")
    ).select("a")
    size = F.lit(known.count())
    cells = known.join(known.withColumnRenamed("a", "b"), F.lit(True)).join(counts, ["a", "b"], "left").join(totals, "a", "left")
    filled = cells.na.fill(0)
    odds = lambda n, all: (F.col(n) + 1) / (F.col(all) + size)
    ratio = F.round(F.log(odds("random", "all_random") / odds("ordinary", "all_ordinary")) * UNIT).cast("int")
    dense = spark.range(_CODES * _CODES).join(
        filled.select(((F.col("a") - _FIRST) * _CODES + F.col("b") - _FIRST).cast("long").alias("id"), ratio.alias("ratio")), "id", "left"
    )
    pairs = F.array_sort(F.collect_list(F.struct("id", F.coalesce("ratio", F.lit(0)).alias("ratio"))))
    return dense.agg(F.transform(pairs, lambda p: p["ratio"]).alias("ratios"))


def model_score(word: Column, ratios: Column) -> Column:
    """Sum of the log-likelihood ratios of a word's steps, in thousandths of a nat."""
    start = F.struct(F.lit(-1).alias("last"), F.lit(0).cast("bigint").alias("sum"))

    def step(seen: Column, letter: Column) -> Column:
        code = F.ascii(letter) - _FIRST
        gain = F.when(seen["last"] >= 0, F.get(ratios, seen["last"] * _CODES + code)).otherwise(0)
        return F.struct(code.alias("last"), (seen["sum"] + gain).alias("sum"))

    return F.aggregate(F.split(word, ""), start, step, lambda seen: seen["sum"])


def find_secrets(
    docs: DataFrame,
    samples: DataFrame | None = None,
    id: str = "doc_id",
    text: str = "text",
    *,
    least: int = LEAST,
    total: int = TOTAL,
    mean: int = MEAN,
    carry: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``text``, ``base``, ``spans``; with ``carry`` the whole row as ``row``.

    ``base`` has the spans of the fixed patterns; ``spans`` adds those of kind
    ``markov``: strings of ``least`` and more characters that overlap no base span
    and whose log-likelihood ratio reaches ``total`` and ``mean`` per character.
    Spans have start and end (exclusive) in code points and go by start, then kind.
    ``samples`` (``text``, ``is_random``) train the models; without them they come
    from ``labelled_samples``. A NULL text counts as empty, and ids are only carried.
    Only DataFrame functions are used; the models are one array of fixed size.
    """
    if samples is None:
        samples = labelled_samples(docs, id, text)
    ratios = F.lit(np.array(ratio_table(samples).first()[0], dtype=np.int32))
    slim = docs.select(F.col(id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
                       *([F.struct("*").alias("row")] if carry else []))
    word = f"[{ALPHABET}]{{{least},}}"
    slim = slim.withColumn("base", base_spans(F.col("text")))
    runs = _matches(F.col("text"), word, 0, least, len(BASE), MODEL)
    scores = F.transform(F.regexp_extract_all(F.col("text"), F.lit(word), F.lit(0)), lambda w: model_score(w, ratios))
    free = lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    judged = F.zip_with(runs, scores, lambda s, n: F.struct(s.alias("span"), n.alias("score")))
    length = lambda x: x["span"]["end"] - x["span"]["start"]
    chosen = F.filter(judged, lambda x: (x["score"] >= total) & (x["score"] >= length(x) * mean) & free(x["span"]))
    return slim.withColumn("added", F.transform(chosen, lambda x: x["span"])).select(
        "doc_id", "text", "base", F.array_sort(F.concat("base", "added")).alias("spans"),
        *(["row"] if carry else []),
    )


def listed(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = REDACTED) -> Column:
    """The text with every stretch of spans replaced by a mark; other characters stay as they are."""
    cut = lambda start, end: F.substr(text, (start + 1).cast("int"), (end - start).cast("int"))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def step(seen: Column, s: Column) -> Column:
        apart = F.concat(seen["done"], cut(seen["at"], s["start"]), F.lit(mark))
        inside = (s["start"] < seen["at"])
        return F.struct(F.greatest(seen["at"], s["end"]).alias("at"), F.when(inside, seen["done"]).otherwise(apart).alias("done"))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(
        spans, start, step, lambda seen: F.concat(seen["done"], cut(seen["at"], F.length(text)))
    ))
