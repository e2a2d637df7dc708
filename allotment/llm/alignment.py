"""Alignment of two tokenizers over whole texts, by Arrow tables inside tasks that Spark deals out."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import byte_letters
from .tables import Scratch

#: Bytes of text that are aligned together, and partial counts that a task holds.
TOGETHER, HELD = 1 << 19, 1 << 18
#: Rows that Spark hands to a task's Python side at once: a row has a whole text, or all its pairs.
ROWS = 256
#: Pairs whose counts are broadcast, the most frequent ones; all others are joined.
FREQUENT = 1 << 17
#: A pair is one number: the id of the first tokenizer above this many bits, that of the second below.
BITS = 32

_STORED = {
    "row": pa.int64(), "doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(),
    "groups_sha256": pa.string(), "pairs": pa.list_(pa.int64()), "links": pa.list_(pa.int64()), "pair": pa.int64(), "documents": pa.int64(),
}
_STORED_DDL = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<long>, links array<long>, pair long, documents long"
)


class Tokenizers:
    """A byte-level BPE file of the tokenizers library (A) and a sentencepiece model (B), with the bytes of their tokens.

    A's merges, whose results are numbered in their order, are run by tiktoken, which knows no
    special tokens here and gives the same ids.
    """

    def __init__(self, first: bytes, second: bytes, pattern: str = public_tokenizers.PATTERN):
        pa.set_cpu_count(1)
        spec, letters = json.loads(first), byte_letters()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ids = {bytes(letters[c] for c in token): id for token, id in spec["model"]["vocab"].items() if token not in special}
        merged = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        made = [ids[bytes(letters[c] for c in x + y)] for x, y in merged]
        if any(x >= y for x, y in zip(made, made[1:])):
            raise ValueError("the ids of the merges' results must rise in the order of the merges")
        self.a = tiktoken.Encoding("first", pat_str=pattern, mergeable_ranks=ids, special_tokens={})
        a_bytes = [b""] * (max([*ids.values(), *special.values()], default=-1) + 1)
        for token, id in [*ids.items(), *((t.encode(), i) for t, i in special.items())]:
            a_bytes[id] = token
        self.b = sentencepiece.SentencePieceProcessor(model_proto=second)
        b_bytes = []
        for id in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(id)
            b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(id) else piece.replace("▁", " ").encode())
        self.a_bytes, self.b_bytes = (pa.array(x, pa.binary()) for x in (a_bytes, b_bytes))
        if max(len(a_bytes), len(b_bytes)) >= 1 << (BITS - 1):
            raise ValueError("a vocabulary is too large for the pair numbers")

    def encode(self, texts: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        """Both tokenizers' ids: A of a blank and the text, B of the text, to which B adds the blank."""
        a = [self.a.encode_ordinary(" " + t) for t in texts]
        b = self.b.encode(texts, num_threads=1) if texts else []
        return tuple(pa.array(ids, pa.list_(pa.int64())) for ids in (a, b))


@lru_cache(maxsize=1)
def _loaded(first: bytes, second: bytes) -> Tokenizers:
    """One pair of tokenizers per worker process."""
    return Tokenizers(first, second)


def _joined(ids: pa.ListArray, of: pa.Array) -> tuple[list[bytes], pa.Array]:
    """Each text's bytes put together from its tokens, and the length of every token."""
    flat = pc.take(of, pc.list_flatten(ids)).cast(pa.large_binary())
    lengths = pc.binary_length(flat)
    ends = np.r_[0, np.cumsum(lengths.to_numpy(zero_copy_only=False))][ids.offsets.to_numpy()]
    data = flat.buffers()[2].to_pybytes() if len(flat) and flat.buffers()[2] is not None else b""
    return [data[s:e] for s, e in zip(ends[:-1], ends[1:])], lengths


def _tokens(ids: pa.ListArray, lengths: pa.Array, base: pa.Array) -> pa.Table:
    """``document``, ``id`` and ``end`` of every token in order.

    ``end`` is the key of the joins: the byte after the token, counted over all documents of
    the batch, that is a running sum of the lengths from each document's ``base`` on.
    """
    document = pc.list_parent_indices(ids)
    total = pc.cumulative_sum(lengths.cast(pa.int64()))
    first = pc.take(pa.array(np.r_[0, total.to_numpy(zero_copy_only=False)]), pc.take(pa.array(ids.offsets), document))
    end = pc.add(pc.subtract(total, first), pc.take(base, document))
    return pa.table({"document": document, "id": pc.list_flatten(ids), "end": end})


def _grouped(one: pa.Table, two: pa.Table) -> tuple[pa.Table, pa.Table, int]:
    """Both sides' tokens with the number of their group, and the number of groups.

    The ends that both sides have are found by a hash join; a token's group is how many of
    them lie before its own end.
    """
    shared = one.select(["document", "end"]).join(two.select(["end"]), "end", join_type="inner", use_threads=False)
    ends = np.sort(shared["end"].to_numpy())
    numbered = [side.append_column("group", pa.array(np.searchsorted(ends, side["end"].to_numpy()))) for side in (one, two)]
    return *numbered, len(ends)


def _named(tokens: pa.Table, count: int) -> tuple[np.ndarray, pa.Array]:
    """Where each group's tokens start, and each group's ids joined by commas."""
    starts = np.searchsorted(tokens["group"].to_numpy(), np.arange(count + 1))
    words = tokens["id"].combine_chunks().cast(pa.string())
    return starts, pc.binary_join(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), words), ",")


def align(a: pa.ListArray, b: pa.ListArray, words: Tokenizers, texts: list[bytes]) -> tuple[dict[str, list], pa.Table]:
    """Digest columns of each text, and its linked pairs: ``document``, ``pair`` and ``links``, how often.

    ``texts`` are what the tokens' bytes must be equal to; a text where either differs, or an empty one, has no tokens.
    """
    (a_joined, _), (b_joined, _) = _joined(a, words.a_bytes), _joined(b, words.b_bytes)
    fits = [len(t) > 0 and x == t and y == t for t, x, y in zip(texts, a_joined, b_joined)]
    none = pa.scalar([], pa.list_(pa.int64()))
    a, b = (pc.if_else(pa.array(fits, pa.bool_()), ids, none) for ids in (a, b))
    sizes = np.array([len(t) if fit else 0 for t, fit in zip(texts, fits)], dtype=np.int64)
    base = pa.array(np.cumsum(sizes) - sizes)
    sides = []
    for ids, of in ((a, words.a_bytes), (b, words.b_bytes)):
        sides.append(_tokens(ids, _joined(ids, of)[1], base))
    one, two = sides
    one, two, count = _grouped(one, two)
    (a_starts, a_names), (b_starts, b_names) = _named(one, count), _named(two, count)
    document = pc.take(one["document"].combine_chunks(), pa.array(a_starts[:-1]))
    groups = np.searchsorted(document.to_numpy(zero_copy_only=False), np.arange(len(texts) + 1))
    lines = pc.binary_join_element_wise(a_names, b_names, "|")
    lines = pc.binary_join(pa.ListArray.from_arrays(pa.array(groups, pa.int32()), lines), ";")
    times = np.r_[0, np.cumsum(np.diff(a_starts) * np.diff(b_starts))][groups]
    told = {
        "n_a": pc.list_value_length(a).cast(pa.int64()), "n_b": pc.list_value_length(b).cast(pa.int64()),
        "n_groups": pa.array(np.diff(groups), pa.int64()), "n_links": pa.array(np.diff(times), pa.int64()),
        "groups_sha256": pa.array([hashlib.sha256(x.encode()).hexdigest() if fit else "" for x, fit in zip(lines.to_pylist(), fits)], pa.string()),
    }
    # Tokens alone with each other are linked by place. In other groups ids are counted first, then both sides meet.
    alone = (np.diff(a_starts) == 1) & (np.diff(b_starts) == 1)
    pairs = [_paired(document.filter(pa.array(alone)), one["id"].take(a_starts[:-1][alone]), two["id"].take(b_starts[:-1][alone]))]
    more = [side.filter(pa.array(~alone[side["group"].to_numpy()])).select(["group", "id"]) for side in (one, two)]
    more = [side.group_by(["group", "id"], use_threads=False).aggregate([([], "count_all")]) for side in more]
    met = more[0].rename_columns(["group", "a", "a_times"]).join(
        more[1].rename_columns(["group", "b", "b_times"]), "group", join_type="inner", use_threads=False
    )
    pairs.append(_paired(document.take(met["group"]), met["a"], met["b"], pc.multiply(met["a_times"], met["b_times"])))
    linked = pa.concat_tables(pairs).group_by(["document", "pair"], use_threads=False).aggregate([("links", "sum")])
    linked = linked.rename_columns(["document", "pair", "links"])
    narrow = np.uint16 if len(texts) < 1 << 16 else np.int64  # short numbers are sorted by radix
    return told, linked.take(np.argsort(linked["document"].to_numpy().astype(narrow), kind="stable"))


def _paired(document, a, b, links=None) -> pa.Table:
    pair = pc.bit_wise_or(pc.shift_left(a, pa.scalar(BITS, pa.int64())), b)
    return pa.table({"document": document, "pair": pair, "links": pa.array(np.ones(len(pair), dtype=np.int64)) if links is None else links})


def _documents_of(parts: list[pa.Table]) -> pa.Table:
    """Partial counts put together: ``pair`` and ``documents``."""
    whole = pa.concat_tables(parts)
    return whole.group_by("pair", use_threads=False).aggregate([("documents", "sum")]).rename_columns(["pair", "documents"])


def _batch(columns: dict[str, pa.Array], size: int) -> pa.RecordBatch:
    arrays = [columns[name] if name in columns else pa.nulls(size, kind) for name, kind in _STORED.items()]
    flat = [a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a for a in arrays]
    return pa.RecordBatch.from_arrays([a.cast(kind) for a, kind in zip(flat, _STORED.values())], list(_STORED))


def _aligner(first, second):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: list[pa.Table] = []

        def counted(parts: list[pa.Table]) -> Iterator[pa.RecordBatch]:
            whole = _documents_of(parts)
            yield _batch({"pair": whole["pair"], "documents": whole["documents"]}, len(whole))

        for batch in batches:
            words = _loaded(first.value, second.value)
            lengths = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False)
            bins = np.cumsum(lengths.astype(np.int64)) // TOGETHER
            cuts = np.r_[0, np.flatnonzero(np.diff(bins)) + 1, batch.num_rows]
            for start, stop in zip(cuts[:-1], cuts[1:]):
                part = batch.slice(start, stop - start)
                texts = [t.as_py() or "" for t in part["text"]]
                told, linked = align(*words.encode(texts), words, [(" " + t).encode() if t else b"" for t in texts])
                ends = pa.array(np.searchsorted(linked["document"].to_numpy(), np.arange(len(texts) + 1)), pa.int32())
                lists = {c: pa.ListArray.from_arrays(ends, linked[c].combine_chunks()) for c in ("pair", "links")}
                yield _batch({"row": part["row"], "doc_id": part["doc_id"], "pairs": lists["pair"], "links": lists["links"]} | told, len(texts))
                each = linked.group_by("pair", use_threads=False).aggregate([([], "count_all")]).rename_columns(["pair", "documents"])
                counts.append(each)
                if sum(map(len, counts)) >= HELD:
                    counts = [_documents_of(counts)]
                    if len(counts[0]) >= HELD // 2:
                        yield from counted(counts)
                        counts = []
        if counts:
            yield from counted(counts)

    return run


def _told(frequent, best):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums over the pairs whose counts are known here; every other pair as a row of its own."""
        known, highest = frequent.value, best.value
        for batch in batches:
            document = pc.list_parent_indices(batch["pairs"]).cast(pa.int64())
            flat = pa.table({"document": document, "pair": pc.list_flatten(batch["pairs"]), "links": pc.list_flatten(batch["links"])})
            met = flat.join(known, "pair", use_threads=False)
            rest = met.filter(pc.is_null(met["documents"]))
            met = met.filter(pc.is_valid(met["documents"]))
            top = pc.take(highest, pc.shift_right(met["pair"], pa.scalar(BITS, pa.int64())))
            sums = pa.table({
                "document": met["document"], "best": pc.if_else(pc.equal(met["documents"], top), met["links"], 0),
                "sum": pc.multiply(met["documents"], met["links"]),
            }).group_by("document", use_threads=False).aggregate([("best", "sum"), ("sum", "sum")])
            out = {"row": batch["row"].to_numpy(), "n_best": np.zeros(batch.num_rows, dtype=np.int64), "count_sum": np.zeros(batch.num_rows, dtype=np.int64)}
            at = sums["document"].to_numpy()
            out["n_best"][at], out["count_sum"][at] = sums["best_sum"].to_numpy(), sums["sum_sum"].to_numpy()
            names, blank = ["row", "n_best", "count_sum", "pair", "links"], pa.nulls(batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([*map(pa.array, out.values()), blank, blank], names)
            zero = pa.array(np.zeros(len(rest), dtype=np.int64))
            row = pc.take(batch["row"], rest["document"].combine_chunks())
            yield pa.RecordBatch.from_arrays([row, zero, zero, rest["pair"].combine_chunks(), rest["links"].combine_chunks()], names)

    return run


@contextmanager
def _rows_at_once(spark: SparkSession, rows: int) -> Iterator[None]:
    """Smaller Arrow batches for the jobs that run inside."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def aligned(docs: DataFrame, first: str, second: str, id: str = "doc_id", text: str = "text", *, frequent: int = FREQUENT) -> DataFrame:
    """How two tokenizers cut each text: one row per row of ``docs``.

    ``first`` is the path of a byte-level BPE file of the tokenizers library (A, which encodes a
    blank and the text), ``second`` of a sentencepiece model (B, which adds the blank); strings of
    special tokens are plain text. Byte offsets where tokens of both end cut the tokens into
    groups; tokens of A and B in one group are linked. The count of an (A id, B id) pair is the
    number of documents that have it linked, over the whole table. Columns: ``doc_id``, ``n_a``,
    ``n_b``, ``n_groups``, ``n_links``, ``n_best`` (links whose count is the highest of their A id),
    ``count_sum`` (counts summed over the links), ``groups_sha256`` (of ``a1,a2|b1;a3|b2,b3``).

    Texts that are NULL or empty, or whose tokens of A or B don't join to a blank and the text,
    have no tokens: zeros and ''. Rows keep their id, also NULL or repeated; each row is a
    document of its own. Other columns are not read. An empty table gives an empty result.

    Tasks align ``TOGETHER`` bytes of texts at a time (a longer text by itself) and pass on each
    row's pairs and partial counts of pairs; Spark adds these up. Counts of the ``frequent`` most
    frequent pairs and each A id's highest count are broadcast, both of a fixed size; all other
    pairs are joined, none of which more than 1 / ``frequent`` of all linked pairs can have.
    """
    spark = docs.sparkSession
    scratch, files = Scratch(spark), []
    for path in (first, second):
        with open(path, "rb") as file:
            files.append(spark.sparkContext.broadcast(file.read()))
    slim = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    with _rows_at_once(spark, ROWS):
        stored = scratch.write(slim.mapInArrow(_aligner(*files), _STORED_DDL), "aligned")
    counts = stored.where("row is null").groupBy("pair").agg(F.sum("documents").alias("documents"))
    counts = scratch.write(counts, "counts")
    a_id = F.shiftright("pair", BITS).alias("a")
    best = counts.groupBy(a_id).agg(F.max("documents").alias("highest"))
    highest = best.toArrow()
    size = int(pc.max(highest["a"]).as_py() if len(highest) else 0) + 1
    table = np.zeros(size, dtype=np.int64)
    table[highest["a"].to_numpy()] = highest["highest"].to_numpy()
    ordered = counts.orderBy(F.col("documents").desc(), "pair").limit(frequent)
    known = spark.sparkContext.broadcast(ordered.toArrow().cast(pa.schema({"pair": pa.int64(), "documents": pa.int64()})))
    rows = stored.where("row is not null")
    sums = _told(known, spark.sparkContext.broadcast(pa.array(table)))
    with _rows_at_once(spark, ROWS):
        told = rows.select("row", "pairs", "links").mapInArrow(sums, "row long, n_best long, count_sum long, pair long, links long")
        told = scratch.write(told, "told")
    rest = told.where("pair is not null").select("row", "pair", "links").join(counts, "pair").withColumn("a", a_id).join(best, "a")
    sums = [
        F.sum(F.when(F.col("documents") == F.col("highest"), F.col("links")).otherwise(0)).alias("n_best"),
        F.sum(F.col("documents") * F.col("links")).alias("count_sum"),
    ]
    rest = rest.groupBy("row").agg(*sums)
    whole = told.where("pair is null").select("row", "n_best", "count_sum").unionByName(rest)
    whole = whole.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return rows.join(whole, "row").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
