"""Near-duplicate documents by SimHash fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .tables import Scratch

BYTES = 8
#: Rows of a postings list that one task compares; longer lists are dealt out in blocks of this size.
BLOCK = 16384
_LANE_ROWS = 255


def fingerprint(text: bytes | None, width: int = 4, seed: int = 42) -> int:
    """SimHash of a text's word shingles as an unsigned 64-bit number.

    A-Z is lower-cased, words are runs without ASCII white space, shingles are
    ``width`` words joined by spaces, repeats included; a shorter text is one
    shingle, a text without words gives 0. A bit is set if more than half of the
    shingles' XXH64 values have it.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    count = len(words) - width + 1
    grams = map(b" ".join, zip(*(islice(words, i, None) for i in range(width))))
    hashes = map(xxhash.xxh64_intdigest, grams, repeat(seed))
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, count, 1 << 16):
        ones += _ones(np.fromiter(islice(hashes, 1 << 16), dtype="<u8", count=min(1 << 16, count - start)))
    return int(np.packbits(ones * 2 > count, bitorder="little").view("<u8")[0])


def _ones(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit: byte lanes of 0 and 1, added up to 255 at a time."""
    bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").view("<u8").reshape(-1, 8)
    whole = len(bits) // _LANE_ROWS * _LANE_ROWS
    lanes = bits[:whole].reshape(-1, _LANE_ROWS, 8).sum(axis=1, dtype=np.uint64)
    lanes = np.vstack([lanes, bits[whole:].sum(axis=0, dtype=np.uint64)])
    return lanes.astype("<u8").view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 4) -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint's 64 bits as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.fromiter((fingerprint(t.as_py(), width) for t in batch["text"]), dtype="<u8", count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(marks.view("<i8"))], ["doc_id", "fp"])

    slim = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return slim.mapInArrow(run, "doc_id long, fp long")


def covering_triples() -> list[tuple[int, int, int]]:
    """Twenty triples of byte positions; any four of the eight positions contain one of them.

    The positions fall into three rings A, B and C; a triple lies in one ring, or has
    two places in a ring and one in the next.
    """
    rings = [(0, 1, 2), (3, 4, 5), (6, 7)]
    inside = [triple for ring in rings for triple in combinations(ring, 3)]
    across = [
        (*pair, one) for k, ring in enumerate(rings) for pair in combinations(ring, 2) for one in rings[(k + 1) % 3]
    ]
    return inside + across


def near_pairs(fps: DataFrame, distance: int = 4, block: int = BLOCK) -> DataFrame:
    """Edges (``a``, ``b``) that connect the same fingerprints as all links do.

    ``fps`` has distinct longs in ``fp``. Two fingerprints with at most four
    differing bits share at least four of their eight bytes in place. So the
    inverted index has a postings list for every triple of positions and its bytes
    (see ``covering_triples``): one list at least holds both. Inside a list the
    shared bytes of pairs are tallied, pairs with the guaranteed four are verified
    bit by bit, and what is emitted is a spanning forest of the list's links, not
    its pairs. Lists longer than ``block`` are cut into blocks, and every two blocks
    are compared as a group of their own. Empty and one-row tables give no edge.
    """
    if not 0 <= distance <= 4:
        raise ValueError("the index finds up to four differing bits")
    places = [(t, sum(0xFF << (8 * p) for p in triple)) for t, triple in enumerate(covering_triples())]
    entries = [
        F.struct(F.lit(t).alias("place"), F.col("fp").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask)).alias("bytes"))
        for t, mask in places
    ]
    scratch = Scratch(fps.sparkSession)
    postings = fps.select("fp", F.inline(F.array(*entries)))

    def compare_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, key, fp, cut = (np.zeros(0, dtype=np.int64) for _ in range(4))
        cut = 0  # blocks already given away of the list that the held rows belong to

        def lists(end: int) -> Iterator[pa.RecordBatch]:
            """The lists in the first ``end`` held rows, the first of which may be a last block."""
            if not end:
                return
            first = np.flatnonzero(np.r_[True, (np.diff(place[:end]) != 0) | (np.diff(key[:end]) != 0)])
            size = np.diff(np.r_[first, end])
            if cut:
                yield _long_list(place[0], key[0], cut, fp[: size[0]])
                first, size = first[1:], size[1:]
            two = first[size == 2]
            near = _near(fp[two], fp[two + 1], distance)
            edges = [np.stack([fp[two][near], fp[two + 1][near]])]
            edges += [_forest(fp[s : s + n], distance) for s, n in zip(first[size > 2], size[size > 2])]
            yield _edges(np.concatenate(edges, axis=1))

        for batch in batches:
            more = [batch[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("place", "bytes", "fp")]
            place, key, fp = (np.r_[x, y] for x, y in zip((place, key, fp), more))
            if not len(fp):
                continue
            last = np.flatnonzero((place != place[-1]) | (key != key[-1]))
            start = last[-1] + 1 if len(last) else 0
            if start:
                yield from lists(start)
                place, key, fp, cut = place[start:], key[start:], fp[start:], 0
            while len(fp) > block:
                yield _long_list(place[0], key[0], cut, fp[:block])
                place, key, fp, cut = place[block:], key[block:], fp[block:], cut + 1
        yield from lists(len(fp))

    found = scratch.write(
        postings.repartition("place", "bytes").sortWithinPartitions("place", "bytes", "fp")
        .mapInArrow(compare_lists, "a long, b long, place int, block int"),
        "lists",
    )
    long = found.where("place >= 0").select("place", F.col("b").alias("bytes"), "block", F.col("a").alias("fp"))
    blocks = long.groupBy("place", "bytes").agg(F.max("block").alias("last"))
    other = F.explode(F.sequence(F.lit(0), F.col("last")))
    pairs = long.join(blocks, ["place", "bytes"]).withColumn("other", other)
    pairs = pairs.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})

    def compare_blocks(table: pa.Table) -> pa.Table:
        members = np.unique(table["fp"].to_numpy().astype(np.int64))
        return pa.Table.from_arrays([pa.array(x) for x in _forest(members, distance)], ["a", "b"])

    crossed = pairs.groupBy("place", "bytes", "low", "high").applyInArrow(compare_blocks, "a long, b long")
    return found.where("place < 0").select("a", "b").union(crossed)


def _near(x: np.ndarray, y: np.ndarray, distance: int) -> np.ndarray:
    """Tally the bytes that both have in place, keep those that reach the minimum, verify the bits."""
    differ = (x ^ y).view(np.uint64)
    marks = differ | (differ >> np.uint64(4))
    marks |= marks >> np.uint64(2)
    marks |= marks >> np.uint64(1)
    shared = BYTES - np.bitwise_count(marks & np.uint64(0x0101010101010101))
    enough = shared >= BYTES - distance
    enough[enough] = np.bitwise_count(differ[enough]) <= distance
    return enough


def _forest(members: np.ndarray, distance: int) -> np.ndarray:
    """Edges from the first member of each linked set of distinct members to its others."""
    starts, ends = [], []
    while len(members) > 1:
        root, members, reached = members[0], members[1:], [members[0]]
        while reached and len(members):
            near = _near(members, reached.pop(), distance)
            if near.any():
                found = members[near]
                members = members[~near]
                starts += [root] * len(found)
                ends += found.tolist()
                reached += list(found)
    return np.array([starts, ends], dtype=np.int64)


def _edges(pairs: np.ndarray) -> pa.RecordBatch:
    flag = np.full(pairs.shape[1], -1, dtype=np.int32)
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (*pairs, flag, flag)], ["a", "b", "place", "block"])


def _long_list(place: int, key: int, block: int, fp: np.ndarray) -> pa.RecordBatch:
    full = lambda value, kind: np.full(len(fp), value, dtype=kind)
    columns = (fp, full(key, np.int64), full(place, np.int32), full(block, np.int32))
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["a", "b", "place", "block"])


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", *, width: int = 4, distance: int = 4, block: int = BLOCK
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fingerprint``, ``component_id``.

    ``fingerprint`` is 16 lowercase hex digits, ``component_id`` the smallest id
    that links reach. Documents link if their fingerprints differ in at most
    ``distance`` bits. A NULL text counts as empty; all texts without words link
    with each other. Rows with a NULL id take part and get the smallest id of
    their component, NULL if it has none; repeated ids each keep their row. Other
    columns of ``docs`` are not read. An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession)
    marked = scratch.write(fingerprints(docs, id, text, width), "fingerprints")
    first = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    first = scratch.write(first, "first")
    parts = connected_components(near_pairs(first.select("fp"), distance, block))
    parts = parts.withColumnRenamed("node", "fp").join(first, "fp")
    least = parts.groupBy("component").agg(F.min("first").alias("least"))
    reached = parts.join(least, "component").select("fp", "least")
    groups = first.join(reached, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id"))
    return marked.join(groups, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(
    docs: DataFrame, id: str = "doc_id", text: str = "text", *, width: int = 4, distance: int = 4, block: int = BLOCK
) -> DataFrame:
    """The rows of ``docs`` with one row of each group that ``near_duplicates`` links.

    The row with the smallest id stays, one without an id only if no row of its group has one;
    of rows with that id the one with the smallest fingerprint, then the smallest text. Rows
    are told apart by id *and* fingerprint, so unlike texts under one id all stay. All columns
    are returned as they are, whatever their names; an empty table gives an empty result.

    Only ids and fingerprints are written to scratch. Rows are matched by a second pass over
    the texts, and shuffled only where the table of chosen ids is too large to broadcast.
    """
    scratch = Scratch(docs.sparkSession)
    marked = scratch.write(
        fingerprints(docs, id, text, width).groupBy("doc_id", "fp").agg(F.count("*").alias("times")), "fingerprints"
    )
    parts = connected_components(near_pairs(marked.select("fp").distinct(), distance, block)).withColumnRenamed("node", "fp")
    rank = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "fp", "times")
    grouped = marked.join(parts, "fp", "left").groupBy(F.coalesce("component", "fp").alias("component"))
    chosen = scratch.write(grouped.agg(F.min(rank).alias("best")).select("best.*"), "chosen")

    @F.arrow_udf("long")
    def mark(texts: pa.Array) -> pa.Array:
        return pa.array(np.fromiter((fingerprint(t.as_py(), width) for t in texts), dtype="<u8", count=len(texts)).view("<i8"))

    rows = docs.select(
        F.struct("*").alias("row"), F.col(id).cast("long").alias("doc_id"), mark(F.col(text).cast("binary")).alias("fp"),
        F.col(text).cast("binary").alias("text"),
    )
    same = rows["doc_id"].eqNullSafe(chosen["doc_id"]) & (rows["fp"] == chosen["fp"])
    kept = rows.join(chosen.where("times = 1"), same, "left_semi").select("row.*")
    repeated = chosen.where("times > 1")
    if repeated.isEmpty():
        return kept
    again = rows.join(repeated, same, "left_semi").groupBy("doc_id", "fp").agg(F.min_by("row", F.struct("text", F.xxhash64("row"))).alias("row"))
    return kept.unionByName(again.select("row.*"))
