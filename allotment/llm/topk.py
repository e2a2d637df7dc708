"""Exact top-k inner products by three-phase uniform thresholds."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import Scratch

#: Rows and queries of a block, queries that a task scores at once, and slices of the dimensions.
ROW_BLOCK, QUERY_BLOCK, AT_ONCE, SLICES = 16384, 1024, 128, 2
#: Row blocks and query blocks that meet in one task at most, the bytes that either may have there, the numbers of
#: groups of row blocks and of tasks that are made at least where there are as many blocks, and partitions at most.
ROW_GROUP, QUERY_GROUP, GROUP_BYTES, ROW_GROUPS, TASKS, PARTITIONS = 8, 64, 1 << 26, 32, 64, 2000


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False))


def quantised(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", scale: int = 64) -> DataFrame:
    """``vec_id`` and ``v``, the components times ``scale`` rounded down, of the usable vectors."""
    whole = F.transform(F.col(vector), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    return vectors.where(usable(F.col(vector))).select(F.col(id).cast("long").alias("vec_id"), whole.alias("v"))


def _matrix(vectors: pa.ChunkedArray, dim: int) -> np.ndarray:
    matrix = np.zeros((len(vectors), dim), dtype="<i8")
    for k, v in enumerate(vectors):
        matrix[k, : len(v.values)] = v.values.to_numpy(zero_copy_only=False)
    return matrix


def _bytes(numbers: np.ndarray, kind: str = "<i8") -> pa.Array:
    return pa.array([np.ascontiguousarray(numbers, dtype=kind).tobytes()], pa.binary())


def _largest(numbers: np.ndarray) -> int:
    return max(-int(numbers.min(initial=0)), int(numbers.max(initial=0)))


def _narrow(matrix: np.ndarray) -> str:
    """The smallest type that holds all numbers."""
    return next(kind for kind in ("<i1", "<i2", "<i4", "<i8") if kind == "<i8" or _largest(matrix) <= np.iinfo(kind).max)


def _row_blocks(rows: DataFrame, block: Column, dim: int) -> DataFrame:
    """One row per block: keys, ids and vectors of its rows as byte strings. Keys number the rows of all blocks."""

    def pack(table: pa.Table) -> pa.Table:
        ids, matrix = table["vec_id"].to_numpy(), _matrix(table["v"], dim)
        order = np.lexsort((*matrix.T[::-1], ids))
        ids, matrix = ids[order], matrix[order]
        new = np.r_[True, (ids[1:] != ids[:-1]) | (matrix[1:] != matrix[:-1]).any(axis=1)]  # repeated rows count once
        number = table["block"][0].as_py()
        keys = (np.int64(number) << 32) + np.arange(new.sum())
        return pa.table({"block": pa.array([number], pa.int64()), "key": _bytes(keys), "ids": _bytes(ids[new]), "matrix": _bytes(matrix[new], _narrow(matrix))})

    return rows.withColumn("block", block).groupBy("block").applyInArrow(pack, "block long, key binary, ids binary, matrix binary")


def _query_blocks(queries: DataFrame, dim: int, cut: bool = False) -> DataFrame:
    """One row per block of queries, the same way; with ``cut``, each query's cutoff."""

    def pack(table: pa.Table) -> pa.Table:
        matrix = _matrix(table["v"], dim)
        columns = {
            "block": pa.array([table["block"][0].as_py()], pa.int64()), "key": _bytes(table["key"].to_numpy()),
            "ids": _bytes(table["vec_id"].to_numpy()), "matrix": _bytes(matrix, _narrow(matrix)),
        }
        return pa.table(columns | ({"cut": _bytes(table["cut"].to_numpy())} if cut else {}))

    return queries.groupBy("block").applyInArrow(pack, "block long, key binary, ids binary, matrix binary" + ", cut binary" * cut)


def _number(largest: int, other: int, dim: int) -> type:
    """The smallest type in which products of such numbers and their sums are exact."""
    bound = float(largest) * float(other) * max(1, dim)
    return np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else np.int64


def _highest(part: np.ndarray, k: int, group: int = 32) -> np.ndarray:
    """Places of the ``k`` highest numbers of each line, or all: first the groups with the highest maxima, then inside."""
    lines, width = part.shape
    if width <= k * group:
        return np.argpartition(-part, k - 1, axis=1)[:, :k] if width > k else np.tile(np.arange(width), (lines, 1))
    many, whole = width // group, width // group * group
    highest = part[:, :whole].reshape(lines, group, many).max(axis=1)  # a group's places lie ``many`` apart, so whole lines are compared
    top = np.argpartition(-highest, k - 1, axis=1)[:, :k]
    places = (top[:, :, None] + np.arange(group) * many).reshape(lines, -1)
    places = np.concatenate([places, np.tile(np.arange(whole, width), (lines, 1))], axis=1)
    inside = np.argpartition(-np.take_along_axis(part, places, axis=1), k - 1, axis=1)[:, :k]
    return np.take_along_axis(places, inside, axis=1)


def exact_top_k(
    rows: DataFrame, is_query: Column, k: int = 20, *, slices: int = SLICES, row_block: int = ROW_BLOCK, query_block: int = QUERY_BLOCK
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: each query's ``k`` highest integer inner products.

    ``rows`` has ``vec_id`` and ``v`` (array of longs, see ``quantised``); ``is_query``
    is a condition on ``vec_id``. A query is compared with every row of another id;
    ties go to the smaller id; with fewer rows all are returned. Shorter vectors are
    filled up with zeros, repeated rows count once, NULL ids take no part; sums must
    fit a long. A score is the sum of the scores of a few slices of the dimensions:

    1. every block of rows lists, for each query and slice, its ``k`` highest slice scores;
       the rows on these lists are added up over all slices, which their block holds, and
       the k-th best of all blocks is a lower bound of the query's k-th score;
    2. this cutoff is sent along with the query blocks. A row that reaches it reaches its
       even share in one slice at least, so only rows that do so are collected;
    3. for these the remaining slices are added, rows below the cutoff fall out, and a
       block returns its ``k`` best at most.

    Queries and rows meet in blocks of fixed size, so memory does not grow. Equal
    ids with different vectors are rows of their own and share one list as queries.
    """
    scratch = Scratch(rows.sparkSession)
    rows = rows.where("vec_id is not null")
    count, dim = rows.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    n_rows = max(1, -(-count // row_block))
    slices = max(1, min(slices, dim))
    cuts = [(int(p[0]), int(p[-1]) + 1) for p in np.array_split(np.arange(max(dim, 1)), slices)]
    packed = scratch.write(_row_blocks(rows, F.pmod(F.xxhash64("vec_id"), F.lit(n_rows)).cast("long"), dim), "rows")

    def unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys, ids = (np.frombuffer(row[n], dtype="<i8") for n in ("key", "ids"))
        width = len(row["matrix"]) // max(1, len(ids) * dim) or 8
        return keys, ids, np.frombuffer(row["matrix"], dtype=f"<i{width}").reshape(len(ids), dim)

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, ids, matrix = unpacked(row)
                vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1, dtype=np.int32) * dim), pa.array(matrix.astype("<i8").ravel()))
                yield pa.RecordBatch.from_pydict({"key": keys, "vec_id": ids, "v": vectors})

    queries = scratch.write(packed.mapInArrow(members, "key long, vec_id long, v array<long>").where(is_query), "queries")
    n_queries = max(1, -(-queries.count() // query_block))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(n_queries)).cast("long"))

    def groups_of(blocks: int, size: int, most: int, least: int) -> int:
        """Into how many groups blocks go: those of one group hold GROUP_BYTES at most, as longs."""
        return max(-(-blocks // max(1, min(most, GROUP_BYTES // (8 * max(1, dim) * size)))), min(blocks, least))

    row_groups = groups_of(n_rows, row_block, ROW_GROUP, ROW_GROUPS)
    query_groups = groups_of(n_queries, query_block, QUERY_GROUP, -(-TASKS // row_groups))

    def met(query_blocks: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
        """``work`` on every group of row blocks with every group of query blocks.

        Each side is copied once per group of the other side and both are dealt by the two
        groups' numbers. A join of copied blocks would not do: the planner takes a table before
        it is copied for its size, and would send all copies through the driver by broadcast.
        """
        copied = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
        rows_there = packed.withColumn("row_group", F.col("block") % row_groups).withColumn("query_group", copied(query_groups))
        queries_there = query_blocks.withColumn("query_group", F.col("block") % query_groups).withColumn("row_group", copied(row_groups))
        dealt = (x.repartition(min(PARTITIONS, row_groups * query_groups), "row_group", "query_group") for x in (rows_there, queries_there))
        one, other = (x.groupBy("row_group", "query_group") for x in dealt)
        return one.cogroup(other).applyInArrow(work, schema)

    def scored(rows: pa.Table, asked: pa.Table) -> Iterator[tuple[dict, Iterator[tuple]]]:
        """A few queries at a time: their keys, ids and cutoffs, and for each block of rows the rows' keys
        and ids, the scores by slice, and the places of rows with the query's own id."""
        blocks = [unpacked(row) for row in rows.to_pylist()]
        given = [(row, *unpacked(row)) for row in asked.to_pylist()]
        kind = _number(max((_largest(x) for *_, x in blocks), default=0), max((_largest(q) for *_, q in given), default=0), dim)
        blocks = [(keys, ids, [x[:, a:b].T.astype(kind, order="C") for a, b in cuts]) for keys, ids, x in blocks]

        def against(q_ids: np.ndarray, part: np.ndarray) -> Iterator[tuple]:
            for keys, ids, sliced in blocks:
                first, last = np.searchsorted(ids, q_ids, "left"), np.searchsorted(ids, q_ids, "right")
                own = [(line, at) for line in np.flatnonzero(first < last) for at in range(first[line], last[line])]
                yield keys, ids, [part[:, a:b] @ x for (a, b), x in zip(cuts, sliced)], tuple(np.array(own, dtype=np.int64).reshape(-1, 2).T)

        for row, q_keys, q_ids, q in given:
            cut = np.frombuffer(row["cut"], dtype="<i8") if "cut" in row else q_keys
            for start in range(0, len(q_ids), AT_ONCE):
                some = slice(start, start + AT_ONCE)
                yield {"key": q_keys[some], "id": q_ids[some], "cut": cut[some]}, against(q_ids[some], q[some].astype(kind))

    def best(line: np.ndarray, score: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Places of the ``k`` best entries of each line; ties to the smaller id."""
        order = np.lexsort((ids, -score, line))
        line = line[order]
        return order[np.arange(len(line)) - np.searchsorted(line, line) < k]

    def of_all_blocks(found: list[tuple[np.ndarray, ...]]) -> list[np.ndarray]:
        """The ``k`` best entries (line, score, id, key) of each line over all blocks of rows."""
        entries = [np.concatenate(x) for x in zip(*found)]
        kept = best(*entries[:3])
        return [x[kept] for x in entries]

    def table(columns: tuple[str, ...], pieces: list[tuple[np.ndarray, ...]]) -> pa.Table:
        return pa.table({c: np.concatenate([np.zeros(0, "<i8"), *(piece[n] for piece in pieces)]) for n, c in enumerate(columns)})

    def gather(rows: pa.Table, asked: pa.Table) -> pa.Table:
        pieces = []
        for some, blocks in scored(rows, asked):
            found = []
            for keys, ids, parts, own in blocks:
                listed = np.concatenate([_highest(part, k + 1 + len(own[0])) for part in parts], axis=1)
                listed.sort(axis=1)
                new = np.c_[np.ones(len(listed), bool), listed[:, 1:] != listed[:, :-1]]
                line, at = np.nonzero(new)[0], listed[new]
                other = ~np.isin(line * len(ids) + at, own[0] * len(ids) + own[1])
                line, at = line[other], at[other]
                score = sum(part[line, at].astype(np.int64) for part in parts)
                kept = best(line, score, ids[at])
                found.append((line[kept], score[kept], ids[at[kept]], keys[at[kept]]))
            if found:
                line, score, _, key = of_all_blocks(found)
                pieces.append((some["key"][line], score, key))
        return table(("q", "score", "r"), pieces)

    plain = scratch.write(_query_blocks(queries, dim), "query_blocks")
    lists = met(plain, gather, "q long, score long, r long")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "r"))
    cutoffs = lists.withColumn("place", place).where(F.col("place") == k).select(F.col("q").alias("key"), F.col("score").alias("cut"))
    lowest = F.lit(-(1 << 62)).cast("long")
    cut = queries.join(cutoffs, "key", "left").withColumn("cut", F.coalesce("cut", lowest))
    armed = scratch.write(_query_blocks(cut, dim, cut=True), "armed")

    def resolve(rows: pa.Table, asked: pa.Table) -> pa.Table:
        pieces = []
        for some, blocks in scored(rows, asked):
            found, cut = [], some["cut"]
            for keys, ids, parts, own in blocks:
                share = -(-cut[:, None] // slices)
                reached = parts[0] >= share.astype(parts[0].dtype)
                for part in parts[1:]:
                    reached |= part >= share.astype(part.dtype)
                reached[own] = False
                line, at = np.divmod(np.flatnonzero(reached), len(ids))
                score = sum(part[line, at].astype(np.int64) for part in parts)
                enough = score >= cut[line]
                line, at, score = line[enough], at[enough], score[enough]
                kept = best(line, score, ids[at])
                found.append((line[kept], score[kept], ids[at[kept]], keys[at[kept]]))
            if found:
                line, score, ids, key = of_all_blocks(found)
                pieces.append((some["id"][line], ids, score, key))
        return table(("query_id", "vec_id", "score", "r"), pieces)

    found = met(armed, resolve, "query_id long, vec_id long, score long, r long")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id", "r"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
