"""Near-duplicate vectors by spherical-cap filters with product codes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .tables import Scratch
from .topk import usable

#: Codes, filters of a code that a vector passes on average, vectors that a filter takes on
#: average, and rows of a filter that one task compares; longer ones are dealt out in blocks.
ROUNDS, PASSED, TAKEN, BLOCK = 3, 8, 64, 4096


class CapFilters:
    """Random directions with a product structure, and the caps around them.

    Every round turns the dimensions at random and cuts them into ``parts``; each part has
    ``codes`` random unit directions, and a filter direction is one code of every part,
    so a round has ``codes ** parts`` filters. A vector passes all filters whose
    direction it exceeds ``height`` with, and in each round the one closest to it.
    Rounds are independent, so that what one misses the next may find.
    """

    def __init__(self, dim: int, rows: int, parts: int = 2, rounds: int = ROUNDS, passed: float = PASSED, taken: float = TAKEN, seed: int = 7):
        chance = np.random.default_rng(seed)
        self.parts = max(1, min(parts, dim))
        self.codes = max(4, round((max(rows, 1) * passed / taken) ** (1 / self.parts)))
        self.cuts = [slice(int(c[0]), int(c[-1]) + 1) for c in np.array_split(np.arange(dim), self.parts)]
        self.turns = [np.linalg.qr(chance.standard_normal((dim, dim)))[0] for _ in range(rounds)]
        self.books = [[self._code(chance, cut.stop - cut.start) for cut in self.cuts] for _ in range(rounds)]
        self.height = self._calibrated(chance, dim, passed)

    def _calibrated(self, chance: np.random.Generator, dim: int, passed: float, trials: int = 256) -> float:
        """The height that random vectors pass ``passed`` filters of a round with, by halving."""
        units = chance.standard_normal((trials, dim))
        units /= np.linalg.norm(units, axis=1, keepdims=True)
        low, high = 0.0, 1.0
        for _ in range(24):
            self.height = (low + high) / 2
            count = self._passing(units @ self.turns[0], self.books[0])
            low, high = (self.height, high) if count > passed * trials else (low, self.height)
        return (low + high) / 2

    def _passing(self, turned: np.ndarray, books: list[np.ndarray]) -> int:
        """How many filters pass: sums of the parts before the last, and the codes of the last that lift them enough."""
        gains = [turned[:, cut] @ book.T / np.sqrt(self.parts) for cut, book in zip(self.cuts, books)]
        last = np.sort(gains[-1], axis=1)
        total = np.zeros((len(turned), 1))
        for gain in gains[:-1]:
            total = (total[:, :, None] + gain[:, None, :]).reshape(len(turned), -1)
        counts = [last.shape[1] - np.searchsorted(line, self.height - sums) for line, sums in zip(last, total)]
        return int(sum(c.sum() for c in counts))

    def _code(self, chance: np.random.Generator, dim: int) -> np.ndarray:
        book = chance.standard_normal((self.codes, dim))
        return book / np.linalg.norm(book, axis=1, keepdims=True)

    def passed(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row, filter) that pass, ordered by row and filter."""
        rounds = [self._round(units @ turn, books) for turn, books in zip(self.turns, self.books)]
        rows, filters = zip(*[(row, filter + k * self.codes**self.parts) for k, (row, filter) in enumerate(rounds)])
        pairs = np.unique(np.stack([np.concatenate(rows), np.concatenate(filters)]), axis=1)
        return pairs[0], pairs[1]

    def _round(self, turned: np.ndarray, books: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """List decoding: prefixes of codes grow part by part, and a prefix lives on only
        while the best codes of the parts to come could still lift it over the height."""
        gains = [turned[:, cut] @ book.T / np.sqrt(self.parts) for cut, book in zip(self.cuts, books)]
        best = [g.max(axis=1) for g in gains]
        rest = np.cumsum([np.zeros(len(turned)), *best[:0:-1]], axis=0)[::-1]
        row, filter, total = np.arange(len(turned)), np.zeros(len(turned), dtype=np.int64), np.zeros(len(turned))
        for gain, after in zip(gains, rest):
            lifted = total[:, None] + gain[row]
            at = np.nonzero(lifted + after[row][:, None] >= self.height)
            row, filter, total = row[at[0]], filter[at[0]] * self.codes + at[1], lifted[at]
        closest = np.zeros(len(turned), dtype=np.int64)
        for gain in gains:
            closest = closest * self.codes + gain.argmax(axis=1)
        return np.r_[row, np.arange(len(turned))], np.r_[filter, closest]


def _linked(x: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
    return x @ y.T >= least


def _first_shared(filters: CapFilters, units: np.ndarray, own: int) -> np.ndarray:
    """For every two rows whether no filter before ``own`` takes both: each pair counts in one filter."""
    row, filter = filters.passed(units)
    before = filter < own
    row, place = row[before], np.unique(filter[before], return_inverse=True)[1]
    if not len(row):
        return np.ones((len(units), len(units)), dtype=bool)
    member = np.zeros((len(units), place.max() + 1), dtype=np.float32)
    member[row, place] = 1
    return member @ member.T == 0


def _counted(filters: CapFilters, own: int, units: np.ndarray, weights: np.ndarray, split: int, least: float):
    """Links of one filter: weights added per row, and edges that connect what the links connect.

    With ``split`` rows in the first of two blocks only links between the blocks count.
    """
    near = _linked(units, units, least)
    np.fill_diagonal(near, False)
    if split:
        near[:split, :split] = near[split:, split:] = False
    touched = np.flatnonzero(near.any(axis=1))
    if not len(touched):
        return touched, touched, touched, touched
    near = near[np.ix_(touched, touched)] & _first_shared(filters, units[touched], own)
    added = near @ weights[touched]
    starts, ends, left = [], [], np.ones(len(touched), dtype=bool)
    for root in range(len(touched)):
        reached = [root] if left[root] else []
        left[root] = False
        while reached:
            found = np.flatnonzero(near[reached.pop()] & left)
            left[found] = False
            starts += [root] * len(found)
            ends += found.tolist()
            reached += found.tolist()
    return touched, added, touched[starts] if starts else touched[:0], touched[ends] if ends else touched[:0]


def near_vectors(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", *, least: float = 0.95,
    parts: int = 2, rounds: int = ROUNDS, passed: float = PASSED, taken: float = TAKEN, block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Two vectors link if their cosine, in double precision, is ``least`` or more and a
    filter takes both (see ``CapFilters``); ``n_links`` counts the other vectors that
    a vector links with, ``component_id`` is the smallest id that links reach, and
    ``kept`` tells whether it is the vector's own. Equal vectors are compared once
    and counted as often as they occur. Inside a filter the cosines of all its vectors
    are computed, a pair counts in its first shared filter only, and what leaves the
    task is a sum per vector and a spanning forest. A filter with more than ``block``
    rows is cut into blocks, every two of them a group of its own. Vectors that are
    NULL, empty, zero, or hold NULL or non-finite components link with nothing, nor do
    rows with a NULL id; their component is their id. Equal ids with different vectors
    share links. Vectors of another length than the longest are filled with zeros.
    """
    scratch = Scratch(vectors.sparkSession)
    rows = vectors.select(F.col(id).cast("long").alias("vec_id"), F.col(vector).alias("v"))
    fits = F.coalesce(usable(F.col("v")) & F.exists("v", lambda x: x != 0) & F.col("vec_id").isNotNull(), F.lit(False))
    rows = scratch.write(rows.withColumn("mark", F.when(fits, F.xxhash64("v"))), "rows")
    distinct = rows.where("mark is not null").groupBy("mark", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    distinct = scratch.write(distinct, "distinct")
    count, dim = distinct.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    filters = CapFilters(dim, count, parts, rounds, passed, taken)

    def units(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
        matrix = np.zeros((len(column), dim))
        for k, v in enumerate(column):
            matrix[k, : len(v.values)] = v.values.to_numpy(zero_copy_only=False)
        matrix /= np.abs(matrix).max(axis=1, keepdims=True)
        return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                row, filter = filters.passed(units(part["v"]))
                taken = [part[c].take(pa.array(row)) for c in ("rep", "copies", "v")]
                yield pa.RecordBatch.from_arrays([pa.array(filter), *taken], ["filter", "rep", "copies", "v"])

    kind = dict(distinct.dtypes)["v"]
    listed = distinct.mapInArrow(index, f"filter long, rep long, copies long, v {kind}")

    def found(table: pa.Table, split: int = 0) -> pa.RecordBatch:
        rep, copies = (table[c].to_numpy() for c in ("rep", "copies"))
        touched, added, a, b = _counted(filters, table["filter"][0].as_py(), units(table["v"]), copies, split, least)
        none = lambda n: pa.nulls(n, pa.int64())
        sums = [pa.array(rep[touched]), none(len(touched)), pa.array(added, pa.int64())]
        edges = [pa.array(rep[a]), pa.array(rep[b]), none(len(a))]
        return pa.RecordBatch.from_arrays([pa.concat_arrays([x, y]) for x, y in zip(sums, edges)], ["a", "b", "links"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, table in _runs(batches, "filter", block):
            if number is None:
                if table.num_rows > 1:
                    yield _widened(found(table), None, None, kind)
            else:
                yield _widened(None, table, number, kind)

    schema = f"a long, b long, links long, filter long, block int, rep long, copies long, v {kind}"
    outcome = scratch.write(listed.repartition("filter").sortWithinPartitions("filter", "rep").mapInArrow(compare, schema), "outcome")
    long = outcome.where("filter is not null").select("filter", "block", "rep", "copies", "v")
    last = long.groupBy("filter").agg(F.max("block").alias("last"))
    pairs = long.join(last, "filter").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
    pairs = pairs.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("last", "other")

    def compare_blocks(table: pa.Table) -> pa.Table:
        table = table.sort_by([("block", "ascending"), ("rep", "ascending")])
        numbers = table["block"].to_numpy()
        return pa.Table.from_batches([found(table, int((numbers == numbers[0]).sum()) if numbers[0] != numbers[-1] else 0)])

    crossed = pairs.groupBy("filter", "low", "high").applyInArrow(compare_blocks, "a long, b long, links long")
    links = scratch.write(outcome.where("filter is null").select("a", "b", "links").union(crossed), "links")
    parts_of = connected_components(links.where("b is not null")).select(F.col("node").alias("rep"), "component")
    sums = links.where("links is not null").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    known = distinct.join(sums, "rep", "left").join(parts_of, "rep", "left").select(
        F.col("mark").alias("_mark"), F.col("v").alias("_v"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "rep").alias("component"),
    )
    joined = rows.join(known, (F.col("mark") == F.col("_mark")) & (F.col("v") == F.col("_v")), "left")
    component = F.coalesce("component", "vec_id")
    return joined.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"),
    )


def _widened(links: pa.RecordBatch | None, rows: pa.Table | None, number: int | None, kind: str) -> pa.RecordBatch:
    """Found links, or the rows of a block, in the columns of both."""
    value = pa.list_(pa.float32() if "float" in kind else pa.float64())
    size = links.num_rows if links is not None else rows.num_rows
    empty = {n: pa.nulls(size, t) for n, t in (
        ("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64()), ("filter", pa.int64()), ("block", pa.int32()),
        ("rep", pa.int64()), ("copies", pa.int64()), ("v", value),
    )}
    if links is not None:
        empty |= {n: links[n] for n in ("a", "b", "links")}
    else:
        empty |= {n: rows[n].combine_chunks() for n in ("filter", "rep", "copies", "v")} | {"block": pa.array([number] * size, pa.int32())}
    return pa.RecordBatch.from_arrays(list(empty.values()), list(empty))


def _runs(batches: Iterator[pa.RecordBatch], key: str, block: int) -> Iterator[tuple[int | None, pa.Table]]:
    """Runs of equal keys from sorted batches: (None, the run), or (number, rows) for the blocks of a long run."""
    held, number = None, 0
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        keys = held[key].to_numpy()
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        for start, end in zip(starts, starts[1:]):
            yield (number if number else None), held.slice(start, end - start)
            number = 0
        held = held.slice(starts[-1])
        while held.num_rows > block:
            yield number, held.slice(0, block)
            held, number = held.slice(block), number + 1
    if held is not None and held.num_rows:
        yield (number if number else None), held
