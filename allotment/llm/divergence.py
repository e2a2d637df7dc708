"""How the sources of a language differ in their words, over a K-squared quadtree of counts."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import global_row_number
from .tables import Scratch

#: Terms that a task counts before it passes them on.
HELD = 1 << 18
#: Sides of a leaf and of a tree, and trees side by side in a strip. A tree is split into quadrants (K = 2).
LEAF, TREE, TREES = 8, 256, 16

# A-Z become small, all other ASCII characters but a-z blanks; other characters are kept as they are.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and non-ASCII characters of UTF-8 text, with A-Z lower-cased."""
    return text.translate(_LETTERS).split()


def _counted(docs: DataFrame, lang: str, source: str, text: str) -> DataFrame:
    """Partial (lang, source, term, times, documents), and one row with a NULL term per document's group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times, within = defaultdict(Counter), defaultdict(Counter)

        def told() -> Iterator[pa.RecordBatch]:
            for (lang, source), counter in times.items():
                words, size = list(counter), len(counter)
                documents = map(within[lang, source].__getitem__, words)
                columns = [
                    pa.array([lang] * (size + 1), pa.string()), pa.array([source] * (size + 1), pa.string()),
                    pa.array([*words, None], pa.binary()).cast(pa.string()),
                    pa.array([*counter.values(), 0], pa.int64()), pa.array([*documents, 0], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "times", "documents"])
            times.clear()
            within.clear()

        for batch in batches:
            held = sum(map(len, times.values()))
            for lang, source, value in zip(*(batch[k] for k in range(3))):
                group, words = (lang.as_py(), source.as_py()), terms(value.as_py())
                before = len(times[group])
                times[group].update(words)
                within[group].update(set(words))
                held += len(times[group]) - before
                if held >= HELD:
                    yield from told()
                    held = 0
        yield from told()

    read = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    slim = docs.select(read(lang).alias("lang"), read(source).alias("source"), read(text).cast("binary").alias("text"))
    return slim.mapInArrow(run, "lang string, source string, term string, times long, documents long")


def share(times: Column, total: Column) -> Column:
    """1 + floor(10 ** 9 * times / total) for 0 <= times <= total.

    Long division in three steps, so that no long overflows up to a total of 9 * 10 ** 15.
    """
    div = lambda a: F.call_function("div", a, total)
    whole, rest = div(times), times % total
    for _ in range(3):
        rest = rest * F.lit(1000).cast("long")
        whole, rest = whole * F.lit(1000).cast("long") + div(rest), rest % total
    return whole + F.lit(1).cast("long")


def _shares(times: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The same in numpy."""
    whole, rest = np.divmod(times, total)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + more
    return whole + 1


class Tree:
    """A K-squared tree (K = 2) over a square of counts, ``TREE`` groups by ``TREE`` terms.

    Each node has a mask of its four quadrants that are not all zero, level by level in
    Z-order; all-zero quadrants are not followed further. Nodes of side ``LEAF`` hold their counts.
    """

    DEPTH = (TREE // LEAF).bit_length() - 1

    def __init__(self, masks: np.ndarray, leaves: np.ndarray):
        self.masks, self.leaves = masks, leaves
        self.present, nodes, at = [], np.zeros(min(1, len(leaves)), dtype=np.int64), 0
        for level in range(self.DEPTH + 1):
            grid = np.zeros((1 << level, 1 << level), dtype=bool)
            grid[_unwoven(nodes)] = True
            self.present.append(grid)
            if level < self.DEPTH:
                inside = masks[at : at + len(nodes), None] >> np.arange(4, dtype=np.uint8) & 1
                at += len(nodes)
                nodes = (nodes[:, None] * 4 + np.arange(4))[inside.astype(bool)]
        self.place = np.full((1 << self.DEPTH,) * 2, -1, dtype=np.int64)
        self.place[_unwoven(nodes)] = np.arange(len(nodes))

    @classmethod
    def of(cls, rows: np.ndarray, columns: np.ndarray, counts: np.ndarray) -> Tree:
        """The tree of some cells of the square; every cell once."""
        codes, leaf = np.unique(_woven(rows // LEAF, columns // LEAF), return_inverse=True)
        leaves = np.zeros((len(codes), LEAF, LEAF), dtype=np.int64)
        leaves[leaf, rows % LEAF, columns % LEAF] = counts
        masks = []
        for _ in range(cls.DEPTH):
            parents, parent = np.unique(codes >> 2, return_inverse=True)
            mask = np.zeros(len(parents), dtype=np.uint8)
            np.bitwise_or.at(mask, parent, np.left_shift(1, codes & 3).astype(np.uint8))
            masks.insert(0, mask)
            codes = parents
        return cls(np.concatenate(masks), leaves)

    def packed(self) -> tuple[bytes, bytes]:
        return self.masks.tobytes(), self.leaves.astype("<i8").tobytes()

    @classmethod
    def unpacked(cls, masks: bytes, leaves: bytes) -> Tree:
        return cls(np.frombuffer(masks, dtype=np.uint8), np.frombuffer(leaves, dtype="<i8").reshape(-1, LEAF, LEAF))

    def priced(self, totals: np.ndarray, smooth: int) -> tuple[np.ndarray, np.ndarray]:
        """Shares of the leaves, those of an all-zero leaf of every row of leaves, and where each leaf's are."""
        by_rows = totals.reshape(-1, LEAF, 1)
        rows = np.nonzero(self.place >= 0)[0][np.argsort(self.place[self.place >= 0])]
        shares = _shares(self.leaves + smooth, by_rows[rows])
        blank = np.broadcast_to(_shares(np.full_like(by_rows, smooth), by_rows), (len(by_rows), LEAF, LEAF))
        where = np.where(self.place >= 0, self.place, len(shares) + np.arange(len(by_rows))[:, None])
        return np.concatenate([shares, blank]), where


def _woven(rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Z-order codes: the bits of row and column by turns."""
    code = np.zeros(len(rows), dtype=np.int64)
    for bit in range(Tree.DEPTH):
        code |= (rows >> bit & 1) << (2 * bit + 1) | (columns >> bit & 1) << (2 * bit)
    return code


def _unwoven(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    bits = range(Tree.DEPTH)
    return sum((code >> (2 * b + 1) & 1) << b for b in bits), sum((code >> (2 * b) & 1) << b for b in bits)


def apart(a: Tree, b: Tree, width: int, a_totals: np.ndarray, b_totals: np.ndarray, smooth: int) -> np.ndarray:
    """Sums of |share in a - share in b| over the first ``width`` columns, for all pairs of rows.

    Both trees are gone through together, from the root. Where the quadrants of both are
    all zero, every pair of their rows differs by the same for each column: the columns are
    only counted. Where one is not, its parts are visited; at the leaves cells are compared.
    """
    side = 1 << Tree.DEPTH
    zeros = np.zeros((side * LEAF, side * LEAF), dtype=np.int64)
    x, y, c = (np.zeros(1, dtype=np.int64) for _ in range(3))
    for level in range(Tree.DEPTH + 1):
        span = TREE >> level
        some = a.present[level][x, c] | b.present[level][y, c]
        columns = np.zeros((1 << level, 1 << level), dtype=np.int64)
        np.add.at(columns, (x[~some], y[~some]), np.clip(width - c[~some] * span, 0, span))
        zeros += columns.repeat(span, axis=0).repeat(span, axis=1)
        x, y, c = x[some], y[some], c[some]
        if level < Tree.DEPTH:
            x, y, c = ((2 * v[:, None] + (np.arange(8) >> k & 1)).ravel() for v, k in ((x, 2), (y, 1), (c, 0)))
    (a_shares, a_where), (b_shares, b_where) = a.priced(a_totals, smooth), b.priced(b_totals, smooth)
    sums = np.zeros((side, side, LEAF, LEAF), dtype=np.int64)
    for start in range(0, len(x), 2048):
        i, j, k = (v[start : start + 2048] for v in (x, y, c))
        gap = np.abs(a_shares[a_where[i, k]][:, :, None, :] - b_shares[b_where[j, k]][:, None, :, :])
        inside = k[:, None] * LEAF + np.arange(LEAF) < width
        np.add.at(sums, (i, j), (gap * inside[:, None, None, :]).sum(axis=3))
    blank = [_shares(np.full_like(t, smooth), t) for t in (a_totals, b_totals)]
    return sums.transpose(0, 2, 1, 3).reshape(zeros.shape) + zeros * np.abs(blank[0][:, None] - blank[1][None, :])


def _planted(cells: pa.Table) -> pa.Table:
    """The trees of a strip of some groups; rows without a column carry the groups' totals."""
    row, column, times = (cells[c].to_numpy() for c in ("row", "column", "times"))
    totals = np.ones(TREE, dtype=np.int64)
    told = column < 0
    totals[row[told] % TREE] = times[told]
    known = row[told].max() % TREE + 1
    row, column, times = row[~told] % TREE, column[~told] % (TREE * TREES), times[~told]
    masks, leaves = [], []
    for tree in range(TREES):
        here = column // TREE == tree
        packed = Tree.of(row[here], column[here] % TREE, times[here]).packed()
        masks.append(packed[0])
        leaves.append(packed[1])
    first = {c: [cells[c][0].as_py()] for c in ("lang", "block", "strip", "blocks", "kept")}
    arrays = {"totals": pa.array([totals[:known].tolist()], pa.list_(pa.int64()))}
    arrays |= {"masks": pa.array([masks], pa.list_(pa.binary())), "leaves": pa.array([leaves], pa.list_(pa.binary()))}
    return pa.table(first | arrays)


def _visited(smooth: int):
    def run(pair: pa.Table) -> pa.Table:
        """Sums of one strip for the pairs of groups of two blocks, or of one with itself."""
        strips = sorted(pair.to_pylist(), key=lambda r: r["block"])
        one, two = strips[0], strips[-1]
        filled = [np.r_[np.array(s["totals"]), np.ones(TREE - len(s["totals"]), dtype=np.int64)] for s in (one, two)]
        sums = np.zeros((TREE, TREE), dtype=np.int64)
        for tree in range(TREES):
            width = min(max(one["kept"] - (one["strip"] * TREES + tree) * TREE, 0), TREE)
            if width:
                trees = [Tree.unpacked(s["masks"][tree], s["leaves"][tree]) for s in (one, two)]
                sums += apart(*trees, width, *filled, smooth)
        g, h = np.divmod(np.arange(TREE * TREE), TREE)
        within = (g < len(one["totals"])) & (h < len(two["totals"])) & ((one["block"] < two["block"]) | (g < h))
        g, h = g[within], h[within]
        value = pa.array(sums[g, h])
        names = pa.array([one["lang"]] * len(g), pa.string())
        return pa.table({"lang": names, "a": pa.array(g + one["block"] * TREE), "b": pa.array(h + two["block"] * TREE), "value": value})

    return run


def divergences(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", *, least: int = 30, smooth: int = 5, top: int = 50
) -> DataFrame:
    """How far the sources of each language are apart in their words, and by which words.

    Columns ``lang``, ``source``, ``part``, ``item``, ``value`` (long) and ``rank`` (int). A
    language keeps the terms (see ``terms``) that at least ``least`` of its documents have. In a
    group (language, source), and in the language, each kept term has the ``share`` (times +
    ``smooth``) of (all times of kept terms + ``smooth`` * kept terms). Part ``pair``: the
    summed differences to each other source of the language, all ranks. Part ``term``: the
    terms that the group has, and more often than its language, with the difference, to rank
    ``top``. Larger values rank first, ties by the item's UTF-8 bytes.

    NULL texts, languages and sources count as ''. Groups without terms, and languages that
    keep none (all values 0), take part. Repeated rows count again. Other columns are not
    read, so their names don't matter; an empty table gives an empty result.

    Groups and kept terms are numbered per language (terms by falling number of documents, so
    that zeros lie together), and the counts laid out as squares of ``TREE`` groups by
    ``TREE`` terms, each a ``Tree``. A task gets one strip of ``TREES`` trees of two blocks of
    groups, however many documents a group has; its sums are added up by Spark. Pairs of
    blocks are those that the result asks for.
    """
    scratch = Scratch(docs.sparkSession)
    counted = _counted(docs, lang, source, text).groupBy("lang", "source", "term")
    cells = scratch.write(counted.agg(F.sum("times").alias("times"), F.sum("documents").alias("documents")), "cells")
    within = cells.where("term is not null").groupBy("lang", "term").agg(F.sum("documents").alias("documents"), F.sum("times").alias("all_times"))
    within = within.where(F.col("documents") >= least)
    kept = global_row_number(within, [F.col("lang"), F.col("documents").desc(), F.col("term")], "place")
    per_lang = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("all_times").alias("lang_times"), F.min("place").alias("first_place"))
    kept = kept.join(per_lang, "lang").select("lang", "term", "all_times", (F.col("place") - F.col("first_place")).alias("column"))
    matrix = scratch.write(
        cells.where("term is not null").join(kept, ["lang", "term"]).select("lang", "source", "term", "column", "times", "all_times"), "matrix"
    )

    groups = cells.where("term is null").select("lang", "source")
    groups = groups.join(matrix.groupBy("lang", "source").agg(F.sum("times").alias("group_times")), ["lang", "source"], "left")
    groups = global_row_number(groups, [F.col("lang"), F.col("source")], "place")
    blocks = groups.groupBy("lang").agg(F.min("place").alias("first_group"), F.ceil(F.count("*") / F.lit(TREE)).cast("long").alias("blocks"))
    number = lambda name: F.coalesce(F.col(name), F.lit(0).cast("long"))
    groups = groups.join(blocks, "lang").join(per_lang, "lang", "left").select(
        "lang", "source", (F.col("place") - F.col("first_group")).alias("row"), "blocks", number("kept").alias("kept"),
        (number("group_times") + number("kept") * smooth).alias("total"), (number("lang_times") + number("kept") * smooth).alias("lang_total"),
    )
    groups = scratch.write(groups, "groups")

    more = matrix.join(groups, ["lang", "source"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        (share(F.col("times") + smooth, F.col("total")) - share(F.col("all_times") + smooth, F.col("lang_total"))).alias("value"),
    ).where("value > 0")

    strip = TREE * TREES
    block = F.floor(F.col("row") / TREE).cast("long").alias("block")
    strips = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("kept") / strip).cast("long"), F.lit(1).cast("long")) - 1))
    bare = groups.select("lang", "row", "blocks", "kept", block, F.lit(-1).cast("long").alias("column"), F.col("total").alias("times"), strips.alias("strip"))
    full = matrix.join(groups, ["lang", "source"]).select(
        "lang", "row", "blocks", "kept", block, "column", "times", F.floor(F.col("column") / strip).cast("long").alias("strip")
    )
    trees = "lang string, block long, strip long, blocks long, kept long, totals array<long>, masks array<binary>, leaves array<binary>"
    planted = scratch.write(bare.unionByName(full).groupBy("lang", "block", "strip").applyInArrow(_planted, trees), "trees")
    dealt = planted.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other")
    sums = dealt.groupBy("lang", "low", "high", "strip").applyInArrow(_visited(smooth), "lang string, a long, b long, value long")
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = sums.select("lang", "value", F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
    names = groups.select("lang", F.col("row").alias("a"), "source")
    pairs = both.join(names, ["lang", "a"]).join(names.select("lang", F.col("a").alias("b"), F.col("source").alias("item")), ["lang", "b"])
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")).alias("rank")
    return pairs.select("*", rank).unionByName(more.select("*", rank).where(F.col("rank") <= top))
