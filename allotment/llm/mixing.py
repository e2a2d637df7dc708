"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import global_row_number
from .tables import Scratch

WORD = r"[^\x20\x09-\x0D]+"
#: Documents that one task pairs at the leaves, and groups that meet in one group on each level above.
LEAF, FAN = 2048, 1024
#: Open documents of a source, one of each size class, that are settled together at the end.
TOGETHER = 14


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sized: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: int = 3
) -> DataFrame:
    """One row per source: ``source``, ``place``, ``documents``, ``source_size``, ``target``.

    ``sized`` has ``source`` and ``size``. Sources in code point order, NULL last,
    take the weights in turn and share the sum of all sizes by them. A target stops
    at ``most`` times its source's size; what is over is shared again by weight
    among the others until no target is above its limit. The sources stay in tables:
    each sharing is one aggregate whose two sums come to the driver.
    """
    scratch = Scratch(sized.sparkSession)
    sources = sized.groupBy("source").agg(
        F.count("*").alias("documents"), F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("source_size")
    )
    sources = scratch.write(global_row_number(sources, [F.col("source").asc_nulls_last()], "place"), "sources")
    share = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    limit = (F.lit(most) * F.col("source_size")).cast("double")
    total, level = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0], 0.0
    while True:
        over = share * F.lit(level) > limit
        capped, open_weight = sources.agg(
            F.coalesce(F.sum(F.when(over, F.lit(most) * F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, share)), F.lit(0.0)),
        ).first()
        risen = (total - capped) / open_weight if open_weight else level
        if risen <= level:
            return sources.withColumn("target", F.when(over, limit).otherwise(share * F.lit(level)))
        level = risen


def pivot(rows: pd.DataFrame) -> pd.DataFrame:
    """Settle a group's fractional copies pair by pair; at most one stays open.

    ``rows``: ``doc_id``, ``size``, ``mass`` (words still open: between 0 and the
    size). Of two open documents a random amount of mass moves from one to the other,
    the most that either direction allows, with the odds that keep both expectations;
    one of them gets all its words or none. So the group's words stay the same. Long
    documents come first. Chance is a hash of the ids.
    """
    rows = rows.sort_values(["size", "doc_id"], ascending=[False, True], kind="stable", na_position="last").reset_index(drop=True)
    sizes, masses, extra = rows["size"].tolist(), rows["mass"].tolist(), [None] * len(rows)
    names = rows["doc_id"].astype("string").fillna("").tolist()

    def chance(one: str, two: str) -> float:
        return xxhash.xxh64_intdigest(f"{one}\x1f{two}", 42) / 2.0**64

    held = None
    for k in range(len(rows)):
        if held is None:
            held = k
            continue
        up, down = min(sizes[held] - masses[held], masses[k]), min(masses[held], sizes[k] - masses[k])
        if chance(names[held], names[k]) * (up + down) < down:
            full, empty = sizes[held] - masses[held] <= masses[k], masses[k] <= sizes[held] - masses[held]
            masses[held], masses[k] = masses[held] + up, masses[k] - up
            first, second = (1 if full else None), (0 if empty else None)
        else:
            empty, full = masses[held] <= sizes[k] - masses[k], sizes[k] - masses[k] <= masses[held]
            masses[held], masses[k] = masses[held] - down, masses[k] + down
            first, second = (0 if empty else None), (1 if full else None)
        extra[held], extra[k] = first, second
        held = held if first is None else k if second is None else None
    return rows.assign(mass=masses, extra=pd.array(extra, dtype="Int64"))


def close(rows: pd.DataFrame) -> pd.DataFrame:
    """Settle what the trees of a source's size classes left open: few documents, of different sizes.

    Of all choices among the ``TOGETHER`` longest of them the one that comes nearest to
    their open mass; shorter ones follow one by one, each going to the nearer side.
    """
    rows = rows.sort_values(["size", "doc_id"], ascending=[False, True], kind="stable", na_position="last").reset_index(drop=True)
    sizes, left = rows["size"].to_numpy(), float(rows["mass"].sum())
    sums = np.zeros(1)
    for size in sizes[:TOGETHER]:
        sums = np.r_[sums, sums + size]
    best = int(np.argmin(np.abs(sums - left)))
    extra = [best >> k & 1 for k in range(min(len(sizes), TOGETHER))]
    left -= sums[best]
    for size in sizes[TOGETHER:]:
        extra.append(int(size <= 2 * left))
        left -= extra[-1] * size
    return rows.assign(mass=0.0, extra=pd.array(extra, dtype="Int64"))


def mix(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    *,
    weights: tuple[float, ...] = (5, 2, 1),
    most: int = 3,
    leaf: int = LEAF,
    fan: int = FAN,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``size``, ``source_size``, ``target``, ``copies``, ``taken``, ``row``.

    ``size`` is the text's number of words (NULL text: 0). A document's expected
    copies are its source's target over its source's size (see ``source_targets``):
    the whole part is taken, the fractional part settled by ``pivot``. Documents of a
    source whose size has the same power of two as its floor are a class. Each class is
    first settled in groups of at most about ``leaf`` documents, dealt by a hash of the
    id, then what each group left open in groups of ``fan`` groups, and so on up a tree,
    so that no task sees more than that of a hot source. At the root one document of each
    class is open, and ``close`` settles these. ``copies`` is at most ``most``, ``taken``
    the copies times the size; a source's taken words miss its target by no more than
    half of one such document, and mostly by few words. Reruns agree. Documents without words are taken as often
    as the whole part says and add nothing. A NULL source is a source, a NULL id an
    id of its own; ids should mostly differ, as equal ones fall into one group.
    ``row`` numbers the rows of one id, in the order of source, size and text hash.
    An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession)
    same_id = Window.partitionBy("doc_id").orderBy("source", "size", "mark")
    sized = docs.select(
        F.col(id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"),
        words_in(F.col(text)).alias("size"),
        F.xxhash64(text).alias("mark"),
    )
    sized = scratch.write(sized.withColumn("row", F.row_number().over(same_id)).drop("mark"), "sized")
    sources = scratch.write(source_targets(sized, weights, most), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    groups = F.ceil(F.col("documents") / F.lit(leaf)).cast("long")
    shared = sources.select(
        F.col("source").alias("_source"), "place", "source_size", "target", groups.alias("groups"),
        F.floor(rate).cast("long").alias("whole"), (rate - F.floor(rate)).alias("part"),
    )
    rows = sized.join(shared, F.col("source").eqNullSafe(F.col("_source"))).select(
        "place", F.floor(F.log2(F.greatest("size", F.lit(1)))).alias("kind"), F.pmod(F.xxhash64("doc_id"), F.col("groups")).alias("group"),
        "doc_id", "row", "size", "whole", (F.col("size") * F.col("part")).alias("mass"), F.lit(None).cast("long").alias("extra"),
    )
    columns = rows.columns
    is_open = (F.col("mass") > 0) & (F.col("mass") < F.col("size"))
    open_rows, settled = rows.where(is_open), [rows.where(~is_open).withColumn("extra", F.lit(0).cast("long"))]
    top = sources.agg(F.max(groups)).first()[0] or 0

    level = 0
    while top:
        tree = open_rows.groupBy("place", "kind", "group").applyInPandas(lambda group: pivot(group)[columns], rows.schema)
        done = scratch.write(tree, f"level{level}")
        settled.append(done.where("extra is not null"))
        open_rows = done.where("extra is null").withColumn("group", F.floor(F.col("group") / fan).cast("long"))
        top, level = (-(-top // fan) if top > 1 else 0), level + 1
    settled.append(open_rows.groupBy("place").applyInPandas(lambda group: close(group)[columns], rows.schema))
    result = settled[0]
    for more in settled[1:]:
        result = result.union(more)
    copies = F.col("whole") + F.col("extra")
    return result.join(sources.select("place", "source_size", "target"), "place").select(
        "doc_id", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"), "row"
    )


def mixed_rows(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The rows of ``docs`` themselves, each as often as ``mix`` takes it, with all their columns."""
    same_id = Window.partitionBy("id").orderBy("source", "size", "mark")
    name = lambda column: F.coalesce(F.col(column).cast("long").cast("string"), F.lit("NULL"))
    taken = mix(docs, id, text, source, **options).where("copies > 0").select(
        name("doc_id").alias("id"), F.col("row").alias("_number"), "copies"
    )
    numbered = docs.select(
        F.struct("*").alias("row"), name(id).alias("id"), F.col(source).cast("string").alias("source"),
        words_in(F.col(text)).alias("size"), F.xxhash64(text).alias("mark"),
    ).withColumn("number", F.row_number().over(same_id))
    # The id alone is the key, as the rows lie by it already: the texts are shuffled once.
    joined = numbered.join(taken, "id").where((F.col("number") <= F.col("_number")) & (F.col("number") >= F.col("_number")))
    copies = joined.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return copies.select(*[F.col("row")[c].alias(c) for c in docs.columns])
