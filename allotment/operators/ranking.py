"""Normalisation, weighted scores and global ranks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..contracts import present_measures
from ..runtime import materialise

SMALLEST_RANGE = 1e-9
# measure -> (output column, higher is better)
NORMALISED = {
    "margin": ("margen_norm", True),
    "stability": ("estabilidad_norm", False),
    "distance": ("distancia_norm", False),
    "mean_margin": ("margen_bruto_prom_norm", True),
}


def min_max_normalise(
    df: DataFrame,
    *,
    margin: str = "margen_bruto_sum",
    stability: str = "cv_margen_bruto",
    distance: str = "distancia",
    mean_margin: str = "margen_bruto_prom",
    bounds: Mapping[str, tuple[float | None, float | None]] | None = None,
) -> DataFrame:
    """Add each present measure scaled to [0, 1] over the whole frame.

    Distance and stability are inverted (1 is best). Absent measures are
    skipped; a measure that is NULL everywhere stays NULL. Known ``bounds``
    (measure -> lowest, highest) save the pass that finds them; all others come
    from one aggregate, read back as a scalar subquery.
    """
    columns = {"margin": margin, "stability": stability, "distance": distance, "mean_margin": mean_margin}
    present = [name for name, there in present_measures(df, columns).items() if there]
    if bounds is not None:
        present = [name for name in present if name in bounds]
    if not present:
        return df
    values = {name: F.col(columns[name]).cast("double") for name in present}
    if bounds is None:
        stats = df.agg(*[
            F.struct(F.min(value), F.max(value)).alias(name) for name, value in values.items()
        ]).select(F.struct("*")).scalar()
        limits = {name: (stats[name]["col1"], stats[name]["col2"]) for name in present}
    else:
        limits = {name: tuple(F.lit(end).cast("double") for end in bounds[name]) for name in present}

    def scaled(name: str) -> Column:
        low, high = limits[name]
        share = (values[name] - low) / F.greatest(high - low, F.lit(SMALLEST_RANGE))
        return share if NORMALISED[name][1] else 1 - share

    return df.withColumns({NORMALISED[name][0]: scaled(name) for name in present})


def weighted_score(
    df: DataFrame,
    weights: tuple[float, float, float],
    columns: tuple[str, str, str],
    name: str = "score",
    digits: int | None = None,
) -> DataFrame:
    """Weighted sum of three columns; rows that lack one get the frame's lowest score.

    ``digits`` rounds the score, for comparison with a score computed elsewhere; by
    default different scores stay different.
    """
    total = sum((F.lit(w) * F.col(c) for w, c in zip(weights, columns)), start=F.lit(0.0))
    known = total if digits is None else F.round(total, digits)  # NULL as soon as one term is NULL
    lowest = df.agg(F.min(known)).scalar()
    return df.withColumn(name, F.coalesce(known, lowest))


def global_row_number(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """1..N over the whole frame without moving it into one partition.

    The frame is range-partitioned and sorted by ``order`` and written once
    together with each row's place in its partition; the place plus the sizes
    of all earlier partitions is the row number. ``order`` should end in a
    unique key: it settles ties and lets heavy ties be split between partitions.
    """
    sorted_rows = df.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id())
    placed = materialise(sorted_rows, "ranked")
    # Documented layout: partition in the upper 31 bits, place in the lower 33.
    part = F.shiftright("_slot", 33)
    place = F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1))
    # One row per partition of the sort, so both the window and the broadcast
    # are bounded by the number of shuffle partitions.
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(*df.columns, (F.col("_before") + place + 1).cast("bigint").alias(name))
    )


def rank_by_score(df: DataFrame, score: str, tie_break: str, name: str) -> DataFrame:
    """Rank by score, best first, NULL last; ties by ``tie_break``."""
    return global_row_number(df, [F.col(score).desc_nulls_last(), F.col(tie_break).asc_nulls_first()], name)
