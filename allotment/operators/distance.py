"""Customer to distribution centre."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import CENTRE_SCHEMA, DISTRIBUTION_CENTRES
from ..functions.geo import great_circle_km, parse_coordinate


def centres(spark: SparkSession, rows: Iterable[tuple] = DISTRIBUTION_CENTRES) -> DataFrame:
    """The distribution centres as a literal relation."""
    return spark.createDataFrame(list(rows), CENTRE_SCHEMA)


def of_centres(customers: DataFrame, codes: Iterable[object], centre: str = "id_centro") -> DataFrame:
    """Customers served by one of the centres."""
    return customers.filter(F.col(centre).cast("string").isin([str(code) for code in codes]))


def parse_coordinates(customers: DataFrame, lat: str = "latitud", lon: str = "longitud") -> DataFrame:
    """Replace the noisy coordinate texts by degrees."""
    return customers.withColumns({
        lat: parse_coordinate(F.col(lat).cast("string")),
        lon: parse_coordinate(F.col(lon).cast("string")),
    })


def distance_to_centre(
    customers: DataFrame,
    centre_rows: DataFrame | Iterable[tuple],
    *,
    centre: str = "id_centro",
    lat: str = "latitud",
    lon: str = "longitud",
) -> DataFrame:
    """Add ``distancia`` in km; NULL without coordinates or without a known centre.

    Literal rows, held in the program, are broadcast; for a frame the planner goes by
    its size.
    """
    located = parse_coordinates(customers, lat, lon).withColumn(centre, F.col(centre).cast("string"))
    if not isinstance(centre_rows, DataFrame):
        centre_rows = F.broadcast(centres(customers.sparkSession, centre_rows))
    joined = located.join(centre_rows, centre, "left")
    km = great_circle_km(F.col(lat), F.col(lon), F.col("latitud_centro"), F.col("longitud_centro"))
    return joined.withColumn("distancia", km).drop("latitud_centro", "longitud_centro")


def max_distance_by(df: DataFrame, key: str, distance: str = "distancia") -> DataFrame:
    """Largest known distance per key."""
    return df.groupBy(key).agg(F.max(distance).alias(distance))
