"""Rolling window, monthly sums and accumulated measures."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.margin import guarded_ratio, homologated_key


def resolve_cutoff(cost_to_serve: DataFrame, cutoff: str | dt.date | None, date: str = "fecha") -> dt.date | None:
    """The given cutoff date, else the last date of the cost-to-serve table.

    The one value is fetched, so that the window becomes two date literals:
    the scan of the fact then prunes partitions, files and row groups on both
    bounds. (A scalar subquery reaches the scan for the upper bound only.)
    """
    if isinstance(cutoff, str):
        return dt.date.fromisoformat(cutoff)
    if cutoff is not None:
        return cutoff
    return cost_to_serve.agg(F.max(F.col(date)).try_cast("date")).first()[0]


def in_window(df: DataFrame, cutoff: dt.date | None, months: int, date: str = "fecha") -> DataFrame:
    """Rows from the month ``months - 1`` before the cutoff up to the cutoff, both ends in.

    Rows without a readable date drop out; without a cutoff all rows do.
    """
    end = F.lit(cutoff).cast("date")
    return df.filter(F.col(date).try_cast("date").between(F.add_months(end, 1 - months), end))


def as_amount(df: DataFrame, column: str) -> Column:
    """The column in its own numeric type; floats and texts as double.

    Decimals and integers give exact sums. Doubles keep all their digits, their
    range and NaN; their sums may differ in the last bits with the order of the rows.
    """
    if isinstance(df.schema[column].dataType, (T.DecimalType, T.IntegralType)):
        return F.col(column)
    return F.col(column).cast("double")


def mean_ratio(ratio: Column, below: float = 1e9) -> Column:
    """Mean of a double that does not depend on the order of the rows.

    Values are added up as decimals with 18 places. Those from ``below`` on, and
    NaN, would not fit and are added up as doubles.
    """
    fits = F.abs(ratio) < below
    exact = F.coalesce(F.sum(F.when(fits, ratio.cast("decimal(38,18)"))).cast("double"), F.lit(0.0))
    rest = F.coalesce(F.sum(F.when(~fits, ratio)), F.lit(0.0))
    return F.when(F.count(ratio) > 0, (exact + rest) / F.count(ratio))


def sums_by(df: DataFrame, keys: list[str], sums: Mapping[str, str]) -> DataFrame:
    """One row per key with the sum of each column (output name -> column)."""
    return df.groupBy(*keys).agg(*[F.sum(as_amount(df, column)).alias(name) for name, column in sums.items()])


def mean_monthly_ratio(
    df: DataFrame,
    key: str,
    *,
    date: str = "fecha",
    margin: str = "margen_bruto",
    sales: str = "venta_neta",
    name: str = "margen_porcentual_prom",
) -> DataFrame:
    """Mean over months of the guarded margin ratio; months without a ratio do not count."""
    monthly = sums_by(df, [key, date], {"_m": margin, "_s": sales})
    return monthly.groupBy(key).agg(mean_ratio(guarded_ratio(F.col("_m"), F.col("_s"))).alias(name))


def monthly_by_customer(
    profitability: DataFrame,
    *,
    customer: str = "cod_cliente",
    date: str = "fecha",
    margin: str = "cc_utilidad_bruta",
    sales: str = "valor_neto",
) -> DataFrame:
    """Margin and sales per customer and date."""
    return sums_by(profitability, [customer, date], {"margen_bruto": margin, "venta_neta": sales})


def accumulate_dates(by_date: DataFrame, key: str, also: Iterable[Column] = ()) -> DataFrame:
    """Margin sum, sales sum, their ratio and the mean monthly ratio per key.

    ``by_date`` holds one row per key and date. Aggregates in ``also`` come along.
    """
    ratio = guarded_ratio(F.col("margen_bruto"), F.col("venta_neta"))
    sums = by_date.groupBy(key).agg(
        F.sum("margen_bruto").alias("margen_bruto_sum"),
        F.sum("venta_neta").alias("venta_neta_sum"),
        mean_ratio(ratio).alias("margen_porcentual_prom"),
        *also,
    )
    overall = guarded_ratio(F.col("margen_bruto_sum"), F.col("venta_neta_sum"))
    return sums.withColumn("margen_porcentual", overall)


def accumulate(monthly: DataFrame, key: str, date: str = "fecha") -> DataFrame:
    """The same measures when a key may have several rows per date (customers of a chain)."""
    by_date = sums_by(monthly, [key, date], {"margen_bruto": "margen_bruto", "venta_neta": "venta_neta"})
    return accumulate_dates(by_date, key)


def link_months(monthly: DataFrame, links: DataFrame, customer: str = "cod_cliente") -> DataFrame:
    """Monthly sums under each chain listing of the customer, times its copies.

    Customers without a listing stand for themselves. Multiplying by ``copies``
    gives the sums of the fanned-out rows without producing those rows.
    """
    linked = homologate(monthly.join(links, customer, "left"), customer=customer)
    copies = F.coalesce(F.col("copies"), F.lit(1)).cast("int")
    return linked.withColumns({
        "margen_bruto": F.col("margen_bruto") * copies,
        "venta_neta": F.col("venta_neta") * copies,
    })


def chain_links(
    customers: DataFrame,
    on_duplicate: str = "fanout",
    *,
    customer: str = "cod_cliente",
    chain: str = "cod_cadena",
    group: str = "grupo_economico",
) -> DataFrame:
    """Customer -> chain, with ``copies``: how many dimension rows say so.

    A customer listed under several chains or groups counts once per listing in
    every sum (``fanout``). ``first`` keeps the smallest listing; ``error``
    makes the job fail when there is more than one.
    """
    listings = customers.select(customer, chain, group).distinct()
    if on_duplicate == "fanout":
        return listings.groupBy(customer, chain).agg(F.count("*").alias("copies"))
    if on_duplicate not in ("first", "error"):
        raise ValueError(f"on_duplicate must be fanout, first or error, not {on_duplicate!r}")
    smallest = F.min(F.struct(F.col(chain).isNull(), F.col(chain), F.col(group).isNull(), F.col(group)))
    picked = listings.groupBy(customer).agg(smallest.alias("_l"), F.count("*").alias("_n"))
    copies = F.lit(1).cast("bigint")
    if on_duplicate == "error":
        message = F.concat(F.lit("customer listed more than once: "), F.coalesce(F.col(customer), F.lit("NULL")))
        copies = F.when(F.col("_n") == 1, copies).otherwise(F.raise_error(message).cast("bigint"))
    return picked.select(customer, F.col("_l").getField(chain).alias(chain), copies.alias("copies"))


def homologate(
    df: DataFrame,
    *,
    customer: str = "cod_cliente",
    chain: str = "cod_cadena",
    name: str = "cod_cliente_homologado",
) -> DataFrame:
    """Add the key under which a customer is scored with its chain."""
    return df.withColumn(name, homologated_key(F.col(chain), F.col(customer)))
